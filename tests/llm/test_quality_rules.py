"""Counts against a plain count, EM against votes of known accuracy, labels, and edge rows."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicata.llm import quality_rules as Q

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            repeated.update(range(i, i + 8))
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def measured(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = rows.select("doc_id", Q.signals(F.col("text")).alias("s")).orderBy("doc_id").collect()
    return [tuple(r.s)[:5] for r in found]


def test_counts_of_odd_texts(spark):
    texts = [
        None,
        "",
        " \n\t\n ",
        "one",
        "a\x1cb \x85 \xa0 c d",
        "é # ü\n|é # ü\né # ü\n\n\né # ü",
        "x " * 5000,
        "a b c d e f g h " * 3 + "tail",
        "z" * 300_000,
        "w%d " * 10,
        " ".join(f"w{i}" for i in range(30_000)),
        "a b c d e f g h",
    ]
    assert measured(spark, texts) == [plain_counts(t) for t in texts]


def test_counts_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = {r.doc_id: tuple(r)[1:6] for r in Q.op1_quality_rules(spark, FOLDER).collect()}
    assert found == {d.doc_id: plain_counts(d.text) for d in docs}


def test_verdict_is_the_posterior_of_a_plain_em(spark):
    rows = Q.op1_quality_rules(spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", Q.signals(F.col("text")).alias("s"))
    votes = {
        r[0]: r[1:] for r in docs.where(~Q.base_failed("s")).select("doc_id", *[Q.vote(rule, "s") for rule in Q.RULES]).collect()
    }
    n = len(Q.RULES)
    right, caught, prior = [0.99] * n, [0.4] * n, 0.8

    def posterior(v):
        good, bad = prior, 1 - prior
        for x, a, b in zip(v, right, caught):
            good *= {1: a, 0: 1, -1: 1 - a}[x]
            bad *= {1: 1 - b, 0: 1, -1: b}[x]
        return good / (good + bad)

    for _ in range(200):
        p = {d: posterior(v) for d, v in votes.items()}
        good = [(sum(p[d] for d, v in votes.items() if v[j] > 0), sum(p[d] for d, v in votes.items() if v[j])) for j in range(n)]
        bad = [(sum(1 - p[d] for d, v in votes.items() if v[j] < 0), sum(1 - p[d] for d, v in votes.items() if v[j])) for j in range(n)]
        heard = [p[d] for d, v in votes.items() if any(v)]
        fresh = (
            [min(0.9999, max(0.5, (x + 0.99) / (y + 1))) for x, y in good],
            [min(0.9999, max(0.001, (x + 0.4) / (y + 1))) for x, y in bad],
            min(0.98, max(0.02, sum(heard) / len(heard))),
        )
        moved = max(abs(a - b) for a, b in zip([*fresh[0], *fresh[1], fresh[2]], [*right, *caught, prior]))
        right, caught, prior = fresh
        if moved < 1e-10:
            break
    for r in rows:
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed
        if failed:
            assert not r.kept
            continue
        assert r.quality_probability == pytest.approx(posterior(votes[r.doc_id]), abs=1e-6)
        assert r.kept == (posterior(votes[r.doc_id]) >= 0.5)


def test_labels_agree(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = Q.op1_quality_rules(spark, FOLDER).join(labels, "doc_id").where("n_words >= 20").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) / len(rows) > 0.97
    good = [r for r in rows if r.quality == 1]
    assert sum(r.kept for r in good) / len(good) > 0.97


@pytest.mark.parametrize(
    ("on_good", "on_bad"),
    [
        ([0.99, 0.985, 0.995, 0.98], [0.6, 0.7, 0.5, 0.8]),
        ([0.8, 0.85, 0.9, 0.8], [0.8, 0.7, 0.75, 0.9]),  # rules that misfire on one good text in five to ten
        ([0.9, 0.99, 0.8, 0.99, 0.99], [0.6, 0.7, 0.8, 0.5, 0.6]),
        ([0.99, 0.98, 0.97, 0.99], [0.05, 0.9, 0.8, 0.7]),  # one that hardly ever catches anything
    ],
)
def test_em_finds_known_accuracies(on_good, on_bad):
    rng = np.random.default_rng(1)
    truth = rng.random(50_000) < 0.7
    votes = np.zeros((len(truth), len(on_good)))
    for j, (a, b) in enumerate(zip(on_good, on_bad)):
        right = rng.random(len(truth)) < np.where(truth, a, b)
        heard = rng.random(len(truth)) < 0.8
        votes[:, j] = np.where(heard, np.where(right == truth, 1, -1), 0)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = Q.expectation_maximisation(patterns, counts.astype(float))
    assert model.on_good == pytest.approx(on_good, abs=0.03)
    assert model.on_bad == pytest.approx(on_bad, abs=0.05)
    assert model.prior == pytest.approx(0.7, abs=0.03)
    odds = np.full(len(truth), np.log(model.prior / (1 - model.prior)))
    for j, (a, b) in enumerate(zip(model.on_good, model.on_bad)):
        odds += np.where(votes[:, j] > 0, np.log(a / (1 - b)), 0) + np.where(votes[:, j] < 0, np.log((1 - a) / b), 0)
    assert (odds[truth] >= 0).mean() > 0.93


def test_judge_leaves_columns_of_its_names(spark):
    table = spark.createDataFrame([(1, "word " * 30, "k", "b")], "doc_id long, text string, kept string, base_failed string")
    rows = table.withColumn("s", Q.signals(F.col("text")))
    found = Q.judge(rows, Q.fit(rows)).first()
    assert (found.kept, found.base_failed) == ("k", "b") and found._base_failed is True and found._kept is False


def test_edge_tables(spark):
    schema = "doc_id long, text string, s string, kept string, n_words int"
    empty = spark.createDataFrame([], schema)
    assert Q.keep_good(empty).collect() == []
    good = " ".join(f"word{i}." for i in range(80))
    rows = [(None, good, "x", None, 1), (1, good, None, "y", 2), (1, good, None, "y", 2), (2, None, "x", "x", 3), (3, "", None, None, None)]
    table = spark.createDataFrame(rows, schema)
    kept = Q.keep_good(table)
    assert kept.dtypes == table.dtypes
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(rows[:3], key=repr)
