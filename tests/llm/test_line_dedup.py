"""Line dedup against a plain count, its filters, and edge rows."""

from collections import Counter
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicata.llm import line_dedup as L

SPACE = " \t\n\x0b\f\r"


def key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(SPACE))


def plain(rows, min_docs, keep_first=False, min_chars=1):
    """Kept text of each row (id, text), in order."""
    texts = [(t or "").split("\n") for _, t in rows]
    counts = Counter(k for lines in texts for k in {key(x) for x in lines})
    often = {k for k, n in counts.items() if n >= min_docs and len(k) >= min_chars}
    first = {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0)):
        for at, x in enumerate(texts[i]):
            first.setdefault(key(x), (i, at))
    kept = []
    for i, lines in enumerate(texts):
        stay = [x for at, x in enumerate(lines) if key(x) not in often or keep_first and first[key(x)] == (i, at)]
        kept.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    return kept


def corpus(n=120, seed=3):
    rand = Random(seed)
    common = ["Cookie policy", "  cookie POLICY\t", "All rights reserved.", "É", "é", "", " \x0b", " x"]
    return [
        (i, "\n".join(rand.choice([rand.choice(common), f"line {rand.randrange(40)}", f"own {i}"]) for _ in range(rand.randrange(12))))
        for i in range(n)
    ]


def kept(df):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in df.collect()}


@pytest.mark.parametrize("options", [{}, {"keep_first": True, "min_docs": 2}, {"min_docs": 3, "min_chars": 7}, {"max_words": 1}])
def test_dedup_equals_plain_count(spark, options):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    asked = {k: v for k, v in options.items() if k != "max_words"}
    expected = dict(zip((r[0] for r in rows), plain(rows, asked.pop("min_docs", L.MIN_DOCS), **asked)))
    assert kept(L.dedup(df, **options)) == expected
    assert any(n for _, n, _ in expected.values())


def test_edge_rows(spark):
    long = "w " * 300_000 + "\n" + "x" * 300_000
    rows = [(None, "a\nown"), (None, "a\nother"), (1, "A \n b"), (1, "\ta"), (2, None), (3, ""), (4, "\n\n"), (5, long), (6, long)]
    extra = "doc_id long, text string, n_lines string, line_key int, who int"
    df = spark.createDataFrame([(*r, "n", 7, 8) for r in rows], extra)
    done = L.dedup(df, min_docs=2)
    assert done.columns == ["doc_id", "text", "n_lines", "line_key", "who", "_n_lines", "n_dropped", "kept_text"]
    found = sorted(((r.doc_id, r.text, r._n_lines, r.n_dropped, r.kept_text) for r in done.collect()), key=repr)
    assert found == sorted(((*r, *p) for r, p in zip(rows, plain(rows, 2))), key=repr)
    assert {(r.n_lines, r.line_key, r.who) for r in done.collect()} == {("n", 7, 8)}


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "same\nmore")] * 10 + [(2, "same")], "doc_id long, text string")
    found = [tuple(r)[2:] for r in L.dedup(df).collect()]
    assert sorted(found) == [(1, 1, "")] + [(2, 2, "")] * 10
    assert L.dedup(df.limit(0)).collect() == []


def test_merged_filters_miss_no_repeat():
    rand = np.random.default_rng(2)
    parts = [rand.integers(0, 1 << 63, 3000, dtype=np.int64).astype(np.uint64) for _ in range(4)]
    shared = rand.integers(0, 1 << 63, 200, dtype=np.int64).astype(np.uint64)
    parts[0] = np.append(parts[0], shared[:100])
    parts[2] = np.append(parts[2], shared)
    parts[3] = np.append(parts[3], shared[100:])
    words = 1 << 11
    merged = L.Pair(words)
    for part in parts:
        pair = L.Pair(words)
        for some in np.array_split(part, 7):
            pair.add(some)
        at = np.flatnonzero(pair.once)
        merged.merge(at, pair.once[at], pair.twice[at])
    at, bits = L.places(shared, words)
    assert ((merged.twice[at] & bits) == bits).all()
    single = parts[1]
    at, bits = L.places(single, words)
    assert ((merged.twice[at] & bits) == bits).mean() < 0.02


def test_single_lines_do_not_leave_their_task(spark):
    df = spark.createDataFrame([(i, f"line of {i}\nshared {i // 2}") for i in range(400)], "doc_id long, text string")
    gone = L.repeated_lines(df, min_docs=2)
    assert gone.agg(F.sum(F.size("lines"))).first()[0] == 400
