"""Components of the n-gram join against all pairs, with and without shingles that count as hot."""

import os
import sys
from random import Random
from types import SimpleNamespace

import pytest

from indicata.llm import ngram_join

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_pipeline import components  # noqa: E402


def corpus(n, seed):
    """Families of near copies; most texts hold one common passage."""
    rand = Random(seed)
    common = [f"c{i}" for i in range(12)]
    rows = []
    for i in range(n):
        family = Random(rand.randrange(n // 5))
        words = [f"w{family.randrange(400)}" for _ in range(family.choice([6, 30, 80]))]
        for _ in range(rand.randrange(4)):
            words[rand.randrange(len(words))] = f"e{rand.randrange(50)}"
        if rand.random() < 0.7:
            words += common
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("hot", [None, (2, 1000, 2, 3), (1, 1000, 1, 2)])
def test_components_equal_all_pairs(spark, monkeypatch, hot):
    if hot:
        for name, value in zip(("HOT_DOCS", "HOT_PART", "HOT_SAMPLE", "SALTS"), hot):
            monkeypatch.setattr(ngram_join, name, value)
    rows = corpus(220, 8)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in ngram_join.link(df).collect()}
    assert found == components([SimpleNamespace(doc_id=d, text=t) for d, t in rows])
    assert 1 < len(set(found.values())) < len(rows)


def test_rows_of_a_hot_shingle_are_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_SAMPLE", 4)
    monkeypatch.setattr(ngram_join, "HOT_DOCS", 100)
    rows = spark.range(4000).selectExpr("id AS doc", "explode(array(7L, id + 100)) AS token")
    hot = ngram_join._hot(rows.where(ngram_join._sampled("doc")), 4000)
    ((token, about),) = hot.collect()
    assert token == 7 and abs(about - 4000) < 800
    shared = ngram_join._shared(rows, hot)
    assert shared.columns == ["token", "doc", "cost"]
    assert {(r.token, r.cost) for r in shared.collect()} == {(7, about)} and shared.count() == 4000
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(token" in plan and "dealt" in plan.split("hashpartitioning(token")[1][:60]
