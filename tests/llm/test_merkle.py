"""Merkle manifests against a plain tree, at small fanouts so that blocks exchange over several rounds."""

import zlib
from hashlib import sha256
from random import Random

import pytest
from pyspark.sql import functions as F

from indicata.llm import merkle as M

TYPE = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes, fanout):
    """Root, and the siblings before and after of each leaf by level."""
    steps = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for own, k in zip(steps, at):
            first = k // fanout * fanout
            own.append(("".join(nodes[first:k]), "".join(nodes[k + 1 : first + fanout])))
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [k // fanout for k in at]
    return nodes[0], steps


def plain_manifest(rows, fanout):
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(r)))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    lower = {s: plain_tree([x[2] for x in sorted(trees[s])], fanout) for s in names}
    root, upper = plain_tree([lower[s][0] for s in names], fanout)
    found = []
    for s, above in zip(names, upper):
        for (known, doc, leaf), own in zip(sorted(trees[s]), lower[s][1]):
            found.append((doc if known else None, s, leaf, lower[s][0], root, tuple(own + above)))
    return sorted(found, key=repr)


def rows_of(df):
    return sorted(
        ((r.order, r.source, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.steps)) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize(("fanout", "local", "n"), [(2, 1, 83), (3, 1, 140), (2, 2, 61), (4, 1, 65), (16, 3, 300), (2, 1, 1)])
def test_manifest_equals_plain_trees(spark, fanout, local, n):
    rand = Random(n)
    rows = [
        (rand.choice([i, i, i, None]), rand.choice(["hot"] * 9 + ["é", "b", "", None]), "en", len(str(i)), rand.choice([f"T{i}é", None, ""]))
        for i in range(n)
    ]
    rows += rows[:5]  # repeated rows
    df = spark.createDataFrame(rows, TYPE).repartition(3).withColumn("leaf", F.lit("x")).withColumn("tree", F.lit(1))
    found = M.manifest(df, fanout=fanout, local=local, carry=["leaf", "tree"])
    assert rows_of(found) == plain_manifest(rows, fanout)
    again = found.select((M.folded("leaf") == F.col("root")).alias("same"), "row.tree").distinct().collect()
    assert [tuple(r) for r in again] == [(True, 1)]


def test_a_source_of_each_row(spark):
    rows = [(1, f"s{i:03}", None, i, "x" * (200_000 if i == 7 else 1)) for i in range(70)]
    found = M.manifest(spark.createDataFrame(rows, TYPE), fanout=2, local=1)
    assert rows_of(found) == plain_manifest(rows, 2)


def test_empty_table(spark):
    assert M.manifest(spark.createDataFrame([], TYPE)).collect() == []


def test_tampered_rows_are_found(spark, tmp_path):
    rows = [(i, f"s{i % 3}", "en", 3, ["Abc", "abc", None][i % 3 if i % 7 else 0]) for i in range(100)]
    spark.createDataFrame(rows, TYPE).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in M.op12_merkle_manifest(spark, str(tmp_path)).collect()}
    for doc, _, _, _, text in rows:
        changed = zlib.crc32(str(doc).encode()) % 5 == 0 and text == "Abc"
        assert found[doc].verified is not changed
        assert (found[doc].folded_root == found[doc].root) is not changed
    proofs = {r[0]: r[5] for r in plain_manifest(rows, 16)}
    for doc, r in found.items():
        assert r.proof_sha256 == h(*(a + b for a, b in proofs[doc]))
