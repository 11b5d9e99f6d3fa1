"""Connected components by contraction, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm import common as C


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for the nodes of edges (``a``, ``b``).

    Each round every node joins its smallest neighbour (or stays, if it is smaller than all), edges are
    relabelled, and those within a node disappear. What is left at least halves per round in all but odd
    graphs, and every step is an aggregate or an equality join of edge size. Nulls and loops are ignored.
    """
    edges = C.cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        step = step.select("node", F.least("node", "low").alias("next"))
        further = step.select(F.col("node").alias("next"), F.col("next").alias("root"))
        step = C.cut(step.join(further, "next").select("node", "root"))
        if nodes is None:
            nodes = step
        else:
            onward = step.select(F.col("node").alias("root"), F.col("root").alias("new"))
            nodes = C.cut(nodes.join(onward, "root", "left").select("node", F.coalesce("new", "root").alias("root")))
        a = step.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        b = step.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        moved = edges.join(a, "a").join(b, "b").where("root_a <> root_b")
        edges = C.cut(moved.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct())
    return nodes if nodes is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
