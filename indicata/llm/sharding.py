"""Proportional stratified interleaving: every shard gets each source's share, and equal row counts.

Rows are shuffled within their source by a seeded hash and ranked. Row r of n has the fraction
(r - 1/2) / n, so any stretch of fractions holds each source in proportion. Rows are sorted by fraction
and cut into shards of counts at most one apart. Both rankings go by buckets (hash ranges of a source,
then ranges of fractions), so a source with a third of all rows is spread like any other.

A null source is a source of its own, null ids and texts are values like others, repeated rows are rows
of their own whose places are interchangeable. An empty table gives no rows. Columns of the input stay;
an output column whose name is taken gets a leading underscore.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm import common as C

SHARDS = 40
SEED = 20260


def interleave(
    df: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    keys: Sequence[str] = ("doc_id",),
    source: str = "source",
) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1), ``slot`` (gapless from 0) and ``fraction``.

    ``keys`` are what the shuffle hashes; they should tell rows apart. The input is read twice.
    """
    names = C.fresh(df, "shard", "slot", "fraction")
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        C.never_null(f"`{source}`").alias("source"),
        F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in keys]).alias("hash"),
    )
    total = df.count()
    buckets = C.buckets_for(total)
    bits = buckets.bit_length() - 1
    rows = rows.withColumn("bucket", F.shiftrightunsigned("hash", 64 - bits))
    ties = [F.col("hash"), *[F.col(f"row.`{k}`") for k in keys]]
    ranked = C.rank_rows(rows, ["source"], "bucket", ties, "rank")
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("size"))
    placed = ranked.join(sizes, "source").select(
        "row", "source", "hash", ((F.col("rank") - 0.5) / F.col("size")).alias("fraction")
    )
    placed = C.cut(placed.withColumn("bucket", F.floor(F.col("fraction") * buckets)))
    order = [F.col("fraction"), F.col("source"), *ties]
    position = C.rank_rows(placed, [], "bucket", order, "rank").withColumn("rank", F.col("rank") - 1)
    shard = f"(rank * {shards}) div {max(total, 1)}"
    first = f"(({shard}) * {total} + {shards - 1}) div {shards}"
    return position.select(
        "row.*",
        F.expr(shard).cast("int").alias(names[0]),
        (F.col("rank") - F.expr(first)).cast("long").alias(names[1]),
        F.col("fraction").alias(names[2]),
    )


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    """Every document's shard and slot of 40 shards with row counts at most one apart."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = C.cut(
        docs.select(
            "doc_id",
            "source",
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
    )
    placed = interleave(rows, keys=("doc_id", "text_crc32", "size"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
        "fraction",
    )
