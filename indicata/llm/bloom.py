"""A blocked Bloom filter of bounded size, made and asked with column expressions only.

A key's hash picks one block of four 64-bit words, and a second hash one bit in each word. The filter is a
table of at most ``MAX_BLOCKS`` rows of 48 bytes, so it can be broadcast whatever it was made of; a fuller
one only lets more keys pass. Null keys are never in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter per key, and the most blocks (of 256 bits) that are ever broadcast: 12 MB.
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 18


def blocks_for(keys: int, max_blocks: int = MAX_BLOCKS) -> int:
    """Enough blocks for ``BITS_PER_KEY`` bits per key, up to the bound."""
    blocks = 1
    while blocks < max_blocks and blocks * 256 < keys * BITS_PER_KEY:
        blocks *= 2
    return blocks


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """One bit of each of the block's four words, from a second hash."""
    second = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    places = [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(4)]
    return [F.call_function("shiftleft", one, place) for place in places]


def blocked_bloom(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The blocks that have bits: ``block`` and words ``w0`` to ``w3``."""
    words = [F.bit_or(bit).alias(f"w{i}") for i, bit in enumerate(_bits(F.col(key)))]
    known = keys.where(F.col(key).isNotNull())
    return known.groupBy(_block(F.col(key), blocks).alias("block")).agg(*words)


def mark(df: DataFrame, key: Column, bloom: DataFrame, blocks: int, out: str) -> DataFrame:
    """``df`` with ``out``, false if the filter cannot hold the key. The rows are not shuffled."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    asked = df.select(row, key.alias("key")).withColumn("at", _block(F.col("key"), blocks))
    probed = asked.join(F.broadcast(bloom), F.col("at") == F.col("block"), "left")  # at most MAX_BLOCKS rows
    hit = F.col("key").isNotNull()
    for i, bit in enumerate(_bits(F.col("key"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    return probed.select("row.*", F.coalesce(hit, F.lit(False)).alias(out))


def possible(df: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be among ``keys``' column ``name``."""
    distinct = keys.select(F.col(name).alias("key")).distinct()
    blocks = blocks_for(distinct.count())
    marked = mark(df, F.col(key), blocked_bloom(distinct, "key", blocks), blocks, "_possible")
    return marked.where("_possible").drop("_possible")
