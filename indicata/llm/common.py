"""Helpers shared by the operators: lineage cuts, distributed ranks, and hashing of words.

A word is a run of bytes outside ``\\x20\\x09-\\x0D``, which is what ``bytes.split`` yields.
"""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Iterator, Sequence
from contextlib import suppress
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Texts are worked on in slices of about this many bytes, which bounds a worker's memory.
SLICE_BYTES = 1 << 20
#: A worker forgets the hashes of words it has seen when it holds so many.
WORD_CACHE = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session that names none gets one of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def never_null(column: str | Column) -> Column:
    """A text that is equal where the column is, with null as a value of its own."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def running_before(table: DataFrame, groups: Sequence[str], bucket: str, count: str, out: str) -> DataFrame:
    """Sum of ``count`` over the earlier buckets of each group.

    Buckets are summed in runs of 1024 and the runs in a second step, so that no task holds more than
    a thousandth of a group's buckets. Groups and buckets must not be null.
    """
    earlier = Window.unboundedPreceding, -1
    table = table.withColumn("_run", F.floor(F.col(bucket) / 1024))
    within = Window.partitionBy(*groups, "_run").orderBy(bucket).rowsBetween(*earlier)
    across = Window.partitionBy(*groups).orderBy("_run").rowsBetween(*earlier)
    runs = table.groupBy(*groups, "_run").agg(F.sum(count).alias("_total"))
    runs = runs.withColumn("_before", F.coalesce(F.sum("_total").over(across), F.lit(0))).drop("_total")
    summed = table.withColumn("_within", F.coalesce(F.sum(count).over(within), F.lit(0)))
    total = (F.col("_within") + F.col("_before")).cast("long").alias(out)
    return summed.join(runs, [*groups, "_run"]).select(*groups, bucket, total)


def rank_rows(df: DataFrame, groups: Sequence[str], bucket: str, order: Sequence[Column], out: str) -> DataFrame:
    """Row numbers from 1 within each group, by bucket and then ``order``, without a group in one task.

    Rows are numbered within (group, bucket), which must be small, and what the earlier buckets hold is
    added. Groups and buckets must not be null and must follow from the row alone.
    """
    keys = [*groups, bucket]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_count"))
    before = running_before(counts, groups, bucket, "_count", "_earlier")
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = df.withColumn("_number", number).join(before, keys)
    return ranked.withColumn(out, F.col("_number") + F.col("_earlier")).drop("_number", "_earlier")


def buckets_for(rows: int, each: int = 4096, least: int = 64) -> int:
    """A power of two of buckets, so that equally spread rows come to about ``each`` per bucket."""
    count = least
    while count * each < rows:
        count *= 2
    return count


# ---------------------------------------------------------------- text in tasks


class WordHash(dict):
    """64-bit hashes of words, computed once per word."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def as_bytes(column: pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).cast(pa.large_binary())


def release() -> None:
    """Give back to the system what this worker has freed, so that it holds little while it waits for other tasks."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every system has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about ``limit`` bytes together; a longer text is alone with few.

    What the slices of the column took is given back after the last one.
    """
    if not len(column):
        return
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(lengths + 16) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(column)]
    yield from zip(cuts, cuts[1:])
    release()


def hashed(texts: Sequence[list[bytes]], cache: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, one text after the other, and where each text begins (and the end)."""
    if len(cache) > WORD_CACHE:
        cache.clear()
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(words) for words in texts], out=bounds[1:])
    values = np.fromiter(map(cache.__getitem__, chain.from_iterable(texts)), np.uint64, int(bounds[-1]))
    return values, bounds


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that their order says nothing about their origin."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(values: np.ndarray, size: int, base: np.uint64 = BASE) -> np.ndarray:
    """A hash of each ``size`` consecutive values; empty where there are fewer."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = values[:n].copy()
    for i in range(1, size):
        out *= base
        out += values[i : n + i]
    return mixed(out)


def window_starts(bounds: np.ndarray, size: int, n: int) -> np.ndarray:
    """True for the starts, of ``n``, whose window ends within its text."""
    good = np.ones(n, bool)
    for end in bounds[1:-1]:
        good[max(0, end - size + 1) : end] = False
    return good


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """True for each of ``n`` positions inside a window of ``size`` that begins at a start."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.subtract.at(steps, starts + size, 1)
    return np.cumsum(steps[:n]) > 0


def owners(bounds: np.ndarray) -> np.ndarray:
    """The number of the text that each position belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the flags of each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def unsigned_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def null_to(column: Column | str, value: object) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(value))


def crc32_sql(text: str) -> str:
    """DuckDB's SQL for the unsigned CRC-32 of an ASCII text: each byte goes in, then eight shifts."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda a, x: {step}), 4294967295)"
