"""Mixing sources to target weights by Pfair scheduling.

A source's rows are shuffled by a seeded hash and cut into blocks. Of a source with weight w, block j
(from 0) is released at slot floor(j / w) and due at slot ceil((j + 1) / w). Each slot takes the released
block with the earliest deadline, which meets every deadline on one stream, so at each slot the number of
blocks taken from a source differs from w times the slots by less than one.

Weights are taken as the exact ratios that their floats are, so nothing is rounded and no error adds up. The
schedule does not repeat. The driver runs through it once, a step for each block, and notes how many blocks
each source has given at the start of each piece, a number for every ``SLOTS_PER_SOURCE`` blocks or so. It holds
``HELD_NUMBERS`` of these at most and writes them to the shared folder as it goes; tasks run through the pieces again
to list their blocks. Larger blocks (``block_rows``) make the schedule of a large corpus as short as is wanted. When a source runs out, a new phase begins in which the others share its weight in proportion; no row
is dropped or repeated, and there are at most as many phases as sources. Weights and windows hold within a
phase.

A null source is a source of its own; null ids and texts are values like others; repeated rows are rows of
their own whose places are interchangeable; an empty table gives no rows. Columns of the input stay; an
output column whose name is taken gets a leading underscore. Weights of sources that have no rows are left
out; a source without a given weight is refused. A deadline beyond a long is given as the largest long.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import count
from math import gcd, lcm

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indicata.llm import common as C

BLOCK_ROWS = 64
PERIOD = 1000
SEED = 77
#: So many sources at most, as the driver steps through a queue of them and each piece has a number for each.
MAX_SOURCES = 1000
#: Numbers of pieces that the driver holds, and blocks that a task lists.
HELD_NUMBERS, BLOCKS_IN_TASK = 1 << 18, 1 << 16
#: A piece has at least this many slots per source, so that pieces stay small beside the blocks.
SLOTS_PER_SOURCE = 64
LAST = (1 << 63) - 1


def shares(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportion of the weights."""
    exact = {k: Fraction(w) for k, w in weights.items()}
    scale = lcm(*[x.denominator for x in exact.values()])
    whole = {k: int(x * scale) for k, x in exact.items()}
    common = gcd(*whole.values())
    return {k: x // common for k, x in whole.items()}


def turns(share: Mapping[str, int], taken: Mapping[str, int], begin: int) -> Iterator[tuple[str, int, int, int]]:
    """(source, block, release, deadline) of each slot of a phase from ``begin`` on, earliest deadline first.

    ``taken`` has the number of blocks that each source gave before.
    """
    total = sum(share.values())
    waiting = [(j * total // share[k], k, j) for k, j in taken.items()]  # (release, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []  # (deadline, source, block, release)
    for slot in count(begin):
        while waiting and waiting[0][0] <= slot:
            release, k, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // share[k]), k, j, release))
        deadline, k, j, release = heapq.heappop(ready)
        yield k, j, release, deadline
        heapq.heappush(waiting, ((j + 1) * total // share[k], k, j + 1))


def pieces(blocks: Mapping[str, int], weights: Mapping[str, float], period: int = PERIOD) -> Iterator[tuple]:
    """(phase's first slot, first and last slot in the phase, shares, blocks before the phase, blocks taken in it).

    A piece has ``period`` slots or more; the last three have a number for each source left.
    """
    left = {k: n for k, n in blocks.items() if n > 0}
    begun = dict.fromkeys(left, 0)
    start = 0
    while left:
        share = shares({k: weights[k] for k in left})
        first = {k: begun[k] for k in left}
        taken = dict.fromkeys(left, 0)
        step = max(period, SLOTS_PER_SOURCE * len(left))
        begin, before = 0, dict(taken)
        for slot, (k, *_) in enumerate(turns(share, taken, 0)):
            if slot == begin + step:
                yield start, begin, slot - 1, share, first, before
                begin, before = slot, dict(taken)
            taken[k] += 1
            if taken[k] == left[k]:
                break
        yield start, begin, slot, share, first, before
        start += slot + 1
        for k, n in taken.items():
            begun[k] += n
        left = {k: n - taken[k] for k, n in left.items() if n > taken[k]}


def listed(start: int, begin: int, end: int, share: dict, first: dict, before: dict) -> Iterator[tuple]:
    """(source, block, slot, release, deadline) of each block of a piece."""
    for slot, (k, j, release, deadline) in zip(range(begin, end + 1), turns(share, before, begin)):
        yield k, first[k] + j, start + slot, start + release, min(start + deadline, LAST)


def phases(blocks: Mapping[str, int], weights: Mapping[str, float], period: int = PERIOD) -> list[tuple]:
    """Rows (source, first block, blocks, share, sum of shares, first slot, slots) of all phases, in one place."""
    slots: dict[tuple[int, str], list[int]] = {}
    about = {}
    for piece in pieces(blocks, weights, period):
        start, _, _, share, first, _ = piece
        for k, _, slot, _, _ in listed(*piece):
            slots.setdefault((start, k), []).append(slot - start)
            about[start, k] = (first[k], share[k], sum(share.values()))
    return [(k, about[s, k][0], len(x), *about[s, k][1:], s, x) for (s, k), x in sorted(slots.items())]


PHASE = "start long, names array<string>, share array<string>, first array<long>"
PIECE = "start long, begin long, end long, before array<long>"


def _planned(spark: SparkSession, table: Iterator[tuple], blocks: int) -> DataFrame:
    """The pieces of ``pieces()`` with what their phases have in common."""
    folder, rows, held = f"{C.shared_folder(spark)}/pfair-{uuid.uuid4().hex}", [], 0
    phases, written = {}, False
    for start, begin, end, share, first, before in table:
        if start not in phases:
            phases[start] = (start, list(share), [str(x) for x in share.values()], list(first.values()))
        rows.append((start, begin, end, list(before.values())))
        held += len(before)
        if held >= HELD_NUMBERS:
            spark.createDataFrame(rows, PIECE).coalesce(1).write.mode("append").parquet(folder)
            rows, held, written = [], 0, True
    plan = spark.createDataFrame(rows, PIECE)
    if written:
        plan = plan.unionByName(spark.read.schema(PIECE).parquet(folder))
    plan = plan.repartition(-(-blocks // BLOCKS_IN_TASK) or 1)
    # at most MAX_SOURCES phases of as many sources
    return plan.join(F.broadcast(spark.createDataFrame(list(phases.values()), PHASE)), "start")


def _schedule(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The blocks of pieces."""
    for batch in batches:
        for start, begin, end, before, names, share, first in batch.itertuples(index=False):
            state = [dict(zip(names, map(int, x))) for x in (share, first, before)]
            found = list(listed(start, begin, end, *state))
            yield pd.DataFrame(found, columns=["source", "block", "slot", "release", "deadline"])


def tempered(counts: Mapping[str, int], exponent: float = 0.5) -> dict[str, float]:
    """Weights that follow the sources' sizes less than in proportion."""
    return {k: float(n) ** exponent for k, n in counts.items()}


def mix(
    df: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    block_rows: int = BLOCK_ROWS,
    seed: int = SEED,
    keys: Sequence[str] = ("doc_id",),
    source: str = "source",
    period: int = PERIOD,
) -> DataFrame:
    """``df`` with ``mix_block``, ``mix_slot``, ``mix_row``, ``mix_release`` and ``mix_deadline``.

    Sorting by (``mix_slot``, ``mix_row``) gives the mixture. Without ``weights`` sources weigh by the
    square root of their rows. ``keys`` are what the shuffle hashes; they should tell rows apart.
    """
    spark = df.sparkSession
    names = C.fresh(df, "mix_block", "mix_slot", "mix_row", "mix_release", "mix_deadline")
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        C.never_null(f"`{source}`").alias("source"),
        F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in keys]).alias("hash"),
    )
    found = rows.groupBy("source").count().limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources to mix")
    counts = {r["source"]: r["count"] for r in found}
    if weights is None:
        weigh = tempered(counts)
    else:
        given = {"" if k is None else f"={k}": float(w) for k, w in weights.items()}
        if missing := [k for k in counts if not given.get(k, 0) > 0]:
            raise ValueError(f"no positive weight for {len(missing)} sources")
        weigh = {k: given[k] for k in counts}
    parts = {k: -(-n // block_rows) for k, n in counts.items()}
    plan = _planned(spark, pieces(parts, weigh, period), sum(parts.values()))
    blocks = plan.mapInPandas(_schedule, "source string, block long, slot long, release long, deadline long")
    bits = C.buckets_for(sum(counts.values())).bit_length() - 1
    rows = rows.withColumn("bucket", F.shiftrightunsigned("hash", 64 - bits))
    # buckets are small, so the blocks are brought to them and rows are dealt out once
    group = ["source", "bucket"]
    held = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("held"))
    spans = held.join(C.running_before(held, ["source"], "bucket", "held", "earlier"), group).withColumn(
        "block", F.explode(F.expr(f"sequence(earlier div {block_rows}, (earlier + held - 1) div {block_rows})"))
    )
    slots = spans.join(blocks, ["source", "block"]).groupBy(*group).agg(
        F.first("earlier").alias("earlier"),
        F.sort_array(F.collect_list(F.struct("block", "slot", "release", "deadline"))).alias("blocks"),
    )
    ties = [F.col("hash"), *[F.col(f"row.`{k}`") for k in keys]]
    number = F.row_number().over(Window.partitionBy(*group).orderBy(*ties))
    placed = rows.withColumn("number", number).join(slots, group)
    placed = placed.withColumn("rank", F.expr("number + earlier - 1"))
    placed = placed.withColumn("p", F.expr(f"blocks[int(rank div {block_rows} - blocks[0].block)]"))
    return placed.select(
        "row.*",
        F.col("p.block").alias(names[0]),
        F.col("p.slot").alias(names[1]),
        F.expr(f"rank % {block_rows}").alias(names[2]),
        F.col("p.release").alias(names[3]),
        F.col("p.deadline").alias(names[4]),
    )


def in_mixed_order(df: DataFrame, **options: object) -> DataFrame:
    """The rows of ``df`` laid out in the order of the mixture, with their own columns only."""
    names = C.fresh(df, "mix_block", "mix_slot", "mix_row", "mix_release", "mix_deadline")
    mixed = mix(df, **options)
    slot, row = names[1], names[2]
    ordered = mixed.repartitionByRange(slot, row).sortWithinPartitions(slot, row)
    return ordered.select(*[f"`{c}`" for c in df.columns])


def placed(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` with each row's place, from 0, in the order in which the table was written.

    Reading deals files out by size, so the place is that of the row in its file, after all rows of the files
    that Spark's writer numbered before. A table that is not read from files has the order it is in.
    """
    path, row, rows, before, out = C.fresh(docs, "_path", "_row", "_rows", "_before", out)
    try:
        at = docs.withColumns({path: F.col("_metadata.file_path"), row: F.col("_metadata.row_index")})
        at.schema
    except AnalysisException:
        within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        at = docs.withColumns({path: F.spark_partition_id().cast("string"), row: within})
        number = [F.col(path).cast("long")]
    else:
        name = r"part-(\d+)[^/]*?(?:-c(\d+))?\.[^/]*$"
        number = [F.regexp_extract(path, name, k).try_cast("long") for k in (1, 2)]
    # one row per file
    files = at.groupBy(path).agg(F.count(F.lit(1)).alias(rows))
    earlier = Window.orderBy(*number, path).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(path, F.coalesce(F.sum(rows).over(earlier), F.lit(0)).alias(before))
    found = at.join(files, path)
    return found.select(*[f"`{c}`" for c in docs.columns], (F.col(before) + F.col(row)).alias(out))


def op7_pfair_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document's place in a mixture of all sources."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs.select("doc_id", "source", "n_chars"), keys=("doc_id", "n_chars")).drop("n_chars")
