"""Exact top-k by inner product, selected with distributed score histograms.

Vectors are turned into integers, so scores are integers and every step is exact. Queries and candidates
are dealt into tiles of bounded size; each tile scores all its pairs as one matrix product. A first pass
counts scores per query in wide bins, each following pass refines the bin that holds the query's k-th
highest score, until a bin is one score wide. A tile reports only its highest bins up to k scores, since
the k-th highest overall cannot lie below the k-th highest of a tile. The last pass keeps scores above the
k-th, and of those equal to it each tile's smallest ids.

Rows whose id is null, whose vector is null, or that hold null or non-finite components take no part. Vectors
are scored with those of their own length; empty ones score 0. Scores are exact for components of any size: by
doubles where all sums stay below 2^53, else by 64-bit integers or Python's. A component or score beyond a long
is an error, as in the SQL. Repeated rows are each candidates. Rows of one query id are one query: equal ones
ask once, and scores of different vectors with one id are ranked together. A query does not find rows with its
own id. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm import common as C

K = 20
SCALE = 64
QUERY_EVERY = 20
TILE_QUERIES, TILE_VECTORS = 512, 8192
BINS = 256
#: Products of lengths up to which doubles and 64-bit integers are exact, half of what they hold.
EXACT_DOUBLE, EXACT_LONG = 2.0**52, 2.0**62
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component as a long; null if a component is null or not finite."""
    good = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )

    def whole(x: Column) -> Column:
        x = x.cast("double") * scale
        fits = (x >= -(2.0**63)) & (x < 2.0**63)
        return F.when(fits, F.floor(x)).otherwise(F.raise_error(F.lit("component beyond a long")).cast("long"))

    return F.when(vector.isNotNull() & good, F.transform(vector, whole))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.to_list(), np.int64).reshape(len(column), len(column.iat[0]))


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m.astype(np.float64) ** 2).sum(axis=1))


def _in_python(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Products of few rows whose scores may not fit a long."""
    out = np.zeros((len(q), c.shape[1]), np.int64)
    if q.shape[1]:
        exact = q.astype(object) @ c.astype(object)
        if exact.size and not (LEAST <= exact.min() and exact.max() <= MOST):
            raise OverflowError("score beyond a long")
        out[:] = exact.astype(np.int64)
    return out


def _scored(queries: pd.DataFrame, vectors: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For some queries at a time: the first one's row, their scores, and which are with themselves."""
    q, c = _matrix(queries["vector"]), _matrix(vectors["vector"])
    q_norms, c_norms = _norms(q), _norms(c)
    plain, c = np.ascontiguousarray(c.T, np.float64), c.T
    ids, own = vectors["candidate"].to_numpy(), queries["id"].to_numpy()
    for i in range(0, len(q), 64):
        some, most = q[i : i + 64], q_norms[i : i + 64].max()
        mine = own[i : i + 64, None] == ids[None, :]
        bound = most * c_norms  # |a.b| <= |a| |b|, also of each part of the sum
        if bound.max() < EXACT_DOUBLE:
            yield i, (some.astype(np.float64) @ plain).astype(np.int64), mine
            continue
        scores = np.zeros(mine.shape, np.int64)
        for at, product in (
            (bound < EXACT_DOUBLE, lambda x: some.astype(np.float64) @ plain[:, x]),
            ((bound >= EXACT_DOUBLE) & (bound < EXACT_LONG), lambda x: some @ c[:, x]),
        ):
            scores[:, at] = product(at).astype(np.int64)
        for r in range(len(some)):
            at = np.flatnonzero((bound >= EXACT_LONG) & ~mine[r])
            scores[r, at] = _in_python(some[r : r + 1], c[:, at])[0]
        yield i, scores, mine


def _histogram(k: int):
    def count(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        """Per query the bins of scores within [low, high], highest first until they hold what is sought."""
        found = []
        if len(queries) and len(vectors):
            low, high, width = (queries[n].to_numpy() for n in ("low", "high", "width"))
            times = vectors["times"].to_numpy()
            for i, scores, own in _scored(queries, vectors):
                for r in range(len(scores)):
                    s = scores[r]
                    at = ~own[r] & (s >= low[i + r]) & (s <= high[i + r])
                    # differences reach 2^64
                    bins = ((s[at] - low[i + r]).view(np.uint64) // np.uint64(width[i + r])).astype(np.int64)
                    n = np.bincount(bins, times[at]).astype(np.int64)[::-1] if len(bins) else np.zeros(0, np.int64)
                    upto = np.searchsorted(np.cumsum(n), k) + 1
                    at = np.flatnonzero(n[:upto])
                    found.append((np.full(len(at), queries["id"].iat[i + r]), len(n) - 1 - at, n[at]))
        columns = list(zip(*found)) or [[np.zeros(0, np.int64)]] * 3
        return pd.DataFrame({n: np.concatenate(x) for n, x in zip(("id", "bin", "n"), columns)})

    return count


def _select(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
    """Per query all scores above the k-th, and of the equal ones the smallest ids, as many as are open."""
    found = []
    if len(queries) and len(vectors):
        kth, open_ = queries["low"].to_numpy(), queries["wanted"].to_numpy()
        ids, times = vectors["candidate"].to_numpy(), vectors["times"].to_numpy()
        for i, scores, own in _scored(queries, vectors):
            for r in range(len(scores)):
                s, mine = scores[r], ~own[r]
                above = np.flatnonzero(mine & (s > kth[i + r]))
                above = np.repeat(above, times[above])  # fewer than k
                equal = np.flatnonzero(mine & (s == kth[i + r]))
                equal = equal[np.argsort(ids[equal])][: open_[i + r]]
                equal = np.repeat(equal, np.minimum(times[equal], open_[i + r]))[: open_[i + r]]
                took = np.concatenate([ids[above], ids[equal]])
                score = np.concatenate([s[above], s[equal]])
                found.append((np.full(len(took), queries["id"].iat[i + r]), took, score))
    columns = list(zip(*found)) or [[np.zeros(0, np.int64)]] * 3
    return pd.DataFrame({n: np.concatenate(x) for n, x in zip(("query_id", "vec_id", "score"), columns)})


def _numbers(n: str) -> Column:
    """A row for each number below column ``n``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = K,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    tile_queries: int = TILE_QUERIES,
    tile_vectors: int = TILE_VECTORS,
    bins: int = BINS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` best rows."""
    rows = df.select(
        F.col(f"`{id}`").cast("long").alias("id"),
        quantised(F.col(f"`{vector}`"), scale).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    ).where("id IS NOT NULL AND vector IS NOT NULL")
    rows = rows.groupBy("id", "vector").agg(F.count(F.lit(1)).alias("times"), F.bool_or("query").alias("query"))
    rows = C.cut(rows.withColumn("length", F.size("vector")))
    zero = F.lit(0).cast("double")
    lengths = C.cut(
        rows.groupBy("length")
        .agg(
            F.ceil(F.count(F.lit(1)) / tile_vectors).alias("vts"),
            F.ceil(F.count_if("query") / tile_queries).alias("qts"),
            F.max(F.aggregate("vector", zero, lambda a, x: a + x.cast("double") * x.cast("double"))).alias("square"),
            F.max(F.aggregate("vector", zero, lambda a, x: F.greatest(a, F.abs(x.cast("double"))))).alias("most"),
        )
        .where("qts > 0")
    )
    square, most = lengths.agg(F.max("square"), F.max("most")).first()
    # |a.b| <= |a| |b|, and no vector is longer than the longest
    bound = min(int((square or 0) * (1 + 1e-9)) + 1, MOST)
    # one row per length
    rows = rows.join(F.broadcast(lengths.select("length", "vts", "qts")), "length")
    if (most or 0) < 1 << 31:
        rows = rows.withColumn("vector", F.col("vector").cast("array<int>"))
    vectors = rows.select(
        F.col("id").alias("candidate"),
        F.col("vector").alias("vector"),
        "times",
        F.col("length").alias("size"),
        F.pmod(F.xxhash64("id", "vector"), F.col("vts")).alias("vt"),
        _numbers("qts").alias("qt"),
    )
    asking = F.pmod(F.xxhash64("id", "vector"), F.col("qts")).alias("qt")
    queries = C.cut(rows.where("query").select("id", F.col("vector").alias("vector"), "length", "vts", asking))

    def tiled(state: DataFrame) -> DataFrame:
        asked = queries.join(state, "id")
        asked = asked.withColumn("vt", _numbers("vts")).groupBy("length", "qt", "vt")
        return asked.cogroup(vectors.groupBy("size", "qt", "vt"))

    width = -(-(2 * bound + 2) // bins)
    state = queries.select("id").distinct().select(
        "id",
        F.lit(-bound - 1).cast("long").alias("low"),
        F.lit(bound).cast("long").alias("high"),
        F.lit(width).cast("long").alias("width"),
        F.lit(k).cast("long").alias("wanted"),
    )
    while True:
        counted = tiled(state).applyInPandas(_histogram(k), "id long, bin long, n long")
        counted = counted.groupBy("id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("id").orderBy(F.desc("bin"))  # at most ``bins`` rows a query
        summed = counted.withColumn("upto", F.sum("n").over(down))
        # the first bin that completes the count, or the lowest one if all are too few
        reached = summed.groupBy("id").agg(F.max(F.struct("upto", "bin", "n")).alias("lowest"))
        hit = summed.join(state.select("id", "wanted"), "id").where("upto >= wanted")
        hit = hit.groupBy("id").agg(F.max(F.struct("bin", "upto", "n")).alias("hit"))
        chosen = reached.join(hit, "id", "left").select(
            "id",
            F.coalesce("hit.bin", "lowest.bin").alias("bin"),
            F.coalesce("hit.upto", "lowest.upto").alias("upto"),
            F.coalesce("hit.n", "lowest.n").alias("n"),
        )
        low = F.col("low").cast("decimal(38,0)") + F.col("bin") * F.col("width").cast("decimal(20,0)")
        state = C.cut(
            state.join(chosen, "id").select(
                "id",
                low.cast("long").alias("low"),
                F.least(low + F.col("width") - 1, F.lit(MOST)).cast("long").alias("high"),
                F.lit(-(-width // bins)).cast("long").alias("width"),
                (F.col("wanted") - F.col("upto") + F.col("n")).alias("wanted"),
            )
        )
        if width == 1:
            break
        width = -(-width // bins)
    best = tiled(state).applyInPandas(_select, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def op6_topk_search(spark, sf_dir: str) -> DataFrame:
    """The 20 best of all other vectors for each vector whose id is divisible by 20."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % QUERY_EVERY == 0)


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
