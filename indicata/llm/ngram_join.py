"""Documents linked by the Jaccard similarity of their 5-word shingles, with adaptive multi-match prefixes.

Shingles are hashed to 64 bits and ordered by their hash, an order that needs no counting. Documents of
equal words are one class, of which the smallest id stands for all. With n shingles and similarity t, two
documents that link share o >= t * max(n) shingles, so of the first ``p = n - ceil(t n) + 1`` of each they
share one, and of the first ``p + e`` they share ``e + 1`` (the lengthened, multi-match prefix).

A prefix is lengthened by what its shingles cost, measured as the documents a shingle brings in: with
``e`` more shingles, and ``e + 1`` shared ones required, a document may leave out its ``e`` commonest prefix
shingles and still meets every partner in one of the others. A shingle that occurs once costs nothing, so a
document whose others are all unique needs no candidates at all; that removes all but near copies.

For a document that is still costly, costs are counted anew among such documents only, over its whole set,
and its ``s`` shingles that occur elsewhere are put in the order of their cost, the same order for all. A pair
that links shares ``o`` or more of them, so of the first ``s - o + l`` of each it shares at least ``l``. How many
matches ``l`` a document asks for, and by how much its prefix is lengthened, follows from the number of
candidates its prefix is estimated to bring: one more for every tenfold, while further shingles are cheap. A
pair takes the smaller ``l`` of its two, and ``o`` from its two sizes, and is verified on whole sets if it
shares that many. Shingles that only one document has count against it this way, so that heavily edited
copies, which share much but too little, meet in few rows or none.

Components, not all links, are the result, so links inside a component are not sought twice: each
document is first verified against a few that come first for most of its shingles, and then only pairs of different
components are formed, from the smaller component to the larger. A group of any number of near copies costs a
number of pairs that follows its size.

Rows that share an id are one node. Null ids take part in nothing and get a null component; null, empty and
white-space texts have no shingles and link with nothing. Extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm import common as C
from indicata.llm.bloom import possible
from indicata.llm.components import components

SHINGLE = 5
PERCENT = 75
#: A prefix is lengthened by ``LONGER + n // 12``; partners are at least 3/4 as large, so at least
#: ``LONGER + n // 16`` of a document's prefix may be left out whatever the partner's size.
LONGER = 24
#: How often documents are linked to a first one each, before all other pairs are formed.
STARS = 3
#: Shingles by which a document finds the first one; what this misses is found as a pair.
LOOKED = 64
#: Candidates that a prefix may bring in before it is lengthened, where tenfold asks for one more match, and the
#: most that a shingle may bring in by which it is lengthened: a dearer one costs more rows than it saves.
EXPECTED = 100
#: A token is hot that so many documents have, and one in ``HOT_PART`` of all, judged by every ``HOT_SAMPLE``-th one;
#: its rows are dealt to ``SALTS`` tasks.
HOT_DOCS, HOT_PART, HOT_SAMPLE, SALTS = 4096, 1000, 64, 64


def base_length(n: int | np.ndarray, percent: int = PERCENT):
    """Shingles of the plain prefix."""
    return n - -(-n * percent // 100) + 1


def _left_out(n: Column, percent: int) -> Column:
    """How many prefix shingles a document of ``n`` may leave out."""
    needed = F.ceil(n * percent / 100)
    longer = F.lit(LONGER) + F.floor(n * percent / 1200)
    return F.least(longer, needed - 1).cast("int")


def shingles(words: list[list[bytes]], cache: C.WordHash) -> Iterator[tuple[np.ndarray, bytes]]:
    """Per text its sorted distinct shingle hashes and a 128-bit hash of its words."""
    values, bounds = C.hashed(words, cache)
    every = C.windows(values, SHINGLE)
    for i in range(len(words)):
        begin, end = bounds[i], bounds[i + 1]
        own = values[begin:end]
        key = xxhash.xxh3_128_digest(own.tobytes())
        if end - begin >= SHINGLE:
            yield np.unique(every[begin : end - SHINGLE + 1]), key
        elif end > begin:
            yield np.array([xxhash.xxh3_64_intdigest(own.tobytes(), seed=int(end - begin))], np.uint64), key
        else:
            yield np.zeros(0, np.uint64), key


PROFILE = "doc_id bigint, key binary, n int"
SPREAD = "doc bigint, prefix array<bigint>"


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[tuple[np.ndarray, bytes]]]]:
    """Ids, and sets with keys, of a slice of texts at a time."""
    cache = C.WordHash()
    for batch in batches:
        data = C.as_bytes(batch.column(1))
        for start, end in C.slices(data):
            words = [(t or b"").lower().split() for t in data.slice(start, end - start).to_pylist()]
            yield batch.column(0).slice(start, end - start), list(shingles(words, cache))


def _prefix(n: int, percent: int) -> int:
    """Shingles of the lengthened prefix."""
    return min(n, base_length(n, percent) + LONGER + n // 12) if n else 0


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, found in _read(batches):
        keys = pa.array([key for _, key in found], pa.binary())
        sizes = pa.array([len(own) for own, _ in found], pa.int32())
        yield pa.RecordBatch.from_arrays([ids, keys, sizes], names=["doc_id", "key", "n"])


def _prefixes(percent: int):
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in _read(batches):
            lists = _lists([own[: _prefix(len(own), percent)] for own, _ in found])
            yield pa.RecordBatch.from_arrays([ids, lists], names=["doc", "prefix"])

    return prefixes


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, found in _read(batches):
        yield pa.RecordBatch.from_arrays([ids, _lists([own for own, _ in found])], names=["doc", "shingles"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose whole sets are similar enough."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(left, "a").join(right, "b")
    similar = both * 100 >= (F.size("x") + F.size("y") - both) * percent
    return joined.where(similar).select("a", "b").distinct()


def _hot(some: DataFrame, docs: int) -> DataFrame:
    """Tokens that very many documents have, and ``about`` how many, from the rows of every ``HOT_SAMPLE``-th document.

    There are at most ``HOT_PART`` times as many as a document has tokens, so the table can be broadcast.
    """
    least = max(HOT_DOCS, docs // HOT_PART) // HOT_SAMPLE
    counted = some.groupBy("token").agg(F.count(F.lit(1)).alias("seen")).where(F.col("seen") >= least)
    return C.cut(counted.select("token", (F.col("seen") * HOT_SAMPLE).cast("int").alias("about")))


def _sampled(doc: str) -> Column:
    return F.pmod(F.xxhash64(doc), F.lit(HOT_SAMPLE)) == 0


def _shared(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows whose ``token`` others have too, with ``cost``, their number; one shuffle.

    Rows of hot tokens, which others do have, go to several tasks, and their cost is the estimate: it orders tokens
    and weighs prefixes, and needs only to be the same for all documents.
    """
    marked = rows.join(F.broadcast(hot), "token", "left")
    dealt = F.when(F.col("about").isNotNull(), F.pmod(F.xxhash64("doc"), F.lit(SALTS))).otherwise(0)
    held = F.count(F.lit(1)).over(Window.partitionBy("token", "dealt")).cast("int")
    counted = marked.withColumn("dealt", dealt).withColumn("cost", F.coalesce("about", held))
    return counted.where("cost > 1").drop("about", "dealt")


def _lively(docs: DataFrame, known: DataFrame, representatives: DataFrame, percent: int) -> DataFrame:
    """The representatives that can have links: ``doc`` and ``n``.

    Copies are left out of the counts but for the few that the Bloom filter lets pass. A document whose prefix
    has no more shared shingles than it may leave out has no candidates.
    """
    some = possible(docs.where("doc_id IS NOT NULL"), "doc_id", representatives, "doc")

    def spread(docs: DataFrame) -> DataFrame:
        prefixes = docs.select("doc_id", "text").mapInArrow(_prefixes(percent), SPREAD)
        return prefixes.select("doc", F.explode("prefix").alias("token"))

    hot = _hot(spread(some.where(_sampled("doc_id"))), representatives.count())
    shared = _shared(spread(some), hot)
    common = shared.groupBy("doc").agg(F.count(F.lit(1)).alias("common"))
    sizes = known.join(representatives, F.col("doc_id") == F.col("doc")).groupBy("doc").agg(F.min("n").alias("n"))
    # rows that share an id are one node, whose smallest size leaves out least
    found = sizes.join(common, "doc").where(F.col("common") > _left_out(F.col("n"), percent))
    return C.cut(found.select("doc", "n"))


def _lengthened(sets: DataFrame, percent: int) -> DataFrame:
    """The documents of ``sets`` that can have links: ``doc``, ``n``, ``asked``, ``extra``, ``tokens``.

    ``tokens`` are the shingles that occur in other sets, the cheapest first; at least one of the first
    ``asked`` is shared with any partner, and ``extra`` more of the first ``asked + extra``.
    """
    size = F.size("shingles").alias("n")
    rows = sets.select("doc", size, F.explode("shingles").alias("token"))
    shared = _shared(rows, _hot(rows.where(_sampled("doc")), sets.count()))
    by_cost = F.sort_array(F.collect_list(F.struct("cost", "token"))).alias("by_cost")
    common = shared.groupBy("doc", "n").agg(by_cost)
    least = F.ceil(F.col("n") * percent / 100).cast("int")
    found = common.withColumn("asked", F.size("by_cost") - least + 1).where("asked > 0")
    # what the prefix brings in at most
    brought = F.aggregate(F.slice("by_cost", F.lit(1), F.col("asked")), F.lit(1).cast("long"), lambda x, c: x + c["cost"])
    more = F.greatest(F.floor(F.log10(brought / EXPECTED)), F.lit(0)).cast("int")
    cheap = F.size(F.filter("by_cost", lambda c: c["cost"] <= EXPECTED)) - F.col("asked")
    extra = F.greatest(F.least(more, cheap), F.lit(0))
    return C.cut(found.select("doc", "n", "asked", extra.alias("extra"), F.col("by_cost.token").alias("tokens")))


def _placed(postings: DataFrame, grouped: DataFrame | None) -> DataFrame:
    """Postings with ``side``, the size and root of the document's component."""
    if grouped is None:
        return postings.withColumn("side", F.struct(F.lit(1).cast("long").alias("members"), F.col("doc").alias("root")))
    weights = grouped.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    named = postings.join(grouped.join(weights, "root"), F.col("doc") == F.col("node"), "left")
    side = F.struct(F.coalesce("members", F.lit(1)).alias("members"), F.coalesce("root", "doc").alias("root"))
    return named.withColumn("side", side).drop("node", "root", "members")


def _stars(placed: DataFrame, turn: int) -> DataFrame:
    """Per document the pair with the document of another component that comes first, in the order of the
    turn, for most of its shingles."""
    order = F.col("doc") if turn == 0 else F.xxhash64("doc", F.lit(turn))
    first = placed.groupBy("token").agg(F.min(F.struct(order.alias("order"), "doc", "side")).alias("first"))
    met = placed.join(first, "token").where("side <> first.side")
    met = met.groupBy("doc", F.col("first.doc").alias("other")).agg(F.count(F.lit(1)).alias("shared"))
    best = met.groupBy("doc").agg(F.max(F.struct("shared", "other")).alias("best"))
    return best.select(F.col("doc").alias("a"), F.col("best.other").alias("b"))


def link(df: DataFrame, percent: int = PERCENT, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row.

    The text is read three times, the last time only of documents that have candidates.
    """
    docs = df.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    profiles = C.cut(docs.mapInArrow(_profiles, PROFILE))
    known = profiles.where("doc_id IS NOT NULL AND n > 0")
    classes = C.cut(known.groupBy("key").agg(F.min("doc_id").alias("doc")))
    lively = _lively(docs, known, classes.select("doc").distinct(), percent)
    # texts of the documents that can have links at all
    some = possible(docs, "doc_id", lively, "doc")
    own = some.join(lively.select(F.col("doc").alias("doc_id")), "doc_id", "left_semi")
    sets = C.cut(own.select("doc_id", "text").mapInArrow(_sets, "doc bigint, shingles array<bigint>"))

    # what is still costly gets prefixes of its whole set, among what else is left
    lively = _lengthened(sets, percent)
    held = F.size("tokens").alias("s")
    postings = lively.select("doc", "n", held, "asked", "extra", F.posexplode("tokens").alias("at", "token"))

    # first links: each document with one that has most of its shingles; three choices, as one may fail
    # about LOOKED shingles of each, the same of like documents, are enough to find one
    looked = F.pmod("token", F.lit(1 << 20)) * F.col("n") < LOOKED << 20
    thin = postings.where(looked).select("doc", "token")
    links = grouped = None
    for turn in range(STARS):
        more = _verified(_stars(_placed(thin, grouped), turn), sets, percent)
        links = C.cut(more if links is None else links.unionByName(more))
        grouped = components(links)

    # then pairs of different components only, from the smaller component to the larger
    placed = _placed(postings.where("at < asked + extra").drop("asked"), grouped)
    extremes = placed.groupBy("token").agg(F.min("side").alias("low"), F.max("side").alias("high"))
    open_ = placed.join(extremes.where("low <> high").drop("low"), "token")
    sides = ("doc", "n", "s", "extra", "at", "side")
    left = open_.where("side <> high").select("token", *[F.col(c).alias(f"{c}_a") for c in sides])
    right = open_.select("token", *[F.col(c).alias(f"{c}_b") for c in sides])
    needed = F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100 + percent))
    matches = F.least(F.col("extra_a") + 1, F.col("extra_b") + 1, needed)
    within = [F.col(f"at_{x}") < F.col(f"s_{x}") - needed + matches for x in "ab"]
    met = left.join(right, "token").where((F.col("side_a") < F.col("side_b")) & within[0] & within[1])
    met = met.select("doc_a", "doc_b", matches.alias("matches")).groupBy("doc_a", "doc_b")
    met = met.agg(F.count(F.lit(1)).alias("shared"), F.max("matches").alias("matches"))
    candidates = met.where("shared >= matches").select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
    links = links.unionByName(_verified(candidates, sets, percent))
    grouped = components(links)
    members = classes.join(grouped, F.col("doc") == F.col("node"), "left").select(
        "key", F.coalesce("root", "doc").alias("root")
    )
    # rows that share an id are one node, so a class may belong to several: the smallest root counts
    named = profiles.select("doc_id", "n", F.when(F.col("n") > 0, F.col("key")).alias("key")).join(members, "key", "left")
    return named.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"),
    )


def one_of_each(df: DataFrame, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` whose id is the smallest of their component; rows without id stay.

    Rows that share that id all stay, be they equal or not.
    """
    linked = link(df, percent, id, text)
    (other,) = C.fresh(df, "other_id")
    others = linked.where("doc_id <> component_id").select(F.col("doc_id").alias(other)).distinct()
    return df.join(others, F.col(f"`{id}`") == F.col(other), "left_anti")


def op8_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Every document's shingle count and component."""
    return link(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 75 * (p.n + q.n - c)
), both_ AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM words UNION SELECT r.doc_id, b.y FROM reached r JOIN both_ b ON b.x = r.other
)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, r.c AS component_id
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id
JOIN (SELECT doc_id, min(other) AS c FROM reached GROUP BY doc_id) r ON r.doc_id = w.doc_id
"""
