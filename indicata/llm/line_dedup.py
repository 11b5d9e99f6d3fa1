"""Line dedup behind two Bloom filters: lines that may repeat go to an exact check, all others never leave their task.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Every task puts the hashes of its
keys, once per document, into a filter of what was seen and, when it is there already, into a filter of what was
seen twice. A filter is a table of 64-bit words; a hash picks a word and four of its bits. Two tasks' pairs merge to
``once | other_once`` and ``twice | other_twice | (once & other_once)``: a key that both have seen has all its bits in the
last term, so no repeat is missed, in whatever order tasks merge. Tasks send their non-zero words only, merged by
stretches of the table on the executors.

The filter of repeats is then broadcast, at most ``MAX_WORDS`` words (32 MB) whatever the corpus. In a second read
only lines whose hash is in it are shuffled, with their text as key: they are counted exactly, by document, with
partial sums in each task, and the first occurrence of each is found. A fuller filter lets more single lines pass, at
the worst all of them, which is the plain shuffle; the result is the same. At 4 bits for each line, 67 million lines
at the bound, about one in 200 single lines passes.

Each row is a document of its own, so rows that share an id count apart; rows equal in id and text get the same
result. Null and empty texts are one empty line; a null text's kept text is empty. A line of white space has an
empty key, which ``min_chars`` of 1 leaves alone. Columns of the input stay; an output column whose name is taken gets
a leading underscore. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm import common as C

MIN_DOCS, MIN_CHARS = 10, 1
#: Bits of each filter per line, and the most 64-bit words of a filter.
BITS_PER_LINE, MAX_WORDS = 8, 1 << 22
#: Words that travel and merge together.
STRETCH = 1 << 13
#: Parts into which the rows of a repeated line are dealt.
SALTS = 16
#: At most so many tasks build filters, which bounds what is merged by this and ``MAX_WORDS``.
BUILDERS = 2048

PART = "stretch int, places binary, once binary, twice binary"
SUSPECT = "who string, mark long, line_key string, lines array<int>"


def words_for(lines: int, max_words: int = MAX_WORDS) -> int:
    """A power of two of words for so many lines, up to the bound."""
    words = STRETCH
    while words < max_words and words * 64 < lines * BITS_PER_LINE:
        words *= 2
    return words


def places(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word and the four bits of each hash."""
    bits = np.zeros(len(hashes), np.uint64)
    for shift in (0, 6, 12, 18):
        bits |= np.uint64(1) << ((hashes >> np.uint64(shift)) & np.uint64(63))
    return (hashes >> np.uint64(24)).astype(np.int64) & (words - 1), bits


class Pair:
    """The filters of what was seen once and twice."""

    def __init__(self, words: int):
        self.once, self.twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)

    def add(self, hashes: np.ndarray) -> None:
        """One hash per document and key; a key in several of these documents occurs as often."""
        hashes, counts = np.unique(hashes, return_counts=True)
        at, bits = places(hashes, len(self.once))
        again = (counts > 1) | ((self.once[at] & bits) == bits)
        _put(self.twice, at[again], bits[again])
        # keys of one call may share bits; as they are distinct keys, that says nothing about repeats
        _put(self.once, at, bits)

    def merge(self, at: np.ndarray, once: np.ndarray, twice: np.ndarray) -> None:
        """Take in the words ``at`` of another pair."""
        self.twice[at] |= twice | (self.once[at] & once)
        self.once[at] |= once


def _put(table: np.ndarray, at: np.ndarray, bits: np.ndarray) -> None:
    if len(at):
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(at[order]) > 0))
        table[at[order][first]] |= np.bitwise_or.reduceat(bits[order], first)


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The key of each line, or None for keys that are too short."""
    found = [line.strip().lower() for line in text.split(b"\n")]
    return [k if len(k) >= min_chars and (min_chars <= 1 or len(k.decode()) >= min_chars) else None for k in found]


def _texts(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    data = C.as_bytes(column)
    for start, end in C.slices(data):
        yield start, [t or b"" for t in data.slice(start, end - start).to_pylist()]


def _build(words: int, min_chars: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, some = Pair(words), False
        for batch in batches:
            for _, texts in _texts(batch.column(0)):
                found: list[int] = []
                for t in texts:
                    own = set(line_keys(t, min_chars))
                    own.discard(None)
                    found.extend(map(xxhash.xxh3_64_intdigest, own))
                if found:
                    pair.add(np.array(found, np.uint64))
                    some = True
        if some:
            for begin in range(0, words, STRETCH):
                at = np.flatnonzero(pair.once[begin : begin + STRETCH])
                if len(at):
                    once, twice = pair.once[begin + at], pair.twice[begin + at]
                    cells = [at.astype(np.uint16).tobytes(), once.tobytes(), twice.tobytes()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([begin // STRETCH], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]],
                        names=["stretch", "places", "once", "twice"],
                    )

    return build


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The merged filter of repeats of each stretch; rows come sorted by stretch, and one stretch is held at a time."""
    current, pair = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([current], pa.int32()), pa.array([pair.twice.tobytes()], pa.binary())], names=["stretch", "twice"]
        )

    for batch in batches:
        for stretch, at, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
            if stretch != current:
                if pair is not None:
                    yield done()
                current, pair = stretch, Pair(STRETCH)
            pair.merge(*(np.frombuffer(x, t) for x, t in ((at, np.uint16), (once, np.uint64), (twice, np.uint64))))
    if pair is not None:
        yield done()


def repeats_filter(texts: DataFrame, words: int, min_chars: int) -> np.ndarray:
    """The filter of the keys that may occur in two or more rows of ``texts``, a table of one column."""
    parts = texts.coalesce(BUILDERS).mapInArrow(_build(words, min_chars), PART)
    merged = parts.repartition("stretch").sortWithinPartitions("stretch").mapInArrow(_merge, "stretch int, twice binary")
    table = np.zeros(words, np.uint64)
    for row in merged.toLocalIterator():  # at most MAX_WORDS words in all
        table[row.stretch * STRETCH : (row.stretch + 1) * STRETCH] = np.frombuffer(row.twice, np.uint64)
    return table


def _ask(table, min_chars: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = table.value
        for batch in batches:
            for start, texts in _texts(batch.column(2)):
                rows, keys, lines = [], [], []
                for row, text in enumerate(texts, start):
                    own: dict[bytes, list[int]] = {}
                    for at, key in enumerate(line_keys(text, min_chars)):
                        if key is not None:
                            own.setdefault(key, []).append(at)
                    rows.extend([row] * len(own))
                    keys.extend(own)
                    lines.extend(own.values())
                if not keys:
                    continue
                at, bits = places(np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)), len(twice))
                hit = np.flatnonzero((twice[at] & bits) == bits)
                who = pa.array(np.array(rows, np.int64)[hit])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(who),
                        batch.column(1).take(who),
                        pa.array([keys[i].decode() for i in hit], pa.string()),
                        pa.array([lines[i] for i in hit], pa.list_(pa.int32())),
                    ],
                    names=["who", "mark", "line_key", "lines"],
                )

    return ask


def _without(text: pa.Array, lines: pa.Array) -> pa.Array:
    kept = []
    for t, gone in zip(C.as_bytes(text).to_pylist(), lines.to_pylist()):
        drop = set(gone or ())
        kept.append(b"\n".join(x for i, x in enumerate((t or b"").split(b"\n")) if i not in drop).decode())
    return pa.array(kept, pa.string())


def repeated_lines(
    df: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    keep_first: bool = False,
    id: str = "doc_id",
    text: str = "text",
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """The lines to drop: ``who`` and ``mark`` (id and hash of the text of a row) and ``lines``, numbers from 0.

    A key in ``min_docs`` rows or more loses all its lines, or with ``keep_first`` all but the first line of the row
    that comes first by id (null first) and text.
    """
    docs = df.select(
        C.never_null(f"`{id}`").alias("who"),
        F.xxhash64(F.col(f"`{text}`")).alias("mark"),
        F.col(f"`{text}`").cast("string").alias("text"),
        F.col(f"`{id}`").alias("order"),
    )
    total = docs.agg(F.sum(_line_count("text"))).first()[0] or 0
    table = repeats_filter(docs.select("text"), words_for(total, max_words), min_chars)
    asked = _ask(df.sparkSession.sparkContext.broadcast(table), min_chars)
    suspects = C.cut(docs.select("who", "mark", "text").mapInArrow(asked, SUSPECT))
    # the id in its own order, for the first occurrence
    order = F.col("who").substr(F.lit(2), F.length("who")).try_cast(docs.schema["order"].dataType)
    place = F.struct(order.alias("order"), "who", "mark", F.get("lines", F.lit(0)).alias("line"))
    counted = suspects.groupBy("line_key").agg(F.count(F.lit(1)).alias("docs"), F.min(place).alias("first"))
    # a line of very many documents is dealt to several tasks; as it is in min_docs rows, this adds no more rows than there are
    salts = max(1, min(min_docs, SALTS))
    often = counted.where(F.col("docs") >= min_docs).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = suspects.withColumn("salt", F.pmod(F.xxhash64("who", "mark"), F.lit(salts)).cast("int"))
    gone = salted.join(often, ["line_key", "salt"])
    if keep_first:
        here = (F.col("who") == F.col("first.who")) & (F.col("mark") == F.col("first.mark"))
        gone = gone.withColumn("lines", F.when(here, F.array_remove("lines", F.col("first.line"))).otherwise(F.col("lines")))
    return gone.groupBy("who", "mark").agg(F.flatten(F.collect_set("lines")).alias("lines"))


def _line_count(text: str) -> Column:
    value = F.coalesce(F.col(text), F.lit(""))
    return (F.octet_length(value) - F.octet_length(F.replace(value, F.lit("\n"), F.lit(""))) + 1).cast("long")


def dedup(df: DataFrame, id: str = "doc_id", text: str = "text", **options: object) -> DataFrame:
    """``df`` with ``n_lines`` (before), ``n_dropped`` and ``kept_text``; options as for ``repeated_lines``."""
    n_lines, n_dropped, kept, who, mark, lines = C.fresh(
        df, "n_lines", "n_dropped", "kept_text", "_who", "_mark", "_lines"
    )
    gone = repeated_lines(df, id=id, text=text, **options)
    gone = gone.select(F.col("who").alias(who), F.col("mark").alias(mark), F.col("lines").alias(lines))
    own = df.withColumns({who: C.never_null(f"`{id}`"), mark: F.xxhash64(F.col(f"`{text}`"))})
    joined = own.join(gone, [who, mark], "left")
    value = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    some = F.size(lines) > 0
    cleaned = F.arrow_udf(_without, "string")(F.when(some, value), F.when(some, F.col(lines)))
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        _line_count(f"`{text}`").alias(n_lines),
        F.when(some, F.size(lines)).otherwise(0).cast("long").alias(n_dropped),
        F.when(some, cleaned).otherwise(value).alias(kept),
    )


def op13_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the lines found in ten documents or more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = dedup(docs)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, row_number() OVER () AS r FROM documents
), lines AS (
  SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs
), keyed AS (
  SELECT r, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), often AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10
), judged AS (
  SELECT r, i, line, k IN (SELECT k FROM often) AS gone FROM keyed
), summed AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM judged GROUP BY r
)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM docs JOIN summed USING (r)
"""
