"""Removing repeated passages: words in a window of 20 words that starts earlier elsewhere.

Seeds: every 20-word window names the smallest hash of its 5-word runs, its anchor (winnowing), so equal
windows have equal anchors. Windows that follow each other mostly share an anchor; such a stretch is a
span. Documents are joined on anchors that occur in more than one of them.

Extension: where all occurrences of an anchor have equal spans, they match as far as the anchor reaches to
both sides, and the span is repeated in all documents but the first. Otherwise the matches end somewhere
within the spans, at the ends of a maximal repeat, and its windows are compared one by one: those whose words
also start in an earlier document are repeated. Repeats within a document are found in the document itself.
What is left standing together is a maximal repeat of 20 words or more, and all but its first occurrence
goes. Windows are judged on the input. Groups are only ever aggregated (smallest and largest document), so a
passage in any number of documents costs one row per document, and no pairs are formed.

Anchors, spans and windows are compared by 64-bit hashes, windows and spans together with their anchor.

Rows that share an id are one another's peers: neither is earlier. A row with a null id only loses what it
repeats itself. Null texts have no words and stay null. Other columns pass through; an output column
whose name is taken gets a leading underscore. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.llm import common as C
from indicata.llm.bloom import blocked_bloom, blocks_for, mark, possible

WINDOW = 20
SEED = 5
OTHER_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(OTHER_BASE), -1, 1 << 64))


class Spans:
    """The windows of some texts: anchor and hash of each, and their spans."""

    def __init__(self, words: list[list[bytes]], cache: C.WordHash, window: int = WINDOW):
        self.window = window
        values, self.bounds = C.hashed(words, cache)
        n = len(values)
        least = C.windows(values, SEED)
        have, want = 1, window - SEED + 1
        while have < want and len(least):
            step = min(have, want - have)
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
            have += step
        self.at = np.flatnonzero(C.window_starts(self.bounds, window, len(least))) if len(least) else np.zeros(0, np.int64)
        self.anchor = least[self.at]
        self.owner = C.owners(self.bounds)[self.at]
        powers = np.full(n + 1, OTHER_BASE, np.uint64)
        back = np.full(n + 1, _INVERSE, np.uint64)
        powers[0] = back[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.back = np.multiply.accumulate(back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers[:n], out=self.sums[1:])
        new = np.ones(len(self.at), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.owner[1:] != self.owner[:-1])
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], len(self.at)) - 1
        self.span_of = np.cumsum(new) - 1

    def _hash(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - begin).astype(np.uint64) * C.BASE
        return C.mixed((self.sums[end] - self.sums[begin]) * self.back[begin] ^ length)

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, anchor and hash of each span, without repeats within a text."""
        owner, anchor = self.owner[self.first], self.anchor[self.first]
        hashes = self._hash(self.at[self.first], self.at[self.last] + self.window)
        return _distinct(owner, anchor, hashes)[:3]

    def window_hashes(self) -> np.ndarray:
        return self._hash(self.at, self.at + self.window)


def _distinct(owner: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The rows without repeats, and where each stood first."""
    order = np.lexsort((np.arange(len(owner)), *reversed(columns), owner))
    rows = [c[order] for c in (owner, *columns)]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([r[1:] != r[:-1] for r in rows], axis=0)
    return (*[r[new] for r in rows], order[new])


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    data = C.as_bytes(batch.column(column))
    for start, end in C.slices(data):
        yield batch.slice(start, end - start), [(t or b"").split() for t in data.slice(start, end - start).to_pylist()]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = C.WordHash()
    for batch in batches:
        for part, words in _slices(batch, 1):
            owner, anchor, span = Spans(words, cache).spans()
            columns = [_signed(anchor), _signed(span), part.column(0).take(pa.array(owner))]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "span", "doc"])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = C.WordHash()
    for batch in batches:
        for part, words in _slices(batch, 2):
            found = Spans(words, cache)
            owner, anchor, _ = _distinct(found.owner[found.first], found.anchor[found.first])
            at = pa.array(owner)
            columns = [_signed(anchor), part.column(0).take(at), part.column(1).take(at)]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "doc", "tag"])


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of the spans whose anchors are listed in the last column."""
    cache = C.WordHash()
    for batch in batches:
        for part, words in _slices(batch, 2):
            found = Spans(words, cache)
            listed = part.column(3)
            chosen = _listed(found, listed)
            owner, anchor, hashes, first = _distinct(
                found.owner[chosen], found.anchor[chosen], found.window_hashes()[chosen]
            )
            at = pa.array(owner)
            start = (found.at[chosen] - found.bounds[found.owner[chosen]])[first]
            columns = [
                _signed(anchor),
                _signed(hashes),
                part.column(0).take(at),
                part.column(1).take(at),
                pa.array(start, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "hash", "doc", "tag", "start"])


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All elements of a list column and the row each belongs to."""
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), counts)


def _listed(found: Spans, lists: pa.Array) -> np.ndarray:
    """True for the windows whose anchor is in their text's list."""
    values, rows = _flat(lists)
    keys = C.mixed(found.anchor + found.owner.astype(np.uint64) * C.BASE)
    wanted = C.mixed(values.astype(np.int64).view(np.uint64) + rows.astype(np.uint64) * C.BASE)
    return np.isin(keys, wanted)


CUT = "struct<n_words:bigint,n_removed:bigint,text:string>"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def _cut(layout: bool):
    def cut(texts: pa.Array, whole: pa.Array, starts: pa.Array) -> pa.Array:
        cache = C.WordHash()
        data = C.as_bytes(texts)
        total, removed, kept = [], [], []
        for begin, end in C.slices(data):
            raw = data.slice(begin, end - begin).to_pylist()
            words = [(t or b"").split() for t in raw]
            found = Spans(words, cache)
            gone = _listed(found, whole.slice(begin, end - begin))
            keys = C.mixed(found.window_hashes() + found.owner.astype(np.uint64) * C.BASE)
            order = np.argsort(keys, kind="stable")
            again = keys[order[1:]] == keys[order[:-1]]
            gone[order[1:][again]] = True
            flags = np.zeros(len(found.bounds) and int(found.bounds[-1]), bool)
            flags[found.at[gone]] = True
            at, rows = _flat(starts.slice(begin, end - begin))
            flags[found.bounds[rows] + at.astype(np.int64)] = True
            out = C.covered(np.flatnonzero(flags), WINDOW, len(flags))
            lost = C.per_text(out, found.bounds)
            total.append(np.diff(found.bounds))
            removed.append(lost)
            for i, t in enumerate(raw):
                if t is None:
                    kept.append(None)
                elif layout and not lost[i]:
                    kept.append(t)
                else:
                    pieces = _WORD.findall(t) if layout else words[i]
                    stay = [w for w, o in zip(pieces, out[found.bounds[i] : found.bounds[i + 1]].tolist()) if not o]
                    kept.append((b"" if layout else b" ").join(stay))
        joined = pa.array(kept, pa.binary()).cast(pa.string())
        counts = [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (total, removed)]
        return pa.StructArray.from_arrays([*counts, joined], names=["n_words", "n_removed", "text"])

    return F.arrow_udf(cut, CUT)


def repeats(docs: DataFrame) -> DataFrame:
    """What to remove from ``docs`` (doc, tag, text): per (doc, tag) anchors whose spans go as a whole
    (``whole``), and the starts of single windows (``starts``)."""
    named = docs.where("doc IS NOT NULL")
    spans = named.select("doc", "text").mapInArrow(_span_rows, "anchor bigint, span bigint, doc bigint")
    shared = (
        spans.groupBy("anchor")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.min("span").alias("a"), F.max("span").alias("b"))
        .where("low < high")
        .select("anchor", "low", (F.col("a") == F.col("b")).alias("equal"))
    )
    seeds = named.select("doc", "tag", "text").mapInArrow(_anchor_rows, "anchor bigint, doc bigint, tag int")
    met = seeds.join(shared, "anchor").where("NOT equal OR doc > low")
    lists = C.cut(
        met.groupBy("doc", "tag").agg(
            F.collect_list(F.when(F.col("equal"), F.col("anchor"))).alias("whole"),
            F.collect_list(F.when(~F.col("equal"), F.col("anchor"))).alias("part"),
        )
    )
    partly = lists.where(F.size("part") > 0).select("doc", "tag", "part")
    texts = possible(named, "doc", partly, "doc").join(partly, ["doc", "tag"])
    windows = C.cut(
        texts.select("doc", "tag", "text", "part").mapInArrow(
            _window_rows, "anchor bigint, hash bigint, doc bigint, tag int, start int"
        )
    )
    earliest = windows.groupBy("anchor", "hash").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    later = windows.join(earliest.where("low < high").drop("high"), ["anchor", "hash"]).where("doc > low")
    starts = later.groupBy("doc", "tag").agg(F.collect_list("start").alias("starts"))
    return C.cut(lists.select("doc", "tag", "whole").join(starts, ["doc", "tag"], "full_outer"))


def dedup(df: DataFrame, id: str = "doc_id", text: str = "text", layout: bool = True) -> DataFrame:
    """``df`` with ``n_words``, ``n_removed`` and ``kept_text``.

    With ``layout`` white space between kept words stays, and a text without repeats is unchanged;
    otherwise kept words are joined by one space. The text is read four times.
    """
    names = C.fresh(df, "n_words", "n_removed", "kept_text")
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(f"`{id}`").cast("long").alias("doc"),
        F.hash(F.col(f"`{text}`")).alias("tag"),
    )
    docs = df.select(
        F.col(f"`{id}`").cast("long").alias("doc"), F.hash(F.col(f"`{text}`")).alias("tag"), F.col(f"`{text}`").alias("text")
    )
    found = repeats(docs)
    ids = found.select(F.col("doc").alias("key")).distinct()
    blocks = blocks_for(ids.count())
    marked = mark(rows, F.col("doc"), blocked_bloom(ids, "key", blocks), blocks, "hit")
    hits = marked.where("hit").join(found, ["doc", "tag"], "left").select("row", "whole", "starts")
    none = F.lit(None).cast("array<bigint>"), F.lit(None).cast("array<int>")
    rest = marked.where("NOT hit").select("row", none[0].alias("whole"), none[1].alias("starts"))
    cut = _cut(layout)

    def done(part: DataFrame) -> DataFrame:
        judged = part.withColumn("cut", cut(F.col(f"row.`{text}`"), F.col("whole"), F.col("starts")))
        return judged.select(
            "row.*",
            F.col("cut.n_words").alias(names[0]),
            F.col("cut.n_removed").alias(names[1]),
            F.col("cut.text").alias(names[2]),
        )

    return done(hits).unionByName(done(rest))


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's words without repeated passages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = dedup(docs, layout=False)
    return cut.select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


OP2_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM words WHERE len(w) >= 20
), windows AS (
  SELECT doc_id, s, sha256(array_to_string(w[s:s + 19], ' ')) AS h FROM starts
), later AS (
  SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, s) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later
), placed AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words
), kept AS (
  SELECT p.doc_id, p.word, p.p, g.p IS NOT NULL AS removed
  FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.p = p.p
), summed AS (
  SELECT doc_id, count(*) AS n, count_if(removed) AS r,
    string_agg(CASE WHEN NOT removed THEN word END, ' ' ORDER BY p) AS t
  FROM kept GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(s.r, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(s.t, '')) AS kept_sha256
FROM words w LEFT JOIN summed s ON s.doc_id = w.doc_id
"""
