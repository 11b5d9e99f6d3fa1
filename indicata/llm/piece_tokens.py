"""SentencePiece encoding and decoding by a Viterbi search that words with a common prefix share.

Spaces become the mark ``\\u2581`` and a text begins with one more. No piece continues over a mark that
follows other text, so the best segmentation of a text is that of its marked words one after the other.
The distinct words of a slice of texts are sorted, which is a trie in depth-first order. A stack keeps for each
prefix its best score, where its last piece begins, and what pieces may still go on. A word only adds the positions
behind the prefix it shares with the word before, and each character costs one step and a look at the pieces that end
there. A segmentation's score is the sum of its pieces'
scores in the model file; of equal scores the one with the longer last piece wins. Characters without a piece are
spelled in byte pieces at a cost below every piece's.

Ids of words are found once per worker and kept by number, up to ``KEPT_BYTES``; a text's ids are gathered by the
numbers of its words. Texts are read in slices of ``SLICE_BYTES``, and what a slice gives leaves the task before the
next one is read.

Encoding is reversible: a mark that stands in the text itself is spelled in bytes, white space is kept as it
is, and decoding gives the exact text. A null text gives null, an empty one no ids. Repeated rows each get
their ids; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.llm import common as C

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: How far below the lowest score of a piece a character spelled in bytes is.
UNKNOWN_PENALTY = 10.0
#: About what a worker keeps of words and their ids before it starts anew.
KEPT_BYTES = 32 << 20
SLICE_BYTES = 1 << 20
#: Positions that the search keeps room for from word to word.
LONG = 1 << 12
DECODED = 1 << 18


@dataclass(frozen=True)
class Pieces:
    """What encoding needs of a model file: pieces with score and id, and the ids and the bytes of each."""

    pieces: tuple[tuple[str, float, int], ...]
    byte_ids: tuple[int, ...]
    raw: tuple[bytes, ...]
    unknown: float
    words: str
    alone: str

    @classmethod
    def load(cls, path: str = MODEL_FILE) -> Pieces:
        """Read on the driver; the pieces travel with the function."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids, raw = [], {}, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                raw.append(b"")
            else:
                pieces.append((piece, model.get_score(i), i))
                raw.append(piece.replace(MARK, " ").encode())
        # marks and line ends that no piece continues over part the text into words
        crossing = any(MARK in p.lstrip(MARK) for p, _, _ in pieces)
        alone = "".join(c for c in "\n\r\t" if not any(c in p for p, _, _ in pieces))
        words = "[\\s\\S]+" if crossing else f"[{alone}]|{MARK}*[^{MARK}{alone}]+|{MARK}+" if alone else f"{MARK}*[^{MARK}]+|{MARK}+"
        return cls(
            tuple(pieces),
            tuple(byte_ids.get(b, model.unk_id()) for b in range(256)),
            tuple(raw),
            min((s for _, s, _ in pieces), default=0.0) - UNKNOWN_PENALTY,
            words,
            "" if crossing else alone,
        )

    def spelled(self, text: str) -> list[int]:
        return [self.byte_ids[b] for b in text.encode()]


class Search:
    """The Viterbi search over sorted words.

    What may still go on at a position follows from the longest ending of the text so far that a piece begins with;
    all other beginnings are endings of that one. So a position's state is that ending: by character the next state,
    and the pieces that end here, the shortest first, with length, score and id. States are made when first met.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.known = {p: (s, i) for p, s, i in pieces.pieces}
        self.starts = {p[:k] for p in self.known for k in range(1, len(p) + 1)}
        self.states: dict[str, tuple[str, dict, tuple]] = {}
        self.first = self._state("")
        self.best, self.begins, self.last, self.at = [0.0], [0], [-1], [self.first]

    def _state(self, ending: str) -> tuple[str, dict, tuple]:
        state = self.states.get(ending)
        if state is None:
            sizes = [k for k in range(1, len(ending) + 1) if ending[-k:] in self.known]
            ended = tuple((k, *self.known[ending[-k:]]) for k in sizes)
            state = self.states[ending] = (ending, {}, ended)
        return state

    def _next(self, state: tuple[str, dict, tuple], c: str) -> tuple[str, dict, tuple]:
        ending = state[0] + c
        while ending and ending not in self.starts:
            ending = ending[1:]
        if ending:
            state[1][c] = self._state(ending)
            return state[1][c]
        return self.first  # a character of no piece, of which there are too many to remember

    def ids(self, words: Iterable[str]) -> tuple[list[int], list[int]]:
        """The best ids of all words, one after the other, and where each word's end.

        Words must be sorted, so that those with a common prefix are together. Lists by position are the stack: of each
        prefix the best score, where its last piece begins and which it is, and its state.
        """
        best, begins, last, at = self.best, self.begins, self.last, self.at
        unknown, spelled = self.pieces.unknown, self.pieces.spelled
        flat: list[int] = []
        ends: list[int] = []
        before = ""
        for word in words:
            end = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                end += 1
            size = len(word)
            if size >= len(best):
                more = size + 1 - len(best)
                best += [0.0] * more
                begins += [0] * more
                last += [-1] * more
                at += [self.first] * more
            state = at[end]
            for c in word[end:]:
                state = state[1].get(c) or self._next(state, c)
                top, begin, piece = best[end] + unknown, end, -1
                end += 1
                for length, score, i in state[2]:
                    total = best[end - length] + score
                    if total >= top:
                        top, begin, piece = total, end - length, i
                best[end], begins[end], last[end], at[end] = top, begin, piece, state
            ids = []
            while end:
                begin = begins[end]
                if last[end] >= 0:
                    ids.append(last[end])
                else:
                    ids.extend(reversed(spelled(word[begin:end])))
                end = begin
            flat += ids[::-1]
            ends.append(len(flat))
            before = word
        if len(best) > LONG:  # what a very long word has left
            del best[1:], begins[1:], last[1:], at[1:]
        return flat, ends


class Encoder:
    """Encodes texts in a task, keeping the ids of words."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.search, self.words_of = pieces, Search(pieces), re.compile(pieces.words)
        self._clear()

    def _clear(self) -> None:
        #: By word its number; None is a mark that stands in the text, which is spelled.
        self.number: dict[str | None, int] = {None: 0}
        self.ids = array("i", self.pieces.spelled(MARK))
        self.ends = array("q", [0, len(self.ids)])
        self.held = 0

    def _learn(self, words: list[str]) -> None:
        flat, ends = self.search.ids(words)
        first, count = len(self.ids), len(self.number)
        self.number.update(zip(words, range(count, count + len(words))))
        self.ids.extend(flat)
        self.ends.extend([first + end for end in ends])
        self.held += 200 * len(words) + 4 * sum(map(len, words))

    def _parts(self, text: str) -> list[str | None]:
        """The words of a text, one by one."""
        parts: list[str | None] = []
        for k, part in enumerate(text.split(MARK) if text else ()):
            if k:
                parts.append(None)
            parts += self.words_of.findall(("" if k else MARK) + part.replace(" ", MARK))
        return parts

    def _split(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct words, and of plain texts the places of their words among these and how many each has.

        Plain texts have single spaces only, which part words as the pattern does; Arrow splits them all at once.
        """
        first, nothing = pa.scalar(MARK, pa.large_string()), pa.scalar("", pa.large_string())
        marked = pc.binary_join_element_wise(first, pc.replace_substring(texts, " ", "\0" + MARK), nothing)
        for c in self.pieces.alone:
            marked = pc.replace_substring(marked, c, f"\0{c}\0")
        split = pc.split_pattern(marked, "\0")
        values = split.flatten()
        full = pc.greater(pc.binary_length(values), 0)
        upto = np.zeros(len(values) + 1, np.int64)
        np.cumsum(full.to_numpy(zero_copy_only=False), out=upto[1:])
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = values.filter(full).dictionary_encode()
        return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.diff(upto[offsets])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin (and the end); nulls have none."""
        if self.held > KEPT_BYTES:
            self._clear()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        odd = pc.or_(pc.equal(pc.binary_length(column), 0), pc.starts_with(column, " "))
        for c in (MARK, "  ", "\0") if self.pieces.alone else ("",):
            odd = pc.or_(odd, pc.match_substring(column, c))
        odd = odd.to_numpy(zero_copy_only=False)
        words, places, plain_counts = self._split(column.filter(pa.array(~odd)))
        parts = [self._parts(t) for t in column.filter(pa.array(odd)).to_pylist()]
        new = {*words, *chain.from_iterable(parts)} - self.number.keys()
        self._learn(sorted(new))
        odd_counts = np.array([len(p) for p in parts], np.int64)
        look = self.number.__getitem__
        plain = np.fromiter(map(look, words), np.int64, len(words))[places]
        numbers = np.append(plain, np.fromiter(map(look, chain.from_iterable(parts)), np.int64, int(odd_counts.sum())))
        # the rows' words, back in the order of the rows
        counts = np.empty(len(column), np.int64)
        counts[~odd], counts[odd] = plain_counts, odd_counts
        before = np.empty(len(column), np.int64)
        before[~odd] = np.cumsum(plain_counts) - plain_counts
        before[odd] = np.cumsum(odd_counts) - odd_counts + len(plain)
        numbers = numbers[_spread(before, counts)[0]]
        ends = np.array(self.ends)
        found, after = _spread(ends[numbers], ends[numbers + 1] - ends[numbers])
        rows = np.zeros(len(column) + 1, np.int64)
        np.cumsum(counts, out=rows[1:])
        return np.array(self.ids, np.int32)[found], after[rows]


def _spread(begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places ``begins`` to ``begins + sizes`` of each, one after the other, and where each one's come (and the end)."""
    after = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=after[1:])
    return np.arange(after[-1]) + np.repeat(begins - after[:-1], sizes), after


class Decoder:
    """Turns ids into bytes by one table of all pieces."""

    def __init__(self, pieces: Pieces):
        self.sizes = np.array([len(r) for r in pieces.raw], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(pieces.raw), np.uint8)

    def decode(self, flat: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        """The bytes of each list of ids, about ``DECODED`` ids at a time, with the mark that encoding put first."""
        first, n = 0, len(offsets) - 1
        while first < n:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + DECODED, "right")) - 1)
            ids = flat[offsets[first] : offsets[last]]
            places, ends = _spread(self.begins[ids], self.sizes[ids])
            data = self.letters[places].tobytes()
            cuts = ends[offsets[first : last + 1] - offsets[first]].tolist()
            yield from (data[a:b] for a, b in zip(cuts, cuts[1:]))
            first = last


def _lists(flat: np.ndarray, offsets: np.ndarray, mask: pa.Array | None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()), mask=mask)


def encode(text: Column, pieces: Pieces) -> Column:
    """The ids of a text."""
    made: list[Encoder] = []

    def encoded(column: pa.Array) -> pa.Array:
        encoder = made[0] if made else made.append(Encoder(pieces)) or made[0]
        parts = [encoder.encode(column.slice(a, b - a)) for a, b in C.slices(column, SLICE_BYTES)]
        offsets = [0]
        for _, own in parts:
            offsets.extend((own[1:] + offsets[-1]).tolist())
        flat = np.concatenate([x for x, _ in parts]) if parts else np.zeros(0, np.int32)
        return _lists(flat, np.array(offsets), column.is_null() if column.null_count else None)

    return F.arrow_udf(encoded, "array<int>")(text)


def decode(ids: Column, pieces: Pieces) -> Column:
    """The text of ids; the mark that encoding put first is taken off again."""
    made: list[Decoder] = []

    def decoded(column: pa.Array) -> pa.Array:
        decoder = made[0] if made else made.append(Decoder(pieces)) or made[0]
        found = decoder.decode(column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy())
        texts = [t.decode(errors="replace").removeprefix(" ") for t in found]
        return pa.array([t if known else None for t, known in zip(texts, column.is_valid().to_pylist())], pa.string())

    return F.arrow_udf(decoded, "string")(ids)


def _tokenize(pieces: Pieces, at: int, names: list[str]):
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(pieces), Decoder(pieces)
        for batch in batches:
            for start, end in C.slices(batch.column(at), SLICE_BYTES):
                rows = batch.slice(start, end - start)
                column = rows.column(at)
                flat, offsets = encoder.encode(column)
                missing = column.is_null() if column.null_count else None
                counts = pa.array(np.diff(offsets), pa.int64(), mask=missing.to_numpy(False) if missing else None)
                back = decoder.decode(flat, offsets)
                texts = column.cast(pa.binary()).to_pylist()
                same = [t == b" " + x if x else not t for t, x in zip(back, texts)]
                arrays = [*rows.columns, _lists(flat, offsets, missing), counts, pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return tokenize


def tokenized(df: DataFrame, pieces: Pieces, text: str = "text") -> DataFrame:
    """``df`` with ``token_ids``, ``n_tokens`` and ``round_trip`` (the ids decode to the text, or both are null)."""
    names = C.fresh(df, "token_ids", "n_tokens", "round_trip")
    types = (T.ArrayType(T.IntegerType()), T.LongType(), T.BooleanType())
    shape = T.StructType([*df.schema, *[T.StructField(n, t) for n, t in zip(names, types)]])
    return df.mapInArrow(_tokenize(pieces, df.columns.index(text), shape.names), shape)


def op9_piece_tokens(spark, sf_dir: str, model_file: str = MODEL_FILE) -> DataFrame:
    """The ids of every document's whole text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return tokenized(docs, Pieces.load(model_file)).drop("text")
