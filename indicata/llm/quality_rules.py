"""Weak supervision: rules vote or abstain, and a label model turns the votes into a probability.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation estimates every rule's
accuracies and the share of good texts from the counts of vote patterns alone, of which there are at
most 3 ** rules whatever the number of texts. The posterior is then plain column arithmetic.

Nulls and empty texts have no words, get no votes and keep the prior probability; repeated rows count
as often as they occur; other columns pass through. An empty table keeps the starting accuracies.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm import common as C

SIGNALS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
    "n_exclaim",
    "n_punct",
)
_TYPE = "struct<" + ",".join(f"{s}:bigint" for s in SIGNALS) + ">"
REPEAT_WINDOW = 8
SYMBOLS = [bytes([c]) for c in b"#*$%&|<>"]

_PUNCTUATION = np.array([33 <= c <= 126 and not chr(c).isalnum() for c in range(256)])


def _measure(column: pa.Array) -> pa.Array:
    """The signals of each text."""
    cache = C.WordHash()
    data = C.as_bytes(column)
    points = pc.fill_null(pc.utf8_length(column.cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)
    out = {s: [] for s in SIGNALS}
    for start, end in C.slices(data):
        raw = [t or b"" for t in data.slice(start, end - start).to_pylist()]
        words = [t.split() for t in raw]
        values, bounds = C.hashed(words, cache)
        sizes = np.array([len(t) for t in raw], np.int64)
        ends = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        chars = np.frombuffer(b"".join(raw), np.uint8)
        follow = sizes - points[start:end]  # bytes that continue a character, all of them in words
        word_bytes = np.array([sum(map(len, w)) for w in words], np.int64)
        lines = [[x for x in t.split(b"\n") if x and not x.isspace()] for t in raw]
        keys = C.windows(values, REPEAT_WINDOW)
        repeated = np.zeros(len(values), bool)
        if len(keys):
            at = np.flatnonzero(C.window_starts(bounds, REPEAT_WINDOW, len(keys)))
            keys = C.mixed(keys[at] + C.owners(bounds)[at].astype(np.uint64) * C.BASE)
            order = np.argsort(keys)
            same = keys[order[1:]] == keys[order[:-1]]
            again = np.zeros(len(at), bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            repeated = C.covered(at[again], REPEAT_WINDOW, len(values))
        upper = (chars >= 65) & (chars <= 90)
        out["n_words"].append(np.diff(bounds))
        out["word_chars"].append(word_bytes - follow)
        out["n_symbols"].append(np.array([sum(map(t.count, SYMBOLS)) for t in raw], np.int64))
        out["n_dup_lines"].append(np.array([len(x) - len(set(x)) for x in lines], np.int64))
        out["n_repeat_words"].append(C.per_text(repeated, bounds))
        out["n_lines"].append(np.array([len(x) for x in lines], np.int64))
        out["n_upper"].append(C.per_text(upper, ends))
        out["n_letters"].append(C.per_text(upper | ((chars >= 97) & (chars <= 122)), ends))
        out["n_punct"].append(C.per_text(_PUNCTUATION[chars], ends))
        out["n_exclaim"].append(np.array([t.count(b"!") for t in raw], np.int64))
    arrays = [pa.array(np.concatenate(out[s]) if out[s] else [], pa.int64()) for s in SIGNALS]
    return pa.StructArray.from_arrays(arrays, names=list(SIGNALS))


def signals(text: Column) -> Column:
    """A struct of counts over the whole text."""

    def measured(column: pa.Array) -> pa.Array:
        return _measure(column)

    return F.arrow_udf(measured, _TYPE)(text)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str


#: ``s`` is the struct of signals.
RULES = (
    Rule("length", "s.n_words < 10", "s.n_words >= 60"),
    Rule("word_length", "s.word_chars > 12 * s.n_words OR s.word_chars < 2 * s.n_words", "s.word_chars BETWEEN 3 * s.n_words AND 8 * s.n_words"),
    Rule("symbols", "10 * s.n_symbols > s.n_words", "100 * s.n_symbols <= s.n_words"),
    Rule("repeated_lines", "10 * s.n_dup_lines > 3 * s.n_lines", "20 * s.n_dup_lines <= s.n_lines"),
    Rule("repeated_words", "5 * s.n_repeat_words > s.n_words", "20 * s.n_repeat_words <= s.n_words"),
    Rule("capitals", "2 * s.n_upper > s.n_letters", "5 * s.n_upper <= s.n_letters"),
    Rule("punctuation", "100 * s.n_punct > 15 * s.word_chars", "100 * s.n_punct <= 8 * s.word_chars"),
    Rule("exclamation", "5 * s.n_exclaim > s.n_words", "50 * s.n_exclaim <= s.n_words"),
)


def vote(rule: Rule, struct: str) -> Column:
    """The rule's vote; a text without words gets none."""
    bad, good = (x.replace("s.", f"`{struct}`.") for x in (rule.bad, rule.good))
    return F.expr(f"CASE WHEN `{struct}`.n_words = 0 THEN 0 WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END").cast("int")


@dataclass(frozen=True)
class LabelModel:
    """What EM estimated: the share of good texts, and per rule how often its vote is right.

    ``on_good[j]`` is the chance that rule j, when it votes on a good text, votes good; ``on_bad[j]``
    that it votes bad on a bad one. A rule that looks for one kind of fault is right on nearly all good
    texts and on few bad ones, so its bad vote weighs much and its good vote little.
    """

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def log_odds(self, votes: Sequence[Column]) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for right, caught, v in zip(self.on_good, self.on_bad, votes):
            total = total + (
                F.when(v > 0, F.lit(math.log(right / (1 - caught))))
                .when(v < 0, F.lit(math.log((1 - right) / caught)))
                .otherwise(F.lit(0.0))
            )
        return total

    def probability(self, votes: Sequence[Column]) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.log_odds(votes)))


#: Where EM starts, and the ranges within which accuracies on good and on bad texts and the prior stay. They only keep
#: logarithms finite, and a rule's vote on good texts from meaning its opposite.
START, GOOD_RANGE, BAD_RANGE, PRIOR_RANGE = (0.8, 0.99, 0.4), (0.5, 0.9999), (0.001, 0.9999), (0.02, 0.98)


def expectation_maximisation(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-10
) -> LabelModel:
    """Accuracies and prior that make the vote patterns likeliest.

    ``patterns`` is (patterns, rules) of -1, 0, 1; abstentions say nothing. The ranges keep a rule from
    being read as its opposite, and one vote at the starting accuracy is added to each estimate.
    """
    prior, good_start, bad_start = START
    on_good = np.full(patterns.shape[1], good_start)
    on_bad = np.full(patterns.shape[1], bad_start)
    up, down = patterns > 0, patterns < 0
    heard = (up | down).any(axis=1)
    total = counts[heard].sum() if len(counts) else 0
    for _ in range(rounds if total else 0):
        odds = math.log(prior / (1 - prior)) + up @ np.log(on_good / (1 - on_bad)) + down @ np.log((1 - on_good) / on_bad)
        good = 1 / (1 + np.exp(-odds))
        weight, rest = counts * good, counts * (1 - good)
        new_good = np.clip((weight @ up + good_start) / (weight @ (up | down) + 1), *GOOD_RANGE)
        new_bad = np.clip((rest @ down + bad_start) / (rest @ (up | down) + 1), *BAD_RANGE)
        new_prior = float(np.clip(weight[heard].sum() / total, *PRIOR_RANGE))
        moved = max(np.abs(new_good - on_good).max(), np.abs(new_bad - on_bad).max(), abs(new_prior - prior))
        on_good, on_bad, prior = new_good, new_bad, new_prior
        if moved < tolerance:
            break
    return LabelModel(prior, tuple(map(float, on_good)), tuple(map(float, on_bad)))


def base_failed(struct: str) -> Column:
    """Too short or too repetitive to be judged at all."""
    s = f"`{struct}`."
    return F.expr(f"{s}n_words < 20 OR 100 * {s}n_repeat_words > 30 * {s}n_words")


def fit(measured: DataFrame, struct: str = "s", rules: Sequence[Rule] = RULES) -> LabelModel:
    """The label model of all rows of ``measured`` that the base passes; ``struct`` holds the signals."""
    measured = measured.where(~base_failed(struct))
    names = [f"v{i}" for i in range(len(rules))]
    votes = measured.select(*[vote(r, struct).alias(n) for r, n in zip(rules, names)])
    rows = sorted(tuple(r) for r in votes.groupBy(*names).count().collect())  # at most 3 ** rules
    table = np.array(rows, np.float64).reshape(len(rows), len(rules) + 1)
    return expectation_maximisation(table[:, :-1], table[:, -1])


def judge(
    measured: DataFrame, model: LabelModel, struct: str = "s", threshold: float = 0.5, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Adds ``quality_probability``, ``base_failed`` and ``kept`` to rows with signals; a name that is taken gets a
    leading underscore."""
    names = C.fresh(measured, "quality_probability", "base_failed", "kept")
    votes = [vote(r, struct) for r in rules]
    failed = base_failed(struct)
    probability = model.probability(votes)
    return measured.withColumns(
        {
            names[0]: probability,
            names[1]: failed,
            names[2]: ~failed & (probability >= F.lit(threshold)),
        }
    )


def keep_good(df: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose text is judged good, with their own columns only.

    Texts are measured twice, once for the model and once for the verdict, so that no text is stored. The counts
    for the model are, as the base's condition on them would otherwise have every text measured a third time.
    """
    (struct,) = C.fresh(df, "s")
    model = fit(C.cut(df.select(signals(F.col(text)).alias("s"))))
    measured = df.withColumn(struct, signals(F.col(text)))
    votes = [vote(r, struct) for r in RULES]
    return measured.where(~base_failed(struct) & (model.probability(votes) >= F.lit(threshold))).select(*[f"`{c}`" for c in df.columns])


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document with its counts, posterior probability and verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    measured = C.cut(docs.select("doc_id", signals(F.col("text")).alias("s")))
    judged = judge(measured, fit(measured))
    return judged.select(
        "doc_id",
        *[F.col(f"s.{x}").alias(x) for x in SIGNALS[:5]],
        "base_failed",
        "kept",
        "quality_probability",
    )
