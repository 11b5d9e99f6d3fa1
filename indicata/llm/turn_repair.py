"""Repair of conversation structure: the cheapest edits after which roles read ``(s?(ua)+)?``, found in a stream.

Rows of a conversation are kept (0), given the role user or assistant (3) or deleted (4), and empty turns of user or
assistant are inserted anywhere (3). A row's first fault counts: blank text and a repeated (role, text) must be
deleted; truncated text, whose last visible character does not close a sentence, costs 3 more unless deleted. Of
equally cheap edits those win whose initials ``D``, ``I``, ``K``, ``R`` read least.

A Viterbi search over four states (nothing yet, after system, after user, after assistant) reads each conversation
in order. The survivors' edits form a tree of back pointers that counts what still refers to each edit; an edit that
nothing refers to is freed with all above it that are left alone. While the tree's root has one child only, all
survivors share that edit, and it is emitted and becomes the root. So memory holds the edits that are still open and
not the conversation, unless its first edit truly hangs on its last row, as where only users speak. Survivors of equal
cost are compared by all their open edits: for each two, the edits in which they first differ are kept, which decides
it however far back that is. Neither can be the start of the other at the same cost, as both have one edit for each row
and insertions cost. A state is given up when another one's cost and the most that it takes to do from there what the
state could do are below its own; otherwise deleting everything would stay a survivor and nothing be shared.

Conversations are spread by id, with one stream each. That keeps even one with a third of all rows in bounded
memory, though in one task: its text is hashed and its edits are ordered by its turns, so they come one after another.

Rows sort by turn (null first), role and text; nulls in role and text are one space, so a null text is blank and a null
role fits nothing. All rows with a null id are one conversation. Repeated rows are duplicates but for the first. Extra
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicata.llm import common as C

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
CHANGE_COST, DELETE_COST = 3, 4
BLANK_CHARS = " \t\n\x0b\f\r"
CLOSERS = ".!?"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn with a role's initial, by the state before.
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NAMES = {"u": "user", "a": "assistant"}
#: What it costs at most to do from the first state what the second one could do.
INSTEAD = {
    (ASSISTANT, START): DELETE_COST,
    (USER, START): CHANGE_COST + DELETE_COST,
    (SYSTEM, START): 2 * CHANGE_COST,
    (START, SYSTEM): 0,
    (ASSISTANT, SYSTEM): 0,
    (USER, SYSTEM): CHANGE_COST,
}

#: Edits that leave a task together.
EDITS_OUT = 1024
EDITS = "conv string, edit string, fault int, cost long, turn long, was_role string, role string, text string"
DIGEST = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


class Edit:
    """An edit of the tree: what it was after, and what refers to it (later edits and survivors)."""

    __slots__ = ("above", "below", "held", "kind", "role", "row")

    def __init__(self, above: Edit | None, kind: str, role: str | None, row: tuple | None):
        self.above, self.kind, self.role, self.row = above, kind, role, row
        self.below: list[Edit] = []
        self.held = 0


#: A survivor of a search step: its cost, the state whose survivor it goes on from, and its edits since, as (kind, role).
Way = tuple[int, int, tuple[tuple[str, str | None], ...]]


class Survivors:
    """What decides between survivors: the cost of each state above the least, and in which edits two first differ.

    There are few such situations, so what a row does to one is worked out once: ``after`` has, by fault and initial,
    the situation after the row, its edits as (edit before, kind, role), and the last edit of each state. An edit
    before is the number of one of these, or ``~state`` for the last one of a state until then.
    """

    def __init__(self, costs: dict[int, int], apart: dict[tuple[int, int], tuple[str, str]]):
        self.costs, self.apart = costs, apart
        self.after: dict[tuple[int, str], tuple[Survivors, list, list]] = {}

    def _differ(self, x: Way, y: Way) -> tuple[str, str]:
        """The edits in which two ways first differ; empty where one has no more."""
        mine, theirs = [kind for kind, _ in x[2]], [kind for kind, _ in y[2]]
        if x[1] != y[1]:
            before = self.apart[x[1], y[1]]
            return before[0] or "".join(mine[:1]), before[1] or "".join(theirs[:1])
        same = 0
        while same < min(len(mine), len(theirs)) and mine[same] == theirs[same]:
            same += 1
        return "".join(mine[same : same + 1]), "".join(theirs[same : same + 1])

    def _better(self, x: Way, y: Way | None) -> bool:
        if y is None or x[0] != y[0]:
            return y is None or x[0] < y[0]
        mine, theirs = self._differ(x, y)
        return mine < theirs

    def step(self, fault: int | None, initial: str) -> tuple[Survivors, list, list]:
        """What a row does; no row (None) before the first one."""
        best: dict[int, Way] = {}

        def offer(state: int, way: Way) -> None:
            if self._better(way, best.get(state)):
                best[state] = way

        more = CHANGE_COST if fault == TRUNCATED else 0
        for state, cost in self.costs.items():
            if fault is None:
                offer(state, (cost, state, ()))
                continue
            offer(state, (cost + DELETE_COST, state, ((DELETE, None),)))
            if fault in (BLANK, DUPLICATE):
                continue
            for role, name in NAMES.items():
                if state in NEXT[role]:
                    offer(NEXT[role][state], (cost + CHANGE_COST + more, state, ((REROLE, name),)))
            if state in NEXT.get(initial, ()):
                offer(NEXT[initial][state], (cost + more, state, ((KEEP, None),)))
        for role, name in NAMES.items():
            for state, target in NEXT[role].items():
                if state in best:
                    cost, before, edits = best[state]
                    offer(target, (cost + CHANGE_COST, before, (*edits, (INSERT, name))))
        for (other, state), most in INSTEAD.items():
            if state in best and other in best and best[other][0] + most < best[state][0]:
                del best[state]
        least = min(cost for cost, _, _ in best.values())
        apart = {(s, t): self._differ(x, y) for s, x in best.items() for t, y in best.items() if s != t}
        made: dict[tuple, int] = {}
        edits = []
        for _, before, kinds in best.values():
            for k in range(1, len(kinds) + 1):
                if (before, kinds[:k]) not in made:
                    made[before, kinds[:k]] = len(edits)
                    edits.append((made[before, kinds[: k - 1]] if k > 1 else ~before, *kinds[k - 1]))
        lasts = [(state, made[before, kinds] if kinds else ~before) for state, (_, before, kinds) in best.items()]
        return Survivors({s: cost - least for s, (cost, _, _) in best.items()}, apart), edits, lasts

    def key(self) -> tuple:
        return tuple(sorted(self.costs.items())), tuple(sorted(self.apart.items()))


class Situations:
    """All situations met so far."""

    def __init__(self) -> None:
        self.known: dict[tuple, Survivors] = {}
        self.first = self._same(Survivors({START: 0}, {}))

    def _same(self, found: Survivors) -> Survivors:
        return self.known.setdefault(found.key(), found)

    def after(self, before: Survivors, fault: int | None, initial: str) -> tuple[Survivors, list, list]:
        found = before.after.get((fault, initial))
        if found is None:
            after, *rest = before.step(fault, initial)
            found = before.after[fault, initial] = (self._same(after), *rest)
        return found


class Repair:
    """The search over one conversation; ``emit`` gets each edit as soon as it is certain."""

    def __init__(self, emit: Callable[[Edit], None], situations: Situations | None = None):
        self.emit = emit
        self.situations = situations or Situations()
        self.root = Edit(None, "", None, None)
        self.root.held = 1
        #: The last edit of the survivor of each state, and what decides between them.
        self.last: dict[int, Edit] = {START: self.root}
        self.now = self.situations.first
        self._go(None, "", None, None)

    def _go(self, fault: int | None, initial: str, role: str | None, row: tuple | None) -> None:
        before = self.last
        self.now, edits, lasts = self.situations.after(self.now, fault, initial)
        made = []
        for above, kind, name in edits:
            above = made[above] if above >= 0 else before[~above]
            edit = Edit(above, kind, role if kind == KEEP else name, None if kind == INSERT else row)
            above.below.append(edit)
            made.append(edit)
        self.last = {state: made[at] if at >= 0 else before[~at] for state, at in lasts}
        for edit in self.last.values():
            edit.held += 1
        for edit in before.values():
            edit.held -= 1
        for edit in before.values():
            while not edit.held and not edit.below and edit.above is not None:
                above = edit.above
                above.below.remove(edit)
                edit.above, edit = None, above

    def row(self, fault: int, role: str, row: tuple) -> None:
        """Take in the next row."""
        self._go(fault, role[:1] if role[:1] in NEXT else "", role, row)
        while not self.root.held and len(self.root.below) == 1:
            self.root = self.root.below[0]
            self.root.above = None
            self.emit(self.root)

    def end(self) -> None:
        """Emit the rest of the best edits; nothing, or an assistant's turn, may come last."""
        ways = {s: (self.now.costs[s], s, ()) for s in (START, ASSISTANT) if s in self.last}
        state = START if START in ways else ASSISTANT
        if len(ways) == 2 and self.now._better(ways[ASSISTANT], ways[START]):
            state = ASSISTANT
        last, rest = self.last[state], []
        while last is not self.root:
            rest.append(last)
            last = last.above
        for edit in reversed(rest):
            self.emit(edit)

    def open_edits(self) -> int:
        """Edits that are held in memory."""
        found, pending = 0, [self.root]
        while pending:
            found += 1
            pending.extend(pending.pop().below)
        return found


def _cost(kind: str, fault: int) -> int:
    if kind == DELETE:
        return DELETE_COST
    more = CHANGE_COST if fault == TRUNCATED else 0
    return more + (0 if kind == KEEP else CHANGE_COST)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of conversations whose rows come one after another."""
    names = [x.split()[0] for x in EDITS.split(", ")]
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    kinds = [types[x.split()[1]] for x in EDITS.split(", ")]
    out: list[tuple] = []
    conv, search, situations = None, None, Situations()

    def emit(edit: Edit) -> None:
        turn, role, text, fault = edit.row or (None, None, "", NONE)
        out.append((conv, edit.kind, fault, _cost(edit.kind, fault), turn, role, edit.role, text))

    def packed() -> pa.RecordBatch:
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        for key, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if key != conv:
                if search is not None:
                    search.end()
                conv, search = key, Repair(emit, situations)
            search.row(fault, role, (turn, role, text, fault))
            if len(out) >= EDITS_OUT:
                yield packed()
    if search is not None:
        search.end()
    if out:
        yield packed()


def edits(df: DataFrame) -> DataFrame:
    """The edits of each conversation of ``df`` (``conv_id``, ``turn``, ``role``, ``text``), in order within a partition.

    ``conv`` is the id as text (``never_null``); a row's edit has its ``turn``, ``was_role``, ``fault`` and ``text``, and all but
    deletions have the ``role`` after it. Rows not deleted, in order, are the repaired conversation.
    """
    text = C.null_to(F.col("text").cast("string"), " ")
    seen = F.btrim(text, F.lit(BLANK_CHARS))
    rows = df.select(
        C.never_null("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        C.null_to(F.col("role").cast("string"), " ").alias("role"),
        text.alias("text"),
        F.when(seen == "", BLANK).when(~F.right(seen, F.lit(1)).isin(*CLOSERS), TRUNCATED).otherwise(NONE).alias("fault"),
    )
    # one shuffle: the numbering finds its rows together by conversation
    again = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy("turn"))
    spread = rows.repartition("conv").withColumn("again", again)
    fault = F.when((F.col("fault") != BLANK) & (F.col("again") > 1), DUPLICATE).otherwise(F.col("fault"))
    ordered = spread.sortWithinPartitions("conv", "turn", "role", "text", "again")
    return ordered.select("conv", "turn", "role", "text", fault.alias("fault")).mapInArrow(_edits, EDITS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from its edits in order."""
    names = [x.split()[0] for x in DIGEST.split(", ")]
    conv, audit, turns, before = None, [], None, None
    counts, digest, first = {}, None, True

    def done() -> pa.RecordBatch:
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        row = [conv, gaps, *(counts[k] for k in (BLANK, DUPLICATE, TRUNCATED, "illegal", "cost"))]
        row += ["".join(audit), digest.hexdigest()]
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=names)

    for batch in batches:
        for key, kind, fault, cost, turn, was, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if key != conv:
                if conv is not None:
                    yield done()
                conv, audit, turns, before = key, [], None, None
                counts, digest, first = dict.fromkeys([NONE, BLANK, DUPLICATE, TRUNCATED, "illegal", "cost"], 0), sha256(), True
            audit.append(kind)
            counts["cost"] += cost
            if kind != INSERT:
                counts[fault] += 1
                if before is not None and before + was[:1] not in ("su", "ua", "au"):
                    counts["illegal"] += 1
                before = was[:1]
                if turn is not None:  # turns ascend
                    turns = (turn, turn, 1) if turns is None else (turns[0], turn, turns[2] + (turn != turns[1]))
            if kind != DELETE:
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
    if conv is not None:
        yield done()


def digests(found: DataFrame) -> DataFrame:
    """Counts, cost, audit and digest of each conversation of ``edits()``, whose order must be left as it is."""
    return found.mapInArrow(_digests, DIGEST)


def damaged(df: DataFrame) -> DataFrame:
    """Rows harmed by what their id and turn hash to: dropped, emptied, without closers, repeated, or said by the user."""
    key = F.concat(*[C.null_to(F.col(c).cast("string"), " ") if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    harm = F.crc32(key.cast("binary")) % 20
    text, role = C.null_to("text", " "), C.null_to("role", " ")
    rows = df.where(harm != 0).select(
        "conv_id",
        "turn",
        F.when(harm == 4, "user").otherwise(role).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate(text, CLOSERS, "")).otherwise(text).alias("text"),
        F.when(harm == 3, 2).otherwise(1).alias("copies"),
    )
    return rows.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")


def op11_turn_repair(spark, sf_dir: str) -> DataFrame:
    """What is wrong with each damaged conversation and the cheapest repair."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    every = rows.select("conv_id", C.never_null("conv_id").alias("conv")).distinct()
    found = every.join(digests(edits(damaged(rows))), "conv", "left")
    empty = sha256().hexdigest()
    values = {"audit": "", "repaired_sha256": empty}
    names = [x.split()[0] for x in DIGEST.split(", ")][1:]
    return found.select("conv_id", *[C.null_to(n, values.get(n, 0)).alias(n) for n in names])


def _best(*found: str) -> str:
    return f"list_sort(list_filter([{', '.join(found)}], lambda x: x IS NOT NULL))[1]"


def _then(state: str, cost: str, kind: str, said: str) -> str:
    """A survivor in SQL after one more edit: cost ``c``, audit ``a`` and output ``o``."""
    more = f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{kind}', 'o': {state}.o || {said}}}"
    return f"CASE WHEN {state} IS NOT NULL THEN {more} END"


def _turned(targets: str, states: str) -> list[str]:
    """A row kept or given the role of ``targets``, from any of the states."""
    found = []
    for s in states:
        kept = _then(f"b{s}", "more", KEEP, "said")
        found.append(f"CASE WHEN fault NOT IN (1, 2) AND left(role, 1) = '{targets}' THEN {kept} END")
        if targets in NAMES:
            other = _then(f"b{s}", "more + 3", REROLE, f"chr(10) || '{NAMES[targets]}:' || text")
            found.append(f"CASE WHEN fault NOT IN (1, 2) THEN {other} END")
    return found


_USER, _ASSISTANT = (f"chr(10) || '{name}:'" for name in NAMES.values())
_DELETED = [_then(f"b{s}", "4", DELETE, "''") for s in range(4)]
_EMPTY = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR))"
_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP11_SQL = f"""
WITH RECURSIVE harmed AS MATERIALIZED (
  SELECT coalesce('=' || conv_id, '') AS conv, turn, {C.crc32_sql(_KEY)} % 20 AS harm,
    coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations
), damaged AS (
  SELECT conv, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN translate(text, '{CLOSERS}', '') ELSE text END AS text,
    unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
  FROM harmed WHERE harm <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) AS again,
    trim(text, {_SPACE}) AS seen FROM damaged
), judged AS MATERIALIZED (
  SELECT conv, turn, role, text, i, CASE WHEN seen = '' THEN 1 WHEN again > 1 THEN 2
    WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM numbered
), search AS (
  SELECT conv, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}} AS b0, {_EMPTY} AS b1,
    {{'c': CAST(3 AS BIGINT), 'a': 'I', 'o': {_USER}}} AS b2,
    {{'c': CAST(6 AS BIGINT), 'a': 'II', 'o': {_USER} || {_ASSISTANT}}} AS b3
  FROM (SELECT DISTINCT conv FROM judged)
  UNION ALL
  SELECT conv, i, b0, b1, b2, {_best("b3", _then("b2", "3", INSERT, _ASSISTANT))} FROM (
    SELECT conv, i, b0, b1, b3, {_best("b2", *[_then(f"b{s}", "3", INSERT, _USER) for s in (0, 1, 3)])} AS b2 FROM (
      SELECT conv, i, {_DELETED[0]} AS b0, {_best(_DELETED[1], *_turned("s", "0"))} AS b1,
        {_best(_DELETED[2], *_turned("u", "013"))} AS b2, {_best(_DELETED[3], *_turned("a", "2"))} AS b3
      FROM (SELECT s.conv, j.i, b0, b1, b2, b3, fault, role, text, chr(10) || role || ':' || text AS said,
          CASE WHEN fault = 3 THEN 3 ELSE 0 END AS more
        FROM search s JOIN judged j ON j.conv = s.conv AND j.i = s.i + 1)))
), repaired AS (
  SELECT conv, {_best("b0", "b3")} AS best FROM search
  WHERE (conv, i) IN (SELECT (conv, max(i)) FROM judged GROUP BY conv)
), pairs AS (
  SELECT *, left(lag(role) OVER (PARTITION BY conv ORDER BY i), 1) || left(role, 1) AS pair FROM judged
), counted AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
    count(*) FILTER (WHERE fault = 3) AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY conv
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS conv FROM conversations)
LEFT JOIN counted USING (conv) LEFT JOIN repaired USING (conv)
"""
