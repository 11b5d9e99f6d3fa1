"""Conversation repair: the streamed search against a plain one, its memory, and edge rows."""

import hashlib
from functools import lru_cache
from random import Random

import compare
import pytest

from indicata.llm import turn_repair as R

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def cheapest(rows):
    """Cost and least audit of rows (fault, initial), from the end backwards."""

    @lru_cache(None)
    def best(i, state, inserted):
        found = [(0, "")] if i == len(rows) and state in (0, 3) else []
        steps = []
        if inserted < 3:
            steps += [(3, "I", i, NEXT[state, c], inserted + 1) for c in "ua" if (state, c) in NEXT]
        if i < len(rows):
            fault, initial = rows[i]
            steps.append((4, "D", i + 1, state, 0))
            if fault not in (R.BLANK, R.DUPLICATE):
                more = 3 if fault == R.TRUNCATED else 0
                steps += [(3 + more, "R", i + 1, NEXT[state, c], 0) for c in "ua" if (state, c) in NEXT]
                if (state, initial) in NEXT:
                    steps.append((more, "K", i + 1, NEXT[state, initial], 0))
        for cost, kind, j, target, n in steps:
            rest = best(j, target, n)
            if rest:
                found.append((cost + rest[0], kind + rest[1]))
        return min(found, default=None)

    return best(0, 0, 0)


def streamed(rows, every=1):
    found = []
    search = R.Repair(found.append)
    most = 0
    for i, (fault, initial) in enumerate(rows):
        search.row(fault, initial, ("", "", "", fault))
        if i % every == 0:
            most = max(most, search.open_edits())
    search.end()
    cost = sum(R._cost(e.kind, e.row[3] if e.row else R.NONE) for e in found)
    return cost, "".join(e.kind for e in found), [e.role for e in found if e.kind != "D"], most


def test_streamed_search_finds_the_least_of_the_cheapest():
    rand = Random(5)
    for _ in range(4000):
        rows = [(rand.choice([0, 0, 0, 1, 2, 3]), rand.choice("suuaax ")) for _ in range(rand.randrange(9))]
        cost, audit, roles, _ = streamed(rows)
        assert (cost, audit) == cheapest(rows), rows
        initials = "".join(r[0] for r in roles)
        assert initials.removeprefix("s") == "ua" * (len(initials) // 2)


@pytest.mark.parametrize("kind", ["random", "blank", "truncated", "good"])
def test_open_edits_stay_few(kind):
    rand = Random(1)
    rows = {
        "random": [(rand.choice([0, 0, 1, 2, 3]), rand.choice("suax")) for _ in range(20_000)],
        "blank": [(1, "u")] * 20_000,
        "truncated": [(3, "ua"[i % 2]) for i in range(20_000)],
        "good": [(0, "ua"[i % 2]) for i in range(20_000)],
    }[kind]
    assert streamed(rows)[3] <= 200


def test_first_edit_that_hangs_on_the_last_row():
    """Only users: whether a turn is put in at once follows from the number of rows, so all edits stay open."""
    for n in (50_000, 50_001):
        cost, audit, _, _ = streamed([(0, "u")] * n, every=n)
        assert (cost, audit) == (3 * (n // 2 + n % 2), "KI" * (n % 2) + "KR" * (n // 2))


TYPE = "conv_id long, turn long, role string, text string"


def digests(spark, rows):
    df = spark.createDataFrame(rows, TYPE)
    return {r.conv: r for r in R.digests(R.edits(df)).collect()}


def sha(*lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_edge_rows(spark):
    long = "word " * 200_000 + "."
    rows = [
        (1, 0, "system", "S."), (1, 2, "user", "Q?"), (1, 5, "assistant", long),
        (2, None, None, None), (2, None, "user", "a."), (2, 1, "user", "a."),
        (None, 0, "user", "x!"), (None, 1, "assistant", "\t"), (None, 1, "assistant", "y"),
        (3, 4, "user", "same."), (3, 4, "user", "same."), (3, 5, "assistant", "ok."),
    ]
    found = digests(spark, rows)
    one = found["=1"]
    assert (one.gaps, one.cost, one.audit) == (3, 0, "KKK")
    assert one.repaired_sha256 == sha("system:S.", "user:Q?", "assistant:" + long)
    two = found["=2"]  # no turn, blank; then a row and its copy
    assert (two.gaps, two.blank, two.duplicate, two.truncated, two.cost) == (0, 1, 1, 0, 11)
    assert two.audit == "DKDI"
    assert two.repaired_sha256 == sha("user:a.", "assistant:")
    null = found[""]
    assert (null.blank, null.truncated, null.cost, null.audit) == (1, 1, 7, "KDK")
    three = found["=3"]
    assert (three.gaps, three.duplicate, three.illegal, three.audit) == (0, 1, 1, "KDK")


def test_every_conversation_of_the_query(spark, tmp_path):
    df = spark.createDataFrame([(i % 50, j, ["user", "assistant", None][j % 3], f"t{i}.") for i in range(120) for j in range(4)], TYPE)
    for rows in (df, df.limit(0), df.selectExpr("cast(null as long) conv_id", "turn", "role", "text", "1 as conv", "2 as fault")):
        folder = f"{tmp_path}/{len(rows.columns)}-{rows.count()}"
        rows.coalesce(1).write.parquet(f"{folder}/conversations.parquet")
        found = R.op11_turn_repair(spark, folder)
        got = [tuple(r) for r in found.collect()]
        assert len(got) == rows.select("conv_id").distinct().count()
        sql = R.OP11_SQL.replace("FROM conversations", f"FROM read_parquet('{folder}/conversations.parquet/*.parquet')")
        names, expected = compare.sql_rows(folder, sql)
        assert compare.difference(found.columns, got, names, expected) is None


def test_edits_keep_the_text_of_rows(spark):
    df = spark.createDataFrame([(7, 1, "assistant", "b."), (7, 0, "user", "a."), (7, 2, "user", "c")], TYPE)
    found = [(r.edit, r.role, r.text, r.cost) for r in R.edits(df.withColumn("edit", df.turn)).collect()]
    assert found == [("K", "user", "a.", 0), ("K", "assistant", "b.", 0), ("D", None, "c", 4)]
