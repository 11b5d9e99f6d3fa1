"""Compare registered queries with their SQL on one folder of tables."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def sql_rows(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    names = [row[0] for row in connection.execute(f"DESCRIBE {sql}").fetchall()]
    return names, connection.execute(sql).fetchall()


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value)
    return value


def canonical(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(names, rows, other_names, other_rows) -> str | None:
    if sorted(names) != sorted(other_names):
        return f"columns {sorted(set(names) ^ set(other_names))}"
    ours, theirs = canonical(names, rows), canonical(other_names, other_rows)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{mine} != {other}"
    return None


_SAME = {
    "tinyint": "TINYINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def type_difference(dtypes: list[tuple[str, str]], folder: str, sql: str) -> dict:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    theirs = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (t, theirs.get(c)) for c, t in dtypes if _SAME.get(t, t) != theirs.get(c)}
