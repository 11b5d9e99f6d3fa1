"""Row filters."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions import dates
from indicata.operators import partials as P


def require(df: DataFrame, columns: list[str], rule: str = "all") -> DataFrame:
    """Drop rows by nulls in ``columns``.

    ``rule="any"`` drops a row when any of them is null, ``rule="all"`` only when all are. A summary
    has no value column; its row has a value when it counts one.
    """
    present = [
        F.col(P.COUNT) > 0
        if name == "VALUE" and P.SUM in df.columns
        else F.col(f"`{name}`").isNotNull()
        for name in columns
    ]
    return df.where(reduce(and_ if rule == "any" else or_, present))


def matching(where: Mapping[str, object] | Column | None) -> Column | None:
    """A condition from ``{column: value}`` equalities, or a condition passed through."""
    if where is None or isinstance(where, Column):
        return where
    return reduce(and_, [F.col(f"`{name}`") == F.lit(value) for name, value in where.items()])


def keep(df: DataFrame, where: Mapping[str, object] | Column | None) -> DataFrame:
    """Keep the rows ``where`` describes; no condition keeps all."""
    condition = matching(where)
    return df if condition is None else df.where(condition)


def without_members(df: DataFrame, column: str, members: tuple[str, ...]) -> DataFrame:
    """Drop rows whose ``column`` is null or one of ``members``."""
    return df.where(~F.col(f"`{column}`").isin(*members)) if members else df


#: A date or timestamp that months follow from, with how far they are moved in its metadata.
STORED_DATE = "_stored_date"
#: The year of a stored month, by which a table is laid out in folders.
YEAR_PARTITION = "REF_YEAR"


def stored_date(date: Column | str, months_later: int = 0, span: int = 1) -> Column:
    """``date`` as the column by which windows and prefixes of ``REF_DATE`` narrow the scan of a table.

    The month of ``REF_DATE`` must be that of the first date of a run of ``span`` months, ``months_later`` months on.
    """
    column = F.col(date) if isinstance(date, str) else date
    return column.alias(STORED_DATE, metadata={"months_later": months_later, "span": span})


def _stored_range(df: DataFrame, first: int, after: int) -> Column:
    """What the months from ``first`` to before ``after``, counted from year 0, mean for the columns a scan knows.

    This follows from the condition on the month itself and drops no further row; but only this reaches the files.
    """
    found = F.lit(True)
    if STORED_DATE in df.columns:
        about = df.schema[STORED_DATE]
        low = first - about.metadata["months_later"]
        high = after - about.metadata["months_later"] + about.metadata["span"] - 1
        bounds = [F.lit(f"{n // 12:04d}-{n % 12 + 1:02d}-01").cast(about.dataType) for n in (low, high)]
        found = found & (F.col(STORED_DATE) >= bounds[0]) & (F.col(STORED_DATE) < bounds[1])
    if YEAR_PARTITION in df.columns:
        found = found & F.col(YEAR_PARTITION).between(first // 12, (after - 1) // 12)
    return found


def within_months(df: DataFrame, window: tuple[str, str] | None, month: str = "REF_DATE") -> DataFrame:
    """Keep a window of months, given as text or as dates; no window keeps all."""
    if window is None:
        return df
    if month == "REF_DATE":
        first, last = (int(y) * 12 + int(m) - 1 for y, m in (bound.split("-") for bound in window))
        df = df.where(_stored_range(df, first, last + 1))
    if df.schema[month].dataType.typeName() == "string":
        return df.where(dates.month_text_in(month, window))
    return df.where(dates.month_in(month, window))


def observed(
    obs: DataFrame,
    where: Mapping[str, object] | Column | None = None,
    window: tuple[str, str] | None = None,
    required: list[str] | None = None,
    null_rule: str = "all",
    month: str = "REF_DATE",
) -> DataFrame:
    """The rows a job looks at: present, matching and within its window.

    A row inside a window has a month, so a rule that only drops rows without month, place and value
    has nothing left to drop there and is not evaluated.
    """
    implied = window is not None and null_rule == "all" and month in (required or [])
    rows = require(obs, required, null_rule) if required and not implied else obs
    return within_months(keep(rows, where), window, month)


def with_prefix(df: DataFrame, column: str, prefixes: tuple[str, ...]) -> DataFrame:
    """Keep rows whose ``column``, as text, starts with one of ``prefixes``."""
    text = F.col(column)
    if df.schema[column].dataType.typeName() != "string":
        text = text.cast("string")
    if column == "REF_DATE" and all(p.isdigit() and len(p) <= 4 for p in prefixes):
        # the beginning of a year is a range of years
        spans = [(int(p.ljust(4, "0")), 10 ** (4 - len(p))) for p in prefixes]
        df = df.where(reduce(or_, [_stored_range(df, 12 * y, 12 * (y + n)) for y, n in spans]))
    return df.where(reduce(or_, [text.startswith(prefix) for prefix in prefixes]))
