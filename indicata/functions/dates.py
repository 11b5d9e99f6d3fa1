"""Months, date windows and week buckets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from indicata.functions import fixed_values as V

MONTH_FORMAT = "yyyy-MM"


def parse_month(month: Column | str) -> Column:
    """The first day of a ``yyyy-MM`` month; null for anything else."""
    return F.try_to_date(month, MONTH_FORMAT)


def months_of(window: tuple[str, str]) -> list[str]:
    """Every ``yyyy-MM`` month from the first to the last of a window."""
    (first_year, first), (last_year, last) = (map(int, bound.split("-")) for bound in window)
    numbers = range(first_year * 12 + first - 1, last_year * 12 + last)
    return [f"{n // 12:04d}-{n % 12 + 1:02d}" for n in numbers]


def month_text_in(month: Column | str, window: tuple[str, str]) -> Column:
    """Whether ``yyyy-MM`` text is a month of the window.

    The same as parsing it and comparing dates, without the parsing: membership in the list of
    months, which the file scan narrows to a range.
    """
    column = F.col(month) if isinstance(month, str) else month
    return column.isin(months_of(window))


def month_in(month: Column | str, window: tuple[str, str]) -> Column:
    """``first <= month <= last`` on a date column."""
    column = F.col(month) if isinstance(month, str) else month
    first, last = (F.lit(f"{bound}-01").cast("date") for bound in window)
    return column.between(first, last)


def week_ranges(
    year: int = V.CASE_YEAR, last_weeks: tuple[int, ...] = V.LAST_WEEK_OF_MONTH
) -> list[tuple[int, int, str]]:
    """``(first week, last week, month)`` rows of the week-to-month table."""
    firsts = (0, *(last + 1 for last in last_weeks[:-1]))
    return [
        (first, last, f"{year}-{number:02d}")
        for number, (first, last) in enumerate(zip(firsts, last_weeks), start=1)
    ]


def week_bucket(
    week: Column | str, ranges: list[tuple[int, int, str]] | None = None
) -> Column:
    """The month label of a week number; null outside every range."""
    column = F.col(week) if isinstance(week, str) else week
    first, *rest = ranges or week_ranges()
    return reduce(
        lambda chain, r: chain.when(column.between(r[0], r[1]), F.lit(r[2])),
        rest,
        F.when(column.between(first[0], first[1]), F.lit(first[2])),
    )
