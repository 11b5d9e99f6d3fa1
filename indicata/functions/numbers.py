"""Number conversions that give null where a strict cast or division would fail."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def truncated(value: Column | str) -> Column:
    """The whole part as int; null when it does not fit."""
    return _column(value).try_cast("int")


def ratio(numerator: Column | str, denominator: Column | str, factor: float = 1) -> Column:
    """``numerator / denominator * factor``; null for a zero denominator."""
    quotient = F.try_divide(_column(numerator), _column(denominator))
    return quotient if factor == 1 else quotient * F.lit(factor)


def scaled(value: Column | str, divisor: float) -> Column:
    """``value / divisor`` as double."""
    number = _column(value).cast("double")
    return number if divisor == 1 else number / F.lit(float(divisor))


def row_total(columns: list[str], null_as_zero: bool = False) -> Column:
    """The sum across columns; one null makes it null unless ``null_as_zero``."""
    terms = [F.col(f"`{name.replace('`', '``')}`") for name in columns]
    if null_as_zero:
        terms = [F.coalesce(term, F.lit(0)) for term in terms]
    return reduce(add, terms)


def feature_cast(value: Column | str, feature_type: str) -> Column:
    """``value`` in the type model features are kept in; null when it does not fit."""
    return _column(value).try_cast(feature_type)
