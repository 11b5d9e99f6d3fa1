"""Sums and counts per raw key, merged after the keys are cleaned.

Parsing a month, stripping a code or running a chain of patterns costs far more than a hash lookup,
and a table has few distinct months and labels however many rows it has. So rows are first reduced
to one sum and one count per raw key, with nothing but the stored columns touched per row; the keys
are cleaned on that small frame and equal cleaned keys merged. Sums and counts merge exactly, so
totals and means are those of the rows. The first step combines map-side, so a key that holds most
of the rows costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions import dates

SUM, COUNT = "_sum", "_count"


def summary(obs: DataFrame, columns: list[str], value: str = "VALUE") -> DataFrame:
    """One row per distinct ``columns`` that stands for all its rows in every total and mean.

    A job takes a summary in place of the observations when it filters and groups by ``columns``
    only. Several jobs over one table then share one scan of it. The value must be whole numbers of int
    range, as jobs that truncate values to it could not truncate those already summed.
    """
    kind = obs.schema[value].dataType.typeName()
    if kind not in ("byte", "short", "integer"):
        raise TypeError(f"only whole values up to int can be summarised, {value} is {kind}")
    return obs.groupBy(*[F.col(f"`{column}`") for column in columns]).agg(
        F.sum(value).alias(SUM), F.count(value).alias(COUNT)
    )


def partial_sums(df: DataFrame, keys: list[str], value: Column | str = "VALUE") -> DataFrame:
    """One row per distinct ``keys`` with the sum and the non-null count of ``value``."""
    if SUM in df.columns:
        sums = (F.sum(SUM), F.sum(COUNT))
    else:
        sums = (F.sum(value), F.count(value))
    return df.groupBy(*[F.col(f"`{key}`") for key in keys]).agg(
        sums[0].alias(SUM), sums[1].alias(COUNT)
    )


def after_sums(key: Column) -> Column:
    """A cleaned key that is only ever computed on partials.

    The optimizer moves a filter on a grouping key (or the null check of a join on it) below the
    aggregate, and would clean the key of every row there. A key that also reads the count cannot
    move below the aggregate that makes the count.
    """
    return F.when(F.col(COUNT) >= 0, key)


def real_months(partials: DataFrame, month: str = "REF_DATE") -> DataFrame:
    """Turn the month text of partials into a date; text that is no month becomes null."""
    if partials.schema[month].dataType.typeName() != "string":
        return partials
    return partials.withColumn(month, after_sums(dates.parse_month(month)))


def total() -> Column:
    """The total over merged partials; null when there was no value."""
    return F.sum(SUM)


def mean() -> Column:
    """The mean over merged partials; null when there was no value."""
    return F.try_divide(F.sum(SUM), F.sum(COUNT))


def mean_where(condition: Column) -> Column:
    """``mean`` over the partials that meet a condition."""
    return F.try_divide(F.sum(F.when(condition, F.col(SUM))), F.sum(F.when(condition, F.col(COUNT))))


def merge(partials: DataFrame, keys: Mapping[str, Column], **measures: Column) -> DataFrame:
    """Merge partials whose cleaned ``keys`` are equal."""
    cleaned = partials.select(*[key.alias(name) for name, key in keys.items()], SUM, COUNT)
    return cleaned.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])
