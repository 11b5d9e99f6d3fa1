"""Operators that bring two or more series together."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions import labels, numbers
from indicata.operators import filters
from indicata.operators import partials as P


def joint_monthly_means(
    left: DataFrame,
    right: DataFrame,
    left_value: str,
    right_value: str,
    left_name: str,
    right_name: str,
    left_month: str = "REF_DATE",
    right_month: str = "YEAR",
    right_where: Mapping[str, object] | Column | None = None,
) -> DataFrame:
    """Mean of each side per month, for the months both sides have.

    Joining the rows first would pair every left member with every right member of a month. That
    repeats each row equally often and leaves both means as they are, so each side is averaged
    before the join and the join is one row to one row.
    """
    lefts = left.groupBy(F.col(left_month).alias("REF_DATE")).agg(F.avg(left_value).alias(left_name))
    rights = (
        filters.keep(right, right_where)
        .groupBy(F.col(right_month).alias("REF_DATE"))
        .agg(F.avg(right_value).alias(right_name))
    )
    return lefts.join(rights, "REF_DATE", "inner")


def series_panel(
    rows: DataFrame,
    series: Mapping[str, tuple[str, str, float]],
    value: str = "VALUE",
    date: str = "DATE",
    name: str = "series",
) -> DataFrame:
    """One row per year with a column per series, for the years every series has a row in.

    ``series`` maps a name to its first day, last day and divisor. All series are filtered in one
    pass and gathered by one aggregate on the year, where a star of joins would shuffle or broadcast
    once per series. A year counts as present by its row, whatever its value; two rows for one
    series and year fail the query.
    """
    members: dict[tuple[str, str], list[str]] = {}
    for member, (first, last, _) in series.items():
        members.setdefault((first, last), []).append(member)
    bounds = [
        F.col(name).isin(names)
        & F.col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        for (first, last), names in members.items()
    ]
    measures = []
    for member, (_, _, divisor) in series.items():
        here = F.col(name) == F.lit(member)
        measures.append(F.count_if(here).alias(f"{member}_rows"))
        measures.append(F.max(F.when(here, numbers.scaled(value, divisor))).alias(member))
    years = (
        rows.where(reduce(or_, bounds))
        .groupBy(F.year(date).alias(date))
        .agg(*measures)
        .where(reduce(and_, [F.col(f"`{member}_rows`") > 0 for member in series]))
    )
    checked = [
        F.when(
            F.col(f"`{member}_rows`") > 1,
            F.raise_error(F.lit(f"series panel: more than one {member} row in a year")).cast("double"),
        )
        .otherwise(F.col(f"`{member}`"))
        .alias(member)
        for member in series
    ]
    return years.select(date, *checked)


def relabelled_monthly_means(
    obs: DataFrame,
    label: str,
    rules: Iterable[tuple[str, str]],
    name: str,
    where: Mapping[str, object] | Column | None = None,
    window: tuple[str, str] | None = None,
    required: list[str] | None = None,
    null_rule: str = "all",
    label_name: str = "NAICS",
) -> DataFrame:
    """Mean of the truncated value per month and cleaned label.

    A label is cleaned by dropping its code and applying ``rules``, once per distinct label and month
    and not once per row.
    """
    rows = filters.observed(obs, where, window, required, null_rule)
    sums = P.partial_sums(rows, ["REF_DATE", label], numbers.truncated("VALUE"))
    sums = P.real_months(sums)
    cleaned = P.after_sums(labels.apply_rules(labels.strip_code(F.col(f"`{label}`")), rules))
    return P.merge(sums, {"REF_DATE": F.col("REF_DATE"), label_name: cleaned}, **{name: P.mean()})


def monthly_productivity(output: DataFrame, hours: DataFrame, factor: float = 1000) -> DataFrame:
    """Output per hour, for the months and industries both sides have."""
    return output.join(hours, ["REF_DATE", "NAICS"], "inner").withColumn(
        "labour_productivity", numbers.ratio("GDP_VALUE", "HOURS_WORKED", factor)
    )


def yearly_productivity(monthly: DataFrame) -> DataFrame:
    """Yearly means; the yearly ratio is the mean of the monthly ratios."""
    return monthly.groupBy(F.year("REF_DATE").alias("YEAR"), "NAICS").agg(
        *[
            F.avg(name).alias(name)
            for name in ("HOURS_WORKED", "GDP_VALUE", "labour_productivity")
        ]
    )


def join_panel(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Inner join of frames on one key of one type."""
    return reduce(lambda left, right: left.join(right, key, "inner"), frames)


def merge_monthly(trend: DataFrame, panel: DataFrame, month: str = "Month") -> DataFrame:
    """Full outer join on a month date, the month last."""
    merged = trend.join(panel, month, "outer")
    return merged.select(*[F.col(f"`{c}`") for c in merged.columns if c != month], month)


def prediction_features(
    productivity: DataFrame,
    prices: DataFrame,
    trade: DataFrame,
    spending: DataFrame,
    region: str = "Canada",
    industry: str = "All industries",
    feature_type: str = "decimal(10,0)",
) -> DataFrame:
    """One row per year of model features.

    Inputs are the yearly productivity, yearly price, monthly trade and yearly spending tables.
    ``feature_type`` is the type inputs are taken in: ``decimal(10,0)`` rounds them to whole numbers,
    ``double`` keeps them.
    """

    def feature(name: str) -> Column:
        return numbers.feature_cast(F.col(f"`{name}`"), feature_type)

    hours = productivity.where(F.col("NAICS") == industry).select(
        "YEAR",
        (feature("HOURS_WORKED") * 1000).alias("Hours_Worked"),
        feature("labour_productivity").alias("labour_productivity"),
    )
    cpi = prices.where(F.col("YEAR").isNotNull()).select("YEAR", feature(region).alias("CPI"))
    traded = (
        trade.where(F.col("REF_DATE").isNotNull())
        .groupBy(F.year("REF_DATE").alias("YEAR"))
        .agg(
            F.avg(feature("Avg GDP Value")).alias("GDP_millions"),
            F.avg(feature("Avg Merch Trade Value")).alias("Merchant_Trade_millions"),
        )
    )
    spent = spending.where(F.col("YEAR").isNotNull()).select(
        "YEAR", feature("household_expenditure*(10^6)").alias("household_expenditure_millions")
    )
    return join_panel([hours, cpi, traded, spent], "YEAR")
