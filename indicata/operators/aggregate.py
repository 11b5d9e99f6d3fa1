"""Totals, means and conditional counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.operators import filters
from indicata.operators import partials as P


def indicator_totals(
    obs: DataFrame,
    by: Mapping[str, str],
    total_name: str,
    where: Mapping[str, object] | Column | None = None,
    window: tuple[str, str] | None = None,
    excluded: Mapping[str, tuple[str, ...]] | None = None,
    above: float | None = None,
    month_name: str = "REF_DATE",
    null_rule: str = "any",
    value: str = "VALUE",
) -> DataFrame:
    """Total value per month and per ``by`` columns (``{output name: source column}``).

    ``excluded`` drops members of source columns, ``above`` keeps only totals over a bound.
    """
    rows = filters.observed(obs, where, window, ["REF_DATE", value], null_rule)
    for column, members in (excluded or {}).items():
        rows = filters.without_members(rows, column, members)
    sums = P.real_months(P.partial_sums(rows, ["REF_DATE", *by.values()], value))
    names = {month_name: F.col("REF_DATE")}
    names.update({name: F.col(f"`{column}`") for name, column in by.items()})
    if window is None:
        # unparsable months all become null here and have to meet again
        totals = P.merge(sums, names, **{total_name: P.total()})
    else:
        totals = sums.select(
            *[column.alias(name) for name, column in names.items()], F.col(P.SUM).alias(total_name)
        )
    return totals if above is None else totals.where(F.col(total_name) > above)


def select_member(totals: DataFrame, column: str, member: str, renames: Mapping[str, str]) -> DataFrame:
    """The rows of one member, with columns picked and renamed by ``{source: output}``."""
    return totals.where(F.col(f"`{column}`") == F.lit(member)).select(
        *[F.col(f"`{source}`").alias(name) for source, name in renames.items()]
    )


def monthly_means(
    series: DataFrame,
    columns: Mapping[str, str],
    window: tuple[str, str] | None = None,
    month: str = "REF_DATE",
) -> DataFrame:
    """Mean per month of several columns (``{output name: source column}``)."""
    rows = filters.within_months(series.where(F.col(month).isNotNull()), window, month)
    raw = rows.groupBy(month).agg(
        F.count("*").alias(P.COUNT),
        *[
            measure
            for name, column in columns.items()
            for measure in (F.sum(column).alias(f"{name}_s"), F.count(column).alias(f"{name}_n"))
        ]
    )
    merged = P.real_months(raw, month)
    means = [
        F.try_divide(F.sum(f"{name}_s"), F.sum(f"{name}_n")).alias(name) for name in columns
    ]
    return merged.groupBy(month).agg(*means)


def yearly_means(
    obs: DataFrame,
    name: str,
    value: Column | str = "VALUE",
    where: Mapping[str, object] | Column | None = None,
    window: tuple[str, str] | None = None,
    required: list[str] | None = None,
    null_rule: str = "all",
    digits: int | None = None,
    month: str = "REF_DATE",
    year_name: str = "YEAR",
) -> DataFrame:
    """Mean value per calendar year of the month column."""
    rows = filters.observed(obs, where, window, required, null_rule, month)
    sums = P.real_months(P.partial_sums(rows, [month], value), month)
    mean = P.mean() if digits is None else F.round(P.mean(), digits)
    return P.merge(sums, {year_name: F.year(month)}, **{name: mean})


def counts_by_period(
    cases: DataFrame,
    period: str,
    recovery_period: str,
    by: tuple[str, ...],
    total_name: str,
    recovered_name: str,
    flags: Mapping[str, Column],
    recovered: Column,
) -> DataFrame:
    """Counts per period, in one pass over the cases.

    A case counts in its own period, and a recovered one also in the period it recovered in. Each
    case therefore yields one or two entries which are counted together, instead of counting every
    condition apart and joining the results. ``flags`` are the conditional counts of the case's own
    period. Conditional counts are 0 where a key is null, as keys that are null match nothing in a
    join; periods with recoveries only are left out.
    """
    keys_known = reduce(and_, [F.col(f"`{key}`").isNotNull() for key in by], F.lit(True))
    own = F.struct(F.col(f"`{period}`").alias("period"), F.lit(False).alias("recovery"))
    later = F.struct(F.col(f"`{recovery_period}`").alias("period"), F.lit(True).alias("recovery"))
    both = recovered & F.col(f"`{recovery_period}`").isNotNull() & keys_known
    entries = cases.select(
        *[F.col(f"`{key}`") for key in by],
        *[condition.alias(name) for name, condition in flags.items()],
        F.explode(F.when(both, F.array(own, later)).otherwise(F.array(own))).alias("entry"),
    ).select("*", "entry.period", "entry.recovery")
    is_own = ~F.col("recovery")
    countable = is_own & F.col("period").isNotNull() & keys_known
    counted = entries.groupBy("period", *[F.col(f"`{key}`") for key in by]).agg(
        F.count_if(is_own).alias(total_name),
        F.count_if(F.col("recovery")).alias(recovered_name),
        *[F.count_if(countable & F.col(f"`{name}`")).alias(name) for name in flags],
    )
    return counted.where(F.col(f"`{total_name}`") > 0)


def nulls_for_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Turn counts of 0 into null, as a left join that finds nothing would."""
    return df.withColumns({name: F.nullif(F.col(f"`{name}`"), F.lit(0)) for name in columns})
