"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.operators import filters
from indicata.operators import partials as P
from indicata.session import checkpointed


def _quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def pivot_domain(df: DataFrame, column: str) -> list:
    """The distinct values of a small frame's column, ascending, nulls first.

    More of them than ``spark.sql.pivotMaxValues`` is an error, as for Spark's own pivot.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = df.select(_quoted(column)).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{column!r} has more than {limit} distinct values to pivot on")
    return sorted((row[0] for row in found), key=lambda value: (value is not None, value))


def _is(column: str, value: object) -> Column:
    return _quoted(column).isNull() if value is None else _quoted(column) == F.lit(value)


def _name(value: object) -> str:
    return "null" if value is None else str(value)


def eav_to_wide(
    eav: DataFrame,
    key: str,
    attribute: str,
    value: str,
    attributes: Sequence[str],
) -> DataFrame:
    """One row per ``key`` with a column per attribute.

    The attributes are known, so this is one aggregate per attribute and one shuffle on the key,
    where a generic pivot would shuffle on (key, attribute) and then again on the key. A cell that
    occurs more than once gives its largest value; ``duplicate_cells`` finds those.
    """
    return eav.groupBy(_quoted(key)).agg(
        *[F.max(F.when(_is(attribute, name), _quoted(value))).alias(name) for name in attributes]
    )


def duplicate_cells(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The cells that occur more than once, with their number of rows."""
    return df.groupBy(*[_quoted(key) for key in keys]).agg(F.count("*").alias("rows")).where("rows > 1")


def pivot_indicator(
    obs: DataFrame,
    column: str,
    by: str = "month",
    value: Column | str = "VALUE",
    where: Mapping[str, object] | Column | None = None,
    window: tuple[str, str] | None = None,
    required: list[str] | None = None,
    null_rule: str = "all",
    digits: int | None = None,
    values: Sequence[str] | None = None,
    dropped: Sequence[str] = (),
    month: str = "REF_DATE",
) -> DataFrame:
    """Mean value per month (or year) with one output column per member of ``column``.

    Members not given as ``values`` are discovered. Discovery reads the per-cell sums, computed once
    and checkpointed, and not the observations a second time.
    """
    rows = filters.observed(obs, where, window, required, null_rule, month)
    sums = P.real_months(P.partial_sums(rows, [month, column], value), month)
    if values is None:
        sums = checkpointed(sums)
        values = pivot_domain(sums, column)
    key, name = (F.year(month), "YEAR") if by == "year" else (F.col(month), month)
    means = [(_name(member), P.mean_where(_is(column, member))) for member in values]
    return sums.groupBy(key.alias(name)).agg(
        *[
            (mean if digits is None else F.round(mean, digits)).alias(member)
            for member, mean in means
            if member not in dropped
        ]
    )


def pivot_means(
    df: DataFrame,
    key: Column,
    key_name: str,
    column: str,
    value: str,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Mean per ``key`` with one column per member, for a frame that is already small.

    Members not given are discovered on the checkpointed frame, so what leads to it runs once.
    """
    if values is None:
        df = checkpointed(df)
        values = pivot_domain(df, column)
    return df.groupBy(key.alias(key_name)).agg(
        *[F.avg(F.when(_is(column, member), _quoted(value))).alias(_name(member)) for member in values]
    )


def label_pivot(
    cells: DataFrame,
    key: str,
    label: str,
    value: str,
    prefix: str = "",
    suffix: str = "",
    values: Sequence[str] | None = None,
    month: bool = False,
) -> DataFrame:
    """One column per label, named ``prefix + label + suffix``; the largest value of a cell.

    Cells are reduced before labels are discovered, so discovery reads the reduced frame. With
    ``month`` the key may be month text and becomes a date.
    """
    reduced = cells.groupBy(_quoted(key), _quoted(label)).agg(
        F.max(_quoted(value)).alias(value), F.count("*").alias(P.COUNT)
    )
    if month:
        reduced = P.real_months(reduced, key)
    if values is None:
        reduced = checkpointed(reduced)
        values = pivot_domain(reduced, label)
    return reduced.groupBy(_quoted(key)).agg(
        *[
            F.max(F.when(_is(label, member), _quoted(value))).alias(f"{prefix}{member}{suffix}")
            for member in values
            if member is not None
        ]
    )


def select_years(
    wide: DataFrame,
    key: str,
    years: Sequence[str],
    required: list[str],
) -> DataFrame:
    """The distinct complete rows of ``key`` and ``years``."""
    return (
        filters.require(wide, required, "any")
        .select(_quoted(key), *[_quoted(year) for year in years])
        .dropna()
        .distinct()
    )


def unpivot_columns(
    df: DataFrame, key: str, columns: Sequence[str], name: str = "name", value: str = "value"
) -> DataFrame:
    """One row per (row, column) of ``columns``."""
    return df.unpivot([_quoted(key)], [_quoted(column) for column in columns], name, value)


def collected_text(value: Column | str, separator: str = "") -> Column:
    """All values of a group that are not null as one text, in ascending order of the values (not of their text).

    The text holds every value, so it is for groups whose values fit into a cell.
    """
    column = F.col(value) if isinstance(value, str) else value
    ordered = F.array_sort(F.collect_list(column))
    return F.array_join(F.transform(ordered, lambda x: x.cast("string")), separator)


def transpose_panel(
    panel: DataFrame,
    columns: Sequence[str],
    pivot_column: str,
    values: Sequence[object] | None = None,
    as_text: bool = True,
    separator: str = "",
) -> DataFrame:
    """Turn ``columns`` into rows and the values of ``pivot_column`` into columns.

    The first output column carries the old column names under the name ``pivot_column``. As text, a cell has
    all its values in ascending order, joined by ``separator``, and is empty without any. With ``as_text=False`` it
    has its one value or null, and two rows for one ``pivot_column`` value fail the query, as no single value is right.

    Cells are made first, each in the task its (column, value) goes to, and the pivot then reads one row per cell;
    ``values`` not given are discovered on these.
    """
    long = unpivot_columns(panel, pivot_column, columns, "_name", "_value")
    cell = collected_text("_value", separator) if as_text else F.max("_value")
    cells = long.groupBy("_name", _quoted(pivot_column)).agg(cell.alias("_cell"), F.count("*").alias("_rows"))
    if values is None:
        cells = checkpointed(cells)
        values = pivot_domain(cells, pivot_column)
    found = []
    for value in values:
        here = _is(pivot_column, value)
        content = F.max(F.when(here, F.col("_cell")))
        if as_text:
            content = F.coalesce(content, F.lit(""))
        else:
            several = F.raise_error(F.lit(f"transpose: more than one row for {pivot_column} {value}"))
            content = F.when(F.max(F.when(here, F.col("_rows"))) > 1, several.cast(cells.schema["_cell"].dataType)).otherwise(content)
        found.append(content.alias(_name(value)))
    return cells.groupBy(F.col("_name").alias(pivot_column)).agg(*found)
