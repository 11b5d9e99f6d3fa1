"""One function per indicator table: DataFrames in, DataFrame out.

Defaults give the published tables. Filters, windows and labels are parameters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions import dates, labels, numbers
from indicata.functions import fixed_values as V
from indicata.operators import aggregate as A
from indicata.operators import combine as C
from indicata.operators import filters
from indicata.operators import reshape as R

ANNUAL_RATES = {"Seasonal adjustment": V.ADJUSTED_ANNUAL}
_PRESENT = ["REF_DATE", "GEO", "VALUE"]


# --- ingest ------------------------------------------------------------------------------------


def cleansed(
    raw: DataFrame,
    prefixes: tuple[str, ...] = V.CLEANSE_PREFIXES,
    month_dates: bool = False,
    text_name: str | None = None,
) -> DataFrame:
    """The rows of the kept decades.

    ``month_dates`` stores month text as dates, parsed here once and for all: every job takes either
    kind, and on a column of dates its window reaches the file scan as a range. ``text_name`` adds a column with
    the text of those that are no month, whose date is null.
    """
    kept = filters.with_prefix(raw, "REF_DATE", prefixes)
    if month_dates and raw.schema["REF_DATE"].dataType.typeName() == "string":
        date = dates.parse_month("REF_DATE")
        added = {text_name: F.when(date.isNull(), F.col("REF_DATE"))} if text_name else {}
        kept = kept.withColumns({**added, "REF_DATE": date})
    return kept


# --- cases -------------------------------------------------------------------------------------


def covid_cases(eav: DataFrame, week_ranges: list[tuple[int, int, str]] | None = None) -> DataFrame:
    """One decoded row per case."""
    wide = R.eav_to_wide(eav, V.CASE_ID, V.CASE_ATTRIBUTE, "VALUE", V.CASE_ATTRIBUTES)
    return decoded_cases(wide, week_ranges)


def decoded_cases(wide: DataFrame, week_ranges: list[tuple[int, int, str]] | None = None) -> DataFrame:
    """Case codes turned into labels, booleans and months."""

    def text(name: str) -> Column:
        return labels.decode(name, V.CASE_CODES[name])

    return wide.select(
        V.CASE_ID,
        "Episode week",
        "Recovery week",
        dates.week_bucket("Episode week", week_ranges).alias("Episode month"),
        dates.week_bucket("Recovery week", week_ranges).alias("Recovery month"),
        text("Region").alias("Region"),
        text("Gender").alias("Gender"),
        text("Age group").alias("Age_group"),
        text("Occupation").alias("Occupation"),
        text("Transmission").alias("Transmission"),
        text("Hospital status").alias("Hospital status"),
        *[labels.to_boolean(name).alias(name) for name in V.BOOLEAN_ATTRIBUTES],
    )


def _equals(column: str, values: Sequence[str]) -> dict[str, Column]:
    return {value: F.col(column) == F.lit(value) for value in values}


def provincial_cases(cases: DataFrame, fill_keys: bool = True) -> DataFrame:
    """Weekly counts per region. ``fill_keys`` also turns an unknown week into week 0."""
    ages = list(V.CASE_CODES["Age group"].values())
    counted = A.counts_by_period(
        cases,
        period="Episode week",
        recovery_period="Recovery week",
        by=("Region",),
        total_name=V.NEW_CASES_WEEKLY,
        recovered_name=V.RECOVERED_CASES,
        flags={
            V.DEATHS: F.col("Death"),
            **_equals("Age_group", ages),
            V.INTERNATIONAL_CASES: F.col("Transmission").like(V.INTERNATIONAL_TRAVEL),
            V.ASYMPTOMATIC_CASES: F.col("Asymptomatic"),
        },
        recovered=F.col("Recovered"),
    )
    week = F.coalesce("period", F.lit(0)) if fill_keys else F.col("period")
    counts = [c for c in counted.columns if c not in ("period", "Region")]
    return counted.select(week.alias("Week Number"), "Region", *[F.col(f"`{c}`") for c in counts])


def case_trend(cases: DataFrame) -> DataFrame:
    """Monthly counts of the cases with a known month; what a month lacks is null."""
    statuses = list(V.CASE_CODES["Hospital status"].values())
    counted = A.counts_by_period(
        cases,
        period="Episode month",
        recovery_period="Recovery month",
        by=(),
        total_name=V.NEW_CASES_MONTHLY,
        recovered_name=V.RECOVERED_CASES,
        flags={
            V.DEATHS: F.col("Death"),
            **_equals("Hospital status", statuses),
            V.CARE_WORKERS_AFFECTED: F.col("Occupation") == V.CARE_WORKER,
        },
        recovered=F.col("Recovered"),
    )
    known = counted.where(F.col("period").isNotNull()).withColumnRenamed("period", "Month")
    return A.nulls_for_zero(known, [c for c in known.columns if c not in ("Month", V.NEW_CASES_MONTHLY)])


# --- output and trade --------------------------------------------------------------------------


def gdp_output(
    gdp: DataFrame,
    where: Mapping[str, object] | Column = ANNUAL_RATES,
    window: tuple[str, str] = V.DECADE,
) -> DataFrame:
    """Monthly GDP per industry."""
    return A.indicator_totals(
        gdp,
        by={"NAICS": V.NAICS},
        total_name=V.TOTAL_GDP,
        where=where,
        window=window,
        excluded={V.NAICS: V.CANNABIS_INDUSTRIES},
        above=100,
    )


def trade_output(trade: DataFrame, window: tuple[str, str] = V.DECADE) -> DataFrame:
    """Monthly merchandise trade per product, direction and basis."""
    return A.indicator_totals(
        trade,
        by={"NAPCS": V.NAPCS, "Trade": "Trade", "Basis": "Basis"},
        total_name=V.TOTAL_TRADE,
        where={"Seasonal adjustment": V.ADJUSTED},
        window=window,
        above=100,
        month_name="YEAR",
    )


def gdp_trade_output(gdp_totals: DataFrame, trade_totals: DataFrame) -> DataFrame:
    """Mean monthly GDP beside mean monthly trade on customs basis."""
    return C.joint_monthly_means(
        gdp_totals,
        trade_totals,
        V.TOTAL_GDP,
        V.TOTAL_TRADE,
        V.MEAN_GDP,
        V.MEAN_TRADE,
        right_where={"Basis": V.CUSTOMS_BASIS},
    )


# --- retail and stock --------------------------------------------------------------------------


def retail_by_province(retail: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """Mean monthly retail sales with a column per province."""
    return R.pivot_indicator(
        retail,
        "GEO",
        where=(F.col("Adjustments") == V.ADJUSTED)
        & ~F.col("GEO").contains(",")
        & (F.col("GEO") != V.NATIONAL),
        window=V.DECADE,
        required=_PRESENT,
        values=values,
    )


def retail_by_industry(
    retail: DataFrame,
    values: Sequence[str] | None = None,
    dropped: Sequence[str] = V.EMPTY_RETAIL_INDUSTRIES,
    window: tuple[str, str] = V.DECADE,
) -> DataFrame:
    """Mean monthly national retail sales with a column per industry."""
    return R.pivot_indicator(
        retail,
        V.NAICS,
        where={"Adjustments": V.ADJUSTED, "GEO": V.NATIONAL},
        window=window,
        required=_PRESENT,
        values=values,
        dropped=dropped,
    )


def stock_output(stock: DataFrame, window: tuple[str, str] | None = V.DECADE) -> DataFrame:
    """Mean monthly volume, high and low."""
    return A.monthly_means(
        stock,
        V.STOCK_MEANS,
        window,
    )


def retail_stock_output(
    by_industry: DataFrame,
    stock: DataFrame,
    exclude: Sequence[str] = (),
    null_as_zero: bool = False,
) -> DataFrame:
    """The row total over industries beside the stock means.

    The total counts every industry column, the whole sector too if it is one; ``exclude`` leaves
    columns out.
    """
    industries = [c for c in by_industry.columns if c != "REF_DATE" and c not in exclude]
    totals = by_industry.select(
        "REF_DATE", numbers.row_total(industries, null_as_zero).alias(V.TOTAL_RETAIL)
    )
    return totals.join(stock, "REF_DATE", "inner")


# --- macro indicators --------------------------------------------------------------------------


def macro_output(macro: DataFrame, years: Sequence[str] = V.MACRO_KEPT_YEARS) -> DataFrame:
    """The distinct complete macro series over the kept years."""
    return R.select_years(macro, "Subject Descriptor", years, ["Subject Descriptor", "Units"])


def development_output(
    panel: DataFrame,
    country: str = V.NATIONAL,
    years: Sequence[int] = V.DEVELOPMENT_YEARS,
    as_text: bool = True,
    values: Sequence[int] | None = None,
) -> DataFrame:
    """One row per financial-development index with a column per year that has rows.

    ``years`` bounds the years; ``values`` names the columns instead of discovering them.
    """
    rows = filters.require(panel, ["ifs", "code", "country"], "any").where(
        (F.col("country") == country) & F.col("year").between(min(years), max(years))
    )
    return R.transpose_panel(
        rows.select("year", *V.DEVELOPMENT_INDICES), V.DEVELOPMENT_INDICES, "year", values, as_text
    )


# --- prices ------------------------------------------------------------------------------------


def cpi_output(cpi: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """Mean yearly consumer prices with a column per place."""
    return R.pivot_indicator(
        cpi,
        "GEO",
        by="year",
        where=(F.col(V.PRODUCT_GROUP) == V.ALL_ITEMS) & ~F.col("GEO").contains(","),
        window=V.DECADE,
        required=_PRESENT,
        digits=2,
        values=values,
    )


# --- productivity ------------------------------------------------------------------------------


def monthly_productivity(
    gdp: DataFrame,
    hours: DataFrame,
    legacy_rules: bool = False,
    gdp_where: Mapping[str, object] | Column | None = None,
) -> DataFrame:
    """GDP, hours and GDP per hour, by month and industry.

    ``legacy_rules`` keeps the published pattern under which wholesale trade finds no hours.
    ``gdp_where`` narrows the GDP rows further, to one price basis for example.
    """
    rules = V.GDP_RELABEL
    if legacy_rules:
        rules = (V.GDP_RELABEL_LEGACY_FIRST, *rules[1:])
    output = C.relabelled_monthly_means(
        filters.keep(gdp, gdp_where),
        V.NAICS,
        rules,
        "GDP_VALUE",
        where={"Seasonal adjustment": V.ADJUSTED_TRADING_DAY},
        window=V.DECADE,
        required=_PRESENT,
    )
    worked = C.relabelled_monthly_means(
        hours,
        V.NAICS,
        V.HOURS_RELABEL,
        "HOURS_WORKED",
        where={"Statistics": V.HOURS_STATISTIC},
        window=V.DECADE,
        required=_PRESENT,
    )
    return C.monthly_productivity(output, worked)


def hours_worked_output(monthly: DataFrame) -> DataFrame:
    """Yearly productivity per industry."""
    return C.yearly_productivity(monthly)


def labour_productivity_output(monthly: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """Yearly productivity with a column per industry."""
    return R.pivot_means(
        monthly, F.year("REF_DATE"), "YEAR", "NAICS", "labour_productivity", values
    )


# --- stock exchange and leading indicators ------------------------------------------------------

STATISTIC = V.TSX_STATISTIC


def tsx_totals(tsx: DataFrame) -> DataFrame:
    """Monthly total per index."""
    return A.indicator_totals(
        tsx,
        by={STATISTIC: STATISTIC},
        total_name=V.TOTAL_STOCK,
        where=(F.col("UOM") == V.TSX_UNIT) & (F.col("VALUE") > 0),
    )


def tsx_output(totals: DataFrame) -> DataFrame:
    """The totals over 100."""
    return totals.where(F.col(V.TOTAL_STOCK) > 100)


def tsx60_output(totals: DataFrame) -> DataFrame:
    """The index of sixty, low totals included."""
    return A.select_member(
        totals,
        STATISTIC,
        V.TSX_60,
        {"REF_DATE": "REF_DATE", V.TOTAL_STOCK: V.TOTAL_TSX_60},
    )


def tsx_yearly(output: DataFrame) -> DataFrame:
    """Yearly mean of the monthly totals."""
    return output.groupBy(F.year("REF_DATE").alias("REF_DATE")).agg(
        F.avg(V.TOTAL_STOCK).alias(V.YEARLY_TSX)
    )


def leading_indicator_output(leading: DataFrame) -> DataFrame:
    """Monthly totals of the smoothed positive leading indicators in the base year."""
    return A.indicator_totals(
        leading,
        by={"Leading Indicators": "Leading indicators"},
        total_name=V.BUSINESS_PROFIT,
        where=(F.col("VALUE") > 0) & (F.col("Composite index") == V.SMOOTHED),
        window=V.BASE_YEAR_MONTHS,
        month_name="YEAR",
    )


# --- retail against its GDP ---------------------------------------------------------------------


def retail_trade_output(
    gdp: DataFrame, retail: DataFrame, gdp_where: Mapping[str, object] | Column | None = None
) -> DataFrame:
    """Yearly retail GDP beside yearly retail sales."""
    industry = F.col(f"`{V.NAICS}`")
    output = A.yearly_means(
        filters.keep(gdp, gdp_where),
        V.RETAIL_GDP,
        value=numbers.truncated("VALUE"),
        where=filters.matching(ANNUAL_RATES) & industry.contains(V.RETAIL_INDUSTRY) & ~industry.contains("("),
        window=V.DECADE,
        required=_PRESENT,
        digits=2,
    )
    sales = A.yearly_means(
        retail,
        V.RETAIL_SALES,
        value=numbers.truncated("VALUE"),
        where={"GEO": V.NATIONAL, V.NAICS: V.RETAIL_TRADE, "Adjustments": V.ADJUSTED},
        window=V.DECADE,
        required=_PRESENT,
    )
    return output.join(sales, "YEAR", "inner")


# --- health care --------------------------------------------------------------------------------


def health_gdp(gdp_totals: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """Monthly GDP with a column per care industry."""
    care = gdp_totals.where(
        F.year("REF_DATE").isin(*V.PANDEMIC_YEARS) & F.col("NAICS").contains(V.CARE_INDUSTRY)
    )
    return R.label_pivot(
        care, "REF_DATE", "NAICS", V.TOTAL_GDP, *V.HEALTH_GDP_NAME, values
    )


def health_cpi(cpi: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """Monthly national prices with a column per health product group."""
    group = F.col(V.PRODUCT_GROUP)
    rows = filters.within_months(
        cpi.where(
            (F.col("GEO") == V.NATIONAL)
            & (group.contains(V.HEALTH_GROUP) | (group == V.MEDICINAL_PRODUCTS))
        ),
        V.PANDEMIC_MONTHS,
    )
    return R.label_pivot(
        rows, "REF_DATE", V.PRODUCT_GROUP, "VALUE", *V.HEALTH_CPI_NAME, values, month=True
    )


def health_retail(by_industry: DataFrame) -> DataFrame:
    """Monthly sales of health stores."""
    recent = by_industry.where(F.year("REF_DATE").isin(*V.PANDEMIC_YEARS))
    return recent.select("REF_DATE", F.col(f"`{V.HEALTH_STORES}`").alias(V.HEALTH_SALES))


def health_trade(trade_totals: DataFrame) -> DataFrame:
    """Monthly pharmaceutical imports and exports, for months with both."""
    rows = trade_totals.where(
        F.year("YEAR").isin(*V.PANDEMIC_YEARS)
        & (F.col("Basis") == V.PAYMENTS_BASIS)
        & (F.col("NAPCS") == V.PHARMA_PRODUCTS)
    )
    names = V.HEALTH_TRADE_NAMES
    sides = [
        F.max(F.when(F.col("Trade") == direction, F.col(V.TOTAL_TRADE))).alias(name)
        for direction, name in names.items()
    ]
    months = rows.groupBy(F.col("YEAR").alias("REF_DATE")).agg(*sides)
    return filters.require(months, list(names.values()), "any")


def healthcare_analysis(
    cases: DataFrame,
    gdp_totals: DataFrame,
    cpi: DataFrame,
    by_industry: DataFrame,
    trade_totals: DataFrame,
    gdp_values: Sequence[str] | None = None,
    cpi_values: Sequence[str] | None = None,
) -> DataFrame:
    """The monthly case trend beside the health indicators."""
    panel = C.join_panel(
        [
            health_gdp(gdp_totals, gdp_values),
            health_cpi(cpi, cpi_values),
            health_retail(by_industry),
            health_trade(trade_totals),
        ],
        "REF_DATE",
    ).withColumnRenamed("REF_DATE", "Month")
    trend = case_trend(cases).withColumn("Month", dates.parse_month("Month"))
    return C.merge_monthly(trend, panel)


# --- spending, countries, prediction -------------------------------------------------------------


def household_consumption_output(spending: DataFrame) -> DataFrame:
    """Mean yearly household spending at current prices."""
    return A.yearly_means(
        spending,
        V.HOUSEHOLD_SPENDING,
        value=numbers.truncated("VALUE"),
        where={
            "Seasonal adjustment": V.ADJUSTED_QUARTERLY,
            "Estimates": V.HOUSEHOLD_CONSUMPTION,
            "Prices": V.CURRENT_PRICES,
        },
        window=V.DECADE,
        required=["REF_DATE", "GEO", "Estimates", "VALUE"],
    )


def gdp_countries_output(
    series: DataFrame, specs: Mapping[str, tuple[str, str, float]] = V.COUNTRY_SERIES
) -> DataFrame:
    """Yearly GDP with a column per country."""
    return C.series_panel(series, specs)


def prediction_input(
    productivity: DataFrame,
    prices: DataFrame,
    trade: DataFrame,
    spending: DataFrame,
    feature_type: str = "decimal(10,0)",
) -> DataFrame:
    """Yearly model features."""
    return C.prediction_features(
        productivity, prices, trade, spending, feature_type=feature_type
    )
