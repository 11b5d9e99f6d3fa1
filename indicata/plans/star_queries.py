"""The registered queries: every job and operator over the star schema's whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions import dates, labels
from indicata.functions import fixed_values as V
from indicata.operators import aggregate as A
from indicata.operators import filters, model
from indicata.operators import partials as P
from indicata.operators import reshape as R
from indicata.plans import jobs
from indicata.session import checkpointed
from indicata.sources import star_views as S
from indicata.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

PANEL_FEATURES = ("YEAR", "hours", "lines", "discounted", "quantity", "GDP")


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`").cast("double"), digits) for c in columns})


def _snake(df: DataFrame) -> DataFrame:
    """Plain lower-case column names, for comparison with SQL."""
    names = [
        "".join(ch if ch.isalnum() else "_" for ch in name.lower()).strip("_") for name in df.columns
    ]
    return df.toDF(*names)


def cleanse_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(
        jobs.cleansed(S.gdp(spark, folder), ("2015", "2018")).select("REF_DATE", "Prices", V.NAICS, "VALUE")
    ).withColumnRenamed("north_american_industry_classification_system__naics", "naics")


def null_rule_any(spark: SparkSession, folder: str) -> DataFrame:
    rows = filters.require(S.retail(spark, folder), ["GEO", "VALUE"], "any")
    return _snake(rows.groupBy("GEO").agg(F.count("*").alias("rows")))


def null_rule_all(spark: SparkSession, folder: str) -> DataFrame:
    rows = filters.require(S.retail(spark, folder), ["GEO", "VALUE"], "all")
    return _snake(rows.groupBy("GEO").agg(F.count("*").alias("rows")))


def duplicate_cells(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(R.duplicate_cells(S.cpi(spark, folder), ["REF_DATE", "GEO", "Products and product groups"]))


def eav_to_wide(spark: SparkSession, folder: str) -> DataFrame:
    eav = S.cases_eav(spark, folder)
    return _snake(R.eav_to_wide(eav, V.CASE_ID, V.CASE_ATTRIBUTE, "VALUE", V.CASE_ATTRIBUTES))


def decode_labels(spark: SparkSession, folder: str) -> DataFrame:
    codes = S.case_codes(spark, folder)
    return _snake(
        codes.select(
            V.CASE_ID, *[labels.decode(name, known).alias(name) for name, known in V.CASE_CODES.items()]
        )
    )


def decode_boolean(spark: SparkSession, folder: str) -> DataFrame:
    codes = S.case_codes(spark, folder)
    return _snake(
        codes.select(V.CASE_ID, *[labels.to_boolean(name).alias(name) for name in V.BOOLEAN_ATTRIBUTES])
    )


def week_to_month(spark: SparkSession, folder: str) -> DataFrame:
    codes = S.case_codes(spark, folder)
    return _snake(
        codes.select(
            V.CASE_ID,
            dates.week_bucket("Episode week").alias("Episode month"),
            dates.week_bucket("Recovery week").alias("Recovery month"),
        )
    )


def covid_cases(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.covid_cases(S.cases_eav(spark, folder)))


def cases_by_week_region(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.provincial_cases(jobs.covid_cases(S.cases_eav(spark, folder))))


def cases_by_known_week_region(spark: SparkSession, folder: str) -> DataFrame:
    cases = jobs.covid_cases(S.cases_eav(spark, folder))
    return _snake(jobs.provincial_cases(cases, fill_keys=False).where(F.col("Week Number").isNotNull()))


def case_trend_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.case_trend(jobs.covid_cases(S.cases_eav(spark, folder))))


def gdp_totals_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.gdp_output(S.gdp(spark, folder)))


def gdp_totals_from_dates(spark: SparkSession, folder: str) -> DataFrame:
    stored = jobs.cleansed(S.gdp(spark, folder), month_dates=True)
    return _snake(jobs.gdp_output(stored))


def gdp_totals_from_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = P.summary(S.gdp(spark, folder), ["REF_DATE", "GEO", "Seasonal adjustment", V.NAICS])
    return _snake(jobs.gdp_output(summary))


def _stored_at(spark: SparkSession, name: str) -> str:
    """A new folder that every executor can reach: in the one for checkpoints, else in the warehouse."""
    context = spark.sparkContext
    shared = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return f"{shared or spark.conf.get('spark.sql.warehouse.dir')}/{name}-{uuid.uuid4().hex}"


def gdp_totals_from_store(spark: SparkSession, folder: str) -> DataFrame:
    """From the cleansed table, stored with a folder per year."""
    path = _stored_at(spark, "store")
    rows = jobs.cleansed(S.gdp(spark, folder), month_dates=True).drop(filters.STORED_DATE)
    rows = rows.withColumn(filters.YEAR_PARTITION, F.year("REF_DATE"))
    tables.write_published(rows, path, partition_by=filters.YEAR_PARTITION, rebalanced=True)
    return _snake(jobs.gdp_output(spark.read.parquet(path)))


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Prices written as sorted CSV files with a header and a schema beside them, and read by these."""
    path = _stored_at(spark, "csv")
    rows = S.cpi(spark, folder).drop(filters.STORED_DATE)
    tables.write_published(rows, path, fmt="csv", sort_by=["REF_DATE", "GEO"], files=4, sidecar=f"{path}.json")
    read = tables.read_csv(spark, path, tables.load_schema(spark, f"{path}.json"))
    keys = ["REF_DATE", "GEO", "Products and product groups"]
    return _snake(read.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum("VALUE").alias("total")))


def gdp_totals_one_price_basis(spark: SparkSession, folder: str) -> DataFrame:
    where = {**jobs.ANNUAL_RATES, "Prices": "2012 constant prices"}
    return _snake(jobs.gdp_output(S.gdp(spark, folder), where))


def trade_totals_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.trade_output(S.trade(spark, folder)))


def tsx_totals_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.tsx_output(jobs.tsx_totals(S.tsx(spark, folder))))


def select_member(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.tsx60_output(jobs.tsx_totals(S.tsx(spark, folder))))


def yearly_mean_of_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.tsx_yearly(jobs.tsx_output(jobs.tsx_totals(S.tsx(spark, folder)))))


def indicator_window_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.leading_indicator_output(S.leading_indicators(spark, folder)))


def joint_monthly_means(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(
        jobs.gdp_trade_output(jobs.gdp_output(S.gdp(spark, folder)), jobs.trade_output(S.trade(spark, folder)))
    )


def pivot_region_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.retail_by_province(S.retail(spark, folder)))


def pivot_industry_monthly_drop(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.retail_by_industry(S.retail(spark, folder), S.RETAIL_INDUSTRIES))


def pivot_geo_yearly_round(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.cpi_output(S.cpi(spark, folder)))


def stock_monthly_means(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.stock_output(S.stock(spark, folder)))


def series_daily_means(spark: SparkSession, folder: str) -> DataFrame:
    means = A.monthly_means(S.daily_events(spark, folder), {"avg_cents": "cents", "avg_size": "size"})
    return _snake(means)


def row_total_join(spark: SparkSession, folder: str) -> DataFrame:
    by_industry = jobs.retail_by_industry(S.retail(spark, folder), S.RETAIL_INDUSTRIES)
    joined = jobs.retail_stock_output(by_industry, jobs.stock_output(S.stock(spark, folder)))
    return _rounded(_snake(joined), 4, "totalretailtradeprice")


def row_total_nulls_as_zero(spark: SparkSession, folder: str) -> DataFrame:
    by_industry = jobs.retail_by_industry(S.retail(spark, folder), S.RETAIL_INDUSTRIES)
    joined = jobs.retail_stock_output(
        by_industry, jobs.stock_output(S.stock(spark, folder)), exclude=[V.RETAIL_TRADE], null_as_zero=True
    )
    return _rounded(_snake(joined), 4, "totalretailtradeprice")


def select_years_distinct(spark: SparkSession, folder: str) -> DataFrame:
    wide = S.macro_wide(spark, folder)
    rows = jobs.macro_output(wide, [str(year) for year in range(2014, 2021)])
    return rows.toDF("subject", *[f"y{name}" for name in rows.columns[1:]])


def unpivot_years(spark: SparkSession, folder: str) -> DataFrame:
    wide = S.macro_wide(spark, folder)
    long = R.unpivot_columns(
        wide, "Subject Descriptor", [str(year) for year in range(2014, 2021)], "year", "amount"
    )
    return _snake(long)


def transpose_panel(spark: SparkSession, folder: str) -> DataFrame:
    years = tuple(range(2010, 2017))
    wide = jobs.development_output(S.development_panel(spark, folder), years=years, values=years)
    return wide.toDF("index_code", *[f"y{name}" for name in wide.columns[1:]])


def transpose_collected(spark: SparkSession, folder: str) -> DataFrame:
    """A row per nation, so the cells of a country of several nations have several values; years are discovered."""
    wide = jobs.development_output(S.development_panel(spark, folder, by_nation=True))
    return wide.toDF("index_code", *[f"y{name}" for name in wide.columns[1:]])


def strip_code(spark: SparkSession, folder: str) -> DataFrame:
    sums = P.partial_sums(S.gdp(spark, folder), [V.NAICS])
    return P.merge(sums, {"naics": P.after_sums(labels.strip_code(F.col(f"`{V.NAICS}`")))}, total=P.total())


def relabel_rules(spark: SparkSession, folder: str) -> DataFrame:
    sums = P.partial_sums(S.gdp(spark, folder), [V.NAICS])
    cleaned = P.after_sums(labels.apply_rules(labels.strip_code(F.col(f"`{V.NAICS}`")), V.GDP_RELABEL))
    return P.merge(sums, {"naics": cleaned}, total=P.total(), average=F.round(P.mean(), 6))


def relabel_rules_legacy(spark: SparkSession, folder: str) -> DataFrame:
    sums = P.partial_sums(S.gdp(spark, folder), [V.NAICS])
    rules = (V.GDP_RELABEL_LEGACY_FIRST, *V.GDP_RELABEL[1:])
    cleaned = P.after_sums(labels.apply_rules(labels.strip_code(F.col(f"`{V.NAICS}`")), rules))
    return P.merge(sums, {"naics": cleaned}, total=P.total())


def productivity_yearly(spark: SparkSession, folder: str) -> DataFrame:
    monthly = jobs.monthly_productivity(S.gdp(spark, folder), S.hours(spark, folder))
    yearly = jobs.hours_worked_output(monthly)
    return _rounded(_snake(yearly), 6, "hours_worked", "gdp_value", "labour_productivity")


def productivity_pivot(spark: SparkSession, folder: str) -> DataFrame:
    """Every industry that the joined months have is a column."""
    monthly = jobs.monthly_productivity(S.gdp(spark, folder), S.hours(spark, folder))
    wide = _snake(jobs.labour_productivity_output(monthly))
    return _rounded(wide, 6, *wide.columns[1:])


def yearly_two_source_join(spark: SparkSession, folder: str) -> DataFrame:
    joined = jobs.retail_trade_output(S.gdp(spark, folder), S.retail(spark, folder))
    return joined.toDF("year", "retail_gdp", "retail_sales")


def yearly_means_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.household_consumption_output(S.spending(spark, folder)).toDF("year", "household_expenditure")


def label_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.health_gdp(jobs.gdp_output(S.gdp(spark, folder), window=HEALTH_MONTHS)))


def label_pivot_prices(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.health_cpi(S.cpi(spark, folder)))


CARE_INDUSTRIES = (
    "Ambulatory health care services [621]",
    "Health care and social assistance [62]",
)
HEALTH_MONTHS = (V.PANDEMIC_MONTHS[0], V.DECADE[1])
HEALTH_GROUPS = (
    "Medicinal and pharmaceutical products",
    "Personal care and health supplies",
    "Prescribed health products",
)


def merge_monthly_outer(spark: SparkSession, folder: str) -> DataFrame:
    merged = jobs.healthcare_analysis(
        jobs.covid_cases(S.cases_eav(spark, folder)),
        jobs.gdp_output(S.gdp(spark, folder), window=HEALTH_MONTHS),
        S.cpi(spark, folder),
        jobs.retail_by_industry(S.retail(spark, folder), S.RETAIL_INDUSTRIES, window=HEALTH_MONTHS),
        jobs.trade_output(S.trade(spark, folder), window=HEALTH_MONTHS),
        CARE_INDUSTRIES,
        HEALTH_GROUPS,
    )
    return merged.toDF(
        *["new_cases", "recovered_cases", "deaths", "icu", "ward", "not_hospitalized", "unknown_status"],
        *["workers", "gdp_ambulatory", "gdp_health", "cpi_pharma", "cpi_personal", "cpi_prescribed"],
        *["retail_health", "imports", "exports", "month"],
    )


def series_panel(spark: SparkSession, folder: str) -> DataFrame:
    return _snake(jobs.gdp_countries_output(S.country_series(spark, folder)))


def _features(spark: SparkSession, folder: str, feature_type: str) -> DataFrame:
    # two of the inputs come from the GDP table, which is scanned once for both
    gdp = checkpointed(P.summary(S.gdp(spark, folder), ["REF_DATE", "GEO", "Seasonal adjustment", V.NAICS]))
    monthly = jobs.monthly_productivity(gdp, S.hours(spark, folder))
    return jobs.prediction_input(
        jobs.hours_worked_output(monthly),
        jobs.cpi_output(S.cpi(spark, folder), ("Canada",)),
        jobs.gdp_trade_output(jobs.gdp_output(gdp), jobs.trade_output(S.trade(spark, folder))),
        jobs.household_consumption_output(S.spending(spark, folder)),
        feature_type,
    )


def prediction_features(spark: SparkSession, folder: str) -> DataFrame:
    table = _snake(_features(spark, folder, "decimal(10,0)"))
    return _rounded(table, 4, *table.columns[1:])


def prediction_features_double(spark: SparkSession, folder: str) -> DataFrame:
    table = _snake(_features(spark, folder, "double"))
    return _rounded(table, 4, *table.columns[1:])


def _panel(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly features per industry, a panel of several rows per year."""
    lines = S.labelled_lines(spark, folder, F.col("p_brand"))
    return (
        lines.groupBy(F.year(F.col("l_shipdate").cast("date")).alias("YEAR"), "label")
        .agg(
            F.sum(F.floor("l_extendedprice").cast("bigint")).alias("GDP"),
            F.sum(F.col("l_linenumber")).alias("hours"),
            F.count("*").alias("lines"),
            F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        )
    )


def minmax_scale(spark: SparkSession, folder: str) -> DataFrame:
    panel = checkpointed(_panel(spark, folder))
    columns = list(PANEL_FEATURES)
    scaled = model.MinMax.fit(panel, columns).transform(panel)
    return _rounded(_snake(scaled), 9, *[c.lower() for c in columns])


def time_split(spark: SparkSession, folder: str) -> DataFrame:
    panel = checkpointed(_panel(spark, folder))
    train, test = model.time_split(model.MinMax.fit(panel, ["YEAR"]).transform(panel))
    parts = [df.withColumn("part", F.lit(name)) for df, name in ((train, "train"), (test, "test"))]
    counted = parts[0].unionByName(parts[1]).groupBy("part", "YEAR")
    return _rounded(_snake(counted.agg(F.count("*").alias("rows"), F.sum("GDP").alias("gdp"))), 9, "year")


def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    predicted = _panel(spark, folder).select(
        (F.col("GDP") / 1e6).alias("GDP"), (F.col("quantity") * 0.0015).alias("prediction")
    )
    return _rounded(_snake(model.regression_metrics(predicted, "GDP")), 4, "r2", "mse", "rmse")


def feature_correlation(spark: SparkSession, folder: str) -> DataFrame:
    features = [c for c in PANEL_FEATURES if c not in ("YEAR", "GDP")]
    return _rounded(model.correlations(_panel(spark, folder), features), 6, "correlation")


def elastic_net_metrics(spark: SparkSession, folder: str) -> DataFrame:
    fitted = model.fit_gdp_model(_panel(spark, folder), PANEL_FEATURES, label="GDP")
    measured = _snake(fitted.metrics.withColumn("alpha", F.lit(fitted.fit.alpha)))
    return _rounded(_rounded(_rounded(measured, 6, "r2"), 8, "mse"), 7, "rmse")


def elastic_net_predictions(spark: SparkSession, folder: str) -> DataFrame:
    found = _snake(model.fit_gdp_model(_panel(spark, folder), PANEL_FEATURES, label="GDP").predictions)
    return _rounded(found, 7, *found.columns)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        cleanse_prefix,
        null_rule_any,
        null_rule_all,
        duplicate_cells,
        eav_to_wide,
        decode_labels,
        decode_boolean,
        week_to_month,
        covid_cases,
        cases_by_week_region,
        cases_by_known_week_region,
        case_trend_monthly,
        gdp_totals_threshold,
        gdp_totals_from_dates,
        gdp_totals_from_summary,
        gdp_totals_from_store,
        csv_round_trip,
        gdp_totals_one_price_basis,
        trade_totals_threshold,
        tsx_totals_threshold,
        select_member,
        yearly_mean_of_totals,
        indicator_window_filtered,
        joint_monthly_means,
        pivot_region_monthly,
        pivot_industry_monthly_drop,
        pivot_geo_yearly_round,
        stock_monthly_means,
        series_daily_means,
        row_total_join,
        row_total_nulls_as_zero,
        select_years_distinct,
        unpivot_years,
        transpose_panel,
        transpose_collected,
        strip_code,
        relabel_rules,
        relabel_rules_legacy,
        productivity_yearly,
        productivity_pivot,
        yearly_two_source_join,
        yearly_means_filtered,
        label_pivot,
        label_pivot_prices,
        merge_monthly_outer,
        series_panel,
        prediction_features,
        prediction_features_double,
        minmax_scale,
        time_split,
        regression_metrics,
        feature_correlation,
        elastic_net_metrics,
        elastic_net_predictions,
    )
}
