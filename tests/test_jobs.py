"""Hand-written rows for the edges of each job."""

import datetime

import pytest
from pyspark.sql import functions as F

from indicata.functions import dates, labels, numbers
from indicata.functions import fixed_values as V
from indicata.operators import aggregate as A
from indicata.operators import combine as C
from indicata.operators import filters
from indicata.operators import reshape as R
from indicata.plans import jobs

GDP = f"REF_DATE string, GEO string, `Seasonal adjustment` string, Prices string, `{V.NAICS}` string, VALUE int"
ANNUAL = "Seasonally adjusted at annual rates"
DAY_ADJUSTED = "Trading-day adjusted"


def day(text):
    return datetime.date.fromisoformat(text)


def collected(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_gdp_edges(spark):
    rows = [
        ("2009-12", "Canada", ANNUAL, "a", "X [1]", 900),
        ("2010-01", "Canada", ANNUAL, "a", "X [1]", 60),
        ("2010-01", "Canada", ANNUAL, "b", "X [1]", 41),
        ("2010-01", "Canada", ANNUAL, "a", "Y [2]", 100),
        ("2020-10", None, ANNUAL, "a", "Y [2]", 500),
        ("2020-11", "Canada", ANNUAL, "a", "Y [2]", 500),
        ("2010-02", "Canada", ANNUAL, "a", "X [1]", None),
        ("2010-02", "Canada", DAY_ADJUSTED, "a", "X [1]", 900),
        ("2010-02", "Canada", ANNUAL, "a", None, 900),
        (None, "Canada", ANNUAL, "a", "X [1]", 900),
        *[("2010-02", "Canada", ANNUAL, "a", name, 900) for name in V.CANNABIS_INDUSTRIES],
        ("REF_DATE", "GEO", "Seasonal adjustment", "Prices", V.NAICS, None),
        (None, None, None, None, None, None),
    ]
    gdp = spark.createDataFrame(rows, GDP)
    assert collected(jobs.gdp_output(gdp)) == [
        (day("2010-01-01"), "X [1]", 101),
        (day("2020-10-01"), "Y [2]", 500),
    ]
    narrowed = jobs.gdp_output(gdp, {**jobs.ANNUAL_RATES, "Prices": "a"})
    assert collected(narrowed) == [(day("2020-10-01"), "Y [2]", 500)]


def test_tsx_edges(spark):
    name = jobs.STATISTIC
    rows = [
        ("2010-01", V.TSX_60, "Index", 60.0),
        ("2010-01", "Other", "Index", 100.0),
        ("2010-01", "Other", "Index", 0.0),
        ("2010-02", "Other", "Index", 101.0),
        ("2010-02", "Other", "Dollars", 900.0),
        ("1990-12", "Other", "Index", 301.0),
        ("not a month", "Other", "Index", 150.0),
        ("also none", "Other", "Index", 150.0),
        (None, "Other", "Index", 150.0),
    ]
    totals = jobs.tsx_totals(spark.createDataFrame(rows, f"REF_DATE string, `{name}` string, UOM string, VALUE double"))
    kept = jobs.tsx_output(totals)
    assert collected(kept) == sorted(
        [
            (day("2010-02-01"), "Other", 101.0),
            (day("1990-12-01"), "Other", 301.0),
            (None, "Other", 300.0),
        ],
        key=repr,
    )
    assert collected(jobs.tsx60_output(totals)) == [(day("2010-01-01"), 60.0)]
    assert collected(jobs.tsx_yearly(kept)) == [(1990, 301.0), (2010, 101.0), (None, 300.0)]


def test_leading_indicator_edges(spark):
    rows = [
        (month, "Housing", kind, value)
        for month in ("2009-12", "2010-01", "2010-12", "2011-01")
        for kind in ("Smoothed", "Unsmoothed")
        for value in (5.0, 0.0, -2.0, None)
    ]
    leading = spark.createDataFrame(
        rows, "REF_DATE string, `Leading indicators` string, `Composite index` string, VALUE double"
    )
    assert collected(jobs.leading_indicator_output(leading)) == [
        (day("2010-01-01"), "Housing", 5.0),
        (day("2010-12-01"), "Housing", 5.0),
    ]


def test_retail_edges(spark):
    schema = f"REF_DATE string, GEO string, `{V.NAICS}` string, Adjustments string, VALUE int"
    adjusted = "Seasonally adjusted"
    rows = [
        ("2010-01", "Canada", "A", adjusted, 10),
        ("2010-01", "Canada", "B.b", adjusted, 5),
        ("2010-02", "Canada", "A", adjusted, 20),
        ("2010-02", "Canada", V.EMPTY_RETAIL_INDUSTRIES[0], adjusted, 7),
        ("2010-02", "Ontario", "A", adjusted, 1),
        ("2010-02", "Ontario", "A", adjusted, None),
        ("2010-03", "Ontario", "A", adjusted, None),
        ("2010-02", "Toronto, Ontario", "A", adjusted, 1),
        ("2010-02", None, "A", adjusted, 1),
        ("2010-02", "Quebec", "A", "Unadjusted", 1),
    ]
    retail = spark.createDataFrame(rows, schema)
    provinces = jobs.retail_by_province(retail)
    assert provinces.columns == ["REF_DATE", "Ontario"]
    assert collected(provinces) == [(day("2010-02-01"), 1.0), (day("2010-03-01"), None)]
    industries = jobs.retail_by_industry(retail)
    assert industries.columns == ["REF_DATE", "A", "B.b"]
    stock = spark.createDataFrame([(day("2010-01-01"), 1.0), (day("2010-02-01"), 2.0)], "REF_DATE date, v double")
    joined = jobs.retail_stock_output(industries, stock)
    assert collected(joined) == [(day("2010-01-01"), 15.0, 1.0), (day("2010-02-01"), None, 2.0)]
    zeroed = jobs.retail_stock_output(industries, stock, null_as_zero=True)
    assert collected(zeroed) == [(day("2010-01-01"), 15.0, 1.0), (day("2010-02-01"), 20.0, 2.0)]
    without = jobs.retail_stock_output(industries, stock, exclude=["B.b"])
    assert collected(without) == [(day("2010-01-01"), 10.0, 1.0), (day("2010-02-01"), 20.0, 2.0)]


def test_too_many_pivot_values_fail(spark):
    rows = [("2010-01", str(i), 1) for i in range(20)]
    obs = spark.createDataFrame(rows, "REF_DATE string, GEO string, VALUE int")
    spark.conf.set("spark.sql.pivotMaxValues", "10")
    try:
        with pytest.raises(ValueError, match="more than 10"):
            R.pivot_indicator(obs, "GEO")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_productivity_edges(spark):
    hours_schema = f"REF_DATE string, GEO string, `{V.NAICS}` string, Statistics string, VALUE double"
    gdp = spark.createDataFrame(
        [
            ("2010-01", "Canada", DAY_ADJUSTED, "a", "Wholesale trade [41]", 100),
            ("2010-01", "Canada", DAY_ADJUSTED, "a", "Retail trade [44-45]", 200),
            ("2010-02", "Canada", DAY_ADJUSTED, "a", "Retail trade [44-45]", 300),
            ("2010-03", "Canada", DAY_ADJUSTED, "a", "Retail trade [44-45]", 300),
            ("2010-03", "Canada", DAY_ADJUSTED, "a", None, 300),
        ],
        GDP,
    )
    hours = spark.createDataFrame(
        [
            ("2010-01", "Canada", "Wholesale and retail trade [41, 44-45]", "Estimate", 50.9),
            ("2010-01", "Canada", "Wholesale and retail trade [41, 44-45]", "Standard error", 7.0),
            ("2010-02", "Canada", "Wholesale and retail trade [41, 44-45]", "Estimate", 0.5),
            ("2010-03", "Canada", None, "Estimate", 5.0),
        ],
        hours_schema,
    )
    monthly = jobs.monthly_productivity(gdp, hours)
    assert collected(monthly) == [
        (day("2010-01-01"), "Wholesale and retail trade", 150.0, 50.0, 3000.0),
        (day("2010-02-01"), "Wholesale and retail trade", 300.0, 0.0, None),
    ]
    assert collected(jobs.hours_worked_output(monthly)) == [
        (2010, "Wholesale and retail trade", 25.0, 225.0, 3000.0)
    ]
    legacy = jobs.monthly_productivity(gdp, hours, legacy_rules=True)
    assert collected(legacy)[0][2] == 200.0
    wide = jobs.labour_productivity_output(monthly)
    assert wide.columns == ["YEAR", "Wholesale and retail trade"] and collected(wide) == [(2010, 3000.0)]


@pytest.mark.parametrize(
    ("rules", "text", "expected"),
    [
        (V.GDP_RELABEL, "Retail trade", "Wholesale and retail trade"),
        (V.GDP_RELABEL, "Wholesale trade", "Wholesale and retail trade"),
        (V.GDP_RELABEL, "Business sector, goods", "Business"),
        (
            V.GDP_RELABEL,
            "Mining, quarrying, and oil and gas extraction",
            "Agriculture, forestry, fishing, mining, quarrying, oil and gas",
        ),
        (V.HOURS_RELABEL, "Agriculture", "Agriculture, forestry, fishing, mining, quarrying, oil and gas"),
        (V.HOURS_RELABEL, "Total actual hours worked, all industries", "All industries"),
        (V.HOURS_RELABEL, "Goods-producing sector", "Goods-producing industries"),
        (V.HOURS_RELABEL, "Utilities", "Utilities"),
    ],
)
def test_relabel_pairs(spark, rules, text, expected):
    df = spark.createDataFrame([(f"{text} [44-45]",)], "l string")
    assert df.select(labels.apply_rules(labels.strip_code("l"), rules)).first()[0] == expected


def test_every_code_decodes_to_a_label_or_null(spark):
    codes = spark.range(-1, 101).select(F.col("id").cast("int").alias("c"))
    for known in V.CASE_CODES.values():
        decoded = {r["c"]: r["l"] for r in codes.withColumn("l", labels.decode("c", known)).collect()}
        assert {c: label for c, label in decoded.items() if label} == known
    flags = {r["c"]: r["b"] for r in codes.withColumn("b", labels.to_boolean("c")).collect()}
    assert {c: b for c, b in flags.items() if b is not None} == {1: True, 2: False}


def test_week_table(spark):
    ranges = dates.week_ranges()
    assert ranges[0] == (0, 4, "2020-01") and ranges[3] == (13, 17, "2020-04") and ranges[-1] == (48, 52, "2020-12")
    weeks = spark.range(-1, 100).withColumn("m", dates.week_bucket("id"))
    found = {r["id"]: r["m"] for r in weeks.collect()}
    assert found[-1] is None and found[53] is None and found[99] is None
    assert all(found[w] == month for first, last, month in ranges for w in range(first, last + 1))
    other = spark.range(1).select(dates.week_bucket(F.lit(52), dates.week_ranges(2021)).alias("m")).first()
    assert other["m"] == "2021-12"


def test_case_edges(spark):
    rows = [
        (1, "Region", 2),
        (1, "Region", 1),
        (1, "Episode week", 53),
        (1, "Unknown attribute", 9),
        (2, "Unknown attribute", 9),
        (3, "Transmission", 2),
        (None, "Region", 3),
    ]
    eav = spark.createDataFrame(rows, f"`{V.CASE_ID}` int, `{V.CASE_ATTRIBUTE}` string, VALUE int")
    cases = {r[V.CASE_ID]: r for r in jobs.covid_cases(eav).collect()}
    assert set(cases) == {1, 2, 3, None}
    assert cases[1]["Region"] == "Quebec" and cases[1]["Episode month"] is None
    assert cases[2]["Region"] is None and cases[2]["Death"] is None
    assert cases[3]["Transmission"] == "International travel"
    duplicates = R.duplicate_cells(eav, [V.CASE_ID, V.CASE_ATTRIBUTE])
    assert collected(duplicates) == [(1, "Region", 2)]


def test_cleanse_prefix_on_text_and_whole_numbers(spark):
    text = spark.createDataFrame([("2009-12",), ("2010-01",), ("2020-05",), (None,), ("REF_DATE",)], "REF_DATE string")
    assert collected(jobs.cleansed(text)) == [("2010-01",), ("2020-05",)]
    assert collected(jobs.cleansed(text, month_dates=True)) == [(day("2010-01-01"),), (day("2020-05-01"),)]
    whole = spark.createDataFrame([(2009,), (2010,), (2029,)], "REF_DATE int")
    assert collected(jobs.cleansed(whole, month_dates=True)) == [(2010,), (2029,)]


def test_null_rules(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, None)], "a int, b int")
    assert filters.require(df, ["a", "b"], "any").count() == 1
    assert filters.require(df, ["a", "b"], "all").count() == 2


def test_transposed_panel(spark):
    panel = spark.createDataFrame([(2010, 0.5, 1.0), (2011, None, 2.0)], "year int, a double, b double")
    assert collected(R.transpose_panel(panel, ["a", "b"], "year")) == [("a", "0.5", ""), ("b", "1.0", "2.0")]
    numbers_ = R.transpose_panel(panel, ["a", "b"], "year", as_text=False)
    assert numbers_.columns == ["year", "2010", "2011"]
    assert collected(numbers_) == [("a", 0.5, None), ("b", 1.0, 2.0)]
    with pytest.raises(Exception, match="more than one row for year 2010"):
        R.transpose_panel(panel.union(panel), ["a", "b"], "year", as_text=False).collect()


def test_transposed_cells_of_several_rows_are_joined_in_order(spark):
    rows = [(2010, 10.0, "x"), (2010, 9.5, None), (2010, 9.5, "b"), (2012, None, "é"), (None, 1.0, "n")]
    panel = spark.createDataFrame(rows, "year int, a double, b string").repartition(4)
    numeric = R.transpose_panel(panel, ["a"], "year")
    assert numeric.columns == ["year", "null", "2010", "2012"]
    assert collected(numeric) == [("a", "1.0", "9.59.510.0", "")]  # by value: as text, 10.0 would come first
    text = R.transpose_panel(panel, ["b"], "year", values=[2010, 2011, 2012], separator="; ")
    assert collected(text) == [("b", "b; x", "", "é")]
    assert collected(R.transpose_panel(panel.limit(0), ["a"], "year", values=[2010])) == []


def test_development_columns_are_the_years_that_have_rows(spark):
    names = list(V.DEVELOPMENT_INDICES)
    rows = [(1, "CA", "Canada", year, *[float(year)] * len(names)) for year in (2009, 2011, 2018, 2019)]
    panel = spark.createDataFrame(rows, ["ifs", "code", "country", "year", *names])
    assert jobs.development_output(panel).columns == ["year", "2011", "2018"]


def test_series_panel_edges(spark):
    specs = {"a": ("2000-01-01", "2002-01-01", 1.0), "b": ("2000-09-30", "2002-09-30", 10.0)}
    rows = [("a", y, "01-01", 1.0) for y in (1999, 2000, 2001, 2002, 2003)]
    rows += [("b", 2000, "09-30", None), ("b", 2002, "09-30", 50.0), ("b", 2003, "09-30", 1.0)]
    series = spark.createDataFrame(rows, "series string, y int, md string, VALUE double").select(
        "series", F.to_date(F.concat_ws("-", "y", "md")).alias("DATE"), "VALUE"
    )
    assert collected(C.series_panel(series, specs)) == [(2000, 1.0, None), (2002, 1.0, 5.0)]
    with pytest.raises(Exception, match="more than one a row"):
        C.series_panel(series.union(series), specs).collect()


def test_feature_rounding(spark):
    productivity = spark.createDataFrame(
        [(2010, "All industries", 115.5, 1.0, 114.4), (2011, "All industries", 1.0, 1.0, 12345678901.0), (2010, "X", 1.0, 1.0, 1.0)],
        "YEAR int, NAICS string, HOURS_WORKED double, GDP_VALUE double, labour_productivity double",
    )
    prices = spark.createDataFrame([(2010, 100.5), (2011, 1.0), (None, 1.0)], "YEAR int, Canada double")
    trade = spark.createDataFrame(
        [(day("2010-01-01"), 1.4, 2.0), (day("2010-02-01"), 1.6, 3.0), (day("2011-02-01"), 1.6, 3.0)],
        "REF_DATE date, `Avg GDP Value` double, `Avg Merch Trade Value` double",
    )
    spending = spark.createDataFrame([(2010, 9.5), (2011, 9.5)], "YEAR int, `household_expenditure*(10^6)` double")
    rows = {r["YEAR"]: r for r in jobs.prediction_input(productivity, prices, trade, spending).collect()}
    assert rows[2010]["Hours_Worked"] == 116_000 and rows[2010]["labour_productivity"] == 114
    assert rows[2010]["CPI"] == 101 and rows[2010]["GDP_millions"] == 1.5 and rows[2011]["labour_productivity"] is None
    kept = jobs.prediction_input(productivity, prices, trade, spending, "double")
    assert kept.where("YEAR = 2010").first()["Hours_Worked"] == 115_500
    assert jobs.prediction_input(productivity.where("YEAR = 2010"), prices, trade, spending).count() == 1


def test_numbers(spark):
    df = spark.createDataFrame([(1.9, 2.0), (-1.9, 0.0), (1e12, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(numbers.truncated("a")).collect()] == [1, -1, None]
    assert [r[0] for r in df.select(numbers.ratio("a", "b", 10)).collect()] == [9.5, None, 2.5e12]


def test_daily_means_take_dates(spark):
    df = spark.createDataFrame([(day("2024-01-05"), 1), (day("2024-01-05"), 4), (None, 9)], "REF_DATE date, v int")
    assert collected(A.monthly_means(df, {"m": "v"})) == [(day("2024-01-05"), 2.5)]
