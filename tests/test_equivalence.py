"""Rewritten plans against the long way round, on random rows with nulls."""

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from indicata.functions import dates, labels
from indicata.functions import fixed_values as V
from indicata.operators import aggregate as A
from indicata.operators import combine as C
from indicata.operators import filters
from indicata.operators import partials as P
from indicata.operators import reshape as R
from indicata.plans import jobs


def rows_of(df, digits=9):
    def plain(value):
        return round(value, digits) if isinstance(value, float) else value

    return sorted((tuple(plain(v) for v in row) for row in df.collect()), key=repr)


def random_cases(spark, seed, n=400):
    pick = random.Random(seed).choice
    rows = [
        (
            pick([None, 0, 1, 2, 3, 4]),
            pick([None, 0, 1, 2, 3, 7]),
            pick([None, "Quebec", "Atlantic"]),
            pick([None, "0-19", "80 <=", "Not Stated", "20-29"]),
            pick([None, "International travel", "Not Stated"]),
            *[pick([None, True, False]) for _ in range(3)],
            pick([None, "Hospitalized and in ICU", "Not hospitalized"]),
            pick([None, "Health care worker", "Other"]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "`Episode week` int, `Recovery week` int, Region string, Age_group string, Transmission string, "
        "Asymptomatic boolean, Recovered boolean, Death boolean, `Hospital status` string, Occupation string",
    )


def test_weekly_counts_equal_joined_counts(spark):
    for seed in range(3):
        cases = random_cases(spark, seed)

        def counted(name, condition, week="Episode week"):
            return (
                cases.where(condition)
                .groupBy(F.col(week).alias("w"), F.col("Region").alias("r"))
                .agg(F.count("*").alias(name))
            )

        ages = list(V.CASE_CODES["Age group"].values())
        by_age = (
            cases.groupBy(F.col("Episode week").alias("w"), F.col("Region").alias("r"))
            .pivot("Age_group", ages)
            .count()
        )
        base = counted("Total New cases", F.lit(True)).alias("n")
        parts = [
            counted("Recovered cases", F.col("Recovered"), "Recovery week"),
            counted("Deaths", F.col("Death")),
            by_age,
            counted("International Transmissions", F.col("Transmission").like("%International%travel%")),
            counted("Asymptomatic cases", F.col("Asymptomatic")),
        ]
        joined = base
        for i, part in enumerate(parts):
            part = part.withColumnsRenamed({"w": f"w{i}", "r": f"r{i}"})
            joined = joined.join(
                part, (F.col("w") == F.col(f"w{i}")) & (F.col("r") == F.col(f"r{i}")), "left"
            ).drop(f"w{i}", f"r{i}")
        expected = joined.fillna(0)
        assert rows_of(jobs.provincial_cases(cases)) == rows_of(expected)


def test_unfilled_week_stays_null(spark):
    cases = random_cases(spark, 5)
    weeks = {row[0] for row in jobs.provincial_cases(cases, fill_keys=False).collect()}
    assert None in weeks


def test_monthly_trend_equals_joined_counts(spark):
    for seed in range(3):
        cases = random_cases(spark, seed).withColumns(
            {
                "Episode month": F.concat(F.lit("2020-0"), F.col("Episode week").cast("string")),
                "Recovery month": F.concat(F.lit("2020-0"), F.col("Recovery week").cast("string")),
            }
        )

        def counted(name, condition, month="Episode month"):
            return cases.where(condition).groupBy(F.col(month).alias("Month")).agg(F.count("*").alias(name))

        statuses = list(V.CASE_CODES["Hospital status"].values())
        expected = (
            counted("New cases", F.lit(True))
            .join(counted("Recovered cases", F.col("Recovered"), "Recovery month"), "Month", "left")
            .join(counted("Deaths", F.col("Death")), "Month", "left")
            .join(
                cases.groupBy(F.col("Episode month").alias("Month")).pivot("Hospital status", statuses).count(),
                "Month",
            )
            .join(
                counted("Healthcare workers affected", F.col("Occupation") == "Health care worker"),
                "Month",
                "left",
            )
        )
        actual = jobs.case_trend(cases)
        assert actual.columns == expected.columns
        assert rows_of(actual) == rows_of(expected)


def test_joint_means_equal_means_over_the_joined_rows(spark):
    rand = random.Random(1)
    left = spark.createDataFrame(
        [(rand.randint(1, 6), rand.choice([None, rand.randint(1, 99)])) for _ in range(80)], "REF_DATE int, a int"
    )
    right = spark.createDataFrame(
        [(rand.randint(3, 9), rand.choice("xy"), rand.randint(1, 99)) for _ in range(80)],
        "YEAR int, Basis string, b int",
    )
    expected = (
        left.join(right, left.REF_DATE == right.YEAR)
        .where("Basis = 'x'")
        .groupBy("REF_DATE")
        .agg(F.avg("a").alias("ma"), F.avg("b").alias("mb"))
    )
    actual = C.joint_monthly_means(left, right, "a", "b", "ma", "mb", right_where={"Basis": "x"})
    assert rows_of(actual) == rows_of(expected)


def test_series_panel_equals_star_of_joins(spark):
    rand = random.Random(2)
    specs = {name: ("2000-01-01", "2015-12-31", 10.0 if name != "b" else 1.0) for name in "abc"}
    rows = [
        (name, f"{year}-01-01", rand.choice([None, rand.random() * 100]))
        for name in "abcz"
        for year in range(1998, 2018)
        if rand.random() < 0.8
    ]
    long = spark.createDataFrame(rows, "series string, d string, VALUE double").select(
        "series", F.col("d").cast("date").alias("DATE"), "VALUE"
    )
    sides = [
        long.where((F.col("series") == name) & F.col("DATE").between("2000-01-01", "2015-12-31")).select(
            F.year("DATE").alias("DATE"), (F.col("VALUE") / divisor).alias(name)
        )
        for name, (_, _, divisor) in specs.items()
    ]
    expected = reduce(lambda x, y: x.join(y, "DATE"), sides)
    assert rows_of(C.series_panel(long, specs)) == rows_of(expected)


def test_partials_equal_plain_aggregates(spark):
    rand = random.Random(3)
    months = ["2009-12", "2010-01", "2010-02", "2020-10", "2020-11", "REF_DATE", None, "2010-1", "2010-01-05"]
    labels_ = ["Retail trade [44-45]", "Retail trade", "Wholesale trade [41]", None]
    obs = spark.createDataFrame(
        [
            (rand.choice(months), "x", rand.choice(labels_), rand.choice([None, rand.randint(-50, 900)]))
            for _ in range(500)
        ],
        f"REF_DATE string, GEO string, `{V.NAICS}` string, VALUE int",
    )
    dated = obs.withColumn("REF_DATE", dates.parse_month("REF_DATE"))
    decade = dated.where(F.col("REF_DATE").between("2010-01-01", "2020-10-01"))
    name = labels.apply_rules(labels.strip_code(F.col(f"`{V.NAICS}`")), V.GDP_RELABEL)

    expected = decade.groupBy("REF_DATE", name.alias("NAICS")).agg(F.avg("VALUE").alias("m"))
    actual = C.relabelled_monthly_means(obs, V.NAICS, V.GDP_RELABEL, "m", window=V.DECADE)
    assert rows_of(actual) == rows_of(expected)

    expected = decade.groupBy(F.year("REF_DATE").alias("YEAR")).agg(F.avg("VALUE").alias("m"))
    assert rows_of(A.yearly_means(obs, "m", window=V.DECADE)) == rows_of(expected)

    unwindowed = A.indicator_totals(
        filters.require(obs, ["REF_DATE"], "any"), by={"n": V.NAICS}, total_name="t"
    )
    expected = (
        obs.where("REF_DATE IS NOT NULL AND VALUE IS NOT NULL")
        .withColumn("REF_DATE", dates.parse_month("REF_DATE"))
        .groupBy("REF_DATE", F.col(f"`{V.NAICS}`").alias("n"))
        .agg(F.sum("VALUE"))
    )
    assert rows_of(unwindowed) == rows_of(expected)

    by_date = A.indicator_totals(
        dated.where("REF_DATE IS NOT NULL"), by={"n": V.NAICS}, total_name="t", window=V.DECADE
    )
    by_text = A.indicator_totals(obs, by={"n": V.NAICS}, total_name="t", window=V.DECADE)
    assert rows_of(by_date) == rows_of(by_text)
    assert rows_of(by_text)


def test_month_text_window_equals_parsed_window(spark):
    texts = ["2010-01", "2009-12", "2020-10", "2020-11", "2010-1", "+2010-01", " 2010-01", "2010-01 "]
    texts += ["2010-01-05", "02010-01", "REF_DATE", None, "2015-13", "2015-00", "201507", "12010-01"]
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    by_text = {row[0] for row in df.where(dates.month_text_in("m", V.DECADE)).collect()}
    by_date = {row[0] for row in df.where(dates.month_in(dates.parse_month("m"), V.DECADE)).collect()}
    assert by_text == by_date == {"2010-01", "2020-10"}


def test_pivot_with_discovered_values_equals_spark_pivot(spark):
    rand = random.Random(4)
    obs = spark.createDataFrame(
        [
            (f"2015-{rand.randint(1, 12):02d}", rand.choice(["a", "b.c", "d e [1]", None]), rand.randint(1, 9))
            for _ in range(200)
        ],
        "REF_DATE string, GEO string, VALUE int",
    )
    expected = (
        obs.withColumn("REF_DATE", dates.parse_month("REF_DATE")).groupBy("REF_DATE").pivot("GEO").agg(F.avg("VALUE"))
    )
    actual = R.pivot_indicator(obs, "GEO")
    assert actual.columns == expected.columns
    assert rows_of(actual) == rows_of(expected)


def test_unpivot_then_pivot_gives_the_frame_back(spark):
    wide = spark.createDataFrame([("x", 1.0, 2.0, None), ("y", 3.0, None, None)], "k string, a double, b double, c double")
    long = R.unpivot_columns(wide, "k", ["a", "b", "c"])
    assert rows_of(R.eav_to_wide(long, "k", "name", "value", ["a", "b", "c"])) == rows_of(wide)


def test_merged_partials_mean(spark):
    df = spark.createDataFrame([("a [1]", 1), ("a [2]", 4), ("a", None), ("b", None)], "l string, VALUE int")
    sums = P.partial_sums(df, ["l"])
    merged = P.merge(sums, {"l": P.after_sums(labels.strip_code("l"))}, m=P.mean(), t=P.total())
    assert rows_of(merged) == [("a", 2.5, 5), ("b", None, None)]


def test_jobs_on_a_summary_equal_jobs_on_the_rows(spark):
    rand = random.Random(6)
    names = ["Retail trade [44-45]", "Wholesale trade [41]", "Cannabis production [111C]", None]
    adjustments = ["Seasonally adjusted at annual rates", "Trading-day adjusted"]
    gdp = spark.createDataFrame(
        [
            (
                rand.choice(["2010-01", "2011-05", "2009-01", None]),
                rand.choice([None, "Canada"]),
                rand.choice(adjustments),
                rand.choice(names),
                rand.choice([None, rand.randint(1, 200)]),
            )
            for _ in range(300)
        ],
        f"REF_DATE string, GEO string, `Seasonal adjustment` string, `{V.NAICS}` string, VALUE int",
    )
    hours = spark.createDataFrame(
        [(month, "Canada", "Wholesale and retail trade [41]", "Estimate", 50.5) for month in ("2010-01", "2011-05")],
        f"REF_DATE string, GEO string, `{V.NAICS}` string, Statistics string, VALUE double",
    )
    short = P.summary(gdp, ["REF_DATE", "GEO", "Seasonal adjustment", V.NAICS])
    assert rows_of(jobs.gdp_output(short)) == rows_of(jobs.gdp_output(gdp))
    by_rows, by_sums = jobs.monthly_productivity(gdp, hours), jobs.monthly_productivity(short, hours)
    assert rows_of(by_rows) == rows_of(by_sums)
    assert rows_of(by_rows)
    with pytest.raises(TypeError):
        P.summary(hours, ["REF_DATE"])
