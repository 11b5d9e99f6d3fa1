"""Wall time of plans written the plain way beside the library's, on the same tables.

Each pair gives equal rows (see tests/test_equivalence.py); this shows what the rewrite saves.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from functools import reduce

from pyspark.sql import functions as F

from indicata import spark_session
from indicata.functions import dates
from indicata.functions import fixed_values as V
from indicata.operators import combine as C
from indicata.operators import reshape as R
from indicata.plans import jobs
from indicata.sources import star_views as S


def joint_rows(gdp, trade):
    pairs = gdp.join(trade.where("Basis = 'Customs'"), gdp.REF_DATE == trade.YEAR)
    return pairs.groupBy("REF_DATE").agg(F.avg("Total GDP Value"), F.avg("Total Merch Trade Value"))


def joined_counts(cases):
    def counted(name, condition, week="Episode week"):
        return cases.where(condition).groupBy(F.col(week).alias("w"), "Region").agg(F.count("*").alias(name))

    ages = list(V.CASE_CODES["Age group"].values())
    parts = [
        counted("Recovered cases", F.col("Recovered"), "Recovery week"),
        counted("Deaths", F.col("Death")),
        cases.groupBy(F.col("Episode week").alias("w"), "Region").pivot("Age_group", ages).count(),
        counted("International Transmissions", F.col("Transmission").like("%International%travel%")),
        counted("Asymptomatic cases", F.col("Asymptomatic")),
    ]
    return reduce(lambda a, b: a.join(b, ["w", "Region"], "left"), parts, counted("n", F.lit(True))).fillna(0)


def star_join(series):
    sides = [
        series.where((F.col("series") == name) & F.col("DATE").between(first, last)).select(
            F.year("DATE").alias("DATE"), (F.col("VALUE") / divisor).alias(name)
        )
        for name, (first, last, divisor) in V.COUNTRY_SERIES.items()
    ]
    return reduce(lambda a, b: a.join(b, "DATE"), sides)


def parsed_rows(gdp):
    dated = gdp.where("VALUE IS NOT NULL").withColumn("REF_DATE", dates.parse_month("REF_DATE"))
    season = F.col("Seasonal adjustment") == "Seasonally adjusted at annual rates"
    return (
        dated.where(season & dates.month_in("REF_DATE", V.DECADE))
        .where(~F.col(f"`{V.NAICS}`").isin(*V.CANNABIS_INDUSTRIES))
        .groupBy("REF_DATE", F.col(f"`{V.NAICS}`").alias("NAICS"))
        .agg(F.sum("VALUE").alias("t"))
        .where("t > 100")
    )


def generic_pivot(eav):
    return eav.groupBy(V.CASE_ID).pivot(V.CASE_ATTRIBUTE, list(V.CASE_ATTRIBUTES)).agg(F.first("VALUE"))


def direct_pivot(eav):
    return R.eav_to_wide(eav, V.CASE_ID, V.CASE_ATTRIBUTE, "VALUE", V.CASE_ATTRIBUTES)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = spark_session("bench rewrites", master=f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")

    def cases():
        return jobs.covid_cases(S.cases_eav(spark, folder))

    def totals():
        return jobs.gdp_output(S.gdp(spark, folder)), jobs.trade_output(S.trade(spark, folder))

    pairs = {
        "means before the join": (lambda: joint_rows(*totals()), lambda: jobs.gdp_trade_output(*totals())),
        "counts in one pass": (lambda: joined_counts(cases()), lambda: jobs.provincial_cases(cases())),
        "series in one aggregate": (
            lambda: star_join(S.country_series(spark, folder)),
            lambda: C.series_panel(S.country_series(spark, folder), V.COUNTRY_SERIES),
        ),
        "months parsed after the sums": (
            lambda: parsed_rows(S.gdp(spark, folder)),
            lambda: jobs.gdp_output(S.gdp(spark, folder)),
        ),
        "pivot of known attributes": (
            lambda: generic_pivot(S.cases_eav(spark, folder)),
            lambda: direct_pivot(S.cases_eav(spark, folder)),
        ),
    }

    def once(build) -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    report = {}
    for name, builds in pairs.items():
        for build in builds:
            once(build)
        plain, ours = (round(statistics.median(once(b) for _ in range(5)), 3) for b in builds)
        report[name] = {"plain": plain, "library": ours}
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
