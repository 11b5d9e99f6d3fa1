"""Observation-shaped views over an orders/line-items star schema.

The jobs read observation tables. These views give a star schema's tables that shape, so the jobs
run on them unchanged: months come from the ship or order date moved into the jobs' windows, labels
from the dimensions, values from the prices. Views hold every row of their fact table and join only
the dimensions they take a label from; dimension labels are made before the join, once per dimension
row. Spark broadcasts a dimension when its size is under the session's threshold and shuffles (and
splits skewed keys) when it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions import fixed_values as V
from indicata.operators import filters
from indicata.operators import partials as P

# --- Fixed values: labels the dimensions are given ----------------------------------------------

GDP_INDUSTRIES = [
    "All industries [T001]",
    "Retail trade [44-45]",
    "Retail trade (except unlicensed cannabis) [4AZ]",
    "Wholesale trade [41]",
    "Finance and insurance [52]",
    "Real estate and rental and leasing [53]",
    "Arts, entertainment and recreation [71]",
    "Business sector industries [T004]",
    "Business sector, goods [T005]",
    "Business sector, services [T006]",
    "Agriculture, forestry, fishing and hunting [11]",
    "Mining, quarrying, and oil and gas extraction [21]",
    "Health care and social assistance [62]",
    "Ambulatory health care services [621]",
    "Goods-producing industries [T002]",
    "Service-producing industries [T003]",
    "Construction [23]",
    "Manufacturing [31-33]",
    "Utilities [22]",
    "Educational services [61]",
    "Public administration [91]",
    "Cannabis production [111C]",
    "Cannabis production (unlicensed) [111CU]",
    "Cannabis production (licensed) [111CL]",
    "Accommodation and food services [72]",
]

HOURS_INDUSTRIES = [
    "Total actual hours worked, all industries",
    "Wholesale and retail trade [41, 44-45]",
    "Finance, insurance, real estate, rental and leasing [52, 53]",
    "Information, culture and recreation [51, 71]",
    "Business, building and other support services [55-56]",
    "Agriculture [111-112]",
    "Forestry, fishing, mining, quarrying, oil and gas [21, 113-114]",
    "Health care and social assistance [62]",
    "Goods-producing sector",
    "Services-producing sector",
    "Construction [23]",
    "Manufacturing [31-33]",
    "Utilities [22]",
    "Educational services [61]",
    "Public administration [91]",
    "Accommodation and food services [72]",
    "Professional, scientific and technical services [54]",
    "Transportation and warehousing [48-49]",
    "Other services [81]",
    "Unclassified A",
    "Unclassified B",
    "Unclassified C",
    "Unclassified D",
    "Unclassified E",
    "Unclassified F",
]

PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

TRADE_PRODUCTS = [
    "Pharmaceutical and medicinal products [273]",
    "Farm and fishing products [C11]",
    "Energy products [C12]",
    "Metal ores [C13]",
    "Industrial chemicals [C15]",
    "Forestry products [C16]",
]

RETAIL_INDUSTRIES = [
    "Retail trade [44-45]",
    "Health and personal care stores [446]",
    "Cannabis stores [453993]",
    "Department stores [4521]",
    "Food and beverage stores [445]",
    "Gasoline stations [447]",
]

# one per nation key from 0; the empty one is an unknown place
PLACES = [
    "Canada",
    "Ontario",
    "Quebec",
    "British Columbia",
    "Alberta",
    "Manitoba",
    "Saskatchewan",
    "Nova Scotia",
    "New Brunswick",
    "Newfoundland and Labrador",
    "Prince Edward Island",
    "Toronto, Ontario",
    "Montreal, Quebec",
    "Vancouver, British Columbia",
    "Calgary, Alberta",
    "Canada",
    "Ottawa-Gatineau, Ontario/Quebec",
    "Ontario",
    "Canada",
    "Quebec",
    "Yukon",
    "Northwest Territories",
    "Nunavut",
    "",
    "Canada",
]

COUNTRIES = list(V.COUNTRY_SERIES)

PRODUCT_GROUPS = [
    "All-items",
    "Prescribed health products",
    "Personal care and health supplies",
    "Medicinal and pharmaceutical products",
    "Food",
]

TSX_STATISTICS = [
    V.TSX_60,
    "Composite Index, high",
    "Composite Index, low",
    "Composite Index, close",
    "Price dividend index",
]

LEADING_INDICATORS = [
    "Average work week, manufacturing",
    "Housing index",
    "Money supply",
    "New orders, durable goods",
    "Retail trade, furniture and appliances",
]

MONTH_SHIFT = 19
BASE_YEAR_SHIFT = 15
SERIES_SHIFT = 2


# --- Fixed values: the star schema's columns ----------------------------------------------------

STAR_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table; its schema is known, so no file is opened before the query runs."""
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _pick(labels: list[str], position: Column) -> Column:
    """The label at a position that counts from 1."""
    return F.element_at(F.lit(labels), position.cast("int"))


def _brand(labels: list[str]) -> Column:
    return _pick(labels, F.substring("p_brand", 7, 3))


def _type(labels: list[str]) -> Column:
    return _pick(labels, F.array_position(F.lit(PART_TYPES), F.col("p_type")))


def _priority(labels: list[str]) -> Column:
    return _pick(labels, F.substring("o_orderpriority", 1, 1))


def _month(date: str, shift: int = MONTH_SHIFT) -> Column:
    day = F.col(date).cast("date")
    month = F.month(day)
    return F.concat(
        (F.year(day) + shift).cast("string"),
        F.when(month < 10, "-0").otherwise("-"),
        month.cast("string"),
    )


def _stored(date: str, shift: int = MONTH_SHIFT, span: int = 1) -> Column:
    """The date that ``_month`` reads, for windows to reach the scan."""
    return filters.stored_date(date, 12 * shift, span)


def _whole(value: Column, kind: str = "int") -> Column:
    return F.floor(value).cast(kind)


def _places(spark: SparkSession, folder: str, side: str, key: str, nation: bool = False) -> DataFrame:
    """``key`` and ``GEO`` of the suppliers or customers, and their ``nation`` if asked for."""
    nations = table(spark, folder, "nation").select(
        "n_nationkey", F.nullif(_pick(PLACES, F.col("n_nationkey") + 1), F.lit("")).alias("GEO")
    )
    sides = table(spark, folder, side)
    return sides.join(nations, F.col(f"{key[0]}_nationkey") == F.col("n_nationkey")).select(
        key, "GEO", *(["n_nationkey"] if nation else [])
    )


def labelled_lines(spark: SparkSession, folder: str, label: Column) -> DataFrame:
    """Line items with the label of their part as ``label``."""
    parts = table(spark, folder, "part").select("p_partkey", label.alias("label"))
    lines = table(spark, folder, "lineitem")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def gdp(spark: SparkSession, folder: str) -> DataFrame:
    lines = labelled_lines(spark, folder, _brand(GDP_INDUSTRIES))
    return lines.select(
        _month("l_shipdate").alias("REF_DATE"),
        _stored("l_shipdate"),
        F.lit("Canada").alias("GEO"),
        F.when(F.col("l_returnflag") == "A", "Seasonally adjusted at annual rates")
        .when(F.col("l_returnflag") == "R", "Trading-day adjusted")
        .otherwise("Unadjusted")
        .alias("Seasonal adjustment"),
        F.when(F.col("l_linestatus") == "F", "Chained (2012) dollars")
        .otherwise("2012 constant prices")
        .alias("Prices"),
        F.col("label").alias(V.NAICS),
        F.when(F.col("l_linenumber") != 7, _whole(F.col("l_extendedprice") / 1000)).alias("VALUE"),
    )


def trade(spark: SparkSession, folder: str) -> DataFrame:
    lines = labelled_lines(spark, folder, _type(TRADE_PRODUCTS))
    return lines.select(
        _month("l_shipdate").alias("REF_DATE"),
        _stored("l_shipdate"),
        F.when(F.col("l_linestatus") == "F", "Import").otherwise("Export").alias("Trade"),
        F.when(F.col("l_returnflag") == "A", "Customs").otherwise("Balance of payments").alias("Basis"),
        F.when(F.col("l_discount") < 0.03, "Unadjusted")
        .otherwise("Seasonally adjusted")
        .alias("Seasonal adjustment"),
        F.col("label").alias(V.NAPCS),
        F.when(F.col("l_linenumber") != 7, _whole(F.col("l_extendedprice") / 1000, "double")).alias(
            "VALUE"
        ),
    )


def hours(spark: SparkSession, folder: str) -> DataFrame:
    lines = labelled_lines(spark, folder, _brand(HOURS_INDUSTRIES))
    return lines.select(
        _month("l_shipdate").alias("REF_DATE"),
        _stored("l_shipdate"),
        F.lit("Canada").alias("GEO"),
        F.col("label").alias(V.NAICS),
        F.when(F.col("l_returnflag") == "N", "Standard error").otherwise("Estimate").alias("Statistics"),
        F.when(F.col("l_linenumber") != 6, F.col("l_extendedprice") / 100).alias("VALUE"),
    )


def retail(spark: SparkSession, folder: str) -> DataFrame:
    lines = labelled_lines(spark, folder, _type(RETAIL_INDUSTRIES)).join(
        _places(spark, folder, "supplier", "s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    return lines.select(
        _month("l_shipdate").alias("REF_DATE"),
        _stored("l_shipdate"),
        "GEO",
        F.col("label").alias(V.NAICS),
        F.when(F.col("l_returnflag") == "N", "Unadjusted")
        .otherwise("Seasonally adjusted")
        .alias("Adjustments"),
        F.when(F.col("l_linenumber") != 7, _whole(F.col("l_extendedprice"))).alias("VALUE"),
    )


def cpi(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").join(
        _places(spark, folder, "customer", "c_custkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    return orders.select(
        _month("o_orderdate").alias("REF_DATE"),
        _stored("o_orderdate"),
        "GEO",
        _priority(PRODUCT_GROUPS).alias("Products and product groups"),
        _whole(F.col("o_totalprice") / 1000, "double").alias("VALUE"),
    )


def tsx(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        _month("o_orderdate").alias("REF_DATE"),
        _stored("o_orderdate"),
        _priority(TSX_STATISTICS).alias("Toronto Stock Exchange Statistics"),
        F.when(F.col("o_orderstatus") == "P", "Dollars").otherwise("Index").alias("UOM"),
        (_whole(F.col("o_totalprice") / 1000, "double") - 50).alias("VALUE"),
    )


def leading_indicators(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        _month("o_orderdate", BASE_YEAR_SHIFT).alias("REF_DATE"),
        _stored("o_orderdate", BASE_YEAR_SHIFT),
        _priority(LEADING_INDICATORS).alias("Leading indicators"),
        F.when(F.col("o_orderstatus") == "O", "Unsmoothed").otherwise("Smoothed").alias("Composite index"),
        (_whole(F.col("o_totalprice") / 1000, "double") - 100).alias("VALUE"),
    )


def spending(spark: SparkSession, folder: str) -> DataFrame:
    quarter = F.trunc(F.col("l_shipdate").cast("date"), "quarter")
    return (
        table(spark, folder, "lineitem")
        .withColumn("quarter", quarter)
        .select(
            _month("quarter").alias("REF_DATE"),
            _stored("l_shipdate", span=3),
            F.lit("Canada").alias("GEO"),
            F.when(F.col("l_linestatus") == "F", "Current prices")
            .otherwise("2012 constant prices")
            .alias("Prices"),
            F.when(F.col("l_returnflag") == "A", "Unadjusted")
            .otherwise("Seasonally adjusted at quarterly rates")
            .alias("Seasonal adjustment"),
            F.when(F.col("l_linenumber") <= 3, "Household final consumption expenditure")
            .otherwise("Goods")
            .alias("Estimates"),
            F.when(F.col("l_quantity") < 50, _whole(F.col("l_extendedprice"))).alias("VALUE"),
        )
    )


def stock(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", _month("o_orderdate")).alias("REF_DATE"),
        _stored("o_orderdate"),
        _whole(price / 100, "double").alias("High"),
        _whole(price / 1000, "double").alias("Low"),
        _whole(price, "double").alias("Volume"),
    )


def daily_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events by day, the value in whole cents."""
    return table(spark, folder, "events").select(
        F.col("ts").cast("date").alias("REF_DATE"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.length("props").alias("size"),
    )


def case_codes(spark: SparkSession, folder: str) -> DataFrame:
    """One row of integer codes per order."""
    day = F.col("o_orderdate").cast("date")
    status = F.col("o_orderstatus")
    week = F.floor(F.dayofyear(day) / 7).cast("int") + F.when(
        F.col("o_orderpriority") == "5-LOW", 1
    ).otherwise(0)
    known_week = F.when(~((F.month(day) == 2) & (status == "P")), week)
    age = F.floor(F.col("o_totalprice") / 50000).cast("int")
    codes = {
        "Region": F.when((F.col("o_orderpriority") == "5-LOW") & (status == "P"), 7).otherwise(
            F.substring("o_orderpriority", 1, 1).cast("int")
        ),
        "Gender": _pick([9, 1, 2], F.col("o_custkey") % 3 + 1),
        "Age group": F.when(age > 8, 99).otherwise(age),
        "Occupation": _pick([1, 2, 3, 4, 9], F.month(day) % 5 + 1),
        "Transmission": F.when(status == "F", 1).when(status == "O", 2).otherwise(9),
        "Hospital status": _pick([1, 2, 3, 9], F.day(day) % 4 + 1),
        "Episode week": known_week,
        "Recovery week": F.when(status != "P", week + 2),
        "Asymptomatic": _pick([9, 1, 2], F.day(day) % 3 + 1),
        "Recovered": F.when(status == "P", 9).otherwise((F.col("o_custkey") % 2 + 1).cast("int")),
        "Death": F.when(F.month(day) % 4 == 1, 1).otherwise(2),
    }
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias(V.CASE_ID), *[codes[name].alias(name) for name in V.CASE_ATTRIBUTES]
    )


def cases_eav(spark: SparkSession, folder: str) -> DataFrame:
    """The codes as one row per order and attribute."""
    wide = case_codes(spark, folder)
    return wide.unpivot(V.CASE_ID, list(V.CASE_ATTRIBUTES), V.CASE_ATTRIBUTE, "VALUE")


def country_series(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly order value per series, one row per series and year; every nation adds to one of them."""
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.try_element_at(F.lit(COUNTRIES), F.col("c_nationkey") % len(COUNTRIES) + 1).alias("series")
    )
    orders = table(spark, folder, "orders").select(
        "o_custkey",
        F.year(F.col("o_orderdate").cast("date")).alias("year"),
        _whole(F.col("o_totalprice"), "bigint").alias("price"),
    )
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    sums = P.partial_sums(joined.where(F.col("series").isNotNull()), ["series", "year"], "price")
    autumn = F.col("series") == "US"
    day = F.make_date(
        F.col("year") + SERIES_SHIFT, F.when(autumn, 9).otherwise(1), F.when(autumn, 30).otherwise(1)
    )
    return sums.select("series", P.after_sums(day).alias("DATE"), F.col(P.SUM).cast("double").alias("VALUE"))


def macro_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Coarse quantities per part type, flag and status with a column per year."""
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    year = F.year(F.col("l_shipdate").cast("date")) + MONTH_SHIFT
    lines = table(spark, folder, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    sums = lines.groupBy("p_type", "l_returnflag", "l_linestatus").agg(
        *[F.sum(F.when(year == y, F.col("l_quantity"))).alias(str(y)) for y in range(2014, 2021)]
    )
    promo = (F.col("p_type") == "PROMO") & (F.col("l_linestatus") == "O")
    return sums.select(
        F.col("p_type").alias("Subject Descriptor"),
        F.nullif("l_returnflag", F.lit("N")).alias("Units"),
        *[
            F.when(F.lit(y != 2020) | ~promo, _whole(F.col(str(y)) / 10000, "double")).alias(str(y))
            for y in range(2014, 2021)
        ],
    )


def development_panel(spark: SparkSession, folder: str, by_nation: bool = False) -> DataFrame:
    """Nine order counts per place and year, or per nation of a place and year."""
    orders = table(spark, folder, "orders").join(
        _places(spark, folder, "customer", "c_custkey", by_nation), F.col("o_custkey") == F.col("c_custkey")
    )
    conditions = [
        F.lit(True),
        *[F.col("o_orderstatus") == status for status in ("F", "O", "P")],
        *[F.col("o_orderpriority").startswith(str(digit)) for digit in range(1, 6)],
    ]
    nation = ["n_nationkey"] if by_nation else []
    counted = orders.groupBy(
        *nation,
        F.col("GEO").alias("country"),
        (F.year(F.col("o_orderdate").cast("date")) + BASE_YEAR_SHIFT).alias("year"),
    ).agg(
        F.lit(1).alias("ifs"),
        F.lit("CODE").alias("code"),
        *[
            F.count_if(condition).cast("double").alias(index)
            for index, condition in zip(V.DEVELOPMENT_INDICES, conditions)
        ],
    )
    return counted.drop(*nation)
