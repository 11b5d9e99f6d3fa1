"""Every registered query against its SQL on the driver's tables."""

import __spark_entry__ as entry_module
import compare
import pytest

from indicata.operators import reshape
from indicata.plans import star_oracles, star_queries

FOLDER = "/root/testdata/sf0.01"
QUERIES = star_queries.QUERIES
SQL = star_oracles.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    result = QUERIES[name](spark, FOLDER)
    rows = [tuple(row) for row in result.collect()]
    assert rows
    names, expected = compare.sql_rows(FOLDER, SQL[name])
    assert compare.difference(result.columns, rows, names, expected) is None
    assert compare.type_difference(result.dtypes, FOLDER, SQL[name]) == {}


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", ["gdp_totals_threshold", "joint_monthly_means", "productivity_yearly", "prediction_features"]
)
def test_keys_are_cleaned_after_the_sums(spark, name):
    """No month is parsed and no pattern applied below the first aggregate."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "gettimestamp(" in line or "regexp_replace(" in line:
            assert "_count#" in line or "CASE WHEN (count(" in line, line[:200]


def test_eav_pivot_is_one_shuffle(spark):
    plan = QUERIES["eav_to_wide"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in plan


def test_series_panel_is_one_aggregate_over_the_years(spark):
    plan = QUERIES["series_panel"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1  # orders to customers; no join per country


def test_case_counts_read_the_cases_once(spark):
    plan = QUERIES["cases_by_week_region"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "Join" not in plan


@pytest.mark.parametrize(
    ("name", "scans"),
    [
        ("indicator_window_filtered", ["o_orderdate"]),
        ("label_pivot", ["l_shipdate"]),
        ("label_pivot_prices", ["o_orderdate"]),
        ("cleanse_prefix", ["l_shipdate"]),
        ("merge_monthly_outer", ["l_shipdate"] * 3 + ["o_orderdate"]),
    ],
)
def test_windows_reach_the_scan_as_ranges(spark, monkeypatch, name, scans):
    """Every scan of a windowed view gets both ends of its range, of those that the query or a checkpoint of it makes."""
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df.persist()

    monkeypatch.setattr(reshape, "checkpointed", kept)
    plans.append(QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString())
    ranges = []
    for line in "\n".join(plans).splitlines():
        if "FileScan" in line and "PushedFilters" in line:
            pushed = line.partition("PushedFilters:")[2]
            for column in ("o_orderdate", "l_shipdate"):
                if f"GreaterThanOrEqual({column}," in pushed and f"LessThan({column}," in pushed:
                    ranges.append(column)
    assert sorted(set(ranges)) == sorted(set(scans)) and len(ranges) >= len(scans)
