"""The plans Spark makes of the queries: what is scanned, moved and broadcast."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"

# Those that write and read files of their own show only the final read.
LAZY = [
    "daily_sales",
    "sales_calendar_left",
    "inventory_calendar_left",
    "weekly_sales",
    "weekly_sales_left",
    "inventory_max_day",
    "no_stock_weekly",
    "stock_last_snapshot",
    "stock_every_snapshot",
    "weekly_sales_no_stock",
    "weekly_kpis",
    "weekly_stock",
    "weekly_stock_as_written",
    "missing_feeds",
    "missing_snapshots",
    "ready_runs",
    "manifest_paths",
    "stock_without_sales",
    "sales_without_stock",
]


@pytest.fixture
def unhinted(spark):
    """Nothing is broadcast but what the code asks for."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.maxMetadataStringLength": "10000",
        "spark.sql.debug.maxToStringFields": "100",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def plan_of(spark, name):
    frame = entry.queries()[name](spark, SF_DIR)
    return frame._jdf.queryExecution().executedPlan().toString()


# One row of partial results per task, or one row per calendar day, comes together in
# one task: the first and last run date, and the list of the calendar's dates.
GATHERS_A_LITTLE = {"missing_feeds", "ready_runs", "manifest_paths", "missing_snapshots"}


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_window_no_python_no_single_task(unhinted, name):
    plan = plan_of(unhinted, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "Python"):
        assert node not in plan
    assert ("SinglePartition" in plan) == (name in GATHERS_A_LITTLE)


def test_weekly_stock_moves_each_fact_as_planned(unhinted):
    plan = plan_of(unhinted, "weekly_stock")
    hash_moves = [m for m in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)]
    facts = [m for m in hash_moves if "CAL_DT" not in m]
    # Weekly sales, weekly stock-outs, the small joined weekly rows, the levels.
    assert len(facts) == 4
    assert sum("DAY_OF_WK_NUM" in m or "max_day_of_week" in m for m in facts) == 2
    assert plan.count("SortMergeJoin") == 2
    # The calendar's broadcasts, one per use.
    assert plan.count("BroadcastHashJoin") == 3


def test_both_sides_of_the_stock_join_have_their_own_shuffle(unhinted):
    """AQE splits a hot partition only then."""
    for name in ("weekly_stock", "weekly_stock_as_written", "stock_last_snapshot"):
        lines = plan_of(unhinted, name).splitlines()
        top = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
        under = [line for line in lines[top:] if re.match(r"^[\s:]*[:+]- Sort ", line)]
        followed = [lines[lines.index(line) + 1] for line in under]
        assert sum("Exchange hashpartitioning" in line for line in followed) >= 2, name


def test_only_needed_columns_are_read(unhinted):
    plan = plan_of(unhinted, "no_stock_weekly")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert not any("l_extendedprice" in s or "l_discount" in s for s in schemas)
    daily = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(unhinted, "daily_sales"))
    assert len(daily) == 1 and "l_orderkey" not in daily[0]


def test_sums_are_formed_before_the_shuffle(unhinted):
    plan = plan_of(unhinted, "weekly_sales")
    assert "partial_sum" in plan


def test_calendar_bounds_reach_the_scans(unhinted, tmp_path):
    from frames import calendar, day, inventory, sales
    from shelfline.plans.weekly import weekly_stock

    spark = unhinted
    inventory(spark, [(0, 1, 1, 1, 1, 0)]).write.parquet(f"{tmp_path}/inventory")
    sales(spark, [(0, 1, 1, 1, 1)]).write.parquet(f"{tmp_path}/sales")
    table = weekly_stock(
        spark.read.parquet(f"{tmp_path}/sales"),
        spark.read.parquet(f"{tmp_path}/inventory"),
        calendar(spark),
        day(3),
    )
    plan = table._jdf.queryExecution().executedPlan().toString()
    for column, scans in (("TRANS_DT", 1), ("CAL_DT", 2)):
        assert plan.count(f"GreaterThanOrEqual({column},2023-01-01)") == scans
        assert plan.count(f"LessThanOrEqual({column},2023-01-07)") == scans
    assert table.count() == 1


def test_week_filter_prunes_partitions(spark, tmp_path):
    from shelfline.sources.sinks import write_table

    frame = spark.range(50).selectExpr("id", "cast(id % 5 AS int) AS YR_WK_NUM")
    write_table(frame, f"{tmp_path}/t", "YR_WK_NUM")
    read = spark.read.parquet(f"{tmp_path}/t").where("YR_WK_NUM <= 1")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*YR_WK_NUM.*<= 1", plan)
