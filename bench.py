"""Time the headline queries, each on its second run; prints one JSON line.

BENCH_SF_DIR   folder of the given tables   (default /root/testdata/sf0.1)
BENCH_CPUS     local threads                (default 8)
BENCH_QUERIES  names separated by commas    (default: the list below)
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from shelfline.catalog import tables
from shelfline.catalog.queries import QUERIES
from shelfline.functions.kpis import with_kpis
from shelfline.operators import inventory, sales
from shelfline.operators.calendar import check_calendar, with_calendar
from shelfline.operators.inventory import attach_levels, dated_inventory, snapshot_levels
from shelfline.plans.job import HASH_JOIN_BYTES, HASH_JOIN_SETTING
from shelfline.schemas import WEEK_KEYS, WEEKLY_COLUMNS

HEADLINE = [
    "weekly_stock",
    "weekly_stock_as_written",
    "weekly_kpis",
    "weekly_sales",
    "daily_sales",
    "sales_calendar_left",
    "no_stock_weekly",
    "inventory_max_day",
    "stock_last_snapshot",
    "weekly_sales_no_stock",
    "stock_without_sales",
    "missing_snapshots",
    "missing_feeds",
    "scan_sales",
    "scan_inventory",
    "extract_row_counts",
    "published_sql",
    "ingest_available_now",
]


def step_by_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly table the long way round, to compare the flagship plan with.

    Sales go through daily totals before the week; inventory is scanned for the
    last day, for the stock-outs and for the levels, each on its own.
    """
    checked = check_calendar(tables.calendar(spark, sf_dir), tables.AS_OF)
    stock = tables.inventory(spark, sf_dir)
    daily = sales.daily_sales(tables.sales(spark, sf_dir)).selectExpr(
        "TRANS_DT",
        "STORE_KEY",
        "PROD_KEY",
        "total_sales_qty AS SALES_QTY",
        "cast(total_sales_amount AS decimal(18,2)) AS SALES_AMT",
        "cast(total_cost AS decimal(18,2)) AS SALES_COST",
        "cast(0 AS decimal(18,2)) AS SHIP_COST",
    )
    weekly = sales.weekly_totals(with_calendar(daily, "TRANS_DT", checked.full, "left"))
    weekly = weekly.join(inventory.no_stock_weekly(stock, checked.days), WEEK_KEYS)
    weekly = weekly.join(inventory.inventory_max_day(stock, checked.days), WEEK_KEYS)
    levels = snapshot_levels(dated_inventory(stock, checked.days))
    table = with_kpis(attach_levels(weekly, levels, "last_snapshot"))
    return table.where(table.YR_WK_NUM <= checked.current_week).select(WEEKLY_COLUMNS)


def session(cpus: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="shelfline-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config(HASH_JOIN_SETTING, HASH_JOIN_BYTES)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", scratch)
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE

    def once(query) -> float:
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    def run(query) -> float:
        once(query)  # generated code is compiled here; not counted
        return once(query)

    for _ in range(3):  # the engine itself gets faster over its first queries
        once(QUERIES["weekly_stock"])
    times = {name: run(QUERIES[name]) for name in names}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "compared": {"weekly_stock_step_by_step": run(step_by_step)},
        "sf": sf_dir.rsplit("/sf", 1)[-1],
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
