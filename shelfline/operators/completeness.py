"""What is missing: feeds that did not arrive, snapshots not taken, keys the joins drop."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import day_lit, feed_day
from shelfline.functions.paths import feed_path
from shelfline.operators.calendar import Days
from shelfline.operators.inventory import dated_inventory
from shelfline.operators.sales import dated_sales
from shelfline.schemas import FEEDS, WEEK_KEYS


def expected_feeds(
    run_dates: DataFrame, prefix: str = "", tables: Sequence[str] = FEEDS
) -> DataFrame:
    """One row per run date and table, with the path the feed should have.

    ``run_dates`` has one column ``run_date``; a run needs the feeds of the day
    before it.
    """
    return (
        run_dates.select(
            "run_date",
            feed_day(F.col("run_date")).alias("feed_date"),
            F.explode(F.array(*[F.lit(t) for t in tables])).alias("table_name"),
        )
        .select(
            "run_date",
            "feed_date",
            "table_name",
            feed_path(F.col("table_name"), F.col("feed_date"), prefix).alias("path"),
        )
    )


def missing_feeds(expected: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Expected feeds whose path is not in the arrival log; empty means complete."""
    # A file listed many times is reduced to one row before the shuffle.
    return expected.join(arrivals.select("path").distinct(), "path", "left_anti").select(
        expected.columns
    )


def ready_runs(expected: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Run dates with every expected feed present, with their table-to-path JSON."""
    arrived = arrivals.select("path").distinct().withColumn("arrived", F.lit(1))
    return (
        expected.join(arrived, "path", "left")
        .groupBy("run_date")
        .agg(
            F.count(F.lit(1)).alias("wanted"),
            F.count("arrived").alias("present"),
            # At most one entry per table.
            F.array_sort(F.collect_list(F.struct("table_name", "path"))).alias("entries"),
        )
        .where(F.col("present") == F.col("wanted"))
        .select("run_date", F.to_json(F.map_from_entries("entries")).alias("manifest"))
    )


def missing_snapshots(inventory: DataFrame, days: Days, as_of: date) -> DataFrame:
    """Calendar days up to ``as_of`` without a snapshot, as stretches of days in a row.

    One row for each stretch (first and last day, number of days) of every store
    and product with a snapshot on one of these days. Repeated snapshots are
    reduced to one row before the shuffle, and the date grid is never formed.
    """
    until = days.frame.where(F.col("CAL_DT") <= day_lit(as_of))
    dates = until.agg(F.array_sort(F.collect_set("CAL_DT")).alias("dates"))
    numbered = dates.select(F.posexplode("dates").alias("at", "CAL_DT"))
    taken = days.within(inventory, "CAL_DT").select("CAL_DT", "STORE_KEY", "PROD_KEY").distinct()
    numbered = F.broadcast(numbered) if days.small else numbered  # at most one row per calendar day
    seen = taken.join(numbered, "CAL_DT")
    # At most one entry per calendar day.
    taken_at = seen.groupBy("STORE_KEY", "PROD_KEY").agg(F.array_sort(F.collect_list("at")).alias("at"))
    all_days = dates.scalar()
    after = F.concat("at", F.array(F.size(all_days)))
    bounds = taken_at.withColumns({"before": F.concat(F.array(F.lit(-1)), "at"), "after": after})
    between = F.zip_with(
        "before", "after", lambda a, b: F.struct((a + 1).alias("first"), (b - 1).alias("last"))
    )
    gaps = bounds.select("STORE_KEY", "PROD_KEY", F.explode(between).alias("gap"))
    return gaps.where("gap.first <= gap.last").select(
        F.get(all_days, F.col("gap.first")).alias("first_day"),
        F.get(all_days, F.col("gap.last")).alias("last_day"),
        (F.col("gap.last") - F.col("gap.first") + 1).cast("bigint").alias("days"),
        "STORE_KEY",
        "PROD_KEY",
    )


def stock_without_sales(sales: DataFrame, inventory: DataFrame, days: Days) -> DataFrame:
    """Weeks, stores and products with stock but no sales: the weekly table has no row for them."""
    return _keys(dated_inventory(inventory, days)).join(
        _keys(dated_sales(sales, days)), WEEK_KEYS, "left_anti"
    )


def sales_without_stock(sales: DataFrame, inventory: DataFrame, days: Days) -> DataFrame:
    """Weeks, stores and products with sales but no stock: the weekly table has no row for them."""
    return _keys(dated_sales(sales, days)).join(
        _keys(dated_inventory(inventory, days)), WEEK_KEYS, "left_anti"
    )


def _keys(dated: DataFrame) -> DataFrame:
    return dated.select(WEEK_KEYS).distinct()
