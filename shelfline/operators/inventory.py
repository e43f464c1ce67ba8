"""Stock levels and stock-outs by week."""

from __future__ import annotations

from typing import Literal, get_args

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.operators.calendar import Days, with_calendar
from shelfline.schemas import WEEK_KEYS

StockPolicy = Literal["last_snapshot", "every_snapshot"]


def check_policy(policy: str) -> None:
    if policy not in get_args(StockPolicy):
        raise ValueError(f"stock_policy must be one of {get_args(StockPolicy)}, not {policy!r}")


def dated_inventory(inventory: DataFrame, days: Days, how: str = "inner") -> DataFrame:
    """Inventory rows with their week and day of week."""
    return with_calendar(inventory, "CAL_DT", days, how)


def weekly_summary(dated: DataFrame) -> DataFrame:
    """Stock-out count and last observed day per week, store and product, in one pass."""
    return dated.groupBy(WEEK_KEYS).agg(
        F.sum("OUT_OF_STOCK_FLG").alias("No_Stock_Instances"),
        F.max("DAY_OF_WK_NUM").alias("max_day_of_week"),
    )


def no_stock_weekly(inventory: DataFrame, days: Days) -> DataFrame:
    """Number of stock-outs per week, store and product."""
    return weekly_summary(dated_inventory(inventory, days)).drop("max_day_of_week")


def inventory_max_day(inventory: DataFrame, days: Days) -> DataFrame:
    """Last day of the week with a snapshot, per week, store and product.

    Not every week has a snapshot on its last day.
    """
    return weekly_summary(dated_inventory(inventory, days)).drop("No_Stock_Instances")


def snapshot_levels(dated: DataFrame) -> DataFrame:
    """Stock level and open orders of every snapshot, keyed by week and day."""
    return dated.select(
        *WEEK_KEYS,
        "DAY_OF_WK_NUM",
        F.col("INVENTORY_ON_HAND_QTY").alias("stock_lvl_eow"),
        F.col("INVENTORY_ON_ORDER_QTY").alias("stock_on_order_eow"),
    )


def attach_levels(weekly: DataFrame, levels: DataFrame, policy: StockPolicy) -> DataFrame:
    """Join rows per week, store and product (with ``max_day_of_week``) to their snapshots.

    ``last_snapshot`` keeps the snapshots of the last observed day, all of them
    if the day has several; ``every_snapshot`` keeps every snapshot of the week.

    Both joins carry a fourth key. With the three week keys alone, the weekly
    side would come out of its aggregation already in place and Spark would
    shuffle only the snapshots; AQE splits a hot partition only where both
    sides have a shuffle of their own, and a single week, store and product may
    hold a large part of all snapshots. The weekly side is one row per key, so
    its extra shuffle is small.
    """
    check_policy(policy)
    if policy == "last_snapshot":
        weekly = weekly.withColumnRenamed("max_day_of_week", "DAY_OF_WK_NUM")
        joined = weekly.join(levels, [*WEEK_KEYS, "DAY_OF_WK_NUM"])
    else:
        weekly = weekly.drop("max_day_of_week").withColumn("spread", F.xxhash64(*WEEK_KEYS))
        levels = levels.withColumn("spread", F.xxhash64(*WEEK_KEYS))
        joined = weekly.join(levels, [*WEEK_KEYS, "spread"]).drop("spread")
    return joined.drop("DAY_OF_WK_NUM")


def week_end_stock(
    inventory: DataFrame, days: Days, policy: StockPolicy = "last_snapshot"
) -> DataFrame:
    """Stock levels per week, store and product under the given policy."""
    check_policy(policy)
    dated = dated_inventory(inventory, days)
    levels = snapshot_levels(dated)
    if policy == "every_snapshot":
        return levels.drop("DAY_OF_WK_NUM").dropna(subset=WEEK_KEYS)
    last_day = weekly_summary(dated).select(*WEEK_KEYS, "max_day_of_week")
    return attach_levels(last_day, levels, policy)
