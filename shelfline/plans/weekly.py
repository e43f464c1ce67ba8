"""The weekly stock and sales table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.kpis import with_kpis
from shelfline.operators.calendar import CheckedCalendar, check_calendar
from shelfline.operators.inventory import (
    StockPolicy,
    attach_levels,
    dated_inventory,
    snapshot_levels,
    weekly_summary,
)
from shelfline.operators.sales import dated_sales, weekly_totals
from shelfline.schemas import WEEK_KEYS, WEEKLY_TYPES


def sales_and_stock_outs(sales: DataFrame, inventory: DataFrame) -> DataFrame:
    """Weekly sales totals with the week's stock-outs and last observed day.

    Takes rows that carry their week. Both sides are aggregated on the join
    keys, so the join itself moves nothing.
    """
    return weekly_totals(sales).join(weekly_summary(inventory), WEEK_KEYS)


def weekly_table(
    sales: DataFrame, inventory: DataFrame, policy: StockPolicy = "last_snapshot"
) -> DataFrame:
    """The weekly table of all weeks, from sales and inventory rows that carry their week."""
    weekly = sales_and_stock_outs(sales, inventory)
    stocked = attach_levels(weekly, snapshot_levels(inventory), policy)
    return with_kpis(stocked).select([F.col(c).cast(t) for c, t in WEEKLY_TYPES.items()])


def weekly_stock(
    sales: DataFrame,
    inventory: DataFrame,
    calendar: DataFrame,
    as_of: date,
    policy: StockPolicy = "last_snapshot",
    checked: CheckedCalendar | None = None,
) -> DataFrame:
    """The weekly table up to and including the week of ``as_of``.

    The calendar is cut to those weeks before the facts are joined to it, so
    later facts leave at the first join and never reach a shuffle.
    """
    days = (checked or check_calendar(calendar, as_of)).days_to_now
    return weekly_table(dated_sales(sales, days), dated_inventory(inventory, days), policy)
