"""Sales by day and by week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.calendar import Days, with_calendar
from shelfline.schemas import WEEK_KEYS


def _exact_sum(value: Column) -> Column:
    return F.sum(value).cast("double")


def _totals() -> list[Column]:
    # A row whose cost or shipping cost is unknown adds nothing to the cost.
    return [
        _exact_sum(F.col("SALES_QTY")).alias("total_sales_qty"),
        _exact_sum(F.col("SALES_AMT")).alias("total_sales_amount"),
        _exact_sum(F.col("SALES_COST") + F.col("SHIP_COST")).alias("total_cost"),
    ]


def daily_sales(sales: DataFrame) -> DataFrame:
    """Totals and average price per date, store and product."""
    qty, amount, cost = _totals()
    return sales.groupBy("TRANS_DT", "STORE_KEY", "PROD_KEY").agg(
        qty, amount, F.avg("SALES_PRICE").alias("avg_sales_price"), cost
    )


def dated_sales(sales: DataFrame, days: Days, how: str = "inner") -> DataFrame:
    """Sales rows with their week."""
    return with_calendar(sales, "TRANS_DT", days.select("CAL_DT", "YR_WK_NUM"), how)


def weekly_totals(dated: DataFrame) -> DataFrame:
    """Totals per week, store and product, from rows that carry their week.

    Daily totals are not formed first: sums of sums are the same sums, and one
    partial aggregation per task sends at most one row per key to the shuffle.
    """
    return dated.groupBy(WEEK_KEYS).agg(*_totals())


def weekly_sales(sales: DataFrame, days: Days, how: str = "inner") -> DataFrame:
    """Totals per week, store and product.

    ``how="left"`` keeps sales outside the calendar, under a NULL week.
    """
    return weekly_totals(dated_sales(sales, days, how))
