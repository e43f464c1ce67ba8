"""Weekly service KPIs as column expressions.

A week without sales has no price and no weeks of supply: ``try_divide`` gives
NULL there, also with ANSI mode on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAYS_IN_WEEK = 7


def with_kpis(weekly: DataFrame) -> DataFrame:
    """Add the seven KPI columns to weekly sales, stock-out counts and stock."""
    qty, amount = F.col("total_sales_qty"), F.col("total_sales_amount")
    stock, instances = F.col("stock_lvl_eow"), F.col("No_Stock_Instances")

    # A NULL comparison is not true, so unknown stock is never low stock.
    is_low = stock < qty
    price = F.try_divide(amount, qty)

    return weekly.withColumns(
        {
            "Low_Stock_flg": F.when(is_low, 1).otherwise(0),
            "Total_Low_Stock_Impact": instances + F.when(is_low, 1).otherwise(0),
            "avg_sales_price": price,
            "Pot_Low_Stock_Impact": F.when(is_low, amount - stock * price).otherwise(0),
            "No_Stock_Impact": F.when(instances > 0, amount).otherwise(0),
            # Always out of seven days, also for the week still running.
            "in_stock_pct": (1 - instances / DAYS_IN_WEEK) * 100,
            "weeks_supply": F.try_divide(stock, qty),
        }
    )
