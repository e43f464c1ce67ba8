"""Column names and types of the five input feeds and of the published tables.

Money and quantities are DECIMAL with room for fractions, so that sums are exact
whatever order Spark adds them in; published, they are DOUBLE. Feeds are read as
text and converted by :func:`shelfline.sources.feeds.typed`, which keeps a bad
value from failing the whole scan.
"""

from __future__ import annotations

from pyspark.sql import types as T

FEEDS = ("calendar", "inventory", "product", "sales", "store")

WEEK_KEYS = ["YR_WK_NUM", "STORE_KEY", "PROD_KEY"]

MONEY = QUANTITY = T.DecimalType(24, 6)

SALES_TYPES = {
    "TRANS_DT": T.StringType(),
    "STORE_KEY": T.LongType(),
    "PROD_KEY": T.LongType(),
    "SALES_QTY": QUANTITY,
    "SALES_AMT": MONEY,
    "SALES_PRICE": T.DoubleType(),
    "SALES_COST": MONEY,
    "SHIP_COST": MONEY,
}

INVENTORY_TYPES = {
    "CAL_DT": T.StringType(),
    "STORE_KEY": T.LongType(),
    "PROD_KEY": T.LongType(),
    "INVENTORY_ON_HAND_QTY": QUANTITY,
    "INVENTORY_ON_ORDER_QTY": QUANTITY,
    "OUT_OF_STOCK_FLG": T.IntegerType(),
    "WASTE_QTY": QUANTITY,
    "PROMOTION_FLG": T.IntegerType(),
    "NEXT_DELIVERY_DT": T.StringType(),
}

CALENDAR_TYPES = {
    "CAL_DT": T.StringType(),
    "DAY_OF_WK_NUM": T.IntegerType(),
    "YR_WK_NUM": T.IntegerType(),
    "CAL_TYPE_DESC": T.StringType(),
    "DAY_OF_WK_DESC": T.StringType(),
    "MNTH_NUM": T.IntegerType(),
    "QTR_NUM": T.IntegerType(),
    "YR_QTR_NUM": T.IntegerType(),
    "YR_MNTH_NUM": T.IntegerType(),
    "YR_NUM": T.IntegerType(),
    "WK_NUM": T.IntegerType(),
}

# Of store and product only the key is fixed; the rest is copied as text.
FEED_TYPES = {
    "sales": SALES_TYPES,
    "inventory": INVENTORY_TYPES,
    "calendar": CALENDAR_TYPES,
    "store": {"STORE_KEY": T.LongType()},
    "product": {"PROD_KEY": T.LongType()},
}

DATE_COLUMNS = {
    "sales": ["TRANS_DT"],
    "inventory": ["CAL_DT", "NEXT_DELIVERY_DT"],
    "calendar": ["CAL_DT"],
    "store": [],
    "product": [],
}

WEEKLY_TYPES = {
    "YR_WK_NUM": T.IntegerType(),
    "STORE_KEY": T.LongType(),
    "PROD_KEY": T.LongType(),
    "total_sales_qty": T.DoubleType(),
    "total_sales_amount": T.DoubleType(),
    "total_cost": T.DoubleType(),
    "No_Stock_Instances": T.LongType(),
    "stock_lvl_eow": T.DoubleType(),
    "stock_on_order_eow": T.DoubleType(),
    "Low_Stock_flg": T.IntegerType(),
    "Total_Low_Stock_Impact": T.LongType(),
    "avg_sales_price": T.DoubleType(),
    "Pot_Low_Stock_Impact": T.DoubleType(),
    "No_Stock_Impact": T.DoubleType(),
    "in_stock_pct": T.DoubleType(),
    "weeks_supply": T.DoubleType(),
}

WEEKLY_COLUMNS = list(WEEKLY_TYPES)

WEEKLY_SCHEMA = T.StructType([T.StructField(n, t) for n, t in WEEKLY_TYPES.items()])
