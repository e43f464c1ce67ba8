"""The five retail tables, derived from the given order tables.

Every given row yields a row: nothing is filtered, so the work grows with the
given tables. ``docs`` for the mapping are in FIXTURES.md; the same mapping in
SQL is in :mod:`shelfline.catalog.oracle`.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.dates import day_lit
from shelfline.functions.paths import feed_path
from shelfline.schemas import FEEDS

AS_OF = date(2023, 5, 31)
MONEY = "decimal(18,2)"

FIRST_GIVEN_DAY = date(1995, 1, 1)
FIRST_DAY = date(2023, 1, 1)
FACT_DAYS = 182
CALENDAR_DAYS = 175


# Columns of the given tables, so that no job has to look them up in the files.
GIVEN_SCHEMAS = {
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
                   l_quantity double, l_extendedprice double, l_discount double, l_tax double,
                   l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
                 o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
               p_retailprice double""",
}


def _given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(GIVEN_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def _day_number(timestamp: str) -> Column:
    return F.date_diff(F.col(timestamp).cast("date"), day_lit(FIRST_GIVEN_DAY))


def _folded(day_number: Column, days: int) -> Column:
    """Seven given years laid over one season."""
    return F.date_add(day_lit(FIRST_DAY), (day_number % days).cast("int"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale per order line."""
    amount = F.col("l_extendedprice").cast(MONEY)
    return _given(spark, sf_dir, "lineitem").select(
        _folded(_day_number("l_shipdate"), FACT_DAYS).alias("TRANS_DT"),
        F.col("l_suppkey").alias("STORE_KEY"),
        F.col("l_linenumber").cast("bigint").alias("PROD_KEY"),
        # Returned lines sold nothing, which gives weeks without any quantity.
        F.when(F.col("l_returnflag") == "R", 0)
        .otherwise(F.col("l_quantity").cast("bigint"))
        .alias("SALES_QTY"),
        amount.alias("SALES_AMT"),
        # Whole numbers, so that an average is the same in any order.
        F.floor(amount.cast("double") / F.lit(7.0)).cast("double").alias("SALES_PRICE"),
        (amount - F.col("l_quantity").cast("decimal(9,0)")).cast(MONEY).alias("SALES_COST"),
        F.when(F.col("l_discount") != 0, (F.col("l_tax") * 100).cast(MONEY)).alias("SHIP_COST"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stock snapshot per order line, on another day than its sale."""
    day = _folded(_day_number("l_shipdate") + F.col("l_orderkey"), FACT_DAYS)
    is_out = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O")
    return _given(spark, sf_dir, "lineitem").select(
        day.alias("CAL_DT"),
        F.col("l_suppkey").alias("STORE_KEY"),
        F.col("l_linenumber").cast("bigint").alias("PROD_KEY"),
        F.when(is_out, 0)
        .when(F.col("l_quantity") != 13, F.col("l_partkey") % 120)
        .alias("INVENTORY_ON_HAND_QTY"),
        (F.col("l_partkey") % 50).alias("INVENTORY_ON_ORDER_QTY"),
        F.when(F.col("l_quantity") != 7, is_out.cast("int")).alias("OUT_OF_STOCK_FLG"),
        (F.col("l_orderkey") % 5).alias("WASTE_QTY"),
        (F.col("l_returnflag") == "N").cast("int").alias("PROMOTION_FLG"),
        F.when(F.col("l_linestatus") == "F", F.date_add(day, F.col("l_linenumber"))).alias(
            "NEXT_DELIVERY_DT"
        ),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order day; shorter than the facts, so some lie outside it."""
    days = (
        _given(spark, sf_dir, "orders")
        .select(_folded(_day_number("o_orderdate"), CALENDAR_DAYS).alias("CAL_DT"))
        .distinct()
    )
    day = F.col("CAL_DT")
    # Weeks run from Sunday to Saturday: the ISO week of the day after.
    after = F.date_add(day, 1)
    week = F.weekofyear(after)
    return days.select(
        day,
        F.dayofweek(day).alias("DAY_OF_WK_NUM"),
        (F.extract(F.lit("YEAROFWEEK"), after) * 100 + week).cast("int").alias("YR_WK_NUM"),
        F.lit("Trading").alias("CAL_TYPE_DESC"),
        F.date_format(day, "EEEE").alias("DAY_OF_WK_DESC"),
        F.month(day).alias("MNTH_NUM"),
        F.quarter(day).alias("QTR_NUM"),
        (F.year(day) * 10 + F.quarter(day)).alias("YR_QTR_NUM"),
        (F.year(day) * 100 + F.month(day)).alias("YR_MNTH_NUM"),
        F.year(day).alias("YR_NUM"),
        week.alias("WK_NUM"),
    )


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("STORE_KEY"),
        F.col("s_name").alias("STORE_DESC"),
        F.col("s_nationkey").alias("NATION_KEY"),
        F.col("s_acctbal").alias("STORE_BALANCE"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("PROD_KEY"),
        F.col("p_name").alias("PROD_NAME"),
        F.col("p_brand").alias("BRAND_DESC"),
        F.col("p_type").alias("TYPE_DESC"),
        F.col("p_size").alias("SIZE_NUM"),
        F.col("p_retailprice").alias("LIST_PRICE"),
    )


TABLES = {
    "sales": sales,
    "inventory": inventory,
    "calendar": calendar,
    "store": store,
    "product": product,
}


def as_feed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table as it lies in its feed file.

    Open deliveries have a word for a date. Sold and stocked quantities are
    written with decimals; waste is a fraction at times, or a word.
    """
    frame = TABLES[table](spark, sf_dir)
    if table == "sales":
        frame = frame.withColumn("SALES_QTY", F.concat(F.col("SALES_QTY").cast("string"), F.lit(".00")))
    if table == "inventory":
        delivery = F.col("NEXT_DELIVERY_DT").cast("string")
        stock, waste = F.col("INVENTORY_ON_HAND_QTY").cast("string"), F.col("WASTE_QTY")
        frame = frame.withColumns(
            {
                "NEXT_DELIVERY_DT": F.coalesce(delivery, F.lit("pending")),
                "INVENTORY_ON_HAND_QTY": F.concat(stock, F.lit(".0")),
                "WASTE_QTY": F.when(waste == 4, "some")
                .when(waste == 3, "2.5")
                .otherwise(waste.cast("string")),
            }
        )
    return frame


LANDING = "landing/"


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An arrival log with one landed file per order, its table by the order's priority."""
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    table = F.element_at(F.array(*[F.lit(t) for t in FEEDS]), priority)
    return _given(spark, sf_dir, "orders").select(
        feed_path(table, F.col("o_orderdate").cast("date"), LANDING).alias("path")
    )


def arrival_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as events; a file arrives on the day of its stamp, at an hour by its order's number."""
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    table, day = F.element_at(F.array(*[F.lit(t) for t in FEEDS]), priority), F.col("o_orderdate").cast("date")
    hour = F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return _given(spark, sf_dir, "orders").select(
        day.alias("feed_date"), table.alias("table_name"), feed_path(table, day, LANDING).alias("path"), (day.cast("timestamp") + hour).alias("arrived")
    )


def run_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date from the first to the last order."""
    day = F.col("o_orderdate").cast("date")
    span = _given(spark, sf_dir, "orders").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi")).alias("run_date"))
