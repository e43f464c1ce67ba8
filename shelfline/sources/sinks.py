"""Published Parquet tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WEEK_PARTITION = "YR_WK_NUM"


def stamp(frame: DataFrame, load_tmst: datetime | None = None) -> DataFrame:
    """Add the load time: the given one, or the time the query runs."""
    now = F.current_timestamp() if load_tmst is None else F.lit(load_tmst)
    return frame.withColumn("load_tmst", now)


def write_table(frame: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite a Parquet table.

    With ``partition_by`` the rows are first brought together by that column so
    that each value gets few files; the rebalance hint lets AQE spread a large
    value over several tasks and put small ones together.
    """
    if partition_by is None:
        frame.write.mode("overwrite").parquet(path)
    else:
        balanced = frame.hint("rebalance", partition_by)
        balanced.write.mode("overwrite").partitionBy(partition_by).parquet(path)


def publish(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> None:
    """Make a written table known to SQL as ``name``, in place of an older one."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path, source="parquet")
    if partitioned:
        spark.catalog.recoverPartitions(name)
