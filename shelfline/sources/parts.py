"""CSV in parts of at most a given number of bytes.

The frame is computed once, into a table of its rows with their length as CSV.
Rows are numbered by where they lie in that table; blocks of neighbouring rows
are summed, and a row's part follows from the bytes before its block: running
sums by task, after the sums of the tasks before, so only sums of blocks and of
tasks are ever brought together. Then every part is one task's file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.sources import files
from shelfline.sources.workspace import work_path

# What a line is written with; white space around a value is part of it.
CSV_OPTIONS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# A block is at most this share of a part, so parts are filled to that.
BLOCKS_PER_PART = 8


def header_bytes(frame: DataFrame) -> int:
    """Bytes of the header line, with every name quoted: an upper bound."""
    return sum(len(c.encode()) + 2 * c.count('"') + 3 for c in frame.columns)


def numbered_parts(sized: DataFrame, max_bytes: int, header: int, block_rows: int) -> DataFrame:
    """(_task, _block, part, rows, bytes) for each block of a table with ``_bytes``, ``_task``, ``_at``.

    Blocks follow each other through the tasks. A part is the blocks that start within
    its share of all bytes, and one block may reach over its end.
    """
    block = F.floor(F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) / block_rows).alias("_block")
    blocks = sized.groupBy("_task", block).agg(
        F.sum("_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    in_task = Window.partitionBy("_task").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # A row per task.
    tasks = blocks.groupBy("_task").agg(F.sum("bytes").alias("all"), F.max("bytes").alias("most"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = tasks.select("_task", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"))
    most = tasks.agg(F.max("most").alias("most"))
    start = F.col("before") + F.coalesce(F.sum("bytes").over(in_task), F.lit(0))
    placed = blocks.join(before, "_task").withColumn("start", start).crossJoin(F.broadcast(most))
    share = F.lit(max_bytes - header) - F.col("most")
    return placed.select("_task", "_block", F.floor(F.col("start") / share).cast("int").alias("part"), "rows", "bytes")


def write_parts(frame: DataFrame, path: str, max_bytes: int) -> DataFrame:
    """Write uncompressed CSV with a header over ``path``, in files of at most ``max_bytes``.

    Returns one row for each file: its number, from 0 without gaps, its rows, and
    its bytes without the header. A frame without rows is one file with a header.
    ``ValueError`` if a row does not fit.
    """
    spark, work = frame.sparkSession, work_path(frame.sparkSession, "parts")
    line = F.coalesce(F.to_csv(F.struct(*[F.col(c) for c in frame.columns]), CSV_OPTIONS), F.lit(""))
    sized = frame.withColumn("_bytes", (F.octet_length(line) + 1).cast("bigint"))
    sized = sized.withColumns({"_task": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    try:
        sized.write.parquet(f"{work}/rows")
        sized = spark.read.schema(sized.schema).parquet(f"{work}/rows")
        header, longest = header_bytes(frame), sized.agg(F.max("_bytes")).first()[0]
        block_rows = max(1, max_bytes // (BLOCKS_PER_PART * (longest or 1)))
        if header + 2 * (longest or 0) * block_rows > max_bytes:
            raise ValueError(f"a row of {longest} bytes and a header do not fit parts of {max_bytes}")
        numbered_parts(sized, max_bytes, header, block_rows).write.parquet(f"{work}/blocks")
        placed = spark.read.parquet(f"{work}/blocks")
        count = (placed.agg(F.max("part")).first()[0] or 0) + 1
        block = F.floor(F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) / block_rows)
        rows = sized.withColumn("_block", block).join(placed.select("_task", "_block", "part"), ["_task", "_block"])
        ordered = rows.repartitionById(count, F.col("part")).sortWithinPartitions("_task", "_at")
        (
            ordered.select(frame.columns)
            .write.mode("overwrite")
            .option("header", True)
            .option("compression", "none")
            .options(**CSV_OPTIONS)
            .csv(path)
        )
        found = placed.groupBy("part").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
        return spark.createDataFrame(found.collect(), "part int, rows bigint, bytes bigint")  # a row per file
    finally:
        files.remove(spark, work)
