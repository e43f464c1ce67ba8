"""Shared folders for intermediate tables, and the given tables."""

from __future__ import annotations

import atexit
from collections.abc import Callable
from functools import wraps
from uuid import uuid4

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Folders of this driver's applications, removed when it ends.
_OWN: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, below the warehouse.

    All folders of an application lie in one, which is removed when its driver ends: until then a
    result may be read from them at any time.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    own = f"{base.rstrip('/')}/llm-{spark.sparkContext.applicationId}"
    if own not in _OWN:
        _OWN.add(own)
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        atexit.register(remove, path, spark._jsc.hadoopConfiguration())
    return f"{own}/{uuid4().hex}"


def remove(path, conf) -> None:
    """Delete a folder; nothing is left to do where the JVM has gone already."""
    try:
        path.getFileSystem(conf).delete(path, True)
    except (Py4JError, OSError):
        pass


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """The frame written to a shared folder and read again: later work starts from the files."""
    path = path or shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def neutral(docs: DataFrame) -> DataFrame:
    """The documents with names for all columns but doc_id and text that no operator uses."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"_column{i}" for i, c in enumerate(docs.columns)])


def keeps_columns(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The operator, which returns the columns of its documents, whatever the others are called."""

    @wraps(operator)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        return operator(neutral(docs), *args, **options).toDF(*docs.columns)

    return run


def one_of_each(keyed: DataFrame, rank: Column) -> DataFrame:
    """Of the rows with one `_key`, the one with the greatest rank (of equal ones the greatest hash of the text).

    Rows are combined before the shuffle, so a row that is there very often moves once from each task.
    """
    whole = F.struct(*[F.col(c) for c in keyed.columns if c != "_key"])
    best = F.max_by(whole, F.struct(rank, F.xxhash64("text"))).alias("_best")
    return keyed.groupBy("_key").agg(best).select("_key", "_best.*")


def numbered(rows: DataFrame, key: str, order: list[Column], parts: int | None = None) -> DataFrame:
    """The rows with `pos`, their number from 0 within the key, in the given order.

    Rows are dealt by range of key and order (equal rows at random), so a hot key is spread over
    tasks; its number is then the place in the task's stretch after the rows of earlier stretches.
    """
    ranged = [F.col(key), *order, F.col("_salt")]
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    dealt = salted.repartitionByRange(parts, *ranged).sortWithinPartitions(*ranged).drop("_salt")
    dealt = stored(dealt.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    stretches = dealt.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task at most
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    stretches = stretches.select(key, "_part", shift.alias("_shift"))
    return dealt.join(stretches, [key, "_part"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def pieces(rows: int, each: int) -> int:
    """How many parts of about `each` rows there are; 1 at least."""
    return max(1, -(-rows // each))


def held_out(doc_id: str = "doc_id", folds: int = 5, fold: int = 0):
    """Whether labels of the row are never learned from; null ids are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(True))
