"""What has landed, and which of it was taken in.

A feed's extract is a file ``<feed>_<stamp>.csv`` or a folder of part files with
that name. An extract that is written again keeps its name, so names alone do
not tell what is new (a stream of file names sees a name once): the ledger holds
each extract's version, a digest of its files' paths, change times and sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.paths import stamp_day
from shelfline.sources import files
from shelfline.sources.local import small_frame

EXTRACT_NAME = r"/((sales|inventory)_([^/]*)\.csv)(?:/[^/]*)?$"

LEDGER_SCHEMA = """name string, feed string, stamp date, changed timestamp, files bigint,
                   bytes bigint, version bigint, path string, sample string"""
TAKEN_SCHEMA = f"{LEDGER_SCHEMA}, status string, generation bigint"


def landed_extracts(spark: SparkSession, landing: str) -> DataFrame:
    """One row per extract in the landing folder, from its listing; files are not read.

    ``stamp`` is NULL where the name has no date. Extracts without a byte have no
    header and have not landed.
    """
    if not files.exists(spark, landing):
        return small_frame(spark, [], LEDGER_SCHEMA)
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(landing)
        .select("path", "length", "modificationTime")
    )
    part = lambda n: F.regexp_extract("path", EXTRACT_NAME, n)
    named = listing.select(
        "*", part(1).alias("name"), part(2).alias("feed"), part(3).alias("stamp_text")
    ).where("name != ''")
    end = F.instr("path", F.concat(F.lit("/"), F.col("name"))) + F.length("name")
    version = F.xxhash64("path", "modificationTime", "length").bitwiseAND(F.lit((1 << 40) - 1))
    return (
        named.withColumn("extract", F.substring("path", F.lit(1), end))
        .groupBy("name", "feed", "stamp_text", F.col("extract").alias("path"))
        .agg(
            F.max("modificationTime").alias("changed"),
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.sum(version).alias("version"),
            F.min(F.when(F.col("length") > 0, F.col("path"))).alias("sample"),
        )
        .where("bytes > 0")
        .withColumn("stamp", stamp_day(F.col("stamp_text")))
        .select("name", "feed", "stamp", "changed", "files", "bytes", "version", "path", "sample")
    )


def not_taken(landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """The extracts, or versions of extracts, that the ledger does not have.

    ``again`` tells whether it has another version.
    """
    known = ledger.select("name", F.col("version").alias("known"))
    return (
        landed.join(known, "name", "left")
        .where(~F.col("known").eqNullSafe(F.col("version")))
        .select(*landed.columns, F.col("known").isNotNull().alias("again"))
    )


def with_taken(ledger: DataFrame, taken: DataFrame) -> DataFrame:
    """The ledger with the newest version of every extract."""
    return ledger.join(taken.select("name"), "name", "left_anti").select(taken.columns).unionAll(taken)
