"""The landing folder as an arrival log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arrival_log(spark: SparkSession, root: str) -> DataFrame:
    """Feeds lying below ``root``: path below the root, bytes, newest change.

    Reads the file listing, not the files. A feed may be one file or a folder
    of part files. A file without a byte has no header, so it has not arrived.
    """
    root = root.rstrip("/")
    # The listing's paths have a scheme; the root may go without.
    bare = "/" + root.split("://", 1)[-1].split(":", 1)[-1].strip("/") + "/"
    rest = F.expr(f"substring(path, instr(path, '{bare}') + {len(bare)})")
    below = F.regexp_extract(rest, r"^(.*?\.csv)(/[^/]*)?$", 1)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(root)
        .select(below.alias("path"), "length", "modificationTime")
        .groupBy("path")
        .agg(F.sum("length").alias("bytes"), F.max("modificationTime").alias("arrived"))
    )
