"""Dated CSV extracts out, with row counts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.dates import day_lit
from shelfline.functions.size import csv_bytes
from shelfline.sources import files
from shelfline.sources.parts import CSV_OPTIONS, write_parts
from shelfline.sources.together import together

# Fixed value: most bytes the five single-file extracts of the feeds' readers may have
# each; a caller who wants the limit passes it on.
SINGLE_FILE_BYTES = 107_772_160

# The date column of the tables that are cut off at the extract day. The
# calendar is not: it keeps its future dates.
CUTOFF_COLUMNS = {"inventory": "CAL_DT", "sales": "TRANS_DT"}

# Fixed value: order of the reported row counts.
EXTRACT_ORDER = ("inventory", "sales", "store", "product", "calendar")


def extract(frame: DataFrame, table: str, as_of: date) -> DataFrame:
    """The rows of a table that belong into the extract of ``as_of``."""
    cutoff = CUTOFF_COLUMNS.get(table)
    return frame if cutoff is None else frame.where(F.col(cutoff) <= day_lit(as_of))


def one_file(frame: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """The frame in a single partition.

    With ``max_bytes`` its size as CSV text is summed over all tasks first;
    ``ValueError`` if it is over.
    """
    if max_bytes is not None and (size := csv_bytes(frame)) > max_bytes:
        raise ValueError(f"{size} bytes do not fit a single file of {max_bytes}")
    return frame.repartition(1)


def write_csv(
    frame: DataFrame,
    path: str,
    single_file: bool = False,
    max_rows_per_file: int = 0,
    max_bytes: int | None = None,
    header: bool = True,
) -> int:
    """Write uncompressed CSV with a header over ``path``; returns the rows written.

    The rows are counted by the writing tasks themselves, not by a second scan.
    ``max_rows_per_file`` cuts large part files; 0 sets no limit. ``max_bytes``
    refuses a single file that would be larger, which computes the frame twice.
    """
    if single_file:
        frame = one_file(frame, max_bytes)
    written = Observation()
    (
        frame.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("header", header)
        .option("compression", "none")
        .options(**CSV_OPTIONS)
        .option("maxRecordsPerFile", max_rows_per_file)
        .csv(path)
    )
    return written.get["rows"]


def write_object(frame: DataFrame, path: str, max_bytes: int | None = None) -> int:
    """Write one plain CSV file with a header at ``path``, over what is there; returns its rows.

    Every task writes its own rows aside and the file is made of these parts, where the
    store can do that (:func:`shelfline.sources.files.can_join`); else one task writes it.
    The file is then moved, so ``path`` holds the old or the new one; a call after a failure
    leaves one file. With ``max_bytes`` a larger file is not moved: ``ValueError``.
    """
    spark, (folder, name) = frame.sparkSession, path.rsplit("/", 1)
    aside = f"{folder}/_{name}-{uuid.uuid4().hex}"
    parted = files.can_join(spark, aside)
    try:
        rows = write_csv(frame, f"{aside}/rows", single_file=not parted, header=not parted)
        if parted:
            write_csv(frame.limit(0), f"{aside}/header")
        parts = [p for kind in ("header", "rows") for p in files.sizes(spark, f"{aside}/{kind}") if p[1] > 0]
        size = sum(length for _, length in parts)
        if max_bytes is not None and size > max_bytes:
            raise ValueError(f"{size} bytes do not fit a single file of {max_bytes}")
        whole = files.join(spark, parts, f"{aside}/rows/whole") if parted else parts[0][0]
        if files.exists(spark, path) and not files.is_file(spark, path):
            files.remove(spark, path)  # an extract in part files
        files.move(spark, whole, path, overwrite=True)
        return rows
    finally:
        files.remove(spark, aside)


def extract_path(root: str, table: str, as_of: date) -> str:
    return f"{root.rstrip('/')}/{table}_{as_of:%Y-%m-%d}.csv"


def extract_feeds(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    as_of: date,
    single_file: bool = False,
    max_bytes: int | None = None,
) -> DataFrame:
    """Write all five extracts of a day; returns ``(table_name, rows_unloaded)``.

    With ``single_file`` each is one plain file, refused if it has more than
    ``max_bytes``; else each is a folder of part files, none of which has more.
    """

    def unload(table: str) -> int:
        rows, path = extract(tables[table], table, as_of), extract_path(root, table, as_of)
        if single_file:
            return write_object(rows, path, max_bytes)
        if max_bytes is not None:
            return sum(part["rows"] for part in write_parts(rows, path, max_bytes).collect())
        return write_csv(rows, path)

    counts = together([partial(unload, t) for t in EXTRACT_ORDER])
    return spark.createDataFrame(
        list(zip(EXTRACT_ORDER, counts, strict=True)), "table_name string, rows_unloaded bigint"
    )
