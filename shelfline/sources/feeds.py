"""CSV feeds in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.dates import as_day
from shelfline.schemas import DATE_COLUMNS, FEED_TYPES


def read_feed(
    spark: SparkSession,
    feed: str,
    path: str | list[str],
    infer: bool = False,
    like: str | None = None,
    header: list[str] | None = None,
) -> DataFrame:
    """Scan one CSV feed as text, columns named by the file's header.

    ``infer=True`` lets Spark read the data once more to find all types. ``like``
    is one of many files, to read the header from; ``header`` has its names where
    they are known.
    """
    csv = spark.read.option("header", True)
    if infer:
        return csv.option("inferSchema", True).csv(path)
    header = header or csv.csv(like or path).columns
    # A part file with another header is an error, not a silent mix-up of columns.
    text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return csv.option("enforceSchema", False).schema(text).csv(path)


def converted(column: str, kind: T.DataType) -> Column:
    """Text as a value of the type; NULL where it is none, or would lose digits.

    A whole number may be written with decimals (``3.00``). Most values are cast
    straight to the type; how many digits others have is read from the text.
    """
    value = F.col(column)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        # A cast to a whole number takes no decimals at all.
        return F.coalesce(value.try_cast(kind), _exactly(value, 0).try_cast(kind))
    if isinstance(kind, T.DecimalType):
        point = F.instr(value, F.lit("."))
        short = (point == 0) | (F.length(value) - point <= kind.scale)
        plain = short & ~F.contains(value, F.lit("e")) & ~F.contains(value, F.lit("E"))
        return F.when(plain, value.try_cast(kind)).otherwise(_exactly(value, kind.scale).try_cast(kind))
    return value.try_cast(kind)


def _exactly(value: Column, scale: int) -> Column:
    """Text of a number as a decimal with ``scale`` places, NULL if it has more."""
    zeros = rf"^\s*[+-]?(\d+(\.\d{{0,{scale}}}0*)?|\.\d{{0,{scale}}}0*)\s*$"
    number = value.try_cast(f"decimal(38,{scale})")
    # With an exponent; the double tells digits that are too small for the decimal.
    exponent = value.rlike(r"[eE][+-]?\p{Nd}") & (number.cast("double") == value.try_cast("double"))
    return F.when(value.rlike(zeros) | exponent, number)


def _conversions(
    frame: DataFrame, feed: str, types: Mapping[str, T.DataType] | None
) -> dict[str, Column]:
    known = {**FEED_TYPES[feed], **(types or {})}
    dates = {c: as_day(c) for c in DATE_COLUMNS[feed] if c in frame.columns}
    numbers = {
        c: converted(c, t)
        for c, t in known.items()
        if c in frame.columns and c not in dates and not isinstance(t, T.StringType)
    }
    return {**dates, **numbers}


def typed(
    frame: DataFrame, feed: str, types: Mapping[str, T.DataType] | None = None
) -> DataFrame:
    """The feed with its known columns converted; a value that does not fit is NULL.

    ``types`` names further columns to convert.
    """
    return frame.withColumns(_conversions(frame, feed, types))


def fix_dates(frame: DataFrame, feed: str) -> DataFrame:
    """Turn the feed's date columns into dates; text that is no date becomes NULL."""
    return frame.withColumns({c: as_day(c) for c in DATE_COLUMNS[feed]})


def scan_feed(
    spark: SparkSession,
    feed: str,
    path: str | list[str],
    infer: bool = False,
    types: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """Scan one CSV feed with its known columns converted."""
    raw = read_feed(spark, feed, path, infer)
    return fix_dates(raw, feed) if infer else typed(raw, feed, types)


REJECT_SCHEMA = "file string, row_text string, columns array<string>"


def typed_with_rejects(raw: DataFrame, feed: str, needed: Sequence[str] | None = None) -> DataFrame:
    """The feed converted, with ``_reject``: NULL, or what does not fit and where it stands.

    A reject has the file, the row as CSV and the names of the columns whose value is
    there but does not fit. ``needed`` names the columns to keep; all count.
    """
    values, names = _conversions(raw, feed, None), raw.columns
    texts = {c: f"_text_{n}" for n, c in enumerate(names)}
    converted = raw.select(
        *[values.get(c, F.col(f"`{c}`")).alias(c) for c in names],
        *[F.col(f"`{c}`").alias(text) for c, text in texts.items()],
        F.col("_metadata.file_path").alias("_file"),
    )
    lost = {c: F.col(texts[c]).isNotNull() & F.col(f"`{c}`").isNull() for c in values}
    # Text and names are made for rejects only.
    none = F.lit(None).cast("string")
    columns = F.array_except(F.array(*[F.when(bad, F.lit(c)) for c, bad in lost.items()], none), F.array(none))
    text = F.to_csv(F.struct(*[F.col(text).alias(c) for c, text in texts.items()]))
    reject = F.struct(F.col("_file").alias("file"), text.alias("row_text"), columns.alias("columns"))
    kept = [F.col(f"`{c}`") for c in (needed or names)]
    return converted.select(*kept, F.when(reduce(Column.__or__, lost.values(), F.lit(False)), reject).alias("_reject"))


def reject_rows(feed: str, staged: DataFrame) -> DataFrame:
    """One row for each value that does not fit, with its file and row."""
    bad = staged.where(F.col("_reject").isNotNull()).select("_reject.*")
    return bad.select(
        F.lit(feed).alias("table_name"), F.explode("columns").alias("column_name"), "file", "row_text"
    )


def feed_rejects(raw: DataFrame, feed: str) -> DataFrame:
    """How many values of each typed column are there but do not fit its type."""
    return _rejects(raw, feed, _conversions(raw, feed, None))


def date_rejects(raw: DataFrame, feed: str) -> DataFrame:
    """How many values of each date column are there but are no date."""
    return _rejects(raw, feed, {c: as_day(c) for c in DATE_COLUMNS[feed]})


def _rejects(raw: DataFrame, feed: str, values: Mapping[str, Column]) -> DataFrame:
    counts = raw.agg(
        *[F.count_if(F.col(c).isNotNull() & v.isNull()).alias(c) for c, v in values.items()]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("rejects")) for c in values]
    )
    return counts.select(F.lit(feed).alias("table_name"), F.inline(pairs))
