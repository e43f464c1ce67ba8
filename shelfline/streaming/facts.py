"""Sales and inventory rows in generations, and the index of those that count.

Rows lie by generation, feed and span of seven days. The index has a row for each
feed, extract and day: the generation its rows lie in, how many they are, and a
digest of them that does not depend on their order. Rows that no index row names
do not count any more. An extract that holds its feed's whole history has no name
in the index: days that it has in common with the one before keep their rows.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from datetime import date
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.schemas import DATE_COLUMNS, FEED_TYPES
from shelfline.sources import files
from shelfline.sources.feeds import read_feed, typed
from shelfline.sources.together import together
from shelfline.streaming.ledger import EXTRACT_NAME

FACT_FEEDS = ("sales", "inventory")
SPAN_DAYS = 7
HEADERS_AT_ONCE = 16

_EPOCH = date(1970, 1, 4)  # a Sunday
_VALUES = [
    T.StructField(c, T.DateType() if c in DATE_COLUMNS[feed] else t)
    for feed in FACT_FEEDS
    for c, t in FEED_TYPES[feed].items()
    if feed == "sales" or c not in FEED_TYPES["sales"]
]
FACT_SCHEMA = T.StructType(
    _VALUES
    + [T.StructField("extract", T.StringType()), T.StructField("day", T.DateType())]
    + [T.StructField("generation", T.LongType()), T.StructField("feed", T.StringType())]
    + [T.StructField("span", T.IntegerType())]
)
INDEX_SCHEMA = """feed string, extract string, day date, generation bigint, rows bigint,
                  digest_a bigint, digest_b bigint"""
ENTRY = ["feed", "extract", "day"]
DIGEST = ["rows", "digest_a", "digest_b"]
INDEX_COLUMNS = [*ENTRY, "generation", *DIGEST]


def span_of(day: Column) -> Column:
    return F.floor(F.date_diff(day, F.lit(_EPOCH)) / SPAN_DAYS).cast("int")


def read_extracts(spark: SparkSession, extracts: Sequence[Row], named: bool) -> DataFrame:
    """The extracts' dated rows, with one scan for each feed and header.

    A row's extract comes from the scan's file path. Columns are found by the
    header; those this package does not know are left out. Without ``named`` the
    extract is empty. Rows without a date are in no week and left out.
    """
    found = []
    for first in range(0, len(extracts), HEADERS_AT_ONCE):
        some = extracts[first : first + HEADERS_AT_ONCE]
        found += together([partial(files.first_line, spark, e["sample"]) for e in some])
    groups = defaultdict(list)
    for extract, header in zip(extracts, found, strict=True):
        groups[extract["feed"], header].append(extract)
    scans = [_scan(spark, *key, own, named) for key, own in sorted(groups.items(), key=repr)]
    return reduce(DataFrame.unionAll, scans)


def _names(header: str | None) -> list[str] | None:
    """Column names of a plain header line; None where Spark has to give names of its own."""
    names = next(csv.reader([(header or "").removeprefix("\ufeff")]), [])
    plain = all(names) and len({n.lower() for n in names}) == len(names) > 0
    return names if plain and "\\" not in header else None


def _scan(
    spark: SparkSession, feed: str, header: str | None, extracts: Sequence[Row], named: bool
) -> DataFrame:
    like = extracts[0]["sample"]
    raw = read_feed(spark, feed, [e["path"] for e in extracts], like=like, header=_names(header))
    source = F.regexp_extract("_metadata.file_path", EXTRACT_NAME, 1)
    if not named or len(extracts) == 1:
        source = F.lit(extracts[0]["name"] if named else "")
    frame = typed(raw.select("*", source.alias("_extract")), feed)
    day = F.col(DATE_COLUMNS[feed][0])
    given = {"extract": F.col("_extract"), "day": day, "feed": F.lit(feed), "span": span_of(day)}
    known = {c: F.col(c) for c in FEED_TYPES[feed] if c in frame.columns}
    columns = {**known, **given}
    return frame.where(day.isNotNull()).select(
        [
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in FACT_SCHEMA.fields
            if f.name != "generation"
        ]
    )


def digests(rows: DataFrame) -> DataFrame:
    """An index row without generation for each feed, extract and day.

    Of a row's 64-bit hash two parts of 28 bits are summed, which a bigint holds for
    more than 30 billion rows of a day.
    """
    bits = F.lit((1 << 28) - 1)
    # A date keeps its place among the values of both feeds, so all columns count.
    whole = F.xxhash64(*[F.col(f.name) for f in _VALUES], "feed")
    return (
        rows.select(*ENTRY, whole.alias("whole"))
        .groupBy(ENTRY)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("whole").bitwiseAND(bits)).alias("digest_a"),
            F.sum(F.shiftrightunsigned("whole", 32).bitwiseAND(bits)).alias("digest_b"),
        )
    )


def entries_of(rows: DataFrame) -> DataFrame:
    """The same without digests, for extracts that are not compared."""
    none = F.lit(None).cast("bigint")
    counted = rows.groupBy(ENTRY).agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumns({"digest_a": none, "digest_b": none})


def changed_days(fresh: DataFrame, known: DataFrame) -> DataFrame:
    """Entries whose rows differ between two indexes, or that only one of them has."""
    now, before = fresh.select(*ENTRY, *DIGEST), known.select(*ENTRY, *DIGEST)
    both = now.alias("a").join(before.alias("b"), ENTRY, "full_outer")
    differs = [~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in DIGEST]
    return both.where(reduce(Column.__or__, differs)).select(
        *ENTRY, F.col("a.rows").isNotNull().alias("there")
    )


def generation_path(root: str, generation: int) -> str:
    return f"{root}/facts/generation={generation}"


def write_generation(rows: DataFrame, root: str, generation: int) -> None:
    """Write rows by feed and span, each feed with its own columns only.

    So no row is shuffled and sorted with the columns of the other feed, and the sort is
    by one number.
    """

    def write(feed: str) -> None:
        own = rows.where(F.col("feed") == feed).select(*FEED_TYPES[feed], "extract", "day", "span")
        writer = own.hint("rebalance", "span").write.mode("overwrite")
        writer.partitionBy("span").parquet(f"{generation_path(root, generation)}/feed={feed}")

    together([partial(write, feed) for feed in FACT_FEEDS])


def read_generation(spark: SparkSession, root: str, generation: int) -> DataFrame:
    path = generation_path(root, generation)
    return spark.read.schema(FACT_SCHEMA).option("basePath", f"{root}/facts").parquet(path)
