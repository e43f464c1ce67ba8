"""Runs told as feeds arrive: when the last feed of a day lands, or its deadline passes.

A stream of arrivals is grouped by the day the feeds are stamped with. The state
of a day holds the path of each of its feeds; the arrival that makes it whole
emits the run with its manifest, and a day that is not whole when event time
passes its deadline emits what is missing. A run may still follow a miss. The days
of which runs are expected are known from ticks, so one on which nothing arrives
is missed too, and feeds of other days wait for their tick.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from datetime import date, datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfline.functions.paths import stamp_day
from shelfline.schemas import FEEDS
from shelfline.sources import files
from shelfline.sources.local import small_frame

EVENT_SCHEMA = "feed_date date, table_name string, path string, arrived timestamp"
OUTCOME_SCHEMA = "run_date date, outcome string, table_name string, detail string"
STATE_SCHEMA = "paths array<string>, expected boolean, ready boolean, missed boolean"

# A day's feeds are due at this hour of the day after it (UTC), when the run is to start.
DUE_HOUR = 2
# Arrivals may be seen that much out of order.
WATERMARK = "1 hour"

FEED_FILE = rf"/(({'|'.join(FEEDS)})_([^/]*)\.csv)(?:/[^/]*)?$"


def due(day: date) -> datetime:
    return datetime(day.year, day.month, day.day, DUE_HOUR, tzinfo=timezone.utc) + timedelta(days=1)


def runs(events: DataFrame, prefix: str = "", tables: Sequence[str] = FEEDS) -> DataFrame:
    """One row for each run that is ready, and for each feed that is missing when it is due.

    ``events`` is a stream of :data:`EVENT_SCHEMA`: an arrival; a tick (without a
    table), which says that a day is expected; or the time alone (without a day).
    ``outcome`` is ``ready`` with the manifest in ``detail``, or ``missing`` with the path.
    """
    order = sorted(tables)

    def tell(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (day,) = key
        if day is None or pd.isna(day):
            return
        out = []
        paths, expected, ready, missed = state.get if state.exists else ([None] * len(order), False, False, False)
        paths = list(paths)
        if not state.hasTimedOut:
            for batch in batches:
                expected = expected or bool(batch["table_name"].isna().any())
                for table, path in batch[["table_name", "path"]].drop_duplicates("table_name").itertuples(index=False):
                    if table in order:
                        paths[order.index(table)] = paths[order.index(table)] or path
        if expected and not ready and all(paths):
            ready = True
            out.append(("ready", None, json.dumps(dict(zip(order, paths)), separators=(",", ":"))))
        deadline, now = int(due(day).timestamp() * 1000), state.getCurrentWatermarkMs()
        if expected and not ready and not missed and (state.hasTimedOut or deadline <= now):
            missed = True
            lacking = [t for t, path in zip(order, paths) if not path]
            out += [("missing", t, f"{prefix}{t}_{day:%Y-%m-%d}.csv") for t in lacking]
        state.update((paths, expected, ready, missed))
        if expected and not ready and not missed:
            state.setTimeoutTimestamp(deadline)
        run_date = day + timedelta(days=1)
        yield pd.DataFrame([(run_date, *row) for row in out], columns=["run_date", "outcome", "table_name", "detail"])

    return (
        events.withWatermark("arrived", WATERMARK)
        .groupBy("feed_date")
        .applyInPandasWithState(tell, OUTCOME_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
    )


def landed_events(spark: SparkSession, landing: str) -> DataFrame:
    """A stream of the feeds' files as they appear in the landing folder; files are not read."""
    listing = "path string, modificationTime timestamp, length bigint, content binary"
    names = spark.readStream.format("binaryFile").schema(listing)
    part = lambda n: F.regexp_extract("path", FEED_FILE, n)
    return (
        names.load(f"{landing.rstrip('/')}/*_*.csv")
        .where("length > 0")
        .select(stamp_day(part(3)).alias("feed_date"), part(2).alias("table_name"), part(1).alias("path"), F.col("modificationTime").alias("arrived"))
        .where("feed_date IS NOT NULL")
    )


class Watch:
    """What is to run and what is missing, kept up to date below a root folder."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    def expect(self, days: DataFrame, now: datetime) -> None:
        """Add ticks for the days (a column ``feed_date``), and the time."""
        ticks = days.select("feed_date", *[F.lit(None).cast("string").alias(c) for c in ("table_name", "path")], F.col("feed_date").cast("timestamp").alias("arrived"))
        clock = small_frame(self.spark, [(None, None, None, now)], EVENT_SCHEMA)
        ticks.unionAll(clock).write.mode("append").parquet(f"{self.root}/ticks")

    def follow(self, events: DataFrame) -> None:
        """Take in all arrivals and ticks there are, then stop."""
        ticks = self.spark.readStream.schema(EVENT_SCHEMA).parquet(f"{self.root}/ticks")
        (
            runs(events.unionByName(ticks), self.prefix)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{self.root}/progress")
            .trigger(availableNow=True)
            .start(f"{self.root}/outcomes")
            .awaitTermination()
        )

    def outcomes(self) -> DataFrame:
        if not files.exists(self.spark, f"{self.root}/outcomes"):
            return small_frame(self.spark, [], OUTCOME_SCHEMA)
        return self.spark.read.schema(OUTCOME_SCHEMA).parquet(f"{self.root}/outcomes")
