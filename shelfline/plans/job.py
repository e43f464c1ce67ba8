"""The daily job: five feeds in, four published tables out."""

from __future__ import annotations

import uuid
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.calendar import check_calendar
from shelfline.operators.inventory import StockPolicy
from shelfline.plans.weekly import weekly_stock
from shelfline.schemas import FEEDS
from shelfline.sources import files
from shelfline.sources.feeds import read_feed, reject_rows, scan_feed, typed_with_rejects
from shelfline.sources.manifest import JobPaths
from shelfline.sources.sinks import WEEK_PARTITION, publish, stamp, write_table
from shelfline.sources.together import together
from shelfline.sources.workspace import work_path

# Input bytes per shuffle partition, and the most shuffle partitions and scan tasks.
# Every scan task writes a block for every shuffle partition: at 100 TB these bounds
# mean 2 GB scans and blocks of some ten kilobytes, instead of ten times as many
# blocks of a tenth. AQE puts partitions together that turn out small.
SHUFFLE_PARTITION_BYTES = 1024**3
MAX_SHUFFLE_PARTITIONS = 40_000
SCAN_TASK_BYTES = 128 * 1024**2
MAX_SCAN_TASKS = 50_000

# Largest partition of a join's smaller side that may be held as a hash table.
HASH_JOIN_SETTING = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
HASH_JOIN_BYTES = "128m"

SALES_NEEDED = [
    "TRANS_DT",
    "STORE_KEY",
    "PROD_KEY",
    "SALES_QTY",
    "SALES_AMT",
    "SALES_COST",
    "SHIP_COST",
]

# Files of the rejects, at most.
REJECT_FILES = 64

INVENTORY_NEEDED = [
    "CAL_DT",
    "STORE_KEY",
    "PROD_KEY",
    "INVENTORY_ON_HAND_QTY",
    "INVENTORY_ON_ORDER_QTY",
    "OUT_OF_STOCK_FLG",
]


def run_job(
    spark: SparkSession,
    paths: JobPaths,
    as_of: date,
    policy: StockPolicy = "last_snapshot",
    load_tmst: datetime | None = None,
    infer: bool = False,
    calendar_type: str | None = None,
    rejects: str | None = None,
) -> None:
    """Scan the feeds and write the weekly table and the stamped dimensions.

    The calendar and ``as_of`` are checked before any output is written. With
    ``rejects`` every feed is parsed once, into a table of typed rows, and the values
    that do not fit are written to that path, with their file and row.
    """
    if rejects is not None:
        if infer:
            raise ValueError("types that are inferred reject nothing")
        _run_staged(spark, paths, as_of, policy, load_tmst, calendar_type, rejects)
        return
    feeds = {t: scan_feed(spark, t, paths.inputs[t], infer) for t in FEEDS}
    checked = check_calendar(feeds["calendar"], as_of, calendar_type)
    needed = checked.days_to_now.within(feeds["inventory"].select(INVENTORY_NEEDED), "CAL_DT")
    name = f"shelfline_{uuid.uuid4().hex}"
    try:
        # The weekly job reads inventory twice, and the second parse of the CSV costs more
        # than this one write.
        needed.write.saveAsTable(name)
        weekly = weekly_stock(
            feeds["sales"], spark.table(name), feeds["calendar"], as_of, policy, checked
        )
        _write_outputs(paths, weekly, feeds, load_tmst)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _run_staged(
    spark: SparkSession,
    paths: JobPaths,
    as_of: date,
    policy: StockPolicy,
    load_tmst: datetime | None,
    calendar_type: str | None,
    rejects: str,
) -> None:
    work = work_path(spark, "feeds")
    try:
        staged = stage_feeds(spark, paths, work)
        feeds = {t: frame.drop("_reject") for t, frame in staged.items()}
        checked = check_calendar(feeds["calendar"], as_of, calendar_type)
        weekly = weekly_stock(
            feeds["sales"], feeds["inventory"], feeds["calendar"], as_of, policy, checked
        )
        bad = reduce(DataFrame.unionAll, [reject_rows(t, frame) for t, frame in staged.items()])
        bad.coalesce(REJECT_FILES).write.mode("overwrite").parquet(rejects)
        _write_outputs(paths, weekly, feeds, load_tmst)
    finally:
        files.remove(spark, work)


def stage_feeds(spark: SparkSession, paths: JobPaths, work: str) -> dict[str, DataFrame]:
    """The five feeds parsed once each, with their rejects, as tables below ``work``."""
    needed = {"sales": SALES_NEEDED, "inventory": INVENTORY_NEEDED}

    def stage(feed: str) -> DataFrame:
        rows = typed_with_rejects(read_feed(spark, feed, paths.inputs[feed]), feed, needed.get(feed))
        rows.write.parquet(f"{work}/{feed}")
        return spark.read.schema(rows.schema).parquet(f"{work}/{feed}")

    return dict(zip(FEEDS, together([partial(stage, t) for t in FEEDS]), strict=True))


def _write_outputs(
    paths: JobPaths, weekly: DataFrame, feeds: dict[str, DataFrame], load_tmst: datetime | None
) -> None:
    outputs = [
        (weekly, paths.weekly, WEEK_PARTITION),
        (feeds["calendar"], paths.calendar, None),
        (feeds["store"], paths.store, None),
        (feeds["product"], paths.product, None),
    ]
    together(
        [
            partial(write_table, stamp(frame, load_tmst), path, partition)
            for frame, path, partition in outputs
        ]
    )


def publish_outputs(spark: SparkSession, paths: JobPaths, database: str) -> None:
    """Make the four outputs of a run known to SQL in ``database``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for path in (paths.weekly, paths.calendar, paths.store, paths.product):
        name = f"{database}.{path.rsplit('/', 1)[-1]}"
        publish(spark, name, path, partitioned=path == paths.weekly)


def tune_session(spark: SparkSession, inputs: list[str]) -> None:
    """Suit the session's scans and shuffles to the bytes of the input files.

    Joins may then be hash joins, but only where AQE has seen every partition of
    the smaller side to be small enough; else they sort, which can spill.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(inputs)
    found = listing.agg(F.sum("length").alias("bytes")).first()["bytes"] or 0
    partitions = min(found // SHUFFLE_PARTITION_BYTES + 1, MAX_SHUFFLE_PARTITIONS)
    partitions = max(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))
    scan_bytes = max(found // MAX_SCAN_TASKS, SCAN_TASK_BYTES)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.files.maxPartitionBytes", f"{scan_bytes}b")
    spark.conf.set(HASH_JOIN_SETTING, HASH_JOIN_BYTES)
