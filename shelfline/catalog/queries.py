"""Every operator as a query over the given tables.

Each takes a session and the folder of the given Parquet tables, and returns a
frame whose columns are named as in :mod:`shelfline.catalog.oracle`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.catalog import tables
from shelfline.catalog.tables import AS_OF, LANDING
from shelfline.functions.dates import day_lit, feed_day
from shelfline.functions.paths import feed_table_name
from shelfline.operators import completeness, inventory, sales
from shelfline.operators.calendar import (
    CheckedCalendar,
    check_calendar,
    current_week,
    with_calendar,
)
from shelfline.plans import weekly
from shelfline.plans.job import publish_outputs, run_job
from shelfline.schemas import DATE_COLUMNS, FEEDS
from shelfline.sources import extract, feeds, manifest, sinks
from shelfline.sources.manifest import JobPaths
from shelfline.sources.together import together
from shelfline.sources.workspace import work_path
from shelfline.streaming.arrivals import EVENT_SCHEMA, Watch
from shelfline.streaming.ingest import WeeklyStore

Query = Callable[[SparkSession, str], DataFrame]

LOAD_TMST = datetime(2023, 6, 1, 2, 0)
SECOND_LANDING = date(2023, 5, 1)
UNPADDED_DAY = date(2023, 5, 9)
INPUT_ROOT = "in/"
OUTPUT_ROOT = "out/analysis/"
PART_BYTES = 100_000
DIMENSION_TYPES = {
    "store": {"NATION_KEY": T.IntegerType(), "STORE_BALANCE": T.DoubleType()},
    "product": {"SIZE_NUM": T.IntegerType(), "LIST_PRICE": T.DoubleType()},
}


def _calendar(spark: SparkSession, sf_dir: str) -> CheckedCalendar:
    return check_calendar(tables.calendar(spark, sf_dir))


def _plain_money(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, the type in which the published tables hold money."""
    decimals = [name for name, kind in frame.dtypes if kind.startswith("decimal")]
    return frame.withColumns({c: F.col(c).cast("double") for c in decimals})


# Sources


def _scan(feed: str) -> Query:
    """Write the whole table as a CSV feed and scan it back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = work_path(spark, f"{feed}.csv")
        extract.write_csv(tables.as_feed(spark, sf_dir, feed), path)
        return _plain_money(feeds.scan_feed(spark, feed, path, types=DIMENSION_TYPES.get(feed)))

    return query


def feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "inventory.csv")
    extract.write_csv(tables.as_feed(spark, sf_dir, "inventory"), path)
    return feeds.feed_rejects(feeds.read_feed(spark, "inventory", path), "inventory")


def date_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "inventory.csv")
    extract.write_csv(tables.as_feed(spark, sf_dir, "inventory"), path)
    return feeds.date_rejects(feeds.read_feed(spark, "inventory", path), "inventory")


def ready_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completeness.ready_runs(
        expected_feeds(spark, sf_dir), tables.arrivals(spark, sf_dir)
    )


def manifest_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest_paths(ready_runs(spark, sf_dir), INPUT_ROOT)


def feed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = tables.arrivals(spark, sf_dir)
    return arrivals.select("path", feed_table_name(F.col("path")).alias("table_name"))


# Extracts


def _extract(table: str) -> Query:
    """Write the day's extract of a table and read it back, dates fixed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = extract.extract(tables.TABLES[table](spark, sf_dir), table, AS_OF)
        path = extract.extract_path(work_path(spark, "extract"), table, AS_OF)
        extract.write_csv(frame, path)
        return _plain_money(feeds.scan_feed(spark, table, path, types=DIMENSION_TYPES.get(table)))

    return query


def extract_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {t: read(spark, sf_dir) for t, read in tables.TABLES.items()}
    return extract.extract_feeds(spark, frames, work_path(spark, "extract"), AS_OF)


def extract_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory extract in parts of bounded size; what the files hold and how they are numbered."""
    path = work_path(spark, "inventory.csv")
    parts = extract.write_parts(tables.inventory(spark, sf_dir), path, PART_BYTES)
    rows = feeds.read_feed(spark, "inventory", path).select("*", "_metadata.file_name", "_metadata.file_size")
    number = F.regexp_extract("file_name", r"^part-(\d+)-", 1).cast("int")
    found = rows.groupBy(number.alias("part")).agg(F.count(F.lit(1)).alias("read"), F.max("file_size").alias("size"))
    return parts.join(found, "part", "full_outer").agg(
        F.sum("read").alias("rows_read"),
        F.sum("bytes").alias("bytes"),
        F.count_if(F.coalesce(F.col("size") > PART_BYTES, F.lit(True))).alias("too_large"),
        F.count_if(~F.col("rows").eqNullSafe(F.col("read"))).alias("miscounted"),
        (F.max("part") + 1 - F.count("part")).alias("numbers_lacking"),
        (F.count("part") > F.floor(F.sum("bytes") / PART_BYTES)).alias("enough"),
    )


def extract_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five extracts, each one plain file, over extracts in part files of the same name."""
    frames, root = {t: read(spark, sf_dir) for t, read in tables.TABLES.items()}, work_path(spark, "extract")
    extract.extract_feeds(spark, {**frames, "store": frames["store"].limit(0)}, root, AS_OF)
    unloaded = extract.extract_feeds(spark, frames, root, AS_OF, single_file=True)
    lying = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    lying = lying.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")
    named = lying.withColumn("table_name", feed_table_name(F.col("file_name")))
    return named.join(unloaded, "table_name", "full_outer").select(
        "table_name", "file_name", "rows_unloaded", (F.col("length") > 0).alias("has_header")
    )


# Sales


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.daily_sales(tables.sales(spark, sf_dir))


def sales_calendar_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _calendar(spark, sf_dir).full
    return with_calendar(daily_sales(spark, sf_dir), "TRANS_DT", days, "left")


def weekly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.weekly_sales(tables.sales(spark, sf_dir), _calendar(spark, sf_dir).days)


def weekly_sales_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.weekly_sales(tables.sales(spark, sf_dir), _calendar(spark, sf_dir).days, "left")


# Inventory


def _on_inventory(operator: Callable[..., DataFrame], **options: str | date) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        days = _calendar(spark, sf_dir).days
        return operator(tables.inventory(spark, sf_dir), days, **options)

    return query


def inventory_calendar_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _calendar(spark, sf_dir).full
    return with_calendar(tables.inventory(spark, sf_dir), "CAL_DT", days, "left")


# Weekly table


def weekly_sales_no_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _calendar(spark, sf_dir).days
    return weekly.sales_and_stock_outs(
        sales.dated_sales(tables.sales(spark, sf_dir), days),
        inventory.dated_inventory(tables.inventory(spark, sf_dir), days),
    ).drop("max_day_of_week")


def weekly_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly table of all weeks."""
    days = _calendar(spark, sf_dir).days
    return weekly.weekly_table(
        sales.dated_sales(tables.sales(spark, sf_dir), days),
        inventory.dated_inventory(tables.inventory(spark, sf_dir), days),
    )


def _weekly_stock(policy: inventory.StockPolicy) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return weekly.weekly_stock(
            tables.sales(spark, sf_dir),
            tables.inventory(spark, sf_dir),
            tables.calendar(spark, sf_dir),
            AS_OF,
            policy,
        )

    return query


def week_of_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_week(tables.calendar(spark, sf_dir), AS_OF)


# Published tables


def _dimension(table: str) -> Query:
    """Stamp a dimension, write it, read it back; the stamp itself is not compared."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = work_path(spark, f"{table}_table")
        sinks.write_table(sinks.stamp(tables.TABLES[table](spark, sf_dir), LOAD_TMST), path)
        return spark.read.parquet(path).drop("load_tmst")

    return query


def load_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stamps of the dimensions: a given one, and the time of the query."""

    def stamped(table: str) -> DataFrame:
        path = work_path(spark, f"{table}_table")
        frame = tables.TABLES[table](spark, sf_dir)
        sinks.write_table(sinks.stamp(frame, LOAD_TMST), path)
        now = sinks.stamp(spark.read.parquet(path).withColumnRenamed("load_tmst", "given"))
        return now.groupBy("given", (F.col("load_tmst") == F.current_timestamp()).alias("is_now")).agg(
            F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("rows")
        )

    every = reduce(DataFrame.unionAll, [stamped(t) for t in ("calendar", "store", "product")])
    return every.withColumn("given", F.date_format("given", "yyyy-MM-dd HH:mm:ss"))


def output_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.output_paths(ready_runs(spark, sf_dir), OUTPUT_ROOT)


def published_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from CSV feeds to published tables, then SQL over them."""
    root = work_path(spark, "job/")
    together(
        [
            partial(
                extract.write_csv,
                tables.as_feed(spark, sf_dir, feed),
                extract.extract_path(root, feed, AS_OF),
            )
            for feed in FEEDS
        ]
    )
    argument = ", ".join(f'"{t}": "{t}_{AS_OF:%Y-%m-%d}.csv"' for t in FEEDS)
    paths = JobPaths.from_json("{" + argument + "}", root, root + "analysis/")
    run_job(spark, paths, AS_OF, load_tmst=LOAD_TMST)
    database = f"shelfline_{uuid.uuid4().hex}"
    publish_outputs(spark, paths, database)
    return spark.sql(
        f"""
        SELECT w.STORE_KEY, s.STORE_DESC,
               count(*) AS weekly_rows,
               CAST(sum(w.total_sales_qty) AS BIGINT) AS sales_qty,
               sum(w.Low_Stock_flg) AS low_stock_rows,
               sum(w.No_Stock_Instances) AS stock_outs,
               count(DISTINCT w.YR_WK_NUM) AS weeks,
               count(DISTINCT p.BRAND_DESC) AS brands,
               max(c.days) AS most_days
        FROM {database}.weekly_agg_table w
        JOIN {database}.store_table s ON s.STORE_KEY = w.STORE_KEY
        JOIN {database}.prod_table p ON p.PROD_KEY = w.PROD_KEY
        JOIN (SELECT YR_WK_NUM, count(*) AS days FROM {database}.calendar_table
              GROUP BY YR_WK_NUM) c ON c.YR_WK_NUM = w.YR_WK_NUM
        GROUP BY w.STORE_KEY, s.STORE_DESC
        """
    )


def feed_reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that the whole job sets aside from its own scan of the feeds, with their rows."""
    root = work_path(spark, "job/")
    together(
        [
            partial(
                extract.write_csv,
                tables.as_feed(spark, sf_dir, feed),
                extract.extract_path(root, feed, AS_OF),
            )
            for feed in FEEDS
        ]
    )
    argument = json.dumps({t: f"{t}_{AS_OF:%Y-%m-%d}.csv" for t in FEEDS})
    paths = JobPaths.from_json(argument, root, root + "analysis/")
    run_job(spark, paths, AS_OF, load_tmst=LOAD_TMST, rejects=f"{root}rejects")
    rows = spark.read.parquet(f"{root}rejects")
    feed_file = F.regexp_extract("file", r"/([a-z]+_[0-9-]+\.csv)/[^/]*$", 1)
    return rows.withColumn("file", feed_file)


# Completeness


def expected_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completeness.expected_feeds(tables.run_dates(spark, sf_dir), LANDING)


def missing_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completeness.missing_feeds(
        expected_feeds(spark, sf_dir), tables.arrivals(spark, sf_dir)
    )


def _dropped(report: Callable[..., DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        days = _calendar(spark, sf_dir).days
        return report(tables.sales(spark, sf_dir), tables.inventory(spark, sf_dir), days)

    return query


# Incremental


def ingest_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the facts as CSV in two goes, ingest after each; equals the batch job."""
    landing, root = work_path(spark, "landing"), work_path(spark, "store")
    store = WeeklyStore(spark, root, tables.calendar(spark, sf_dir))
    facts = {f: tables.as_feed(spark, sf_dir, f) for f in ("sales", "inventory")}
    first_days = {f: F.col(DATE_COLUMNS[f][0]) < day_lit(SECOND_LANDING) for f in facts}
    for stamp, late in (("2023-05-30", False), ("2023-05-31", True)):
        parts = {f: rows.where(first_days[f] != F.lit(late)) for f, rows in facts.items()}
        together(
            [
                partial(extract.write_csv, part, f"{landing}/{f}_{stamp}.csv")
                for f, part in parts.items()
            ]
        )
        store.ingest(landing)
    return store.weekly(AS_OF)


def ingest_daily_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days' extracts, each with the whole history so far, ingested after each."""
    landing, root = work_path(spark, "landing"), work_path(spark, "store")
    frames = {t: read(spark, sf_dir) for t, read in tables.TABLES.items()}
    store = WeeklyStore(spark, root, frames["calendar"], cumulative=True)
    for day in (SECOND_LANDING, AS_OF):
        extract.extract_feeds(spark, frames, landing, day)
        store.ingest(landing)
    return store.weekly(AS_OF)


def ingest_reextracted_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's extracts with wrong stock and sales, ingested, written again, ingested again."""
    landing, root = work_path(spark, "landing"), work_path(spark, "store")
    frames = {t: read(spark, sf_dir) for t, read in tables.TABLES.items()}
    wrong = {
        **frames,
        "sales": frames["sales"].withColumn("SALES_QTY", F.col("SALES_QTY") + 1),
        "inventory": frames["inventory"].where(F.col("STORE_KEY") % 2 == 0),
    }
    store = WeeklyStore(spark, root, frames["calendar"], cumulative=True)
    for landed in (wrong, frames):
        extract.extract_feeds(spark, landed, landing, AS_OF)
        store.ingest(landing)
    return store.weekly(AS_OF)


def ingest_unpadded_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts named with single digits; by their text the older ones would come last."""
    landing, root = work_path(spark, "landing"), work_path(spark, "store")
    frames = {t: tables.TABLES[t](spark, sf_dir) for t in ("sales", "inventory")}
    for day in (AS_OF, UNPADDED_DAY):
        named = f"{day.year}-{day:%m}-{day.day}"
        together(
            [
                partial(extract.write_csv, extract.extract(rows, t, day), f"{landing}/{t}_{named}.csv")
                for t, rows in frames.items()
            ]
        )
    store = WeeklyStore(spark, root, tables.calendar(spark, sf_dir), cumulative=True)
    store.ingest(landing, max_files_per_batch=2)
    return store.weekly(AS_OF)


def ingest_calendar_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All facts landed while the calendar still ends early; then it grows."""
    landing, root = work_path(spark, "landing"), work_path(spark, "store")
    calendar = tables.calendar(spark, sf_dir)
    for feed in ("sales", "inventory"):
        extract.write_csv(tables.as_feed(spark, sf_dir, feed), f"{landing}/{feed}_2023-05-31.csv")
    early = calendar.where(F.col("CAL_DT") < day_lit(SECOND_LANDING))
    WeeklyStore(spark, root, early).ingest(landing)
    store = WeeklyStore(spark, root, calendar)
    store.ingest(landing)
    return store.weekly(AS_OF)


def arrival_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order a landed file, streamed; runs as they get ready, misses as they are due."""
    root = work_path(spark, "watch")
    tables.arrival_events(spark, sf_dir).repartition(8).write.parquet(f"{root}/arrivals")
    events = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 4)
    watch = Watch(spark, root, LANDING)
    days = tables.run_dates(spark, sf_dir).select(feed_day(F.col("run_date")).alias("feed_date"))
    watch.expect(days, datetime(2023, 1, 1, tzinfo=timezone.utc))
    watch.follow(events.parquet(f"{root}/arrivals"))
    return watch.outcomes()


QUERIES: dict[str, Query] = {
    **{f"scan_{feed}": _scan(feed) for feed in FEEDS},
    "date_rejects": date_rejects,
    "feed_rejects": feed_rejects,
    "manifest_paths": manifest_paths,
    "output_paths": output_paths,
    "ready_runs": ready_runs,
    "feed_table_name": feed_tables,
    **{f"extract_{table}": _extract(table) for table in extract.EXTRACT_ORDER},
    "extract_row_counts": extract_row_counts,
    "extract_parts": extract_parts,
    "extract_objects": extract_objects,
    "daily_sales": daily_sales,
    "sales_calendar_left": sales_calendar_left,
    "inventory_calendar_left": inventory_calendar_left,
    "weekly_sales": weekly_sales,
    "weekly_sales_left": weekly_sales_left,
    "inventory_max_day": _on_inventory(inventory.inventory_max_day),
    "no_stock_weekly": _on_inventory(inventory.no_stock_weekly),
    "stock_last_snapshot": _on_inventory(inventory.week_end_stock, policy="last_snapshot"),
    "stock_every_snapshot": _on_inventory(inventory.week_end_stock, policy="every_snapshot"),
    "weekly_sales_no_stock": weekly_sales_no_stock,
    "weekly_kpis": weekly_kpis,
    "current_week": week_of_today,
    "weekly_stock": _weekly_stock("last_snapshot"),
    "weekly_stock_as_written": _weekly_stock("every_snapshot"),
    **{f"dim_{table}": _dimension(table) for table in ("calendar", "store", "product")},
    "load_stamps": load_stamps,
    "published_sql": published_sql,
    "feed_reject_rows": feed_reject_rows,
    "expected_feeds": expected_feeds,
    "missing_feeds": missing_feeds,
    "arrival_outcomes": arrival_outcomes,
    "missing_snapshots": _on_inventory(completeness.missing_snapshots, as_of=AS_OF),
    "stock_without_sales": _dropped(completeness.stock_without_sales),
    "sales_without_stock": _dropped(completeness.sales_without_stock),
    "ingest_available_now": ingest_available_now,
    "ingest_daily_extracts": ingest_daily_extracts,
    "ingest_reextracted_day": ingest_reextracted_day,
    "ingest_unpadded_names": ingest_unpadded_names,
    "ingest_calendar_extended": ingest_calendar_extended,
}
