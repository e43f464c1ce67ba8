"""Command line for spark-submit.

    shelfline_job.py weekly  '<manifest json>' --input-root R --output-root R
    shelfline_job.py extract --database D --output-root R
    shelfline_job.py check   --landing R
    shelfline_job.py watch   --landing R --store R
    shelfline_job.py ingest  --landing R --store R --calendar FILE

``--as-of YYYY-MM-DD`` stands for today in all of them.
"""

from __future__ import annotations

import argparse
import sys
from datetime import date, datetime, timezone
from typing import get_args

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfline.functions.dates import day_lit, feed_day
from shelfline.operators.completeness import expected_feeds, missing_feeds, ready_runs
from shelfline.operators.inventory import StockPolicy
from shelfline.plans.job import publish_outputs, run_job, tune_session
from shelfline.schemas import FEEDS
from shelfline.sources.extract import extract_feeds
from shelfline.sources.feeds import scan_feed
from shelfline.sources.landing import arrival_log
from shelfline.sources.manifest import JobPaths
from shelfline.streaming.arrivals import Watch, landed_events
from shelfline.streaming.ingest import WeeklyStore


def weekly(spark: SparkSession, args: argparse.Namespace) -> None:
    paths = JobPaths.from_json(args.manifest, args.input_root, args.output_root)
    tune_session(spark, list(paths.inputs.values()))
    rejects = f"{args.output_root}rejected_values"
    run_job(
        spark,
        paths,
        args.as_of,
        args.stock_policy,
        infer=args.infer_schema,
        calendar_type=args.calendar_type,
        rejects=None if args.infer_schema else rejects,
    )
    if not args.infer_schema:
        counts = spark.read.parquet(rejects).groupBy("table_name", "column_name").count()
        for row in counts.orderBy("table_name", "column_name").collect():  # a row per column
            print(f"{row['table_name']}.{row['column_name']}: {row['count']} values do not fit")
    if args.publish:
        publish_outputs(spark, paths, args.publish)


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = {t: spark.table(f"{args.database}.{t}") for t in FEEDS}
    extract_feeds(spark, tables, args.output_root, args.as_of, args.single_file, args.max_bytes).show()


def check(spark: SparkSession, args: argparse.Namespace) -> None:
    today = spark.range(1).select(day_lit(args.as_of).alias("run_date"))
    expected, arrived = expected_feeds(today), arrival_log(spark, args.landing)
    ready = ready_runs(expected, arrived).first()
    if ready is not None:
        print(ready["manifest"])
    else:
        missing_feeds(expected, arrived).orderBy("path").show(truncate=False)
        sys.exit(1)


def watch(spark: SparkSession, args: argparse.Namespace) -> None:
    now = datetime.now(timezone.utc)
    today = spark.range(1).select(feed_day(day_lit(args.as_of)).alias("feed_date"))
    arrivals = Watch(spark, args.store)
    arrivals.expect(today, now)
    arrivals.follow(landed_events(spark, args.landing))
    arrivals.outcomes().where(F.col("run_date") == day_lit(args.as_of)).show(truncate=False)


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    tune_session(spark, [args.landing])
    calendar = scan_feed(spark, "calendar", args.calendar)
    store = WeeklyStore(spark, args.store, calendar, args.stock_policy, not args.added_rows)
    store.ingest(args.landing, args.max_files_per_batch)
    newest = store.weekly(args.as_of).agg(F.max("YR_WK_NUM").alias("week")).first()["week"]
    print(f"weekly table is complete up to week {newest}")


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--as-of", type=date.fromisoformat, default=date.today())

    policy = argparse.ArgumentParser(add_help=False)
    policy.add_argument(
        "--stock-policy", choices=get_args(StockPolicy), default="last_snapshot"
    )

    top = argparse.ArgumentParser(prog="shelfline_job.py")
    commands = top.add_subparsers(required=True)

    sub = commands.add_parser("weekly", parents=[common, policy])
    sub.add_argument("manifest", help="JSON object from table name to path")
    sub.add_argument("--input-root", required=True)
    sub.add_argument("--output-root", required=True)
    sub.add_argument("--calendar-type", help="the CAL_TYPE_DESC to use, if there are several")
    sub.add_argument("--infer-schema", action="store_true")
    sub.add_argument("--publish", metavar="DATABASE")
    sub.set_defaults(run=weekly)

    sub = commands.add_parser("extract", parents=[common])
    sub.add_argument("--database", required=True)
    sub.add_argument("--output-root", required=True)
    sub.add_argument("--single-file", action="store_true")
    sub.add_argument("--max-bytes", type=int, help="most bytes of a file; a larger single file is refused")
    sub.set_defaults(run=extract)

    sub = commands.add_parser("check", parents=[common])
    sub.add_argument("--landing", required=True)
    sub.set_defaults(run=check)

    sub = commands.add_parser("watch", parents=[common])
    sub.add_argument("--landing", required=True)
    sub.add_argument("--store", required=True)
    sub.set_defaults(run=watch)

    sub = commands.add_parser("ingest", parents=[common, policy])
    sub.add_argument("--landing", required=True)
    sub.add_argument("--store", required=True)
    sub.add_argument("--calendar", required=True)
    sub.add_argument("--max-files-per-batch", type=int)
    sub.add_argument(
        "--added-rows", action="store_true", help="files add rows; else each holds all history"
    )
    sub.set_defaults(run=ingest)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("shelfline").getOrCreate()
    args.run(spark, args)
