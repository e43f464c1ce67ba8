"""The whole job through its command line."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from frames import calendar, day, inventory, sales

from shelfline import cli
from shelfline.plans import job
from shelfline.plans.weekly import weekly_stock
from shelfline.operators.calendar import check_calendar
from shelfline.schemas import FEEDS, WEEKLY_COLUMNS
from shelfline.sources.extract import extract, extract_feeds
from shelfline.sources.manifest import JobPaths

AS_OF = day(10)


@pytest.fixture
def landed(spark, tmp_path):
    tables = {
        "sales": sales(spark, [(n, n % 3, 1, n % 4, n + 0.25) for n in range(20)]),
        "inventory": inventory(spark, [(n, n % 3, 1, n, 2, n % 2) for n in range(20)]),
        "calendar": calendar(spark),
        "store": spark.createDataFrame([(0, "a"), (1, "b")], "STORE_KEY int, NAME string"),
        "product": spark.createDataFrame([(1, "x")], "PROD_KEY int, NAME string"),
    }
    extract_feeds(spark, tables, f"{tmp_path}/landing", AS_OF)
    return tmp_path, tables


TUNED = (
    "spark.sql.shuffle.partitions",
    "spark.sql.files.maxPartitionBytes",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold",
)


@pytest.fixture(autouse=True)
def untuned(spark):
    before = {key: spark.conf.get(key) for key in TUNED}
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def manifest(landed_on=AS_OF):
    return json.dumps({t: f"landing/{t}_{landed_on}.csv" for t in FEEDS})


@pytest.mark.parametrize("options", [[], ["--infer-schema"]])
def test_weekly_job(spark, landed, options):
    root, tables = landed
    cli.main(
        ["weekly", manifest(), "--input-root", f"{root}/", "--output-root", f"{root}/out/",
         "--as-of", str(AS_OF), "--publish", "job_test", *options]
    )
    sold, stocked = (extract(tables[t], t, AS_OF) for t in ("sales", "inventory"))
    want = weekly_stock(sold, stocked, tables["calendar"], AS_OF)
    got = spark.table("job_test.weekly_agg_table")
    assert sorted(tuple(r) for r in got.select(WEEKLY_COLUMNS).collect()) == sorted(
        tuple(r) for r in want.select(WEEKLY_COLUMNS).collect()
    )
    assert got.count() > 0 and got.where("load_tmst IS NULL").count() == 0
    stores = spark.sql(
        "SELECT STORE_KEY, NAME FROM job_test.store_table WHERE load_tmst > '2023-01-01'"
    )
    assert sorted(tuple(r) for r in stores.collect()) == [(0, "a"), (1, "b")]
    assert spark.table("job_test.calendar_table").count() == 28
    assert spark.table("job_test.prod_table").count() == 1


@pytest.mark.parametrize("as_of", [AS_OF, date(2030, 1, 1)])
def test_job_leaves_no_table_of_its_own(spark, landed, as_of):
    root, _ = landed
    paths = JobPaths.from_json(manifest(), f"{root}/", f"{root}/done/")
    before = {t.name for t in spark.catalog.listTables()}
    if as_of == AS_OF:
        job.run_job(spark, paths, as_of)
    else:
        with pytest.raises(ValueError, match="no week"):
            job.run_job(spark, paths, as_of)
        assert not (root / "done").exists()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_one_of_several_calendars(spark, landed):
    _, tables = landed
    both = tables["calendar"].unionAll(
        tables["calendar"].withColumn("CAL_TYPE_DESC", F.lit("Fiscal"))
    )
    with pytest.raises(ValueError, match="2 rows for one date"):
        check_calendar(both, AS_OF)
    assert check_calendar(both, AS_OF, "Fiscal").day_count == 28


def test_check_prints_the_manifest_or_what_is_missing(spark, landed, capsys):
    root, _ = landed
    cli.main(["check", "--landing", f"{root}/landing", "--as-of", str(day(11))])
    assert json.loads(capsys.readouterr().out) == {t: f"{t}_{AS_OF}.csv" for t in FEEDS}
    with pytest.raises(SystemExit, match="1"):
        cli.main(["check", "--landing", f"{root}/landing", "--as-of", str(day(12))])
    assert f"sales_{day(11)}.csv" in capsys.readouterr().out


def test_extract_command(spark, landed, capsys):
    root, tables = landed
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_test")
    for name, frame in tables.items():
        frame.write.mode("overwrite").option("path", f"{root}/raw/{name}").saveAsTable(
            f"raw_test.{name}"
        )
    cli.main(["extract", "--database", "raw_test", "--output-root", f"{root}/again",
              "--as-of", str(AS_OF)])
    assert "inventory" in capsys.readouterr().out
    assert spark.read.option("header", True).csv(f"{root}/again/sales_{AS_OF}.csv").count() == 11


def test_ingest_command(spark, landed, capsys):
    root, _ = landed
    arguments = ["ingest", "--landing", f"{root}/landing", "--store", f"{root}/store",
                 "--calendar", f"{root}/landing/calendar_{AS_OF}.csv", "--as-of", str(AS_OF)]
    cli.main(arguments)
    assert "week 202302" in capsys.readouterr().out


def test_as_of_defaults_to_today():
    args = cli.parser().parse_args(["check", "--landing", "x"])
    assert args.as_of == date.today()


def test_tasks_and_shuffles_grow_with_the_input_up_to_a_bound(spark, tmp_path, monkeypatch):
    def tuned():
        job.tune_session(spark, [str(tmp_path)])
        return int(spark.conf.get(TUNED[0])), spark.conf.get(TUNED[1])

    (tmp_path / "a.csv").write_text("x" * 1000)
    before = int(spark.conf.get(TUNED[0]))
    assert tuned() == (before, "134217728b")
    monkeypatch.setattr(job, "SCAN_TASK_BYTES", 20)
    monkeypatch.setattr(job, "MAX_SCAN_TASKS", 10)
    monkeypatch.setattr(job, "SHUFFLE_PARTITION_BYTES", 10)
    assert tuned() == (101, "100b")
    monkeypatch.setattr(job, "MAX_SHUFFLE_PARTITIONS", 50)
    spark.conf.set(TUNED[0], str(before))
    assert tuned() == (50, "100b")


def test_weekly_reads_each_feed_once(spark, landed, monkeypatch, capsys):
    """The inputs are gone once they are staged, and the job still writes everything."""
    import shutil

    root, tables = landed
    feed = root / "landing" / f"sales_{AS_OF}.csv"
    header = next(feed.glob("part-*")).read_text().splitlines()[0]
    part = feed / "part-more.csv"
    part.write_text(f"{header}\n{AS_OF},1,1,many,1,1,0,0\n")
    real = job.stage_feeds

    def staged(*args):
        frames = real(*args)
        shutil.rmtree(root / "landing")
        return frames

    monkeypatch.setattr(job, "stage_feeds", staged)
    cli.main(["weekly", manifest(), "--input-root", f"{root}/", "--output-root", f"{root}/out/", "--as-of", str(AS_OF)])
    assert "sales.SALES_QTY: 1 values do not fit" in capsys.readouterr().out
    (bad,) = spark.read.parquet(f"{root}/out/rejected_values").collect()
    assert (bad["table_name"], bad["column_name"]) == ("sales", "SALES_QTY") and "many" in bad["row_text"]
    assert bad["file"].endswith(part.name)
    expected = weekly_stock(tables["sales"], tables["inventory"], tables["calendar"], AS_OF)
    got = spark.read.parquet(f"{root}/out/weekly_agg_table")
    assert got.count() == expected.count()
    assert spark.read.parquet(f"{root}/out/calendar_table").count() == tables["calendar"].count()
