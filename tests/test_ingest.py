"""Incremental ingest ends in the same table as one batch over everything."""

from __future__ import annotations

from collections import Counter

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from frames import calendar, day, inventory, sales

from shelfline.plans.weekly import weekly_stock
from shelfline.sources import files
from shelfline.sources.extract import write_csv, write_object
from shelfline.streaming import facts, generations
from shelfline.streaming.ingest import WeeklyStore

SOLD = [(n, n % 3, n % 2, n % 4, n + 0.5, 1, 0.25) for n in range(40)]
STOCKED = [(n, n % 3, n % 2, n % 9, n % 5, n % 2) for n in range(40)]
AS_OF = 20


def land(spark, root, name, sold, stocked):
    if sold:
        write_csv(sales(spark, sold), f"{root}/sales_{name}.csv")
    if stocked:
        write_csv(inventory(spark, stocked), f"{root}/inventory_{name}.csv")


def batch(spark, policy="last_snapshot"):
    return rows(
        weekly_stock(
            sales(spark, SOLD), inventory(spark, STOCKED), calendar(spark), day(AS_OF), policy
        )
    )


def rows(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("policy", ["last_snapshot", "every_snapshot"])
def test_one_go_equals_batch(spark, tmp_path, policy):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark), policy)
    land(spark, f"{tmp_path}/landing", "a", SOLD, STOCKED)
    store.ingest(f"{tmp_path}/landing")
    assert rows(store.weekly(day(AS_OF))) == batch(spark, policy)


def test_late_days_and_repeated_calls_equal_batch(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark))
    parts = [(SOLD[30:], STOCKED[::2]), (SOLD[:30:2], STOCKED[1::4]), (SOLD[1:30:2], STOCKED[3::4])]
    for n, (sold, stocked) in enumerate(parts):
        land(spark, f"{tmp_path}/landing", f"2023-02-0{n}", sold, stocked)
        store.ingest(f"{tmp_path}/landing", max_files_per_batch=1)
    assert rows(store.weekly(day(AS_OF))) == batch(spark)
    store.ingest(f"{tmp_path}/landing")
    assert rows(store.weekly(day(AS_OF))) == batch(spark)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark))
    land(spark, f"{tmp_path}/landing", "a", SOLD, STOCKED)
    real, seen = store._take_in, []

    def failing(rows, batch_id):
        real(rows, batch_id)
        if not seen:
            seen.append(batch_id)
            raise RuntimeError("lost after both writes")

    store._take_in = failing
    with pytest.raises(Exception, match="lost after both writes"):
        store.ingest(f"{tmp_path}/landing")
    store.ingest(f"{tmp_path}/landing")
    assert rows(store.weekly(day(AS_OF))) == batch(spark)


def test_rows_outside_the_calendar_are_kept_and_publish_nothing(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark, days=28))
    land(spark, f"{tmp_path}/landing", "a", [(35, 1, 1, 1, 1)], [(35, 1, 1, 1, 1, 0)])
    store.ingest(f"{tmp_path}/landing")
    assert not (tmp_path / "store" / "weekly").exists()
    assert spark.read.parquet(f"{tmp_path}/store/facts").count() == 2
    longer = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark, days=42))
    longer.ingest(f"{tmp_path}/landing")
    assert [r["YR_WK_NUM"] for r in longer.weekly(day(41)).collect()] == [202306]


def test_columns_are_found_by_header(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark))
    land(spark, f"{tmp_path}/landing", "a", [], STOCKED)
    swapped = sales(spark, SOLD).withColumn("NOTE", F.lit("x"))
    swapped = swapped.select(*reversed(swapped.columns))
    write_csv(swapped, f"{tmp_path}/landing/sales_a.csv")
    store.ingest(f"{tmp_path}/landing")
    assert rows(store.weekly(day(AS_OF))) == batch(spark)


def test_the_newest_extract_stands_for_its_feed(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark), cumulative=True)
    land(spark, f"{tmp_path}/landing", "2023-01-09", SOLD[:9] + [(27, 9, 9, 1, 1)], STOCKED[:9])
    store.ingest(f"{tmp_path}/landing")
    land(spark, f"{tmp_path}/landing", "2023-01-10", SOLD, STOCKED)
    store.ingest(f"{tmp_path}/landing")
    assert rows(store.weekly(day(AS_OF))) == batch(spark)


def test_fact_files_do_not_grow_with_the_tasks(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark))
    write_csv(sales(spark, SOLD).repartition(16), f"{tmp_path}/landing/sales_a.csv")
    write_csv(inventory(spark, STOCKED).repartition(16), f"{tmp_path}/landing/inventory_a.csv")
    store.ingest(f"{tmp_path}/landing")
    files = len(list((tmp_path / "store" / "facts").rglob("*.parquet")))
    assert files <= 80  # a file for each of 40 days and two feeds
    assert rows(store.weekly(day(AS_OF))) == batch(spark)


# Versions of an extract, and the order of stamps


def one_day(spark, root, stamp, qty):
    land(spark, root, stamp, [(2, 1, 1, qty, qty)], [(2, 1, 1, 3, 1, 0)])


def quantities(store):
    return [r["total_sales_qty"] for r in store.weekly(day(AS_OF)).collect()]


@pytest.mark.parametrize("cumulative", [True, False])
def test_an_extract_written_again_replaces_itself(spark, tmp_path, cumulative):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark), cumulative=cumulative)
    for qty in (1, 5):
        one_day(spark, f"{tmp_path}/landing", "2023-01-10", qty)
        store.ingest(f"{tmp_path}/landing")
        assert quantities(store) == [qty]
    assert store.ledger().count() == 2


def test_a_plain_file_written_again_replaces_itself(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark))
    write_object(inventory(spark, [(2, 1, 1, 3, 1, 0)]), f"{tmp_path}/landing/inventory_x.csv")
    for qty in ("4", "17"):
        text = f"TRANS_DT,STORE_KEY,PROD_KEY,SALES_QTY,SALES_AMT\n2023-01-03,1,1,{qty},2\n"
        (tmp_path / "landing" / "sales_x.csv").write_text(text)
        store.ingest(f"{tmp_path}/landing")
        assert quantities(store) == [float(qty)]


def test_stamps_with_single_digits_are_in_order(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark), cumulative=True)
    one_day(spark, f"{tmp_path}/landing", "2023-01-10", 5)
    one_day(spark, f"{tmp_path}/landing", "2023-01-9", 1)
    one_day(spark, f"{tmp_path}/landing", "latest", 7)
    store.ingest(f"{tmp_path}/landing")
    assert quantities(store) == [5]
    one_day(spark, f"{tmp_path}/landing", "2023-1-8", 2)
    store.ingest(f"{tmp_path}/landing")
    assert quantities(store) == [5]
    one_day(spark, f"{tmp_path}/landing", "2023-01-11", 6)
    store.ingest(f"{tmp_path}/landing")
    assert quantities(store) == [6]
    assert {r["name"] for r in store.rejected().collect()} == {"sales_latest.csv", "inventory_latest.csv"}
    status = {r["name"]: r["status"] for r in store.ledger().where("feed = 'sales'").collect()}
    assert status == {
        "sales_2023-01-10.csv": "taken", "sales_2023-01-9.csv": "older", "sales_latest.csv": "undated",
        "sales_2023-1-8.csv": "older", "sales_2023-01-11.csv": "taken",
    }


# Cumulative extracts as differences


def test_a_second_extract_with_one_new_day_writes_one_day_and_one_week(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark), cumulative=True)
    land(spark, f"{tmp_path}/landing", "2023-01-19", SOLD[:18], STOCKED[:18])
    store.ingest(f"{tmp_path}/landing")
    before = generations.newest(spark, f"{tmp_path}/store")
    land(spark, f"{tmp_path}/landing", "2023-01-20", SOLD[:19], STOCKED[:19])
    store.ingest(f"{tmp_path}/landing")
    after = generations.newest(spark, f"{tmp_path}/store")
    assert {w for w, g in after.weeks.items() if before.weeks.get(w) != g} == {202303}
    written = facts.read_generation(spark, f"{tmp_path}/store", after.generation)
    assert sorted(r["day"] for r in written.collect()) == [day(18), day(18)]
    assert spark.read.parquet(f"{tmp_path}/store/facts").count() == 38  # no history twice
    whole = weekly_stock(sales(spark, SOLD[:19]), inventory(spark, STOCKED[:19]), calendar(spark), day(AS_OF))
    assert rows(store.weekly(day(AS_OF))) == rows(whole)


def test_days_that_an_extract_no_longer_has_go(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark), cumulative=True)
    land(spark, f"{tmp_path}/landing", "2023-01-19", SOLD, STOCKED)
    store.ingest(f"{tmp_path}/landing")
    land(spark, f"{tmp_path}/landing", "2023-01-20", SOLD[10:], STOCKED[8:])
    store.ingest(f"{tmp_path}/landing")
    whole = weekly_stock(sales(spark, SOLD[10:]), inventory(spark, STOCKED[8:]), calendar(spark), day(AS_OF))
    assert rows(store.weekly(day(AS_OF))) == rows(whole)


def test_first_extracts_are_parsed_once(spark, tmp_path, monkeypatch):
    plans, digests = [], facts.digests

    def seen(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return digests(frame)

    monkeypatch.setattr(facts, "digests", seen)
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark), cumulative=True)
    land(spark, f"{tmp_path}/landing", "2023-01-19", SOLD, STOCKED)
    store.ingest(f"{tmp_path}/landing")
    assert "FileScan parquet" in plans[0] and "FileScan csv" not in plans[0]
    assert rows(store.weekly(day(AS_OF))) == batch(spark)


def test_a_longer_calendar_builds_only_weeks_that_differ(spark, tmp_path):
    land(spark, f"{tmp_path}/landing", "2023-01-19", SOLD, STOCKED)
    early = calendar(spark).where(F.col("CAL_DT") < F.lit(day(10)))
    WeeklyStore(spark, f"{tmp_path}/store", early).ingest(f"{tmp_path}/landing")
    before = generations.newest(spark, f"{tmp_path}/store").weeks
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark))
    store.ingest(f"{tmp_path}/landing")
    after = generations.newest(spark, f"{tmp_path}/store").weeks
    assert sorted(before) == [202301, 202302]
    assert {w for w, g in before.items() if after[w] == g} == {202301}
    assert rows(store.weekly(day(AS_OF))) == batch(spark)


def test_digests_see_every_change_but_order(spark):
    def found(rows):
        frame = sales(spark, rows).withColumns({"feed": F.lit("sales"), "extract": F.lit(""), "day": F.col("TRANS_DT")})
        lacking = [f for f in facts.FACT_SCHEMA.fields if f.name not in frame.columns]
        frame = frame.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking})
        return [tuple(r) for r in facts.digests(frame).collect()]

    base = [(0, 1, 1, 2, 2), (0, 1, 2, 3, 3)]
    assert found(base) == found(base[::-1])
    others = [base + base[:1], base[:1] * 2, [(0, 1, 1, 3, 2), (0, 1, 2, 2, 3)], [(0, 1, 1, 2, None), base[1]]]
    assert len({repr(found(x)) for x in [base, *others]}) == 5


# Scans, generations, merging


def test_a_backfill_is_one_scan_for_each_feed_and_header(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for n in range(120):
        columns = "TRANS_DT,STORE_KEY,PROD_KEY,SALES_QTY,SALES_AMT"
        line = f"{day(n % 20)},1,{n},{n},1"
        if n % 3 == 0:
            columns, line = "NOTE," + columns, "x," + line
        (landing / f"sales_2023-02-{n}.csv").write_text(f"{columns}\n{line}\n")
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark))
    from shelfline.streaming import ledger

    landed = ledger.landed_extracts(spark, str(landing)).collect()
    assert len(landed) == 120
    frame = facts.read_extracts(spark, landed, named=True)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2
    got = {(r["extract"], r["PROD_KEY"], r["SALES_QTY"]) for r in frame.collect()}
    assert got == {(f"sales_2023-02-{n}.csv", n, n) for n in range(120)}
    store.ingest(str(landing))
    assert store.ledger().where("status = 'taken'").count() == 120


def test_facts_of_a_feed_have_its_own_columns_and_nothing_is_left_aside(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark))
    land(spark, f"{tmp_path}/landing", "2023-01-10", [(0, 1, 1, 2, 2), (9, 1, 1, 2, 2)], [(9, 1, 1, 3, 1, 0)])
    store.ingest(f"{tmp_path}/landing")
    number = generations.newest(spark, f"{tmp_path}/store").generation
    path = facts.generation_path(f"{tmp_path}/store", number)
    own = {feed: set(spark.read.parquet(f"{path}/feed={feed}").columns) for feed in facts.FACT_FEEDS}
    assert own == {feed: {*facts.FEED_TYPES[feed], "extract", "day", "span"} for feed in facts.FACT_FEEDS}
    got = facts.read_generation(spark, f"{tmp_path}/store", number).groupBy("feed", "extract").count().collect()
    assert sorted(map(tuple, got)) == [("inventory", "inventory_2023-01-10.csv", 1), ("sales", "sales_2023-01-10.csv", 2)]
    assert not any(Path(f"{tmp_path}/store/digests").glob("*"))


def test_a_failed_write_leaves_the_state_before(spark, tmp_path, monkeypatch):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark))
    one_day(spark, f"{tmp_path}/landing", "2023-01-10", 1)
    store.ingest(f"{tmp_path}/landing")
    land(spark, f"{tmp_path}/landing", "2023-01-11", [(2, 1, 1, 4, 4)], [])
    with monkeypatch.context() as m:

        def lost(state):
            raise RuntimeError("lost before it was published")

        m.setattr(store, "_publish", lost)
        with pytest.raises(RuntimeError, match="lost"):
            store.ingest(f"{tmp_path}/landing")
        assert quantities(store) == [1]
    store.ingest(f"{tmp_path}/landing")
    assert quantities(store) == [5]


def test_a_reader_of_the_state_before_is_not_disturbed(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark))
    one_day(spark, f"{tmp_path}/landing", "2023-01-10", 1)
    store.ingest(f"{tmp_path}/landing")
    reader = store.weekly(day(AS_OF))
    one_day(spark, f"{tmp_path}/landing", "2023-01-10", 4)
    store.ingest(f"{tmp_path}/landing")
    assert [r["total_sales_qty"] for r in reader.collect()] == [1]
    assert quantities(store) == [4]


def test_two_writers_cannot_publish_the_same_number(spark, tmp_path):
    state = generations.State().next()
    generations.publish(spark, str(tmp_path), state)
    with pytest.raises(Exception, match="(?i)exist"):
        generations.publish(spark, str(tmp_path), state)


def test_many_batches_on_one_day_are_merged_and_old_files_go(spark, tmp_path):
    store = WeeklyStore(spark, f"{tmp_path}/store", calendar(spark), merge_after=3)
    (tmp_path / "landing").mkdir()
    land(spark, f"{tmp_path}/landing", "a", [], [(2, 1, 1, 3, 1, 0)])
    for n in range(7):
        text = f"TRANS_DT,STORE_KEY,PROD_KEY,SALES_QTY,SALES_AMT\n2023-01-03,1,1,{n},1\n"
        (tmp_path / "landing" / f"sales_{n}.csv").write_text(text)
        store.ingest(f"{tmp_path}/landing")
    assert quantities(store) == [sum(range(7))]
    names = list((tmp_path / "store" / "facts").rglob("*.parquet"))
    assert len(names) <= 2 * (3 + 3 + 1)  # of two feeds: up to the next merge, merged, before it
    assert len(list((tmp_path / "store" / "published").glob("*.json"))) == 2
    assert len(list((tmp_path / "store" / "weekly").rglob("*.parquet"))) <= 2
    text = "TRANS_DT,STORE_KEY,PROD_KEY,SALES_QTY,SALES_AMT\n2023-01-03,1,1,100,1\n"
    (tmp_path / "landing" / "sales_3.csv").write_text(text)  # after it was merged
    store.ingest(f"{tmp_path}/landing")
    assert quantities(store) == [sum(range(7)) - 3 + 100]


def test_files_helper(spark, tmp_path):
    files.write_text(spark, f"{tmp_path}/a/x.txt", "é\nzwei")
    assert files.read_text(spark, f"{tmp_path}/a/x.txt") == "é\nzwei"
    assert files.first_line(spark, f"file://{tmp_path}/a/x.txt") == "é"
    assert files.children(spark, f"{tmp_path}/a") == ["x.txt"]
    files.write_text(spark, f"{tmp_path}/b.txt", "new")
    with pytest.raises(Exception, match="(?i)exist"):
        files.move(spark, f"{tmp_path}/b.txt", f"{tmp_path}/a/x.txt")
    files.move(spark, f"{tmp_path}/b.txt", f"{tmp_path}/a/x.txt", overwrite=True)
    assert files.read_text(spark, f"{tmp_path}/a/x.txt") == "new"
    assert not files.exists(spark, f"{tmp_path}/b.txt") and files.is_file(spark, f"{tmp_path}/a/x.txt")
    files.remove(spark, f"{tmp_path}/a")
    assert files.children(spark, f"{tmp_path}/a") == []
