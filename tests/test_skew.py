"""One week, store and product with a third of all rows; results against brute force."""

from __future__ import annotations

from collections import Counter, defaultdict
from contextlib import contextmanager
from pathlib import Path

import pytest
from frames import calendar, day
from pyspark.sql import functions as F

from shelfline.operators import calendar as calendar_operators
from shelfline.operators import completeness
from shelfline.operators.calendar import check_calendar
from shelfline.plans.weekly import weekly_stock
from shelfline.sources.sinks import write_table

ROWS = 6000


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _spread(column, n):
    """Every third row goes to 0, the others over all values."""
    return F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id", F.lit(column)), n))


@pytest.fixture(scope="module")
def facts(spark):
    base = spark.range(ROWS)
    first = F.lit(day(0)).cast("date")
    # A third of all rows lie on days 5 and 6 of the first week, at store 0 and product 0.
    date = F.when(F.col("id") % 3 == 0, 5 + F.col("id") % 2).otherwise(
        F.pmod(F.xxhash64("id", F.lit("d")), 30)
    )
    keys = [
        F.date_add(first, date.cast("int")).alias("day"),
        _spread("s", 4).cast("bigint").alias("STORE_KEY"),
        _spread("p", 5).cast("bigint").alias("PROD_KEY"),
    ]
    qty = F.pmod(F.xxhash64("id", F.lit("q")), 4).cast("bigint")
    sold = base.select(
        *keys,
        qty.alias("SALES_QTY"),
        (qty * 3).cast("decimal(18,2)").alias("SALES_AMT"),
        F.lit(1.0).alias("SALES_PRICE"),
        F.lit(1).cast("decimal(18,2)").alias("SALES_COST"),
        F.lit(0).cast("decimal(18,2)").alias("SHIP_COST"),
    ).withColumnRenamed("day", "TRANS_DT")
    stocked = base.select(
        *keys,
        F.pmod(F.xxhash64("id", F.lit("h")), 50).cast("bigint").alias("INVENTORY_ON_HAND_QTY"),
        (F.col("id") % 7).alias("INVENTORY_ON_ORDER_QTY"),
        (F.col("id") % 5 == 0).cast("int").alias("OUT_OF_STOCK_FLG"),
    ).withColumnRenamed("day", "CAL_DT")
    return sold, stocked


def _brute_force(sold, stocked, policy, current=202303):
    def week(d):
        n = (d - day(0)).days
        return (202301 + n // 7, n % 7 + 1) if n < 28 else (None, None)

    sums = defaultdict(lambda: [0, 0])
    for r in sold.collect():
        total = sums[(week(r["TRANS_DT"])[0], r["STORE_KEY"], r["PROD_KEY"])]
        total[0] += r["SALES_QTY"]
        total[1] += r["SALES_AMT"]
    groups = defaultdict(list)
    for r in stocked.collect():
        wk, dow = week(r["CAL_DT"])
        groups[(wk, r["STORE_KEY"], r["PROD_KEY"])].append((dow, r))
    out = Counter()
    for key, rows in groups.items():
        if key[0] is None or key[0] > current or key not in sums:
            continue
        last = max(dow for dow, _ in rows)
        outs = sum(r["OUT_OF_STOCK_FLG"] for _, r in rows)
        for dow, r in rows:
            if policy == "every_snapshot" or dow == last:
                out[(*key, sums[key][0], float(sums[key][1]), outs,
                     r["INVENTORY_ON_HAND_QTY"], r["INVENTORY_ON_ORDER_QTY"])] += 1
    return out


COLUMNS = ["YR_WK_NUM", "STORE_KEY", "PROD_KEY", "total_sales_qty", "total_sales_amount",
           "No_Stock_Instances", "stock_lvl_eow", "stock_on_order_eow"]


@pytest.mark.parametrize("join", ["SortMergeJoin", "ShuffledHashJoin"])
@pytest.mark.parametrize("policy", ["last_snapshot", "every_snapshot"])
def test_hot_group_is_whole_and_split(spark, facts, policy, join):
    sold, stocked = facts
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
        spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold=(
            "0" if join == "SortMergeJoin" else "1m"
        ),
    ):
        table = weekly_stock(sold, stocked, calendar(spark), day(15), policy)
        got = Counter(tuple(r) for r in table.select(COLUMNS).collect())
        table = table.select(COLUMNS)
        table.collect()
        plan = table._jdf.queryExecution().executedPlan().toString()
    assert got == _brute_force(sold, stocked, policy)
    assert f"{join}(skew=true)" in plan


def test_hot_week_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(30000).select(
        F.xxhash64("id").alias("value"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("YR_WK_NUM"),
    )
    with settings(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__files__maxPartitionBytes="64KB",
    ):
        write_table(rows, f"{tmp_path}/t", "YR_WK_NUM")
    assert len(list(Path(tmp_path, "t", "YR_WK_NUM=0").glob("*.parquet"))) > 1
    assert spark.read.parquet(f"{tmp_path}/t").count() == 30000


def test_missing_snapshots_of_a_hot_product(spark, facts):
    _, stocked = facts
    days = check_calendar(calendar(spark)).days
    seen = {(r["CAL_DT"], r["STORE_KEY"], r["PROD_KEY"]) for r in stocked.collect()}
    pairs = {k[1:] for k in seen}
    want = {(day(n), *p) for n in range(28) for p in pairs} - seen
    got = completeness.missing_snapshots(stocked, days, day(27)).collect()
    each = [
        (r["first_day"] + timedelta(n), r["STORE_KEY"], r["PROD_KEY"])
        for r in got
        for n in range(r["days"])
    ]
    assert len(each) == len(want)
    assert set(each) == want


def test_calendar_beyond_the_broadcast_bound_gives_the_same_rows(spark, facts, monkeypatch):
    sold, stocked = facts
    args = (sold, stocked, calendar(spark), day(15))
    small = Counter(tuple(r) for r in weekly_stock(*args).collect())
    monkeypatch.setattr(calendar_operators, "MAX_BROADCAST_DAYS", 3)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        large = weekly_stock(*args)
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert Counter(tuple(r) for r in large.collect()) == small


def test_wide_calendar_is_not_broadcast(spark, monkeypatch):
    def hinted(frame):
        return "ResolvedHint" in frame._jdf.queryExecution().analyzed().toString()

    checked = check_calendar(calendar(spark))
    assert hinted(checked.full) and hinted(checked.days.frame)
    monkeypatch.setattr(calendar_operators, "MAX_BROADCAST_BYTES", 100)
    checked = check_calendar(calendar(spark))
    assert not hinted(checked.full) and hinted(checked.days.frame)
