"""The weekly table on hand-made edge cases."""

from __future__ import annotations

import pytest
from frames import calendar, day, inventory, sales

from shelfline.operators import inventory as stock_ops
from shelfline.operators.calendar import check_calendar, current_week
from shelfline.operators.sales import daily_sales, weekly_sales
from shelfline.plans.weekly import weekly_stock
from shelfline.schemas import WEEKLY_SCHEMA


def weekly(spark, sold, stocked, as_of=27, policy="last_snapshot", days=28):
    frame = weekly_stock(
        sales(spark, sold),
        inventory(spark, stocked),
        calendar(spark, days),
        day(as_of),
        policy,
    )
    return [r.asDict() for r in frame.orderBy("YR_WK_NUM", "STORE_KEY", "PROD_KEY").collect()]


ONE_WEEK = [(0, 1, 1, 10, 5, 0), (2, 1, 1, 4, 6, 1), (4, 1, 1, 30, 7, 0)]


def test_last_snapshot_takes_the_last_observed_day_of_a_week_without_saturday(spark):
    (row,) = weekly(spark, [(0, 1, 1, 20, 100)], ONE_WEEK)
    assert (row["stock_lvl_eow"], row["stock_on_order_eow"]) == (30, 7)
    assert row["No_Stock_Instances"] == 1


def test_every_snapshot_repeats_the_week_on_each_snapshot(spark):
    rows = weekly(spark, [(0, 1, 1, 20, 100)], ONE_WEEK, policy="every_snapshot")
    assert sorted(r["stock_lvl_eow"] for r in rows) == [4, 10, 30]
    assert {r["total_sales_qty"] for r in rows} == {20}
    assert {r["No_Stock_Instances"] for r in rows} == {1}


def test_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError, match="stock_policy"):
        weekly(spark, [], [], policy="first_snapshot")


def test_two_snapshots_on_the_last_day_are_both_kept(spark):
    rows = weekly(spark, [(0, 1, 1, 20, 100)], [*ONE_WEEK, (4, 1, 1, 31, 8, 0)])
    assert sorted(r["stock_lvl_eow"] for r in rows) == [30, 31]


def test_kpis(spark):
    (row,) = weekly(spark, [(1, 1, 1, 40, 100), (3, 1, 1, 10, 25)], ONE_WEEK)
    assert row["Low_Stock_flg"] == 1
    assert row["Total_Low_Stock_Impact"] == 2
    assert row["avg_sales_price"] == 2.5
    assert row["Pot_Low_Stock_Impact"] == 125 - 30 * 2.5
    assert row["No_Stock_Impact"] == 125
    assert row["in_stock_pct"] == (1 - 1 / 7) * 100
    assert row["weeks_supply"] == 30 / 50


def test_enough_stock_has_no_impact(spark):
    (row,) = weekly(spark, [(1, 1, 1, 30, 60)], [(6, 1, 1, 30, 0, 0)])
    assert (row["Low_Stock_flg"], row["Pot_Low_Stock_Impact"]) == (0, 0)
    assert (row["No_Stock_Instances"], row["No_Stock_Impact"]) == (0, 0)
    assert row["in_stock_pct"] == 100


def test_zero_weekly_quantity_gives_null_ratios(spark):
    (row,) = weekly(spark, [(1, 1, 1, 0, 60)], [(6, 1, 1, 30, 0, 0)])
    assert row["avg_sales_price"] is None
    assert row["weeks_supply"] is None
    assert row["Pot_Low_Stock_Impact"] == 0


def test_negative_stock_with_zero_quantity_has_unknown_impact(spark):
    (row,) = weekly(spark, [(1, 1, 1, 0, 60)], [(6, 1, 1, -3, 0, 0)])
    assert row["Low_Stock_flg"] == 1
    assert row["Pot_Low_Stock_Impact"] is None


def test_unknown_stock_is_not_low_stock(spark):
    (row,) = weekly(spark, [(1, 1, 1, 5, 60)], [(6, 1, 1, None, None, 0)])
    assert row["Low_Stock_flg"] == 0
    assert row["weeks_supply"] is None


def test_unknown_flags_give_unknown_stock_out_count(spark):
    (row,) = weekly(spark, [(1, 1, 1, 5, 60)], [(6, 1, 1, 1, 0, None)])
    assert row["No_Stock_Instances"] is None
    assert row["Total_Low_Stock_Impact"] is None
    assert row["in_stock_pct"] is None
    assert row["No_Stock_Impact"] == 0


def test_more_than_seven_stock_outs_go_below_zero_percent(spark):
    (*_, row) = weekly(spark, [(1, 1, 1, 5, 60)], [(n % 7, 1, 1, 1, 0, 1) for n in range(8)])
    assert row["in_stock_pct"] == (1 - 8 / 7) * 100


def test_running_week_is_in_and_later_weeks_are_not(spark):
    sold = [(n, 1, 1, 1, 1) for n in (0, 7, 14)]
    stocked = [(n, 1, 1, 1, 1, 0) for n in (0, 7, 14)]
    assert [r["YR_WK_NUM"] for r in weekly(spark, sold, stocked, as_of=8)] == [202301, 202302]


def test_snapshots_after_as_of_in_the_running_week_count(spark):
    (row,) = weekly(spark, [(0, 1, 1, 1, 1)], [(0, 1, 1, 5, 0, 0), (6, 1, 1, 9, 0, 0)], as_of=1)
    assert row["stock_lvl_eow"] == 9


def test_facts_outside_the_calendar_leave_no_row(spark):
    assert weekly(spark, [(9, 1, 1, 1, 1)], [(9, 1, 1, 1, 1, 0)], as_of=1, days=7) == []


def test_keys_on_one_side_only_leave_no_row(spark):
    rows = weekly(
        spark,
        [(0, 1, 1, 1, 1), (0, 2, 1, 1, 1), (0, None, 1, 1, 1)],
        [(0, 1, 1, 1, 1, 0), (0, 3, 1, 1, 1, 0), (0, None, 1, 1, 1, 0)],
    )
    assert [r["STORE_KEY"] for r in rows] == [1]


def test_as_of_outside_the_calendar_is_a_clear_error(spark):
    with pytest.raises(ValueError, match="2023-03-02"):
        weekly(spark, [], [], as_of=60)


def test_doubled_calendar_date_is_refused(spark):
    with pytest.raises(ValueError, match="2 rows for one date, e.g. 2023-01-04"):
        check_calendar(calendar(spark, doubled=[3]))


def test_current_week(spark):
    assert [tuple(r) for r in current_week(calendar(spark), day(8)).collect()] == [
        (day(8), 202302)
    ]


def test_published_types(spark):
    frame = weekly_stock(sales(spark, []), inventory(spark, []), calendar(spark), day(0))
    assert [(f.name, f.dataType) for f in frame.schema] == [
        (f.name, f.dataType) for f in WEEKLY_SCHEMA
    ]


def test_unknown_cost_part_drops_the_cost_of_its_row_only(spark):
    rows = sales(spark, [(0, 1, 1, 1, 1, 5, None), (0, 1, 1, 1, 1, 7, 2), (1, 1, 1, 1, 1, 3, 1)])
    assert [r["total_cost"] for r in daily_sales(rows).orderBy("TRANS_DT").collect()] == [9, 4]
    days = check_calendar(calendar(spark)).days
    assert [r["total_cost"] for r in weekly_sales(rows, days).collect()] == [13]


def test_left_weekly_sales_keep_sales_without_a_week(spark):
    rows = sales(spark, [(0, 1, 1, 1, 1), (40, 1, 1, 2, 2)])
    days = check_calendar(calendar(spark)).days
    assert weekly_sales(rows, days).count() == 1
    left = weekly_sales(rows, days, "left").collect()
    assert {r["YR_WK_NUM"]: r["total_sales_qty"] for r in left} == {202301: 1, None: 2}


def test_both_policies_have_the_same_keys(spark):
    rows = inventory(spark, [(n, n % 3, n % 2, n, n, 0) for n in range(28)])
    days = check_calendar(calendar(spark)).days
    keys = [
        set(stock_ops.week_end_stock(rows, days, p).select("YR_WK_NUM", "STORE_KEY", "PROD_KEY")
            .collect())
        for p in ("last_snapshot", "every_snapshot")
    ]
    assert keys[0] == keys[1]
    last = stock_ops.week_end_stock(rows, days)
    assert last.count() == len(keys[0])
