"""The KPI expressions against the same rules in plain Python, on many value combinations."""

from __future__ import annotations

from itertools import product

from shelfline.functions.kpis import with_kpis

QTY = [None, 0, 1, 7, 50, -2]
AMOUNT = [None, 0.0, 12.5, 99.99, -3.0]
STOCK = [None, 0, 1, 7, 60, -4]
INSTANCES = [None, 0, 1, 3, 7, 9]


def expected(qty, amount, stock, instances):
    low = int(stock is not None and qty is not None and stock < qty)
    price = None if amount is None or not qty else amount / qty
    if not low:
        potential = 0.0
    elif price is None:
        potential = None
    else:
        potential = amount - stock * price
    return {
        "Low_Stock_flg": low,
        "Total_Low_Stock_Impact": None if instances is None else instances + low,
        "avg_sales_price": price,
        "Pot_Low_Stock_Impact": potential,
        "No_Stock_Impact": amount if instances is not None and instances > 0 else 0.0,
        "in_stock_pct": None if instances is None else (1 - instances / 7) * 100,
        "weeks_supply": None if stock is None or not qty else stock / qty,
    }


def test_every_combination(spark):
    names = ["total_sales_qty", "total_sales_amount", "stock_lvl_eow", "No_Stock_Instances"]
    combinations = list(product(QTY, AMOUNT, STOCK, INSTANCES))
    frame = spark.createDataFrame(
        combinations,
        "total_sales_qty bigint, total_sales_amount double, stock_lvl_eow bigint,"
        "No_Stock_Instances bigint",
    )
    rows = with_kpis(frame).collect()
    assert len(rows) == len(combinations)
    for row in rows:
        values = row.asDict()
        want = expected(*(values[n] for n in names))
        assert {k: values[k] for k in want} == want, values
