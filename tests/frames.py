"""Small hand-made feeds."""

from __future__ import annotations

from datetime import date, timedelta

from shelfline.schemas import CALENDAR_TYPES, INVENTORY_TYPES, SALES_TYPES

SUNDAY = date(2023, 1, 1)


def day(n: int) -> date:
    """The n-th day of the hand-made calendar, which starts on a Sunday."""
    return SUNDAY + timedelta(days=n)


def _frame(spark, types, dates, rows):
    schema = ", ".join(
        f"{n} {'date' if n in dates else t.simpleString()}" for n, t in types.items()
    )
    return spark.createDataFrame([tuple(r.get(n) for n in types) for r in rows], schema)


def calendar(spark, days=28, doubled=()):
    rows = [
        {
            "CAL_DT": day(n),
            "DAY_OF_WK_NUM": n % 7 + 1,
            "YR_WK_NUM": 202301 + n // 7,
            "CAL_TYPE_DESC": "Trading",
        }
        for n in [*range(days), *doubled]
    ]
    return _frame(spark, CALENDAR_TYPES, ["CAL_DT"], rows)


def sales(spark, rows):
    """Rows of (day number, store, product, quantity, amount[, cost, shipping])."""
    full = []
    for n, store, prod, qty, amount, *costs in rows:
        cost, shipping = costs or (0, 0)
        full.append(
            {
                "TRANS_DT": day(n),
                "STORE_KEY": store,
                "PROD_KEY": prod,
                "SALES_QTY": _money(qty),
                "SALES_AMT": _money(amount),
                "SALES_PRICE": 1.0,
                "SALES_COST": _money(cost),
                "SHIP_COST": _money(shipping),
            }
        )
    return _frame(spark, SALES_TYPES, ["TRANS_DT"], full)


def inventory(spark, rows):
    """Rows of (day number, store, product, on hand, on order, out of stock)."""
    full = [
        {
            "CAL_DT": day(n),
            "STORE_KEY": store,
            "PROD_KEY": prod,
            "INVENTORY_ON_HAND_QTY": _money(hand),
            "INVENTORY_ON_ORDER_QTY": _money(order),
            "OUT_OF_STOCK_FLG": out,
        }
        for n, store, prod, hand, order, out in rows
    ]
    return _frame(spark, INVENTORY_TYPES, ["CAL_DT", "NEXT_DELIVERY_DT"], full)


def _money(value):
    from decimal import Decimal

    return None if value is None else Decimal(str(value))
