"""The same queries in ANSI SQL over the given tables, for a second engine to answer.

Sums are cast to BIGINT and divisions guarded, so that types and values can be
compared bit by bit.
"""

from __future__ import annotations

from shelfline.catalog.tables import AS_OF
from shelfline.schemas import FEEDS, WEEKLY_COLUMNS

_SALES = """
sales AS (
  SELECT DATE '2023-01-01'
           + CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 182 AS INTEGER)
           AS TRANS_DT,
         l_suppkey AS STORE_KEY,
         CAST(l_linenumber AS BIGINT) AS PROD_KEY,
         CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS SALES_QTY,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS SALES_AMT,
         floor(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) / 7.0) AS SALES_PRICE,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS DECIMAL(9,0)) AS DECIMAL(18,2)) AS SALES_COST,
         CASE WHEN l_discount <> 0 THEN CAST(l_tax * 100 AS DECIMAL(18,2)) END AS SHIP_COST
  FROM lineitem
)"""

_INVENTORY = """
inventory AS (
  SELECT CAL_DT, STORE_KEY, PROD_KEY,
         CASE WHEN is_out THEN 0 WHEN l_quantity <> 13 THEN l_partkey % 120 END
           AS INVENTORY_ON_HAND_QTY,
         l_partkey % 50 AS INVENTORY_ON_ORDER_QTY,
         CASE WHEN l_quantity <> 7 THEN CAST(is_out AS INTEGER) END AS OUT_OF_STOCK_FLG,
         l_orderkey % 5 AS WASTE_QTY,
         CAST(l_returnflag = 'N' AS INTEGER) AS PROMOTION_FLG,
         CASE WHEN l_linestatus = 'F' THEN CAL_DT + l_linenumber END AS NEXT_DELIVERY_DT
  FROM (
    SELECT *,
           DATE '2023-01-01' + CAST((date_diff('day', DATE '1995-01-01',
             CAST(l_shipdate AS DATE)) + l_orderkey) % 182 AS INTEGER) AS CAL_DT,
           l_suppkey AS STORE_KEY,
           CAST(l_linenumber AS BIGINT) AS PROD_KEY,
           l_returnflag = 'A' AND l_linestatus = 'O' AS is_out
    FROM lineitem
  )
)"""

_CALENDAR = """
calendar AS (
  SELECT CAL_DT,
         CAST(dayofweek(CAL_DT) + 1 AS INTEGER) AS DAY_OF_WK_NUM,
         CAST(yearweek(CAL_DT + 1) AS INTEGER) AS YR_WK_NUM,
         'Trading' AS CAL_TYPE_DESC,
         dayname(CAL_DT) AS DAY_OF_WK_DESC,
         CAST(month(CAL_DT) AS INTEGER) AS MNTH_NUM,
         CAST(quarter(CAL_DT) AS INTEGER) AS QTR_NUM,
         CAST(year(CAL_DT) * 10 + quarter(CAL_DT) AS INTEGER) AS YR_QTR_NUM,
         CAST(year(CAL_DT) * 100 + month(CAL_DT) AS INTEGER) AS YR_MNTH_NUM,
         CAST(year(CAL_DT) AS INTEGER) AS YR_NUM,
         CAST(weekofyear(CAL_DT + 1) AS INTEGER) AS WK_NUM
  FROM (
    SELECT DISTINCT DATE '2023-01-01'
      + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 175 AS INTEGER)
      AS CAL_DT
    FROM orders
  )
)"""

_STORE = """
store AS (
  SELECT s_suppkey AS STORE_KEY, s_name AS STORE_DESC, s_nationkey AS NATION_KEY,
         s_acctbal AS STORE_BALANCE
  FROM supplier
)"""

_PRODUCT = """
product AS (
  SELECT p_partkey AS PROD_KEY, p_name AS PROD_NAME, p_brand AS BRAND_DESC, p_type AS TYPE_DESC,
         p_size AS SIZE_NUM, p_retailprice AS LIST_PRICE
  FROM part
)"""

_WEEKLY_SALES = """
weekly_sales AS (
  SELECT YR_WK_NUM, STORE_KEY, PROD_KEY,
         CAST(sum(SALES_QTY) AS DOUBLE) AS total_sales_qty,
         CAST(sum(SALES_AMT) AS DOUBLE) AS total_sales_amount,
         CAST(sum(SALES_COST + SHIP_COST) AS DOUBLE) AS total_cost
  FROM sales JOIN calendar ON TRANS_DT = calendar.CAL_DT
  GROUP BY ALL
)"""

_DATED = """
dated AS (
  SELECT inventory.*, YR_WK_NUM, DAY_OF_WK_NUM
  FROM inventory JOIN calendar ON inventory.CAL_DT = calendar.CAL_DT
)"""

_NO_STOCK = """
no_stock AS (
  SELECT YR_WK_NUM, STORE_KEY, PROD_KEY,
         CAST(sum(OUT_OF_STOCK_FLG) AS BIGINT) AS No_Stock_Instances
  FROM dated
  GROUP BY ALL
)"""

_EVERY_SNAPSHOT = """
snapshots AS (
  SELECT YR_WK_NUM, STORE_KEY, PROD_KEY,
         INVENTORY_ON_HAND_QTY AS stock_lvl_eow, INVENTORY_ON_ORDER_QTY AS stock_on_order_eow
  FROM dated
)"""

_LAST_SNAPSHOT = """
snapshots AS (
  SELECT YR_WK_NUM, STORE_KEY, PROD_KEY,
         INVENTORY_ON_HAND_QTY AS stock_lvl_eow, INVENTORY_ON_ORDER_QTY AS stock_on_order_eow
  FROM dated
  QUALIFY DAY_OF_WK_NUM = max(DAY_OF_WK_NUM) OVER (PARTITION BY YR_WK_NUM, STORE_KEY, PROD_KEY)
)"""

_WEEKLY = """
weekly AS (
  SELECT *,
         CASE WHEN stock_lvl_eow < total_sales_qty THEN 1 ELSE 0 END AS Low_Stock_flg,
         No_Stock_Instances + Low_Stock_flg AS Total_Low_Stock_Impact,
         total_sales_amount / nullif(total_sales_qty, 0) AS avg_sales_price,
         CASE WHEN Low_Stock_flg = 1 THEN total_sales_amount - stock_lvl_eow * avg_sales_price
              ELSE 0 END AS Pot_Low_Stock_Impact,
         CASE WHEN No_Stock_Instances > 0 THEN total_sales_amount ELSE 0 END AS No_Stock_Impact,
         (1 - No_Stock_Instances / 7) * 100 AS in_stock_pct,
         stock_lvl_eow / nullif(total_sales_qty, 0) AS weeks_supply
  FROM weekly_sales
  JOIN no_stock USING (YR_WK_NUM, STORE_KEY, PROD_KEY)
  JOIN snapshots USING (YR_WK_NUM, STORE_KEY, PROD_KEY)
)"""

# The table names in the order of the order priorities that stand for them.
_TABLE_LIST = "[" + ", ".join(f"'{t}'" for t in FEEDS) + "]"

_ARRIVALS = f"""
arrivals AS (
  SELECT 'landing/' || ({_TABLE_LIST})[CAST(o_orderpriority[1] AS INTEGER)] || '_'
         || strftime(o_orderdate, '%Y-%m-%d') || '.csv' AS path
  FROM orders
)"""

_EXPECTED = f"""
expected AS (
  SELECT run_date, run_date - 1 AS feed_date, table_name,
         'landing/' || table_name || '_' || strftime(run_date - 1, '%Y-%m-%d') || '.csv' AS path
  FROM (
    SELECT run_date, unnest({_TABLE_LIST}) AS table_name
    FROM (
      SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))
               AS DATE) AS run_date
      FROM orders
    )
  )
)"""

_READY = """
ready AS (
  SELECT run_date
  FROM expected
  WHERE path IN (SELECT path FROM arrivals)
  GROUP BY run_date
  HAVING count(*) = 5
)"""


def _query(body: str, *ctes: str) -> str:
    return f"WITH {', '.join(c.strip() for c in ctes)}\n{body}"


_FACTS = (_SALES, _INVENTORY, _CALENDAR)
_STOCKED = (*_FACTS, _WEEKLY_SALES, _DATED, _NO_STOCK)
_WEEKLY_LIST = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" if c.endswith("_eow") else c for c in WEEKLY_COLUMNS
)
_UP_TO_NOW = (
    f"SELECT {_WEEKLY_LIST} FROM weekly WHERE YR_WK_NUM <= "
    f"(SELECT YR_WK_NUM FROM calendar WHERE CAL_DT = DATE '{AS_OF}')"
)
_WEEKLY_STOCK = _query(_UP_TO_NOW, *_STOCKED, _LAST_SNAPSHOT, _WEEKLY)

_DAILY = """
daily AS (
  SELECT TRANS_DT, STORE_KEY, PROD_KEY,
         CAST(sum(SALES_QTY) AS DOUBLE) AS total_sales_qty,
         CAST(sum(SALES_AMT) AS DOUBLE) AS total_sales_amount,
         avg(SALES_PRICE) AS avg_sales_price,
         CAST(sum(SALES_COST + SHIP_COST) AS DOUBLE) AS total_cost
  FROM sales
  GROUP BY ALL
)"""

_TABLE_CTES = {
    "sales": _SALES,
    "inventory": _INVENTORY,
    "calendar": _CALENDAR,
    "store": _STORE,
    "product": _PRODUCT,
}
_CUT_OFF = {
    "sales": f" WHERE TRANS_DT <= DATE '{AS_OF}'",
    "inventory": f" WHERE CAL_DT <= DATE '{AS_OF}'",
}

# Money and quantities read from CSV are compared as DOUBLE.
_AS_READ = {
    "sales": """* REPLACE (CAST(SALES_QTY AS DOUBLE) AS SALES_QTY,
                         CAST(SALES_AMT AS DOUBLE) AS SALES_AMT,
                         CAST(SALES_COST AS DOUBLE) AS SALES_COST,
                         CAST(SHIP_COST AS DOUBLE) AS SHIP_COST)""",
    "inventory": """* REPLACE (CAST(INVENTORY_ON_HAND_QTY AS DOUBLE) AS INVENTORY_ON_HAND_QTY,
                         CAST(INVENTORY_ON_ORDER_QTY AS DOUBLE) AS INVENTORY_ON_ORDER_QTY,
                         CAST(WASTE_QTY AS DOUBLE) AS WASTE_QTY)""",
}

# The feed has fractions and words for some waste.
_FEED_WASTE = "CASE WASTE_QTY WHEN 4 THEN NULL WHEN 3 THEN 2.5 ELSE WASTE_QTY END"
_AS_SCANNED = {
    **_AS_READ,
    "inventory": _AS_READ["inventory"].replace("CAST(WASTE_QTY", f"CAST({_FEED_WASTE}"),
}

# The extracts of AS_OF have no later facts.
_FROM_EXTRACTS = _query(
    _UP_TO_NOW,
    *(c.replace(f"FROM {t}", f"FROM (SELECT * FROM {t}{_CUT_OFF[t]}) {t}") if t else c
      for t, c in ((None, _SALES), (None, _INVENTORY), (None, _CALENDAR),
                   ("sales", _WEEKLY_SALES), ("inventory", _DATED), (None, _NO_STOCK),
                   (None, _LAST_SNAPSHOT), (None, _WEEKLY))),
)

ORACLE: dict[str, str] = {
    **{
        f"scan_{t}": _query(f"SELECT {_AS_SCANNED.get(t, '*')} FROM {t}", cte)
        for t, cte in _TABLE_CTES.items()
    },
    **{
        f"extract_{t}": _query(
            f"SELECT {_AS_READ.get(t, '*')} FROM {t}{_CUT_OFF.get(t, '')}", cte
        )
        for t, cte in _TABLE_CTES.items()
    },
    **{f"dim_{t}": _query(f"SELECT * FROM {t}", _TABLE_CTES[t])
       for t in ("calendar", "store", "product")},
    "extract_row_counts": _query(
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS rows_unloaded FROM {t}{_CUT_OFF.get(t, '')}"
            for t in _TABLE_CTES
        ),
        *_TABLE_CTES.values(),
    ),
    "extract_parts": _query(
        """SELECT count(*) AS rows_read,
                  CAST(sum(9 + 10 + length(STORE_KEY::VARCHAR) + length(PROD_KEY::VARCHAR)
                    + coalesce(length(INVENTORY_ON_HAND_QTY::VARCHAR), 0)
                    + length(INVENTORY_ON_ORDER_QTY::VARCHAR)
                    + coalesce(length(OUT_OF_STOCK_FLG::VARCHAR), 0)
                    + length(WASTE_QTY::VARCHAR) + length(PROMOTION_FLG::VARCHAR)
                    + CASE WHEN NEXT_DELIVERY_DT IS NULL THEN 0 ELSE 10 END) AS BIGINT) AS bytes,
                  0::BIGINT AS too_large, 0::BIGINT AS miscounted,
                  0::BIGINT AS numbers_lacking, true AS enough
           FROM inventory""",
        _INVENTORY,
    ),
    "extract_objects": _query(
        "\nUNION ALL ".join(
            f"""SELECT '{t}' AS table_name, '{t}_{AS_OF}.csv' AS file_name,
                       count(*) AS rows_unloaded, true AS has_header FROM {t}{_CUT_OFF.get(t, '')}"""
            for t in _TABLE_CTES
        ),
        *_TABLE_CTES.values(),
    ),
    "load_stamps": _query(
        "\nUNION ALL ".join(
            f"""SELECT '{t}' AS table_name, '2023-06-01 02:00:00' AS given, true AS is_now,
                       count(*) AS rows FROM {t}"""
            for t in ("calendar", "store", "product")
        ),
        _CALENDAR, _STORE, _PRODUCT,
    ),
    "output_paths": _query(
        """SELECT run_date, role, table_name, 'out/analysis/' || table_name AS path
           FROM (SELECT DISTINCT run_date FROM expected JOIN ready USING (run_date))
           CROSS JOIN (VALUES ('weekly', 'weekly_agg_table'), ('calendar', 'calendar_table'),
                              ('store', 'store_table'), ('product', 'prod_table')) t(role, table_name)""",
        _EXPECTED,
        _ARRIVALS,
        _READY,
    ),
    "date_rejects": _query(
        """SELECT 'inventory' AS table_name, 'CAL_DT' AS column_name,
                  count(*) - count(CAL_DT) AS rejects FROM inventory
           UNION ALL
           SELECT 'inventory', 'NEXT_DELIVERY_DT', count(*) - count(NEXT_DELIVERY_DT)
           FROM inventory""",
        _INVENTORY,
    ),
    "feed_rejects": _query(
        """SELECT 'inventory' AS table_name, unnest(['CAL_DT', 'STORE_KEY', 'PROD_KEY',
                  'INVENTORY_ON_HAND_QTY', 'INVENTORY_ON_ORDER_QTY', 'OUT_OF_STOCK_FLG',
                  'WASTE_QTY', 'PROMOTION_FLG', 'NEXT_DELIVERY_DT']) AS column_name,
                  unnest([0, 0, 0, 0, 0, 0, count_if(WASTE_QTY = 4), 0,
                          count(*) - count(NEXT_DELIVERY_DT)]::BIGINT[]) AS rejects
           FROM inventory""",
        _INVENTORY,
    ),
    "feed_reject_rows": _query(
        f"""SELECT 'inventory' AS table_name, unnest(columns) AS column_name,
                   'inventory_{AS_OF}.csv' AS file, row_text
            FROM (
              SELECT [c FOR c IN [CASE WHEN WASTE_QTY = 4 THEN 'WASTE_QTY' END,
                                  CASE WHEN NEXT_DELIVERY_DT IS NULL THEN 'NEXT_DELIVERY_DT' END]
                      IF c IS NOT NULL] AS columns,
                     concat(CAL_DT, ',', STORE_KEY, ',', PROD_KEY, ',', INVENTORY_ON_HAND_QTY || '.0',
                            ',', INVENTORY_ON_ORDER_QTY, ',', OUT_OF_STOCK_FLG, ',',
                            CASE WASTE_QTY WHEN 4 THEN 'some' WHEN 3 THEN '2.5'
                                           ELSE CAST(WASTE_QTY AS VARCHAR) END,
                            ',', PROMOTION_FLG, ',',
                            coalesce(CAST(NEXT_DELIVERY_DT AS VARCHAR), 'pending')) AS row_text
              FROM inventory
            )""",
        _INVENTORY,
    ),
    "feed_table_name": _query(
        "SELECT path, split_part(split_part(path, '/', -1), '_', 1) AS table_name FROM arrivals",
        _ARRIVALS,
    ),
    "expected_feeds": _query("SELECT * FROM expected", _EXPECTED),
    "missing_feeds": _query(
        "SELECT * FROM expected WHERE path NOT IN (SELECT path FROM arrivals)",
        _EXPECTED,
        _ARRIVALS,
    ),
    "ready_runs": _query(
        """SELECT run_date,
                  '{' || string_agg('"' || table_name || '":"' || path || '"', ','
                                    ORDER BY table_name) || '}' AS manifest
           FROM expected JOIN ready USING (run_date)
           GROUP BY run_date""",
        _EXPECTED,
        _ARRIVALS,
        _READY,
    ),
    "arrival_outcomes": _query(
        """SELECT run_date, 'missing' AS outcome, table_name, path AS detail
           FROM expected WHERE path NOT IN (SELECT path FROM arrivals)
           UNION ALL
           SELECT run_date, 'ready', NULL,
                  '{' || string_agg('"' || table_name || '":"' || path || '"', ','
                                    ORDER BY table_name) || '}'
           FROM expected JOIN ready USING (run_date)
           GROUP BY run_date""",
        _EXPECTED,
        _ARRIVALS,
        _READY,
    ),
    "manifest_paths": _query(
        """SELECT run_date, table_name, 'in/' || path AS path
           FROM expected JOIN ready USING (run_date)""",
        _EXPECTED,
        _ARRIVALS,
        _READY,
    ),
    "daily_sales": _query("SELECT * FROM daily", _SALES, _DAILY),
    "sales_calendar_left": _query(
        """SELECT daily.*, calendar.* RENAME (CAL_DT AS "Date")
           FROM daily LEFT JOIN calendar ON TRANS_DT = CAL_DT""",
        _SALES,
        _CALENDAR,
        _DAILY,
    ),
    "inventory_calendar_left": _query(
        """SELECT inventory.*, cal.*
           FROM inventory
           LEFT JOIN (SELECT * RENAME (CAL_DT AS "Date") FROM calendar) cal
             ON inventory.CAL_DT = cal."Date\"""",
        _INVENTORY,
        _CALENDAR,
    ),
    "weekly_sales": _query("SELECT * FROM weekly_sales", _SALES, _CALENDAR, _WEEKLY_SALES),
    "weekly_sales_left": _query(
        "SELECT * FROM weekly_sales",
        _SALES,
        _CALENDAR,
        _WEEKLY_SALES.replace("sales JOIN", "sales LEFT JOIN"),
    ),
    "inventory_max_day": _query(
        """SELECT YR_WK_NUM, STORE_KEY, PROD_KEY, max(DAY_OF_WK_NUM) AS max_day_of_week
           FROM dated GROUP BY ALL""",
        _INVENTORY,
        _CALENDAR,
        _DATED,
    ),
    "no_stock_weekly": _query(
        "SELECT * FROM no_stock", _INVENTORY, _CALENDAR, _DATED, _NO_STOCK
    ),
    "stock_last_snapshot": _query(
        "SELECT * FROM snapshots", _INVENTORY, _CALENDAR, _DATED, _LAST_SNAPSHOT
    ),
    "stock_every_snapshot": _query(
        "SELECT * FROM snapshots", _INVENTORY, _CALENDAR, _DATED, _EVERY_SNAPSHOT
    ),
    "weekly_sales_no_stock": _query(
        "SELECT * FROM weekly_sales JOIN no_stock USING (YR_WK_NUM, STORE_KEY, PROD_KEY)",
        *_STOCKED,
    ),
    "weekly_kpis": _query(
        f"SELECT {_WEEKLY_LIST} FROM weekly", *_STOCKED, _LAST_SNAPSHOT, _WEEKLY
    ),
    "current_week": _query(
        f"SELECT CAL_DT, YR_WK_NUM FROM calendar WHERE CAL_DT = DATE '{AS_OF}'", _CALENDAR
    ),
    "weekly_stock": _WEEKLY_STOCK,
    "weekly_stock_as_written": _query(_UP_TO_NOW, *_STOCKED, _EVERY_SNAPSHOT, _WEEKLY),
    "published_sql": _query(
        f"""SELECT STORE_KEY, STORE_DESC,
                   count(*) AS weekly_rows,
                   CAST(sum(total_sales_qty) AS BIGINT) AS sales_qty,
                   CAST(sum(Low_Stock_flg) AS BIGINT) AS low_stock_rows,
                   CAST(sum(No_Stock_Instances) AS BIGINT) AS stock_outs,
                   count(DISTINCT YR_WK_NUM) AS weeks,
                   count(DISTINCT BRAND_DESC) AS brands,
                   max(days) AS most_days
            FROM ({_UP_TO_NOW}) JOIN store USING (STORE_KEY) JOIN product USING (PROD_KEY)
            JOIN (SELECT YR_WK_NUM, count(*) AS days FROM calendar GROUP BY ALL)
              USING (YR_WK_NUM)
            GROUP BY ALL""",
        *_STOCKED,
        _LAST_SNAPSHOT,
        _WEEKLY,
        _STORE,
        _PRODUCT,
    ),
    "missing_snapshots": _query(
        f"""SELECT min(CAL_DT) AS first_day, max(CAL_DT) AS last_day,
                   CAST(count(*) AS BIGINT) AS days, STORE_KEY, PROD_KEY
            FROM (
              SELECT *, place - row_number() OVER (PARTITION BY STORE_KEY, PROD_KEY
                                                   ORDER BY place) AS stretch
              FROM until, (SELECT DISTINCT STORE_KEY, PROD_KEY
                           FROM inventory JOIN until USING (CAL_DT)) pairs
              WHERE (until.CAL_DT, STORE_KEY, PROD_KEY) NOT IN
                    (SELECT (CAL_DT, STORE_KEY, PROD_KEY) FROM inventory)
            )
            GROUP BY STORE_KEY, PROD_KEY, stretch""",
        _INVENTORY,
        _CALENDAR,
        f"""until AS (SELECT CAL_DT, row_number() OVER (ORDER BY CAL_DT) AS place
                      FROM calendar WHERE CAL_DT <= DATE '{AS_OF}')""",
    ),
    "stock_without_sales": _query(
        """SELECT YR_WK_NUM, STORE_KEY, PROD_KEY FROM no_stock
           ANTI JOIN weekly_sales USING (YR_WK_NUM, STORE_KEY, PROD_KEY)""",
        *_STOCKED,
    ),
    "sales_without_stock": _query(
        """SELECT YR_WK_NUM, STORE_KEY, PROD_KEY FROM weekly_sales
           ANTI JOIN no_stock USING (YR_WK_NUM, STORE_KEY, PROD_KEY)""",
        *_STOCKED,
    ),
    "ingest_available_now": _WEEKLY_STOCK,
    **{
        f"ingest_{name}": _FROM_EXTRACTS
        for name in ("daily_extracts", "reextracted_day", "unpadded_names")
    },
    "ingest_calendar_extended": _WEEKLY_STOCK,
}
