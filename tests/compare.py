"""Run a query on Spark and its SQL on DuckDB and compare all rows exactly."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "string": "VARCHAR",
    "decimal(18,2)": "DECIMAL(18,2)",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def oracle_rows(con, sql: str) -> tuple[dict[str, str], Counter]:
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    types = {row[0]: row[1] for row in described}
    names = list(types)
    order = [names.index(n) for n in sorted(names)]
    rows = con.execute(sql).fetchall()
    return types, Counter(tuple(r[i] for i in order) for r in rows)


def spark_rows(frame) -> tuple[dict[str, str], Counter]:
    types = {name: TYPE_NAMES.get(kind, kind) for name, kind in frame.dtypes}
    assert len(types) == len(frame.columns), "column names must be unique"
    return types, Counter(tuple(r) for r in frame.select(sorted(frame.columns)).collect())


def difference(spark: SparkSession, con, query, sql: str, sf_dir: str) -> str | None:
    """None if both engines agree on names, types and rows."""
    types, rows = spark_rows(query(spark, sf_dir))
    want_types, want = oracle_rows(con, sql)
    if types != want_types:
        return f"types {sorted(set(types.items()) ^ set(want_types.items()))}"
    if rows != want:
        return (
            f"{rows.total()} rows, expected {want.total()}; "
            f"extra {list((rows - want).items())[:2]}, lacking {list((want - rows).items())[:2]}"
        )
    return None if want else "no rows to compare"


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry

    from conftest import build_session

    spark = build_session()
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or oracle:
        start = time.time()
        found = difference(spark, con, queries[name], oracle[name], sf_dir)
        failed += found is not None
        print(f"{'FAIL' if found else 'ok':4} {name:28} {time.time() - start:6.2f}s {found or ''}",
              flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    sys.exit(main(sys.argv[1], sys.argv[2:]))
