"""Compare registered queries with their SQL: python tests/oracle_check.py [sf_dir] [name ...]."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def cell(value):
    """One comparable form per value: numbers to 12 significant digits, dates as text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return "NULL" if math.isnan(number) else f"{number + 0.0:.12g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, dt.date) else str(value)


def comparable(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


def differences(frame, con, sql: str) -> str:
    """Empty when both sides hold the same rows."""
    got_names, got = comparable(frame.columns, frame.collect())
    result = con.execute(sql)
    want_names, want = comparable([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns differ: {set(got_names) ^ set(want_names)}"
    if got == want:
        return ""
    extra, missing = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
    return f"{len(got)} rows against {len(want)}\n  {got_names}\n  only Spark {extra}\n  only SQL   {missing}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tillmark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                               "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, built, sql = connect(sf_dir), queries(), oracle_sql()
    failed = []
    for name in sys.argv[2:] or built:
        start = time.time()
        try:
            problem = differences(built[name](spark, sf_dir), con, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += [name] if problem else []
        print(f"{'ok  ' if not problem else 'DIFF'} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
