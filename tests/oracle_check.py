"""Compare registered queries with their SQL: python tests/oracle_check.py [sf_dir] [query ...]."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as spark_entry  # noqa: E402
from tallyhouse import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()
TABLES += "documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def rows_by_name(names: list[str], rows: list) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = spark_entry.queries()[name](spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    spark_sec = time.time() - start
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(got_rows)} rows, no SQL, {spark_sec:.1f}s"
    start = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_rows = result.fetchall()
    sql_sec = time.time() - start
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    got, want = rows_by_name(df.columns, got_rows), rows_by_name(names, want_rows)
    if got != want:
        missing, extra = list((want - got).elements())[:2], list((got - want).elements())[:2]
        return False, f"{len(got_rows)} vs {len(want_rows)} rows\n  want {missing}\n  got  {extra}"
    return True, f"{len(got_rows)} rows, spark {spark_sec:.1f}s, sql {sql_sec:.1f}s"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(spark_entry.queries())
    spark = build_session(
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), []
    for name in names:
        try:
            ok, text = compare(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            ok, text = False, f"{type(e).__name__}: {str(e)[:1200]}"
        print("ok  " if ok else "FAIL", name, text, flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} agree", failed)
    return bool(failed)


if __name__ == "__main__":
    raise SystemExit(main())
