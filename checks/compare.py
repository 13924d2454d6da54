"""Runs registered queries against their SQL counterparts: `python -m checks.compare SF [name ...]`."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks import ORACLE, QUERIES
from meteospark import session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, con, sf: str, name: str) -> str:
    start = time.time()
    df = QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in ORACLE:
        return f"ROWS {name}: {len(got)} rows, {took:.1f}s"
    start = time.time()
    cur = con.execute(ORACLE[name])
    want = cur.fetchall()
    sql_took = time.time() - start
    a = rows_of(df.columns, got)
    b = rows_of([d[0] for d in cur.description], want)
    note = f"{len(got)} rows, spark {took:.1f}s, sql {sql_took:.1f}s"
    if a == b:
        return f"OK   {name}: {note}"
    if a[0] != b[0]:
        return f"FAIL {name}: columns {a[0]} / {b[0]}"
    left, right = set(a[1]), set(b[1])
    only_a, only_b = sorted(left - right), sorted(right - left)
    return (
        f"FAIL {name}: {note}; want {len(want)} rows; differing {len(only_a)}/{len(only_b)}\n"
        f"  cols {a[0]}\n  spark {only_a[:2]}\n  sql   {only_b[:2]}"
    )


def main() -> None:
    sf, names = sys.argv[1], sys.argv[2:]
    spark = session.build(
        "compare",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf)
    bad = 0
    for name in names or list(QUERIES):
        try:
            line = compare(spark, con, sf, name)
        except Exception as error:  # keep going: the report lists every query
            line = f"FAIL {name}: {type(error).__name__} {str(error)[:900]}"
        bad += line.startswith("FAIL")
        print(line, flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
