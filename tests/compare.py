"""Run registered queries and their SQL checks side by side.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def database(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def same(spark, con, query, sql, folder):
    """Empty string when both give the same rows, else what differs."""
    df = query(spark, folder)
    columns, rows = canon(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names, expected = canon([c[0] for c in result.description], result.fetchall())
    if columns != names:
        return f"columns {sorted(set(columns) ^ set(names))}"
    if len(rows) != len(expected):
        return f"rows {len(rows)} != {len(expected)}"
    for got, want in zip(rows, expected):
        if got != want:
            diff = [(n, g, w) for n, g, w in zip(columns, got, want) if g != w]
            return f"values {diff[:4]} in {got[:4]}"
    return "" if rows else "no rows on both sides"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from linepulse.session import line_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = line_session(
        "compare",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, bad = database(folder), oracle_sql(), 0
    for name, query in queries().items():
        if args and name not in args:
            continue
        begin = time.time()
        try:
            found = same(spark, con, query, checks[name], folder) if name in checks else (
                f"no check, {query(spark, folder).count()} rows"
            )
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        print(f"{'ok  ' if not found else 'DIFF'} {time.time() - begin:6.1f}s {name} {found}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
