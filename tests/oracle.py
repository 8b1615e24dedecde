"""Compare registered queries with their SQL texts on the given tables.

    python tests/oracle.py [folder] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def cell(value):
    """Value in a form that differs if type family or value differ."""
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else ("float", value + 0.0)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("time", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("list", tuple(cell(v) for v in value))
    if isinstance(value, dict):
        return ("struct", tuple((k, cell(v)) for k, v in value.items()))
    return ("text", str(value))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(cell(r[i]) for i in order) for r in rows
    )


def compare(spark, con, name: str, folder: str) -> tuple[bool, str, float]:
    from tideline.catalogue import QUERIES, SQL_TEXTS

    start = time.time()
    df = QUERIES[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in SQL_TEXTS:
        return True, f"{len(got)} rows, no SQL", took
    want = con.execute(SQL_TEXTS[name])
    names = [d[0] for d in want.description]
    left, right = canonical(df.columns, got), canonical(names, want.fetchall())
    if left == right:
        return True, f"{len(got)} rows", took
    if left[0] != right[0]:
        return False, f"columns {left[0]} / {right[0]}", took
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    text = f"{len(got)} / {len(right[1])} rows, {len(bad)} differ"
    for a, b in bad[:3]:
        diff = [(c, x, y) for c, x, y in zip(left[0], a, b) if x != y]
        text += f"\n    {diff}"
    return False, text, took


def main() -> int:
    from tideline.catalogue import QUERIES
    from tideline.session import get_spark

    args = sys.argv[1:]
    folder = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = get_spark(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                              "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("OFF")
    con, wrong = connect(folder), 0
    for name in args or QUERIES:
        try:
            ok, text, took = compare(spark, con, name, folder)
        except Exception as e:  # report and go on
            ok, text, took = False, f"{type(e).__name__}: {str(e)[:600]}", 0.0
        wrong += not ok
        print(f"{'ok  ' if ok else 'BAD '} {took:6.1f}s {name}: {text}", flush=True)
    print(f"{wrong} wrong")
    return wrong


if __name__ == "__main__":
    sys.exit(main() > 0)
