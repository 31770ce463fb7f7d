"""Run registered queries against their check SQL and print what differs.

    python tests/check_queries.py [folder] [name prefix ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tabloom.plans.registry import ORACLES, QUERIES, TABLES, Tables, load_all  # noqa: E402
from tabloom.session import build_session  # noqa: E402


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return int(value) if value == int(value) and abs(value) < 1e15 else value
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, datetime.datetime) and value.tzinfo:
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(plain(r[i]) for i in order) for r in records]
    return sorted(columns), sorted(rows, key=repr)


def compare(spark, con, folder, name):
    start = time.time()
    df = QUERIES[name](Tables(spark, folder))
    cols, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if name not in ORACLES:
        return ("rows", f"{len(rows)} rows, e.g. {rows[:2]}", took)
    result = con.execute(ORACLES[name])
    ocols, orows = rows_of([d[0] for d in result.description], result.fetchall())
    if cols != ocols:
        return ("COLUMNS", f"{cols} != {ocols}", took)
    if len(rows) != len(orows):
        return ("COUNT", f"{len(rows)} != {len(orows)}\n   {rows[:3]}\n   {orows[:3]}", took)
    bad = [(a, b) for a, b in zip(rows, orows) if a != b]
    if bad:
        return ("VALUES", f"{cols}: {len(bad)} differ, e.g.\n   {bad[0][0]}\n   {bad[0][1]}", took)
    return ("ok", f"{len(rows)} rows", took)


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    load_all()
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad, total = [], 0
    for name in QUERIES:
        if prefixes and not name.startswith(prefixes):
            continue
        total += 1
        try:
            state, note, took = compare(spark, con, folder, name)
        except Exception as e:  # report and go on with the next query
            state, note, took = "ERROR", f"{type(e).__name__}: {str(e)[:700]}", 0.0
        if state not in ("ok", "rows"):
            bad.append(name)
        print(f"{state:8}{took:6.1f}s {name}: {note}", flush=True)
    print(f"{total - len(bad)} of {total} good; bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
