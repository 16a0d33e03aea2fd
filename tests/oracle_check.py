"""Run registered queries next to their SQL twins and compare whole results.

    python tests/oracle_check.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


def sort_key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(
        (tuple(normal(r[n]) for n in names) for r in df.collect()), key=sort_key
    )


def duck_rows(con, sql):
    cursor = con.execute(sql)
    found = [d[0] for d in cursor.description]
    names = sorted(found)
    places = [found.index(n) for n in names]
    rows = [tuple(normal(r[p]) for p in places) for r in cursor.fetchall()]
    return names, sorted(rows, key=sort_key)


def difference(df, con, sql) -> str | None:
    """None when both give the same rows, else a short description."""
    names, left = spark_rows(df)
    other, right = duck_rows(con, sql)
    if names != other:
        return f"columns {names} vs {other}"
    if len(left) != len(right):
        return f"{len(left)} vs {len(right)} rows; first {left[:1]} vs {right[:1]}"
    for a, b in zip(left, right):
        if a != b:
            return f"{dict(zip(names, a))} vs {dict(zip(names, b))}"
        if [type(x) for x in a] != [type(x) for x in b]:
            return f"types {dict(zip(names, a))} vs {dict(zip(names, b))}"
    return None


def main() -> int:
    from tidecast.session import get_session
    import __spark_entry__ as entry

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = get_session("check", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, run in queries.items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            df = run(spark, args.sf)
            if name in oracles:
                problem = difference(df, con, oracles[name])
                note = "sql"
            else:
                problem, note = None, f"rows={df.count()}"
        except Exception as error:  # report and go on with the next query
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += problem is not None
        took = time.time() - start
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {took:6.2f}s {note} {problem or ''}",
              flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
