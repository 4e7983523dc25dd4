"""Runs registered queries next to their SQL in DuckDB and reports differences.

    python -m tests.oracle_check [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(plain(x) for x in v.values()) + "}"
    return str(v)


# Declared types on both sides; anything else is compared by name as it is.
SPARK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
               "date": "DATE", "timestamp": "TIMESTAMP"}


def differences(df, con, sql: str) -> list[str]:
    """Empty when rows, column names and values agree whatever the row order."""
    left_names = df.columns
    left = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    right_names = [c[0] for c in cursor.description]
    problems: list[str] = []
    described = list(cursor.description)
    right = cursor.fetchall()
    if sorted(left_names) != sorted(right_names):
        return [f"columns {sorted(left_names)} != {sorted(right_names)}"]
    order_left = [left_names.index(n) for n in sorted(left_names)]
    order_right = [right_names.index(n) for n in sorted(left_names)]
    declared = {n: SPARK_TYPES.get(t, t) for n, t in df.dtypes}
    for c in described:
        if declared[c[0]] != str(c[1]):
            problems.append(f"{c[0]}: type {declared[c[0]]} != {c[1]}")
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    a = sorted(tuple(plain(r[i]) for i in order_left) for r in left)
    b = sorted(tuple(plain(r[i]) for i in order_right) for r in right)
    if a != b:
        extra, missing = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        problems.append(f"{sorted(left_names)}\n   spark only {extra}\n   sql only {missing}")
    return problems


def main(argv: list[str]) -> int:
    from ledgerlens.plans.registry import ORACLES, QUERIES
    from tests.conftest import make_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:])
    spark, con, bad = make_session(), duck(sf_dir), 0
    for name, query in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problems = differences(df, con, ORACLES[name]) if name in ORACLES else [f"no sql, {df.count()} rows"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        failed = bool(problems) and not problems[0].startswith("no sql")
        bad += failed
        print(f"{'BAD ' if failed else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n   ", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
