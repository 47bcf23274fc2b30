"""Run registered queries in Spark and their SQL in DuckDB, and compare the rows.

    python -m tests.compare <folder> [query ...]
"""

from __future__ import annotations

import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (datetime, date)):
        return str(value)
    return value


def sorted_rows(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(plain(r[i]) for i in at) for r in rows]
    return [columns[i] for i in at], sorted(shaped, key=lambda r: [(v is None, str(v)) for v in r])


def compare(spark, con, folder, name, fn, sql):
    """(problem or None, rows, seconds)."""
    start = time.time()
    df = fn(spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return None, len(got), took
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    odd = [f"{d[0]} {d[1]}" for d in result.description
           if str(d[1]) not in ("BIGINT", "DOUBLE", "VARCHAR", "BOOLEAN", "NUMBER", "STRING", "bool")
           and not str(d[1]).startswith(("INTEGER",))]
    want = result.fetchall()
    left, right = sorted_rows(df.columns, got), sorted_rows(names, want)
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}", len(got), took
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}", len(got), took
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"first difference\n   spark {a}\n   duck  {b}", len(got), took
    return (f"types {odd}" if odd else None), len(got), took


def main(folder: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark, con = make_session(), duck(folder)
    sql, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        try:
            problem, rows, took = compare(spark, con, folder, name, fn, sql.get(name))
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem, rows, took = f"{type(e).__name__}: {str(e)[:700]}", -1, 0.0
        bad += problem is not None
        mark = "ok  " if problem is None and name in sql else "rows" if problem is None else "BAD "
        print(f"{mark} {name:28s} {rows:8d} rows {took:7.2f}s {problem or ''}", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
