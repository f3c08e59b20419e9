"""Spark-vs-DuckDB comparison used by the tests and by hand:
row count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from txnscore.views import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 9))
    if isinstance(v, int):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], len(rows), h, lines


def duck(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def compare(spark, name: str, fn, sql: str, sf_dir: str):
    sc, sr = spark_rows(fn(spark, sf_dir))
    dc, dr = duck(sf_dir, sql)
    a, b = digest(sc, sr), digest(dc, dr)
    ok = a[0] == b[0] and a[1] == b[1] and a[2] == b[2]
    detail = ""
    if not ok:
        diff_a = sorted(set(a[3]) - set(b[3]))[:3]
        diff_b = sorted(set(b[3]) - set(a[3]))[:3]
        detail = f"cols {a[0]} vs {b[0]}; rows {a[1]} vs {b[1]}; spark-only {diff_a}; duck-only {diff_b}"
    return ok, a[1], detail
