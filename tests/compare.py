"""Runs a query on both engines and compares columns and rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return f"{v:.6f}".rstrip("0").rstrip(".")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()[:19]
    return str(v)


def connect(sf_dir: str):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def rows_of(columns, rows) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([_plain(r[i]) for i in order] for r in rows)


def assert_same(df, con, sql: str) -> int:
    got = con.execute(sql)
    columns = [x[0] for x in got.description]
    assert sorted(df.columns) == sorted(columns)
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(columns, got.fetchall())
    assert ours == theirs
    return len(ours)
