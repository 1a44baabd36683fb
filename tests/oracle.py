"""Run a query and its SQL side by side and compare the rows as a bag."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

ROOT = "/root/testdata"


def connection(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(v):
    if v is None or v != v:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(repr(float(v)))
    return str(v)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, folder):
    frame = fn(spark, folder)
    left = _bag(frame.columns, [tuple(r) for r in frame.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    right = _bag(names, cur.fetchall())
    assert sorted(names) == sorted(frame.columns), (names, frame.columns)
    return sum(left.values()), left - right, right - left
