"""Spark results beside those of the SQL engine, row by row."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def _run(sql: str, sf_dir: str):
    con = duckdb.connect()
    con.execute("set threads = 8")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    found = con.execute(sql)
    return [d[0] for d in found.description], found.fetchall()


def oracle_rows(sql: str, sf_dir: str):
    names, rows = _run(sql, sf_dir)
    return sorted(names), _rows(names, rows)


def oracle_list(sql: str, sf_dir: str):
    """Names and rows in the order in which they come."""
    names, rows = _run(sql, sf_dir)
    return names, [tuple(map(plain, row)) for row in rows]


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])
