"""Rows of a query and of its SQL twin in comparable form."""

from __future__ import annotations

import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(folder):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{name}'")
    return con


def _plain(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int | float):
        return repr(float(v))
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in data)
