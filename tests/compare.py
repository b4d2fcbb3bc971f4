"""Compares a Spark result with DuckDB's as multisets of rows."""

from __future__ import annotations

import glob
import os
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def assert_same(got: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    want = con.sql(sql)
    assert sorted(got.columns) == sorted(want.columns)
    got_rows = rows_of(got.columns, got.collect())
    want_rows = rows_of(want.columns, want.fetchall())
    missing, extra = want_rows - got_rows, got_rows - want_rows
    assert not missing and not extra, (
        f"missing {sum(missing.values())} {list(missing)[:3]}; "
        f"extra {sum(extra.values())} {list(extra)[:3]}"
    )
    return sum(got_rows.values())
