"""Compare a registered query with its SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if value == 0:
            return 0.0
        return int(value) if value.is_integer() and abs(value) < 2**53 else value
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return value.date()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def as_bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    bag = Counter(tuple(plain(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], bag


def differences(frame, connection, sql: str, limit: int = 3) -> str | None:
    """None if both results hold the same rows, else a short description."""
    got_columns, got = as_bag(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    want_columns, want = as_bag([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got == want:
        return None
    extra = list((got - want).elements())
    lacking = list((want - got).elements())
    return (f"{len(extra)} unexpected, {len(lacking)} missing of {sum(want.values())} rows; columns {got_columns}\n"
            f"  unexpected {sorted(map(str, extra))[:limit]}\n  missing    {sorted(map(str, lacking))[:limit]}")
