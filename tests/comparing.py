"""Compare a query with its SQL on the same files."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    return Counter(tuple(_plain(row[index]) for index in order) for row in rows)


def differences(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns and the same multiset of rows."""
    cursor = connection.execute(sql)
    names = [item[0] for item in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} and {sorted(names)}"
    wanted = _rows(names, cursor.fetchall())
    found = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    if wanted == found:
        return None
    return (f"{sum(found.values())} and {sum(wanted.values())} rows; only in query: "
            f"{list((found - wanted).items())[:3]}; only in SQL: {list((wanted - found).items())[:3]}")
