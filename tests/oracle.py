"""Compare registered queries with DuckDB on the driver's tables."""

from __future__ import annotations

import math
from datetime import date, datetime

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    """One spelling for equal values of both engines."""
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (datetime, pd.Timestamp)):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in records),
        key=lambda row: tuple((v is None, str(type(v)), v if v is not None else "") for v in row),
    )


def expected(connection, sql):
    found = connection.execute(sql)
    columns = [c[0] for c in found.description]
    return sorted(columns), rows(found.fetchall(), columns), {c[0]: str(c[1]) for c in found.description}


def actual(frame):
    return sorted(frame.columns), rows(frame.collect(), frame.columns), dict(frame.dtypes)
