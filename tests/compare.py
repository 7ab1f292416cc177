"""Order-insensitive comparison of a Spark result with DuckDB on the same files."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(" ")
    return value


def normalized(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(con, sql: str, df) -> list[str]:
    """Empty if both sides agree in column names, row count and values."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    left, right = normalized(df.columns, df.collect()), normalized(names, expected)
    if len(left) != len(right):
        return [f"{len(left)} rows != {len(right)}"]
    return [f"{a} != {b}" for a, b in zip(left, right) if a != b][:3]
