"""Runs a registered query and its SQL side by side and compares rows as multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return tuple(value) if isinstance(value, list) else value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df, sql: str, connection: duckdb.DuckDBPyConnection) -> str | None:
    """Nothing when both sides agree, else what differs."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    theirs = _rows(names, expected.fetchall())
    ours = _rows(df.columns, df.collect())
    if ours != theirs:
        return f"{ours.total()} rows, {theirs.total()} expected; only here {list((ours - theirs))[:2]}, only there {list((theirs - ours))[:2]}"
    return None
