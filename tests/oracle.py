"""Run a registered query and its SQL counterpart, and compare rows and types."""

from __future__ import annotations

import math
from datetime import date, datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _kind(value):
    if isinstance(value, datetime):
        return "timestamp"
    if isinstance(value, date):
        return "date"
    return type(value).__name__


def _sort_key(row):
    return tuple((v is not None, str(v)) for v in row)


def normalized(columns, rows):
    """Columns by name, rows in a fixed order, each value with its kind."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=_sort_key)


def same(left, right) -> bool:
    if left is None or right is None:
        return left is right
    if isinstance(left, float) and isinstance(right, float):
        return left == right or (math.isnan(left) and math.isnan(right))
    return _kind(left) == _kind(right) and left == right


def compare(spark_df, con, sql) -> str | None:
    """None when equal, else what differs."""
    got_columns, got = normalized(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want_columns, want = normalized([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} instead of {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for g, w in zip(got, want, strict=True):
        if not all(same(a, b) for a, b in zip(g, w, strict=True)):
            return f"row {g} instead of {w}"
    return None
