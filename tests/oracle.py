"""Compare a query with its oracle: names, row count and order-insensitive values."""

from __future__ import annotations

import math
from datetime import date, datetime
from pathlib import Path

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql) -> tuple[int, str]:
    """(row count, difference or '')"""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return 0, f"columns {sorted(df.columns)} != {sorted(names)}"
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return len(actual), f"{len(actual)} rows != {len(expected)}"
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    return len(actual), f"{len(different)} rows differ, first {different[0]}" if different else ""
