"""Compare registered queries with their SQL in DuckDB, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
from collections import Counter

import duckdb


def connect(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{base}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in value.items())
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return f"{type(value).__name__}:{value}"


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None if both give the same columns and the same rows in any order."""
    result = con.execute(sql)
    want_cols = [d[0] for d in result.description]
    want = _bag(want_cols, result.fetchall())
    if sorted(want_cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(want_cols)}"
    have = _bag(df.columns, [tuple(r) for r in df.collect()])
    if have == want:
        return None
    return (
        f"{sum(have.values())} rows instead of {sum(want.values())}; "
        f"extra {list((have - want).items())[:3]}; missing {list((want - have).items())[:3]}"
    )
