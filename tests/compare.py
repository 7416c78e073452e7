"""Compare Spark results with DuckDB results, row for row without order."""

from __future__ import annotations

import datetime
import math

import duckdb

from paperloom.plans.derived import BASE


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    got = df.collect()
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    a, b = _rows(df.columns, got), _rows(names, want.fetchall())
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}: {[r for r in a if r not in b][:2]} {[r for r in b if r not in a][:2]}"
    if not a:
        return "both are empty"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ: {wrong[:2]}" if wrong else None
