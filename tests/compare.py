"""Run registered queries against DuckDB on the same files."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 9) + 0.0
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    if type(value).__name__ == "Decimal":
        return ("dec", str(value))
    return str(value)


def _rows(rows, order):
    plain = [tuple((type(v).__name__ if v is not None else "", _plain(v)) for v in (row[i] for i in order)) for row in rows]
    return sorted(plain, key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when both results hold the same columns and rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    got = [tuple(r) for r in df.collect()]
    if len(got) != len(expected):
        return f"{len(got)} rows vs {len(expected)}"
    columns = sorted(names)
    a = _rows(got, [df.columns.index(c) for c in columns])
    b = _rows(expected, [names.index(c) for c in columns])
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"{columns}: {x} vs {y}"
    return None if expected else "no rows"
