"""Row-for-row comparison of a Spark result with an oracle result."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def normalized(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides agree in names, row count and values."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    actual = [tuple(r) for r in df.collect()]
    out = []
    if len(actual) != len(expected):
        out.append(f"rows {len(actual)} != {len(expected)}")
    a, b = normalized(df.columns, actual), normalized(names, expected)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        out.append(f"{sorted(df.columns)}: {len(only_a)} vs {len(only_b)} differ: {only_a[:3]} / {only_b[:3]}")
    return out
