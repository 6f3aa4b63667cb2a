"""Comparing a query with its SQL counterpart."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def views(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def as_multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(frame, connection, sql: str) -> str | None:
    """Nothing if both results are the same rows under the same names, else what differs."""
    result = connection.execute(sql)
    expected_columns = [c[0] for c in result.description]
    if sorted(frame.columns) != sorted(expected_columns):
        return f"columns {sorted(frame.columns)} != {sorted(expected_columns)}"
    expected = as_multiset(expected_columns, result.fetchall())
    found = as_multiset(frame.columns, (tuple(r) for r in frame.collect()))
    if found == expected:
        return None
    missing, extra = expected - found, found - expected
    return (
        f"{sum(expected.values())} rows expected, {sum(found.values())} found; "
        f"missing {list(missing)[:3]}, unexpected {list(extra)[:3]}"
    )
