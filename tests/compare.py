"""Compare a registered query with its SQL: columns by name, rows as multisets, values exactly."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> tuple[int, list, list]:
    """Row count, rows only Spark has, rows only the SQL has."""
    relation = connection.sql(sql)
    assert sorted(df.columns) == sorted(relation.columns), (df.columns, relation.columns)
    ours = _rows(df.columns, df.collect())
    theirs = _rows(relation.columns, relation.fetchall())
    return sum(ours.values()), list((ours - theirs).items()), list((theirs - ours).items())
