"""Compare registered queries with their SQL on the given tables."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v + 0.0 if isinstance(v, float) else v


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    got = query(spark, sf_dir)
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(got.columns) != sorted(names):
        return [f"columns {sorted(got.columns)} vs {sorted(names)}"]
    left, right = rows_of(got.columns, got.collect()), rows_of(names, expected.fetchall())
    if len(left) != len(right):
        return [f"{len(left)} rows vs {len(right)}"]
    unlike = [(a, b) for a, b in zip(left, right) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return [f"{len(unlike)} rows differ, first: {str(a)[:300]} vs {str(b)[:300]}" for a, b in unlike[:1]]
