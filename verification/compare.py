"""Side-by-side check of a registered query against its DuckDB text."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_over(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else format(value + 0.0, ".9g")
    return str(value)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    names = [columns[i].lower() for i in order]
    return names, sorted(tuple(cell(r[i]) for i in order) for r in rows)


def differences(spark: SparkSession, folder: str, build, sql: str) -> list[str]:
    """What differs; empty when both engines agree."""
    df = build(spark, folder)
    names, got = canonical(df.columns, df.collect())
    result = duckdb_over(folder).execute(sql)
    expected_names, expected = canonical([d[0] for d in result.description], result.fetchall())
    problems = []
    if names != expected_names:
        problems.append(f"columns {names} against {expected_names}")
    if len(got) != len(expected):
        problems.append(f"{len(got)} rows against {len(expected)}")
    for ours, theirs in zip(got, expected):
        if ours != theirs:
            problems.append(f"row {str(ours)[:600]} against {str(theirs)[:600]}")
            break
    return problems
