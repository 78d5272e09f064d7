"""The registry: each query by name, with the DuckDB text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verification.fixtures import Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of the fixture views under its own name."""

    def register(build: Callable[[Fixtures], DataFrame]):
        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(Fixtures(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Fractions rounded, so that the order in which an engine adds numbers does not show."""
    return df.select(
        *[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def joined(col: Column | str, sep: str = " ") -> Column:
    return F.array_join(col, sep)
