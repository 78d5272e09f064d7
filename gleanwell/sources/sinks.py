"""Writers. All of them write one file per task; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.sources.tables import EMBEDDINGS, EMBEDDINGS_COUNTED


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nested records as JSON lines."""
    df.write.mode(mode).json(path)


def write_high_quality_users(scores: DataFrame, path: str, threshold: float = 7.0) -> None:
    """Two-column CSV with a header: ids and scores from the threshold up."""
    high = scores.filter(F.col("quality_score") >= threshold).select("fid", "quality_score")
    high.write.mode("overwrite").option("header", True).csv(path)


def write_embeddings(df: DataFrame, path: str, counted: bool = True) -> None:
    """Embedding table with fixed column types, snappy-compressed."""
    schema = EMBEDDINGS_COUNTED if counted else EMBEDDINGS
    typed = [F.col(name).cast(kind).alias(name) for name, kind in
             (column.split(" ", 1) for column in schema.split(", "))]
    df.select(*typed).write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Create a catalogue table from a result."""
    df.write.mode(mode).saveAsTable(name)
