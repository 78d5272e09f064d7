"""Shared pieces of the corpus operators: saved tables, words and files in the shared folder."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwell.session import CLEANUP, dropped, filesystem, scratch_folder, shuffles_freed  # noqa: F401

SPACE = "[\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the checkpoint folder that the cluster shares."""
    return scratch_folder(spark, name)


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """The rows written once to the shared folder and read back, which ends their lineage and frees their exchanges."""
    path = shared_folder(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a text column; null gives empty bytes."""
    values = batch.column(column).cast(pa.large_binary()).to_pylist()
    return [v or b"" for v in values]


def parts(batches, rows: int = 512):
    """Batches cut to a few rows, so that very long texts are not unpacked all at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_list(text: Column | str) -> Column:
    """The words of a text in order; null gives an empty list."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def count_of(text: Column, characters: str) -> Column:
    """How many characters of a text are in a class such as ``A-Z``: what is left without the others."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


def text_key(text: Column | str) -> Column:
    """A 64-bit digest of a text that, beside a document's id, tells rows of one id apart."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
