"""Long stages that can be killed and started again: work in key ranges, each published once.

A range is a share of the hash of the key. Its rows are written beside the output and published by
one rename, so a range is either whole or absent; the published ranges are the ledger. A second run
reads the ledger and computes the other ranges only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE, FACTS = "key_range", "_ranges"


def run_in_ranges(
    df: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], out: str, ranges: int = 64, wave: int = 8
) -> DataFrame:
    """``work`` over all rows of ``df``, written to ``out`` and read back, with the column ``key_range``.

    ``work`` may change or drop rows and add columns, but keeps ``key``, and a row's result depends on
    rows of the same key alone. ``wave`` ranges are computed by one job; what a killed job has not
    published is computed again. Rows with a null key share the range of the null. A second run
    needs the same key, number of ranges and result columns, else it is an error; an input that has
    changed between the runs is not noticed. Finished runs only read.
    """
    if "," in key or RANGE in df.columns:
        raise ValueError(f"a key may hold no comma and a column may not be called {RANGE}")
    spark = df.sparkSession
    placed = F.pmod(F.xxhash64(F.col(key)), F.lit(ranges)).cast("int")
    schema = work(df).schema
    _same_run(spark, out, f"{key},{ranges},{schema.json()}")
    done = finished_ranges(spark, out)
    missing = [i for i in range(ranges) if i not in done]
    for start in range(0, len(missing), wave):
        part = missing[start : start + wave]
        trial = f"{out}/_trial-{uuid.uuid4().hex}"
        result = work(df.filter(placed.isin(part)))
        result.withColumn(RANGE, placed).write.partitionBy(RANGE).parquet(trial)
        for i in part:
            _publish(spark, f"{trial}/{RANGE}={i}", f"{out}/{RANGE}={i}")
        _delete(spark, trial)
    return spark.read.schema(schema.add(RANGE, "integer")).option("basePath", out).parquet(out)


def finished_ranges(spark: SparkSession, out: str) -> set[int]:
    """The ranges that are published below ``out``; one entry per range."""
    path, fs = _file_system(spark, out)
    if not fs.exists(path):
        return set()
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return {int(n.split("=")[1]) for n in names if n.startswith(f"{RANGE}=")}


def _same_run(spark: SparkSession, out: str, facts: str) -> None:
    """Notes key, ranges and columns of the first run and compares those of later ones."""
    path, fs = _file_system(spark, f"{out}/{FACTS}")
    if fs.exists(path):
        if "\n".join(r["value"] for r in spark.read.text(f"{out}/{FACTS}/*.txt").collect()) != facts:
            raise ValueError(f"{out} holds ranges of another run: other key, number of ranges or columns")
        return
    trial = f"{out}/_trial-{uuid.uuid4().hex}"
    spark.createDataFrame([(facts,)], "value string").coalesce(1).write.text(trial)
    _publish(spark, trial, f"{out}/{FACTS}")


def _publish(spark: SparkSession, source: str, target: str) -> None:
    """One rename; a range without rows becomes an empty folder."""
    path, fs = _file_system(spark, source)
    goal, _ = _file_system(spark, target)
    if not fs.exists(path):
        fs.mkdirs(path)
    if not fs.rename(path, goal):
        raise OSError(f"cannot publish {target}")


def _delete(spark: SparkSession, path: str) -> None:
    found, fs = _file_system(spark, path)
    fs.delete(found, True)


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
