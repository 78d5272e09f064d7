"""Session helpers: a local session for tests and benches, and the checkpoint folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_SCRATCH: list[str] = []
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int = 8, app: str = "gleanwell") -> SparkSession:
    """A single-JVM session. Cluster jobs bring their own session and settings."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a scratch folder of its own; on a
    cluster a missing setting is an error, since executors could not read such a folder.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(shared)
        return
    if sc.getCheckpointDir() is not None:
        return
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="gleanwell-checkpoint-")
    atexit.register(shutil.rmtree, local, True)
    sc.setCheckpointDir(local)


def scratch_folder(spark: SparkSession, name: str = "stage") -> str:
    """A new path below the shared folder; ``clear_scratch`` deletes what was written there."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables that this process has written, once their results are out."""
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Exchanges of the queries planned inside are deleted when each has ended, not when the driver collects garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialized(df: DataFrame, folder: str | None = None, mode: str = "error") -> DataFrame:
    """The same rows, written once to ``folder`` or to the shared folder, and read back.

    For results that several later steps read. Lineage ends at the files, so a lost executor
    costs no recomputation, each later step reads only the columns it needs, and the exchanges
    behind the rows are deleted. In mode ``append`` the rows join those already in the folder.
    """
    path = folder or scratch_folder(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a saved table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path on it, for use inside tasks."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))
