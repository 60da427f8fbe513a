"""Intermediate tables in the cluster's shared folder.

A small table that many plans read (a crosswalk, season totals) is written
once and read back: its lineage ends there, a lost executor only re-reads
files, and the optimiser sees its size.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_JOBS: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`. Only a local session may do without: it gets a folder that goes when Python ends."""
    path = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {SETTING} to a folder that driver and executors of {master} share")
        path = tempfile.mkdtemp(prefix="touchline-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Writes the rows under the shared folder, a folder for each value of `by` if given, and returns the written table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/touchline/{name}-{uuid.uuid4().hex}"
    if _JOBS:
        _JOBS[-1].append(path)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Changes when the files of `path` do: their number, total length and the time of the last change."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        return 0, 0, 0
    total = files.getContentSummary(where)
    return total.getFileCount(), total.getLength(), files.getFileStatus(where).getModificationTime()


@contextmanager
def job_tables(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end, so nothing lazy that reads them may leave the block."""
    _JOBS.append([])
    try:
        yield
    finally:
        for path in _JOBS.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
