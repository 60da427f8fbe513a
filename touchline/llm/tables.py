"""Joins that look at the size of their smaller side first, and Arrow batches of bounded size."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sinks import shared
from touchline.sinks.shared import job_tables, shared_dir

BROADCAST_BYTES = 64 << 20
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def sized(small: DataFrame, row_bytes: Column | int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`small`, a written table, marked for broadcast if its measured size is within `limit`; else it is left to a shuffled join."""
    cost = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    total = small.agg(F.sum(cost.cast("long"))).first()[0] or 0
    return F.broadcast(small) if total <= limit else small


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Rows go to Python in batches of at most `rows`, in this session from now on: the default of 10,000 texts may fill an executor."""
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= rows:
        spark.conf.set(BATCH_SETTING, rows)


def one_id_a_text(docs: DataFrame, id_col: str, text_col: str, name: str, missing: bool) -> tuple[DataFrame, bool]:
    """Adds `name`, the id where only one row has it; rows of a repeated id get one id for each different text, below all others.
    So do rows without an id, if `missing`; else they have none. Tells whether there were such rows."""
    key, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    again = docs.groupBy(key.alias("__id")).agg(F.count("*").alias("n")).where("(n > 1 and __id is not null)" + (" or __id is null" if missing else ""))
    again = shared.written(again.select("__id"), "repeated-ids")
    if again.isEmpty():
        return docs.withColumn(name, key), False
    digest = F.sha2(F.coalesce(F.concat(F.lit("t"), text), F.lit("")), 256)
    twice = docs.join(sized(again, 16), key.eqNullSafe(F.col("__id")), "left_semi").select(key.alias("__id"), digest.alias("__text")).distinct()
    least = min(0, docs.agg(F.min(key)).first()[0] or 0)
    names = sized(shared.written(twice.withColumn("__uid", F.lit(least - 1).cast("long") - F.monotonically_increasing_id()), "names"), 96)
    named = docs.join(names, key.eqNullSafe(F.col("__id")) & (digest == F.col("__text")), "left")
    return named.withColumn(name, F.coalesce("__uid", key)).drop("__id", "__text", "__uid"), True


def result_of(spark: SparkSession, work: Callable[[], DataFrame], name: str) -> DataFrame:
    """Writes the rows of `work` and deletes the intermediate tables it made; returns the written table.

    Arrow batches are small meanwhile; the session gets its own setting back."""
    path, rows = f"{shared_dir(spark)}/touchline/{name}-{uuid.uuid4().hex}", spark.conf.get(BATCH_SETTING)
    small_batches(spark)
    try:
        with job_tables(spark):
            made = work()
            schema = made.schema
            made.write.parquet(path)
    finally:
        spark.conf.set(BATCH_SETTING, rows)
    return spark.read.schema(schema).parquet(path)



@contextmanager
def working_tables() -> Iterator[list[str]]:
    """Collects the paths of the intermediate tables written inside; they stay until `dropped`."""
    paths: list[str] = []
    shared._JOBS.append(paths)
    try:
        yield paths
    finally:
        shared._JOBS.pop()


def dropped(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    paths.clear()
