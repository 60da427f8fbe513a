"""Which files have been seen, and which matches are due.

The manifest is a table of files with length and modification time, numbered by arrival. Listing is done a bounded number
of match folders at a time, by Spark's own parallel listing; what is not in the manifest with the same length and time is
appended to it. A match is due when it has an event document and was never loaded, or its last load failed, or (if asked)
files of it arrived after its last load. Matches whose event document is late wait in the manifest and are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sinks import tables as sink
from ..sinks.shared import input_state
from ..sources.documents import _file_parts

FILES = "root string, combo_id string, provider string, file string, path string, modified timestamp, length bigint, source string, arrival bigint"
LOADS = "combo_id string, arrival bigint, failed boolean"
FOLDERS_AT_A_TIME = 1000
BATCH_BYTES = 4 << 30


def _path(base: str, name: str) -> str:
    return sink.table_path(base, "raw", name)


def _table(spark: SparkSession, base: str, name: str, schema: str) -> DataFrame:
    path = _path(base, name)
    return spark.read.schema(schema).parquet(path) if input_state(spark, path)[0] else spark.createDataFrame([], schema)


def files(spark: SparkSession, base: str) -> DataFrame:
    return _table(spark, base, "_manifest", FILES)


def loads(spark: SparkSession, base: str) -> DataFrame:
    return _table(spark, base, "_loads", LOADS)


def described(listed: DataFrame) -> DataFrame:
    """Listed files (path, modified, length) that lie in a match folder, with match, provider and name."""
    return listed.select("path", "modified", "length", *_file_parts(F.col("path"))).filter("combo_id <> ''")


def unseen(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Files that are new or have changed."""
    return listed.join(known.select("path", "modified", "length"), ["path", "modified", "length"], "left_anti")


def _folders(spark: SparkSession, root: str) -> Iterator[str]:
    """The folders right under `root`, as the file system hands them out."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatusIterator(where)
    while found.hasNext():
        entry = found.next()
        if entry.isDirectory():
            yield entry.getPath().toString()


def next_arrival(spark: SparkSession, base: str) -> int:
    return (files(spark, base).agg(F.max("arrival")).first()[0] or 0) + 1


def discover(spark: SparkSession, root: str, base: str, at_a_time: int = FOLDERS_AT_A_TIME) -> int:
    """Adds new and changed files under `root` to the manifest; returns the number of the arrival."""
    known, folders, arrival = files(spark, base), _folders(spark, root), next_arrival(spark, base)
    while some := list(islice(folders, at_a_time)):
        listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(some)
                  .select(F.url_decode("path").alias("path"), F.col("modificationTime").alias("modified"), "length"))
        add(unseen(described(listed), known), root, base, "listing", arrival)
    return arrival


def add(found: DataFrame, root: str, base: str, source: str, arrival: int) -> None:
    rows = found.withColumns({"root": F.lit(root.rstrip("/")), "source": F.lit(source), "arrival": F.lit(arrival).cast("bigint")})
    rows.select("root", "combo_id", "provider", "file", "path", "modified", "length", "source", "arrival").write.mode("append").parquet(_path(base, "_manifest"))


def due(seen: DataFrame, loaded: DataFrame, changed: bool = False, force: bool = False) -> DataFrame:
    """combo_id, arrival (of its last file) and bytes of the matches to load."""
    event = (F.col("provider") == "events") & F.col("file").rlike(r"^events_\d+$")
    latest = seen.groupBy("combo_id", "path").agg(F.max("arrival").alias("arrival"), F.max_by("length", "arrival").alias("length"), F.first(event).alias("event"))
    matches = latest.groupBy("combo_id").agg(F.max("arrival").alias("arrival"), F.sum("length").alias("bytes"), F.max("event").alias("event")).filter("event").drop("event")
    if force:
        return matches
    last = loaded.groupBy("combo_id").agg(F.max_by(F.struct("arrival", "failed"), F.struct("arrival", ~F.col("failed"))).alias("last"))
    again = F.col("last").isNull() | F.col("last.failed")
    if changed:
        again = again | (F.col("arrival") > F.col("last.arrival"))
    return matches.join(last, "combo_id", "left").filter(again).select("combo_id", "arrival", "bytes")


def portions(found: DataFrame, batch_bytes: int = BATCH_BYTES) -> Iterator[list[tuple[str, int]]]:
    """The due matches in portions of about `batch_bytes`: (combo_id, arrival). One portion at a time is on the driver."""
    total = found.agg(F.sum("bytes")).first()[0]
    if total is None:
        return
    n = max(1, -(-total // batch_bytes))
    for i in range(n):
        some = [(r.combo_id, r.arrival) for r in found.filter(F.pmod(F.xxhash64("combo_id"), F.lit(n)) == i).collect()]
        if some:
            yield some


def note(spark: SparkSession, base: str, tried: list[tuple[str, int]], good: DataFrame) -> None:
    """Records the outcome of a portion: the matches of `good` are loaded up to their arrival, the others failed."""
    rows = spark.createDataFrame(tried, "combo_id string, arrival bigint").join(good.select("combo_id", F.lit(False).alias("_ok")).distinct(), "combo_id", "left")
    rows.select("combo_id", "arrival", F.coalesce("_ok", F.lit(True)).alias("failed")).coalesce(1).write.mode("append").parquet(_path(base, "_loads"))
