"""Incremental loading as a stream of new files.

Each run takes the files that arrived since the last one and stops. A batch goes into the manifest first, once: a batch that
is repeated after a failure finds its number there. Then the matches that are due are loaded; one whose event document is
late waits in the manifest, and a match that is delivered again is a reload.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans import manifest
from ..plans.load import audit_path, load_due


def new_files(spark: SparkSession, root: str) -> DataFrame:
    """Stream of files: path, time and length; contents are read when a match is due, whole matches at a time."""
    schema = "value string"
    return (spark.readStream.schema(schema).option("wholetext", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.json").format("text").load(root)
            .select(F.url_decode("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_size").alias("length")))


def take(batch: DataFrame, batch_id: int, root: str, base: str, source: str, only: list[str] | None = None) -> None:
    """Enters a batch of files and loads what is due."""
    spark = batch.sparkSession
    name = f"{source}#{batch_id}"
    if manifest.files(spark, base).filter(F.col("source") == name).isEmpty():
        manifest.add(manifest.described(batch), root, base, name, manifest.next_arrival(spark, base))
    audit = load_due(spark, root, base, only=only, changed=True)
    if not audit.filter("error IS NOT NULL AND table <> 'documents'").isEmpty():
        raise RuntimeError(f"a table failed, see {audit_path(base)}")


def ingest(spark: SparkSession, root: str, base: str, checkpoint: str, only: list[str] | None = None) -> None:
    """Loads what is new and returns when it is done."""
    query = (new_files(spark, root).writeStream.foreachBatch(lambda batch, batch_id: take(batch, batch_id, root, base, checkpoint, only))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
