"""Token ids as ORC files.

`write_tokens` encodes whole texts and writes one row per document (doc_id, pos, n_tokens, ids) in ascending id order:
ranges of ids per file, sorted within. Ids are integers under ORC's run-length encoding; the files carry row indexes
and a Bloom filter on doc_id, so a lookup of some ids skips stripes and row groups by metadata and a full read runs
stripe by stripe in parallel. `read_tokens` returns rows of the files, of given ids only if wished.
`token_starts` adds to each row the number of ids before it: totals per file, then sums within each file.

A null or empty text holds the end id only. Repeated rows stay separate rows (equal ids in the order of their texts'
hashes), rows without an id come first. An empty table gives an empty folder that reads as no rows. Columns besides
id and text are not read. Only one row per file meets in one task.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.text import remembered, text_batches
from touchline.llm.tokens import WordEncoder
from touchline.sinks.shared import shared_dir

SCHEMA = "doc_id long, pos long, n_tokens long, ids array<int>"
STRIPE_BYTES, ROWS_PER_INDEX, FALSE_POSITIVES = 32 << 20, 10_000, 0.01


def encoder(path: str | None) -> WordEncoder:
    """One per Python worker, so that words learned in a task serve the next."""
    return remembered(("encoder", path), lambda: WordEncoder(path))


def write_tokens(docs: DataFrame, path: str, end_id: int, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    def task(batches):
        words, pos = encoder(vocabulary), 0
        for batch, texts in text_batches(batches):
            ids, n = words.encode(texts, end_id)
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype("i4"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.arange(pos, pos + len(n))), pa.array(n.astype("i8")),
                                              pa.ListArray.from_arrays(offsets, pa.array(ids.astype("i4")))], names=["doc_id", "pos", "n_tokens", "ids"])
            pos += len(n)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("_h"))
    rows = rows.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h").select("doc_id", "text")
    (rows.mapInArrow(task, SCHEMA).write.option("orc.compress", "ZSTD").option("orc.create.index", "true").option("orc.row.index.stride", str(ROWS_PER_INDEX))
     .option("orc.stripe.size", str(STRIPE_BYTES)).option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", str(FALSE_POSITIVES)).orc(path))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """All rows, or those of `doc_ids` (the filter is pushed into the ORC reader)."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def token_starts(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of rows from `read_tokens`; the checksum covers the ids as little-endian unsigned integers."""

    def task(batches):
        for batch in batches:
            ids = batch.column("ids")
            values, at = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_file", "doc_id", "pos", "n_tokens")), pa.array(crc, pa.int64())],
                                             names=["_file", "doc_id", "pos", "n_tokens", "ids_crc32"])

    named = rows.withColumn("_file", F.col("_metadata.file_path"))
    files = named.groupBy("_file").agg(F.sum("n_tokens").alias("_n"), F.min(F.struct("doc_id", "_file")).alias("_first"))
    earlier = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(F.col("_file").alias("_f"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_file").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    summed = (named.select("_file", "doc_id", "pos", "n_tokens", "ids").mapInArrow(task, "_file string, doc_id long, pos long, n_tokens long, ids_crc32 long")
              .withColumn("_sum", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))))
    return summed.join(files, F.col("_file") == F.col("_f")).select("doc_id", (F.col("_base") + F.col("_sum")).alias("start"), "n_tokens", "ids_crc32")


def op10_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/touchline/tokens-{uuid.uuid4().hex}"
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, end_id=2)
    return token_starts(read_tokens(spark, path))
