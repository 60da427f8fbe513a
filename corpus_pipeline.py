"""From raw documents to packed sequences: five stages, each over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns the columns of `documents`; the last returns packed pieces. A stage's
input is a table that can be read several times.

| stage | what goes or changes |
|---|---|
| language | documents without a letter or without a language that stands out go; a missing `lang` is filled in |
| lines | lines that repeat an earlier one, up to two edits, go; so do documents left without a word |
| near_duplicates | one document of each group of five-word Jaccard similarity 0.8 or more stays, the one with the smallest id |
| mixing | documents are drawn to their source's target: not at all, once or twice, one per source in part |
| packing | windows of 2048 token ids |

Null texts and empty tables pass through all stages without a failure and end with no rows for them. Columns besides those
of `documents` are dropped by the first stage. Texts of any length are worked on whole. Different texts of one id are
different documents everywhere; rows that have id and text in common are copies, of which the third stage keeps one. Of
equally good candidates the one with the smaller id stays, rows of repeated or missing ids before all others.

The working tables of a stage go when the next one begins, as its result has been written by then.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import jaccard, langid, lines, mixing, packing
from touchline.llm.tables import dropped, one_id_a_text, sized, working_tables
from touchline.sinks.shared import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_LANGUAGE_SCORE = 0.01
DUPLICATE_WORDS, DUPLICATE_PCT = 5, 80


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    found = langid.identified(docs, langid.training_text(docs))
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = lines.dedup_lines(docs.select(*COLUMNS))
    return _with_length(done.where(F.col("text").rlike(mixing.WORD)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named, _ = one_id_a_text(docs.select(*COLUMNS), "doc_id", "text", "uid", missing=True)
    found = jaccard.jaccard_components(named, id_col="uid", size=DUPLICATE_WORDS, pct=DUPLICATE_PCT, links=False)
    per_id = written(found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("n")), "groups")
    gone = written(per_id.where("component_id < doc_id").select(F.col("doc_id").alias("_id")), "group-members")
    copies = written(per_id.where("n > 1").select(F.col("doc_id").alias("_id")), "copied-rows")
    same = F.col("uid") == F.col("_id")
    left = named.join(sized(gone, 16), same, "left_anti")
    one = left.join(sized(copies, 16), same, "left_semi").groupBy("uid").agg(F.min(F.struct(*COLUMNS)).alias("r"))
    return left.join(sized(copies, 16), same, "left_anti").select(*COLUMNS).unionByName(one.select("r.*"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    return _with_length(mixing.mixed_documents(docs))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, with_ids=False)


#: Working tables of the last stage that was called.
_WORKING: list[str] = []


def _alone(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, after the working tables of the one before it have been deleted."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        dropped(spark, _WORKING)
        with working_tables() as paths:
            out = stage(spark, docs, sf_dir)
        _WORKING.extend(paths)
        return out

    return run_stage


STAGES = [(name, _alone(stage)) for name, stage in (("language", language), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
                                                    ("mixing", mixed_sources), ("packing", packed_sequences))]

#: The language model, edit distances and retrieval have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with working_tables() as paths:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        dropped(spark, last)
        last = paths
    return STAGES[-1][1](spark, docs, sf_dir)
