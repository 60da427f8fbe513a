"""Finding and reading match documents.

Layout: {root}/{match key}/{events|xg|reference|odds}/*.json. A match counts
only when it has an event document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .schemas import ALIAS

_PATH = r"/([^/]+)/(events|xg|reference|odds)/([^/]+)\.json$"


def _file_parts(path: Column) -> list[Column]:
    return [F.regexp_extract(path, _PATH, 1).alias("combo_id"), F.regexp_extract(path, _PATH, 2).alias("provider"),
            F.regexp_extract(path, _PATH, 3).alias("file")]


def file_id(name: Column) -> Column:
    """Number at the end of a file name like `events_1903468`."""
    return F.regexp_extract(name, r"_(\d+)$", 1).try_cast("bigint")


def scan(spark: SparkSession, root: str) -> DataFrame:
    """One descriptor per match. Lists the files; their content is not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
             .load(root).select(F.url_decode("path").alias("path")))
    return descriptors(files)


def descriptors(files: DataFrame) -> DataFrame:
    """Groups file paths by match: paths and ids per provider, `has_*` flags."""
    parts = files.select("path", *_file_parts(F.col("path"))).filter("combo_id <> ''")
    ev = (F.col("provider") == "events") & F.col("file").rlike(r"^events_\d+$")
    xg = (F.col("provider") == "xg") & F.col("file").rlike(r"^xg_\d+$")
    found = parts.groupBy("combo_id").agg(
        F.min(F.when(ev, F.col("path"))).alias("ev_path"), F.min_by(file_id(F.col("file")), F.when(ev, F.col("path"))).alias("ev_id"),
        F.min(F.when(xg, F.col("path"))).alias("xg_path"), F.min_by(file_id(F.col("file")), F.when(xg, F.col("path"))).alias("xg_id"),
        F.coalesce(F.max(F.col("provider") == "reference"), F.lit(False)).alias("has_reference_data"),
        F.coalesce(F.max(F.col("provider") == "odds"), F.lit(False)).alias("has_odds_data"))
    return (found.filter(F.col("ev_path").isNotNull())
            .withColumn("has_events", F.lit(True)).withColumn("has_xg_data", F.col("xg_path").isNotNull()))


def not_loaded(scanned: DataFrame, loaded: DataFrame, force_reload: bool = False) -> DataFrame:
    """Matches that are not loaded yet; all of them when a reload is forced."""
    return scanned if force_reload else scanned.join(loaded.select("combo_id").distinct(), "combo_id", "left_anti")


def read_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per file: match key, provider, file name and the text."""
    raw = (spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(paths)
           .select(F.url_decode("_metadata.file_path").alias("path"), "value"))
    return raw.select(*_file_parts(F.col("path")), "value")


_NOT_JSON, _BLOCKED, _MISSING, _ODD = "not JSON", "block page", "required field missing", "odd field"


def _judged(texts: DataFrame, schema: str, required: str | None) -> DataFrame:
    """Adds the parsed document `doc` and `reason`, what is wrong with it. A field of another type than
    the schema's is NULL and leaves the text in `doc._corrupt_record`; the rest of the document is read."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    out = texts.withColumn("doc", F.from_json("value", schema, options))
    flawed = F.col("doc").isNull() | F.col("doc._corrupt_record").isNotNull()
    reason = F.when(flawed & F.try_parse_json("value").isNull(), _NOT_JSON)
    if "code:" in schema.split(",")[0]:
        reason = reason.when(F.col("doc.code") == "TURNSTILE_REQUIRED", _BLOCKED)
    if required:
        reason = reason.when(F.col(f"doc.{required}").isNull(), _MISSING)
    return out.withColumn("reason", reason.when(flawed, _ODD))


def parse(texts: DataFrame, schema: str, required: str | None = None) -> DataFrame:
    """Adds the parsed document `doc`. Texts that are not JSON, and those an upstream
    block page replaced, are left out; so are those without the `required` field."""
    judged = _judged(texts, schema, required)
    return judged.filter(F.coalesce(F.col("reason") == _ODD, F.lit(True)) & F.col("doc").isNotNull()).drop("value", "reason")


def rejected(texts: DataFrame, schema: str, required: str | None = None) -> DataFrame:
    """Files that `parse` leaves out or reads in part (`odd field`), with the reason."""
    return _judged(texts, schema, required).filter("reason IS NOT NULL").drop("value", "doc")


def read_alias(spark: SparkSession, path: str) -> DataFrame:
    """Identity overrides (bad_id, canonical_id); usually empty."""
    return spark.read.schema(ALIAS).option("header", True).csv(path)
