"""Odds provider documents, one per market."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .documents import parse
from .schemas import ODDS_DOC


def odds_documents(texts: DataFrame) -> DataFrame:
    """File names are `<match id>_odds_<market>`; empty answers carry a message and no data."""
    named = texts.filter((F.col("provider") == "odds") & F.col("file").rlike(r"^\d+_odds_.+$"))
    return (parse(named, ODDS_DOC, "data.odds")
            .withColumn("od_match_id", F.regexp_extract("file", r"^(\d+)_odds_", 1)).withColumn("market_slug", F.regexp_extract("file", r"^\d+_odds_(.+)$", 1)))


def _label(names: Column, key: Column) -> Column:
    """Outcome `o2` is the second outcome name, or stays `o2` without one."""
    return F.coalesce(F.get(names, F.regexp_extract(key, r"(\d+)$", 1).try_cast("int") - 1), key)


def odds(docs: DataFrame, full_time_only: bool = False) -> DataFrame:
    """One row per market, period, line and outcome: best price, no bookmaker."""
    d = F.col("doc.data")
    base = docs.select(
        "combo_id", "od_match_id", "market_slug", F.coalesce(d["market_name"], F.col("market_slug")).alias("market_name"),
        d["market_group_id"].alias("market_group_id"), F.lower(F.coalesce(d["has_handicap"], F.lit("0"))).isin("1", "true").alias("_lines"),
        d["outcome_names"].alias("_names"), d["periods"].alias("_periods"), F.explode(d["odds"]).alias("_period", "o"))
    period = F.try_element_at(F.filter("_periods", lambda p: p["id"] == F.col("_period")), F.lit(1))["name"]
    base = base.withColumn("period_name", F.coalesce(period, F.concat(F.lit("Period "), F.col("_period"))))
    keep = ["combo_id", "od_match_id", "market_name", "market_group_id", "market_slug", "period_name"]
    has_lines = F.col("_lines") & F.col("o.alternative").isNotNull()
    lines = (base.filter(has_lines).select(*keep, "_names", F.explode("o.alternative").alias("a"))
             .select(*keep, "_names", F.coalesce(F.nullif("a.name", F.lit("")), "a.name_en", F.lit("")).alias("line"), F.explode("a.odds").alias("k", "v")))
    fixed = base.filter(~has_lines).select(*keep, "_names", F.lit(None).cast("string").alias("line"), F.explode("o.odds").alias("k", "v"))
    out = lines.unionByName(fixed).filter(F.col("v").isNotNull()).select(
        *keep, "line", _label(F.col("_names"), F.col("k")).alias("outcome_name"), F.col("v.odds_value").alias("odds_value"),
        F.col("v.odds_direction").alias("odds_direction"))
    return out.filter("period_name = 'Full Time'") if full_time_only else out
