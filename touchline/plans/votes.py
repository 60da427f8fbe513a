"""The identity vote kept over loads (X01-X03): counts per anchor and candidate, brought up to date by the matches of a load.

Two tables of the raw store: the pairs that each match has shown, replaced with their match, and the count of every pair.
A load adds the pairs of its matches and takes away those that the same matches had shown before; only the counts of pairs
in this difference are written. The winner of an anchor follows from the counts, so a crosswalk reads no old lineups for
its vote. A reference player's name counts as it is known when a match is loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.identity import lineup_keys, named, observations
from ..sinks.shared import written
from ..sinks.store import Store

PAIRS, COUNTS = "vote_pairs", "vote_counts"
PAIR = ["provider", "anchor_id", "prov_id"]


def match_pairs(lineups: dict[str, DataFrame]) -> DataFrame:
    """combo_id, provider, anchor_id and prov_id of every observation. `lineups` has `ev` and any of `rd` (with names) and `xg`."""
    anchor, out = lineup_keys(lineups["ev"]), None
    for provider in ("rd", "xg"):
        if provider in lineups:
            found = observations(anchor, lineup_keys(lineups[provider])).select("combo_id", F.lit(provider).alias("provider"), F.col("anchor_id").cast("bigint").alias("anchor_id"),
                                                                              F.col("prov_id").cast("bigint").alias("prov_id"))
            out = found if out is None else out.unionByName(found)
    return out


def count_matches(store: Store, matches: DataFrame, pairs: DataFrame) -> None:
    """Brings the counts up to date with the `pairs` of `matches`, which may have none and may have been counted before."""
    matches = matches.select("combo_id").distinct()
    new = pairs.filter("anchor_id is not null and prov_id is not null").withColumn("n", F.lit(1).cast("bigint"))
    change = new
    if PAIRS in store.layouts:
        old = store.read(PAIRS).filter("anchor_id is not null").join(matches, "combo_id", "left_semi")
        change = new.unionByName(old.withColumn("n", -F.col("n")))
    change = written(change.groupBy(*PAIR).agg(F.sum("n").alias("change")).filter("change <> 0"), "vote-change")
    counts = change.withColumnRenamed("change", "votes")
    if COUNTS in store.layouts:
        before = store.read(COUNTS).join(change.select(*PAIR), PAIR, "left_semi")
        counts = before.unionByName(counts).groupBy(*PAIR).agg(F.sum("votes").alias("votes"))
    store.append(COUNTS, written(counts, "vote-counts"), PAIR)
    # A match without pairs leaves a row without ids, which replaces what it had shown.
    per_match = new.groupBy("combo_id", *PAIR).agg(F.sum("n").alias("n"))
    empty = matches.select("combo_id", F.lit(None).cast("string").alias("provider"), F.lit(None).cast("bigint").alias("anchor_id"), F.lit(None).cast("bigint").alias("prov_id"), F.lit(0).cast("bigint").alias("n"))
    store.append(PAIRS, per_match.unionByName(empty), ["combo_id"], whole=True)


def count_load(store: Store, matches: DataFrame) -> None:
    """Counts the lineups that the store now has of these matches."""
    def of(name: str) -> DataFrame:
        return store.read(name).join(matches, "combo_id", "left_semi")

    lineups = {"ev": of("ev_lineups")}
    if "xg_lineups" in store.layouts:
        lineups["xg"] = of("xg_lineups")
    if "rd_lineups" in store.layouts and "rd_players" in store.layouts:
        lineups["rd"] = named(of("rd_lineups"), store.read("rd_players"))
    if len(lineups) > 1:
        count_matches(store, matches, written(match_pairs(lineups), "vote-pairs"))
