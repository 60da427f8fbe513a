"""Data checks as Spark jobs (T01-T05). Failures come back as (check, severity, key, n)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

# (table, column, severity) of the standard checks; tables are marts, the two crosswalks and a staged view.
NOT_NULL = [("player_xwalk", "player_uid"), ("player_xwalk", "ev_player_id"), ("team_xwalk", "team_uid"), ("team_xwalk", "ev_team_id"),
            ("ev_lineups", "player_uid"), ("dim_match", "combo_id"), ("dim_player", "player_uid"), ("dim_team", "team_uid")]
UNIQUE = [("player_xwalk", "ev_player_id", "error"), ("team_xwalk", "ev_team_id", "error"), ("player_xwalk", "rd_player_id", "error"),
          ("dim_match", "combo_id", "warn"), ("dim_player", "player_uid", "warn"), ("dim_team", "team_uid", "warn"),
          ("dim_coach", "coach_uid", "warn"), ("dim_referee", "referee_uid", "warn"), ("fct_shots", "shot_uid", "warn")]


def not_null(df: DataFrame, column: str, check: str, severity: str = "error") -> DataFrame:
    """One row with the number of NULLs, if there are any."""
    return (df.agg(F.count_if(F.col(column).isNull()).alias("n")).filter("n > 0")
            .select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.lit(None).cast("string").alias("key"), "n"))


def unique(df: DataFrame, column: str, check: str, severity: str = "error") -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    return (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("key"))
            .agg(F.count("*").alias("n")).filter("n > 1")
            .select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), "key", "n"))


def shot_counts(ev: DataFrame, xg: DataFrame, rd: DataFrame) -> DataFrame:
    """Matches where a provider that has shots disagrees with the event provider's count."""
    def of(df: DataFrame, src: str) -> DataFrame:
        return df.select("combo_id", F.lit(src).alias("src"))

    counts = of(ev, "ev").unionByName(of(xg, "xg")).unionByName(of(rd, "rd")).groupBy("combo_id").agg(
        *[F.count_if(F.col("src") == s).alias(f"{s}_n") for s in ("ev", "xg", "rd")])
    return counts.filter(((F.col("xg_n") > 0) & (F.col("ev_n") != F.col("xg_n")))
                         | ((F.col("rd_n") > 0) & (F.col("ev_n") != F.col("rd_n"))))


def table(marts, name: str) -> DataFrame:
    """A mart, crosswalk or staged view by name."""
    found = getattr(marts, name, None)
    return marts.staged(name) if found is None else found() if callable(found) else found


def key_failures(tables: Callable[[str], DataFrame], not_null: list[tuple[str, str]] = NOT_NULL, unique: list[tuple[str, str, str]] = UNIQUE) -> DataFrame:
    """All null and uniqueness checks with one pass over each table and one grouping over all of them.

    A row gives one value for each check of its table; equal values of a check are counted, with partial counts before
    the shuffle. A null fails its check at once, any other value if it comes twice.
    """
    parts = []
    for name in dict.fromkeys([t for t, _ in not_null] + [t for t, *_ in unique]):
        values = [F.struct(F.lit(f"not_null:{name}.{c}").alias("check"), F.lit("error").alias("severity"), F.lit(None).cast("string").alias("key"), F.lit(1).alias("allowed"),
                           F.col(c).isNull().alias("counts")) for t, c in not_null if t == name]
        values += [F.struct(F.lit(f"unique:{name}.{c}").alias("check"), F.lit(s).alias("severity"), F.col(c).cast("string").alias("key"), F.lit(2).alias("allowed"),
                            F.col(c).isNotNull().alias("counts")) for t, c, s in unique if t == name]
        parts.append(tables(name).select(F.inline(F.array(*values))).filter("counts"))
    counted = reduce(DataFrame.unionByName, parts).groupBy("check", "severity", "key").agg(F.count("*").alias("n"), F.max("allowed").alias("allowed"))
    return counted.filter("n >= allowed").select("check", "severity", "key", "n")


def drifted(marts) -> DataFrame:
    """Shot counts of a match that differ between providers, as a check."""
    drift = shot_counts(marts.staged("ev_shots"), marts.staged("xg_shots"), marts.staged("rd_shots"))
    return drift.select(F.lit("shot_counts").alias("check"), F.lit("warn").alias("severity"), F.col("combo_id").alias("key"), F.col("ev_n").alias("n"))


def run_checks(marts) -> DataFrame:
    """All standard checks. Rows with severity `error` should stop publication."""
    return key_failures(lambda name: table(marts, name)).unionByName(drifted(marts))
