"""Same-team runs: receivers, circulation tempo, hold times.

A match's feed comes from one document, so the windows below sort one match
at a time; the rows are shuffled once, by match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions import fixed as K
from ..functions.expr import is_base_pass, pct, ratio
from .common import PLAYER, TEAM, own_teams

_RUN = ["combo_id", "run_id"]


def runs(feed: DataFrame) -> DataFrame:
    """Feed without administrative events, with the 1-based `run_id` of its same-team run."""
    order = Window.partitionBy("combo_id").orderBy("t_s", "pos")
    kept = own_teams(feed).filter(~F.col("etype").isin(*K.ADMIN_TYPES))
    changed = F.when(F.col("team_id").eqNullSafe(F.lag("team_id").over(order)), 0).otherwise(1)
    return kept.withColumn("_new", changed).withColumn("run_id", F.sum("_new").over(order)).drop("_new")


def receivers(run_feed: DataFrame) -> DataFrame:
    """Adds `receiver_id`: the player of the first strictly later event of the
    run that is by somebody else.

    Going back in time, `_next` is the first player of the following block of
    another player. The event right after the pass (in time) either is by
    somebody else, or its block is the passer's and `_next` is the answer.
    """
    order = Window.partitionBy(*_RUN).orderBy("t_s", "pos")
    back = Window.partitionBy(*_RUN).orderBy(F.desc("t_s"), F.desc("pos"))
    later = Window.partitionBy(*_RUN).orderBy(F.desc("t_s"))
    known = F.col("player_id").isNotNull()
    before = F.last("player_id", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        run_feed
        .withColumn("_head", F.when(known & ~F.col("player_id").eqNullSafe(before), F.col("player_id")))
        .withColumn("_next", F.last("_head", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_after", F.min(F.when(known, F.struct("t_s", "pos", "player_id", "_next")))
                    .over(later.rangeBetween(Window.unboundedPreceding, -1)))
        .withColumn("receiver_id", F.when(F.col("_after.player_id").eqNullSafe(F.col("player_id")), F.col("_after._next"))
                    .otherwise(F.col("_after.player_id")))
        .drop("_head", "_next", "_after"))


def pass_network(feed: DataFrame) -> DataFrame:
    """Directed passer -> receiver edges over all accurate passes."""
    return (receivers(runs(feed))
            .filter((F.col("type_id") == 1) & F.col("ok")
                    & F.col("player_id").isNotNull() & F.col("receiver_id").isNotNull())
            .groupBy(*TEAM, F.col("player_id").alias("passer_id"), "receiver_id")
            .agg(F.count("*").alias("pass_count")))


def release_gaps(feed: DataFrame) -> DataFrame:
    """Seconds between consecutive base passes of a run by different players, within (0, 10]."""
    order = Window.partitionBy(*_RUN).orderBy("t_s", "pos")
    gap = F.col("t_s") - F.lag("t_s").over(order)
    same = F.col("player_id").eqNullSafe(F.lag("player_id").over(order))
    return (runs(feed).filter(is_base_pass())
            .withColumn("gap", gap).withColumn("_same", same)
            .filter(~F.col("_same") & (F.col("gap") > 0) & (F.col("gap") <= 10))
            .select(*TEAM, "gap"))


def tempo(feed: DataFrame) -> DataFrame:
    """Circulation tempo per team."""
    n = F.count("*")
    return release_gaps(feed).groupBy(*TEAM).agg(
        ratio(F.sum("gap"), n, 2).alias("avg_release_seconds"),
        pct(F.count_if(F.col("gap") <= 2), n).alias("quick_pass_pct"),
        pct(F.count_if(F.col("gap") > 5), n).alias("slow_pass_pct"))


def _last_touch_before() -> Column:
    """Time of the player's latest touch strictly before this event."""
    before = (Window.partitionBy(*PLAYER).orderBy("t_s").rangeBetween(Window.unboundedPreceding, -1))
    return F.max(F.when(F.col("is_touch"), F.col("t_s"))).over(before)


def hold_times(feed: DataFrame) -> DataFrame:
    """Average seconds between a player's previous touch and the base pass, gaps within (0, 15]."""
    gaps = (own_teams(feed).filter(F.col("player_id").isNotNull() & (F.col("is_touch") | (F.col("type_id") == 1)))
            .withColumn("gap", F.col("t_s") - _last_touch_before())
            .filter(is_base_pass() & (F.col("gap") > 0) & (F.col("gap") <= 15)))
    return gaps.groupBy(*PLAYER).agg(ratio(F.sum("gap"), F.count("*"), 2).alias("avg_hold_seconds"))
