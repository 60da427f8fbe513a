"""Shot-creating actions (W01): up to two creating actions before each shot.

Each shot asks for the events 1..15 places before it in feed order. Shots are
a few percent of the feed, the look-back is an equi-join on (match, position),
and everything after it works inside one shot's 15 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions import fixed as K
from ..functions.expr import has_any

_SHOT = ["combo_id", "shot_pos"]


def shots_only(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("is_shot") & F.col("type_id").isin(*K.SHOT_TYPE_IDS))


def creating_kind() -> Column:
    """Label of an event as a creating action, NULL if it cannot be one."""
    et, ok = F.col("etype"), F.col("ok")
    return (F.when((et == "Pass") & ok & has_any(K.SCA_DEAD_PASS), "Pass (Dead)")
            .when((et == "Pass") & ok, "Pass (Live)")
            .when((et == "TakeOn") & ok, "Take-On")
            .when(et.isin(*K.SHOT_TYPES), "Shot")
            .when(et.isin("Interception", "Tackle"), et))


def shot_creating_actions(feed: DataFrame) -> DataFrame:
    """One row per credit: shot (match, shot_pos), slot 1 or 2, creator and kind."""
    reach = K.SCA_LOOKBACK + K.SCA_PEEK
    wanted = shots_only(feed).select(
        "combo_id", F.col("pos").alias("shot_pos"), F.col("team_id").alias("shot_team"),
        F.explode(F.sequence(F.lit(1), F.lit(reach))).alias("d")
    ).withColumn("pos", F.col("shot_pos") - F.col("d"))
    before = feed.select("combo_id", "pos", "team_id", "player_id", "etype", "ok", creating_kind().alias("kind"))
    steps = wanted.join(before, ["combo_id", "pos"])

    own = F.col("team_id") == F.col("shot_team")
    foul = F.col("etype") == "Foul"
    theirs = ~foul & (F.col("team_id") != F.col("shot_team"))
    back = Window.partitionBy(*_SHOT).orderBy("d")
    seen = back.rowsBetween(Window.unboundedPreceding, -1)

    # The ball-winning action right before a recovery: nearest of the three earlier events with a team.
    peek = F.coalesce(*[
        F.lead(F.when(F.col("team_id").isNotNull(), F.struct("team_id", "player_id", "kind")), i).over(back)
        for i in range(1, K.SCA_PEEK + 1)])
    credit = F.when(foul & own & F.col("ok"), "Fouled").when(~foul & own, F.col("kind"))
    stops = (
        (theirs & ((F.col("etype").isin("Pass", "TakeOn") & F.col("ok")) | F.col("etype").isin(*K.SHOT_TYPES, "Interception")))
        | (~foul & own & F.col("kind").isNull() & F.col("etype").isin(*K.SCA_START)))
    walked = (steps.withColumn("peek", peek).withColumn("credit", credit)
              .withColumn("stop", F.coalesce(stops, F.lit(False)))
              .filter(F.col("d") <= K.SCA_LOOKBACK)
              .withColumn("over", F.coalesce(F.max("stop").over(seen), F.lit(False)))
              .filter(~F.col("over")))
    peeked = (F.col("stop") & own & (F.col("etype") == "BallRecovery") & (F.col("peek.team_id") == F.col("shot_team"))
              & F.col("peek.kind").isin("Tackle", "Interception"))
    found = walked.select(
        *_SHOT, "shot_team", "d",
        F.when(peeked, F.struct(F.col("peek.player_id").alias("player_id"), F.col("peek.kind").alias("kind")))
        .when(~F.col("stop") & F.col("credit").isNotNull(), F.struct("player_id", F.col("credit").alias("kind"))).alias("hit")
    ).filter(F.col("hit").isNotNull())
    ranked = (found.withColumn("slot", F.row_number().over(back))
              .withColumn("_first", F.first("hit.kind").over(back)).filter(F.col("slot") <= 2))
    return (ranked.filter((F.col("slot") == 1) | (F.col("_first") != "Shot"))
            .select("combo_id", "shot_pos", F.col("shot_team").alias("team_id"), "slot",
                    F.col("hit.player_id").alias("player_id"), F.col("hit.kind").alias("kind")))
