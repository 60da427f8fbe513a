"""Possession: shares, touches, dribbles, retention; pressing and tilt variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions import fixed as K
from ..functions.expr import count_where as C, exact_sum, has_id, is_base_pass, pct, ratio, rnd, third, touch_in_box, xcol, ycol
from .common import PLAYER, TEAM, opponent, own_teams, spine, with_players

ZONES = ["own_third", "middle_third", "final_third"]


def possession_share(minutes: DataFrame, sides: DataFrame) -> DataFrame:
    """Share of the per-minute possession values (0-1), one half each when there are none."""
    own = minutes.groupBy(*TEAM).agg(exact_sum(F.col("value")).alias("_own"))
    rows = sides.select(*TEAM).join(own, TEAM, "left").na.fill(0.0, ["_own"])
    total = F.sum("_own").over(Window.partitionBy("combo_id"))
    return rows.withColumn("share", F.coalesce(ratio(F.col("_own"), total), F.lit(0.5))).drop("_own")


def _touch_metrics(total: str) -> list[Column]:
    x, y, touch = xcol(50), ycol(50), F.col("is_touch")
    return [C(touch, total),
            *[C(touch & (third(x) == z), f"touches_{z}") for z in ZONES],
            C(touch & touch_in_box(x, y), "touches_in_box"),
            ratio(exact_sum(F.when(touch, x)), F.count_if(touch), 1).alias("avg_touch_x")]


def _dribble_metrics() -> list[Column]:
    dribble, won, zone = F.col("etype") == "TakeOn", F.col("ok"), third(xcol(50))
    out = [C(dribble, "dribbles_attempted"), C(dribble & won, "dribbles_won"), C(dribble & ~won, "dribbles_lost"),
           pct(F.count_if(dribble & won), F.count_if(dribble), 1).alias("dribble_success_pct")]
    for z in ZONES:
        there = dribble & (zone == z)
        out += [C(there, f"dribbles_{z}"), C(there & won, f"dribbles_won_{z}"),
                pct(F.count_if(there & won), F.count_if(there), 1).alias(f"dribble_success_pct_{z}")]
    lost = (dribble & ~won) | (F.col("etype") == "Dispossessed")
    touches = F.count_if(F.col("is_touch"))
    return out + [C(F.col("etype") == "Dispossessed", "dispossessed"), C(lost, "ball_losses"),
                  pct(touches - F.count_if(lost), touches, 1).alias("ball_retention_pct")]


def team_possession(feed: DataFrame, sides: DataFrame, minutes: DataFrame) -> DataFrame:
    et = F.col("etype")
    dribble, gone, corner = et == "TakeOn", et == "Dispossessed", (et == "CornerAwarded") & (xcol(50) > 50)
    rows = own_teams(feed).groupBy(*TEAM).agg(
        *_touch_metrics("touches_total"), *_dribble_metrics(),
        C(dribble & has_id(286), "dribbles_offensive"), C(dribble & has_id(285), "dribbles_defensive"),
        C(dribble & has_id(211), "dribbles_overrun"),
        C(gone & has_id(286), "dispossessed_offensive"), C(gone & has_id(285), "dispossessed_defensive"),
        C(et == "ShieldBallOpp", "shield_ball_opp"),
        C(corner, "corners_won"), C(corner & has_id(73), "corners_miss_left"), C(corner & has_id(75), "corners_miss_right"),
        C((et == "Pass") & is_base_pass() & F.col("ok"), "_good_passes"))
    share = (possession_share(minutes, sides)
             .withColumn("possession_pct", rnd(F.col("share") * 100, 1))
             .withColumn("possession_minutes", rnd(F.col("possession_pct") / 100 * 90, 2)).drop("share"))
    return (spine(sides, rows).join(share, TEAM)
            .withColumn("passing_rate", ratio(F.col("_good_passes"), F.col("possession_minutes"), 2))
            .drop("_good_passes"))


def player_possession(feed: DataFrame) -> DataFrame:
    """Players with a touch, a take-on or a lost ball."""
    involved = F.col("is_touch") | F.col("etype").isin("TakeOn", "Dispossessed")
    return (with_players(feed).filter(involved).groupBy(*PLAYER)
            .agg(*_touch_metrics("touches"), *_dribble_metrics()))


def ppda_possession(feed: DataFrame, sides: DataFrame) -> DataFrame:
    """Pressing variant: opponent passes up to x 66.6 per own action from x 33.4."""
    x = xcol(-1)
    rows = spine(sides, own_teams(feed).groupBy(*TEAM).agg(
        C((F.col("etype") == "Pass") & (x <= K.FINAL_THIRD), "_passes"),
        C(F.col("etype").isin(*K.PRESSING_TYPES) & (x >= K.PRESS_MIN_X), "def_actions")))
    return (rows.withColumn("opp_passes", opponent("_passes"))
            .withColumn("ppda", ratio(F.col("opp_passes"), F.col("def_actions"), 2)).drop("_passes"))


def field_tilt_possession(feed: DataFrame, sides: DataFrame) -> DataFrame:
    """Final-third touch share and completed-pass share, 50 when there are none."""
    deep = xcol(0) > K.FINAL_THIRD
    rows = spine(sides, own_teams(feed).groupBy(*TEAM).agg(
        C(F.col("is_touch") & deep, "final_third_touches"),
        C((F.col("etype") == "Pass") & F.col("ok") & deep, "_passes")))
    rows = rows.withColumn("_t", opponent("final_third_touches")).withColumn("_p", opponent("_passes"))
    return rows.select(
        *TEAM, "final_third_touches",
        pct(F.col("final_third_touches"), F.col("final_third_touches") + F.col("_t"), 1, empty=50).alias("field_tilt_pct"),
        pct(F.col("_passes"), F.col("_passes") + F.col("_p"), 1, empty=50).alias("field_tilt_passes_pct"))
