"""Shooting: shot rows, team and player aggregates, creating-action totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions import fixed as K
from ..functions.expr import (
    count_where as C, exact_sum, first_of, goal_distance_m, has, has_any, has_id, open_play_shot, pct, ratio, rnd,
    shot_angle, shot_blocked, shot_location, shot_off_target, shot_on_target, shot_placement, xcol, ycol,
)
from .common import PLAYER, TEAM, own_teams
from .sca import shot_creating_actions, shots_only


def shots(feed: DataFrame) -> DataFrame:
    """One row per shot. `row_id` is its 0-based place among the match's shots, in feed order."""
    by_match = Window.partitionBy("combo_id").orderBy("pos")
    where = shots_only(feed).withColumn("_loc", shot_location()).withColumn(
        "_dist", rnd(goal_distance_m(xcol(0), ycol(50)), 2))
    return where.select(
        "combo_id", (F.row_number().over(by_match) - 1).cast("bigint").alias("row_id"), "pos", "event_id", "team_id",
        "player_id", "minute", "second", "expanded_minute", "period", xcol(0).alias("x"), ycol(50).alias("y"),
        (F.col("etype") == "Goal").alias("is_goal"), shot_on_target().alias("is_on_target"),
        shot_blocked().alias("is_blocked"), shot_off_target().alias("is_off_target"),
        open_play_shot().alias("is_open_play"),
        F.col("_loc").alias("location"), (F.col("_loc") == "InBox").alias("in_box"),
        has("SixYardBlock").alias("six_yard_box"),
        has_any(["SmallBoxCentre", "SmallBoxLeft", "SmallBoxRight"]).alias("small_box"),
        F.col("_dist").alias("distance_m"), shot_angle(F.col("_dist")).alias("angle_deg"),
        F.coalesce(first_of(K.BODY_PARTS), F.lit("Unknown")).alias("body_part"),
        has("Head").alias("is_header"), has("RightFoot").alias("is_right_foot"), has("LeftFoot").alias("is_left_foot"),
        has("Volley").alias("is_volley"), has("FirstTouch").alias("is_first_touch"),
        F.coalesce(first_of(K.PATTERNS), F.lit("RegularPlay")).alias("pattern"),
        has("FromCorner").alias("is_from_corner"), has_any(["FreekickTaken", "SetPiece"]).alias("is_from_freekick"),
        has("FastBreak").alias("is_fast_break"), has_id(29).alias("is_assisted"),
        has("IndividualPlay").alias("is_individual_play"), has("BigChance").alias("is_big_chance"),
        has("OneOnOne").alias("is_one_on_one"), "goal_mouth_y", "goal_mouth_z",
        shot_placement().alias("placement"), "related_event_id")


def shots_with_creators(feed: DataFrame) -> DataFrame:
    """Shot rows with their two creator slots."""
    def slot(i: int, name: str) -> Column:
        return F.max(F.when(F.col("slot") == i, F.col(name)))

    slots = shot_creating_actions(feed).groupBy("combo_id", F.col("shot_pos").alias("pos")).agg(
        *[slot(i, c).alias(f"sca_{i}_{n}") for i in (1, 2) for c, n in (("player_id", "player_id"), ("kind", "type"))])
    return shots(feed).join(slots, ["combo_id", "pos"], "left")


def _metrics() -> list[Column]:
    goal, sot, op, box = F.col("is_goal"), F.col("is_on_target"), F.col("is_open_play"), F.col("in_box")
    big, n = F.col("is_big_chance"), F.count("*")
    return [
        n.alias("total_shots"), C(goal, "goals"), C(sot, "shots_on_target"), C(F.col("is_blocked"), "shots_blocked"),
        C(F.col("is_off_target"), "shots_off_target"),
        pct(F.count_if(sot), n).alias("shots_on_target_pct"), pct(F.count_if(goal), n).alias("conversion_rate_pct"),
        pct(F.count_if(goal), F.count_if(sot), empty=0).alias("goals_per_shot_on_target_pct"),
        C(big, "big_chances"), C(big & goal, "big_chances_scored"),
        pct(F.count_if(big & goal), F.count_if(big)).alias("big_chance_conversion_pct"),
        C(F.col("is_one_on_one"), "one_on_ones"),
        C(box, "shots_in_box"), C(~box, "shots_out_of_box"), C(F.col("six_yard_box"), "shots_six_yard_box"),
        pct(F.count_if(box & goal), F.count_if(box)).alias("in_box_conversion_pct"),
        ratio(exact_sum(F.col("distance_m")), F.count("distance_m"), 2).alias("avg_shot_distance_m"),
        C(F.col("is_right_foot"), "shots_right_foot"), C(F.col("is_left_foot"), "shots_left_foot"),
        C(F.col("is_header"), "shots_header"), C(F.col("is_volley"), "shots_volley"),
        C(F.col("is_first_touch"), "shots_first_touch"),
        C(F.col("is_from_corner"), "shots_from_corner"), C(F.col("is_from_freekick"), "shots_from_freekick"),
        C(F.col("is_fast_break"), "shots_fast_break"), C(F.col("is_assisted"), "shots_assisted"),
        C(F.col("is_individual_play"), "shots_individual_play"),
        C(op, "shots_open_play"), C(op & goal, "goals_open_play"), C(op & sot, "shots_on_target_open_play"),
        C(sot & (F.col("placement") == "TopCorner"), "placement_top_corner"),
        C(sot & (F.col("placement") == "LowCorner"), "placement_low_corner"),
        C(sot & (F.col("placement") == "CentreFrame"), "placement_centre_frame"),
    ]


def _credits(total: str) -> list[Column]:
    kind = F.col("kind")
    return [F.count("*").alias(total), C(kind == "Pass (Live)", "sca_pass_live"), C(kind == "Pass (Dead)", "sca_pass_dead"),
            C(kind == "Take-On", "sca_take_on"), C(kind == "Shot", "sca_shot"), C(kind == "Fouled", "sca_fouled"),
            C(kind.isin("Interception", "Tackle"), "sca_defense")]


def team_shooting(feed: DataFrame) -> DataFrame:
    """Teams with at least one shot."""
    return shots(own_teams(feed)).groupBy(*TEAM).agg(*_metrics())


def player_shooting(feed: DataFrame) -> DataFrame:
    return shots(feed).filter(F.col("player_id").isNotNull()).groupBy(*PLAYER).agg(*_metrics())


def team_sca(feed: DataFrame) -> DataFrame:
    """Creating actions behind each team's shots."""
    return (shot_creating_actions(feed).groupBy(*TEAM)
            .agg(*_credits("sca_total"), C(F.col("slot") == 1, "shots_with_sca")))


def player_sca(feed: DataFrame) -> DataFrame:
    """Creating actions credited to each player, also on other players' shots."""
    return (shot_creating_actions(feed).filter(F.col("player_id").isNotNull())
            .groupBy(*PLAYER).agg(*_credits("sca")))


def team_shooting_full(feed: DataFrame) -> DataFrame:
    sca = team_sca(feed)
    return team_shooting(feed).join(sca, TEAM, "left").na.fill(0, [c for c in sca.columns if c not in TEAM])


def player_shooting_full(feed: DataFrame) -> DataFrame:
    """Shooters and creators; a player who only created has NULL shot metrics."""
    sca = player_sca(feed)
    return player_shooting(feed).join(sca, PLAYER, "full").na.fill(0, [c for c in sca.columns if c not in PLAYER])


def sca_totals(feed: DataFrame) -> DataFrame:
    """Team totals and player credits in one table; `player_id` is NULL on team rows."""
    team = team_sca(feed).withColumnRenamed("sca_total", "sca").withColumn("player_id", F.lit(None).cast("bigint"))
    player = player_sca(feed).withColumn("shots_with_sca", F.lit(None).cast("bigint"))
    return team.unionByName(player)
