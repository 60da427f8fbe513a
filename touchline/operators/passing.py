"""Passing: team and player metrics, the pass map, pressing and field tilt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed as K
from ..functions.expr import (
    count_where as C, exact_sum, expected_threat, goal_distance_units, has, has_id, is_base_pass,
    open_play_pass, pass_into_box, pct, ratio, rnd, xcol, ycol,
)
from .common import PLAYER, TEAM, left_counts, linked, opponent, own_teams, spine, with_players
from .runs import hold_times, receivers, runs, tempo

def _is_pass() -> Column:
    return F.col("type_id") == 1


def _entry() -> Column:
    """Pass or offside pass that crosses into the final third; keeper throws do not count."""
    end = F.coalesce("pass_end_x", F.lit(0.0))
    return (F.col("type_id").isin(1, 2) & ~has_id(123) & (end != 0)
            & (xcol(0) < K.FINAL_THIRD) & (end >= K.FINAL_THIRD))


def _in_third() -> Column:
    return is_base_pass() & (F.coalesce("pass_end_x", F.lit(0.0)) >= K.FINAL_THIRD)


def _key_pass() -> Column:
    return F.col("type_id").isin(1, 61) & has("KeyPass")


def _core_metrics() -> list[Column]:
    base, ok = is_base_pass(), F.col("ok")
    lb = base & has("Longball")
    cross = _is_pass() & has_id(2)
    return [
        C(base, "passes_total"), C(base & ok, "passes_accurate"), C(base & ~ok, "passes_inaccurate"),
        pct(F.count_if(base & ok), F.count_if(base), empty=0).alias("pass_accuracy_pct"),
        C(lb, "longballs_attempted"), C(lb & ok, "longballs_accurate"),
        pct(F.count_if(lb & ok), F.count_if(lb)).alias("longball_accuracy_pct"),
        C(base & has("Throughball"), "throughballs"), C(base & has("HeadPass"), "head_passes"),
        C(base & has("LayOff"), "layoffs"),
        C(cross, "crosses_attempted"), C(cross & ok, "crosses_accurate"),
        C(_key_pass(), "key_passes"), C(_is_pass() & has("BigChanceCreated"), "big_chances_created"),
        C(_entry(), "passes_entering_final_third"),
        C(_in_third(), "passes_in_final_third"), C(_in_third() & ok, "passes_in_final_third_accurate"),
    ]


def assists(feed: DataFrame) -> DataFrame:
    """Assisted goals with their assisting event: the goal's team and the struct `link`."""
    goals = own_teams(feed).filter((F.col("etype") == "Goal") & has_id(29)).select(*TEAM, "pos", "related_event_id")
    return linked(feed, goals, ["pos"], ["team_id", "player_id", "dead_ball"])


def team_passing(feed: DataFrame, sides: DataFrame) -> DataFrame:
    base, ok = is_base_pass(), F.col("ok")
    length = F.coalesce("length", F.lit(0.0))
    cross, throw = _is_pass() & has_id(2), _is_pass() & has_id(107)
    keeper, corner = _is_pass() & has_id(123), _is_pass() & has_id(6)
    rows = own_teams(feed).groupBy(*TEAM).agg(
        *_core_metrics(),
        C(base & (length < 10), "passes_short"), C(base & length.between(10, 32), "passes_medium"),
        C(base & (length > 32), "passes_long_band"),
        C(base & has_id(5), "freekick_passes"), C(base & has_id(241), "indirect_fk_passes"),
        C(base & has_id(124), "goalkick_passes"),
        pct(F.count_if(cross & ok), F.count_if(cross)).alias("cross_accuracy_pct"),
        C(corner, "corner_deliveries"), C(corner & ok, "corner_deliveries_accurate"),
        C(throw, "throwins_attempted"), C(throw & ok, "throwins_accurate"),
        C(keeper, "keeper_throws_attempted"), C(keeper & ok, "keeper_throws_accurate"),
        C(F.col("type_id") == 74, "blocked_passes"))
    made = (assists(feed).filter(F.col("link.team_id") == F.col("team_id"))
            .groupBy(*TEAM).agg(F.count("*").alias("assists")))
    return left_counts(spine(sides, rows), made, TEAM).na.fill(0.0, ["pass_accuracy_pct"])


def _player_assists(feed: DataFrame) -> DataFrame:
    return (assists(feed).filter(F.col("link.player_id").isNotNull())
            .groupBy(*TEAM, F.col("link.player_id").alias("player_id")).agg(F.count("*").alias("assists")))


def player_passing(feed: DataFrame) -> DataFrame:
    """Players with at least one pass."""
    rows = (with_players(feed).filter(F.col("type_id").isin(1, 2, 61))
            .groupBy(*PLAYER).agg(*_core_metrics(), F.count_if(_is_pass()).alias("_passes"))
            .filter("_passes > 0").drop("_passes"))
    return left_counts(rows, _player_assists(feed), PLAYER)


# -- pass map --------------------------------------------------------------------

def _geometry(feed: DataFrame) -> DataFrame:
    """Base-pass geometry as columns; rows that are not base passes get NULL flags."""
    x, y = xcol(0), ycol(50)
    ex = F.coalesce("pass_end_x", "end_x", x)
    ey = F.coalesce("pass_end_y", "end_y", y)
    start, end = goal_distance_units(x, y), goal_distance_units(ex, ey)
    length = F.coalesce("length", F.lit(0.0))
    return feed.select(
        "*", x.alias("sx"), y.alias("sy"), ex.alias("ex"), ey.alias("ey"), length.alias("plen"),
        is_base_pass().alias("base"), open_play_pass().alias("open_play"),
        ((ex - x) * F.lit(1.05)).alias("v_gain"),
        start.alias("d0"), end.alias("d1"),
        (F.col("ok") & (x > 33.3) & (end < start * 0.75)).alias("progressive"),
        ((x < K.FINAL_THIRD) & (ex >= K.FINAL_THIRD)).alias("entry"),
        (F.col("ok") & pass_into_box(ex, ey)).alias("into_box"),
        ((length > 32) & (F.abs(y - ey) > 25)).alias("switch"),
        expected_threat(x, y).alias("xt0"), expected_threat(ex, ey).alias("xt1"))


def pass_map(feed: DataFrame) -> DataFrame:
    """One row per base pass, with its receiver."""
    rows = _geometry(receivers(runs(feed))).filter("base")
    return rows.select(
        "combo_id", "team_id", "pos", "event_id", "player_id", "minute", "second", "expanded_minute", "period",
        F.col("sx").alias("x"), F.col("sy").alias("y"), F.col("ex").alias("end_x"), F.col("ey").alias("end_y"),
        F.col("plen").alias("length"), F.col("ok").alias("accurate"), "v_gain",
        rnd(F.col("d0"), 2).alias("dist_to_goal_start"), rnd(F.col("d1"), 2).alias("dist_to_goal_end"),
        F.col("progressive").alias("is_progressive"), F.col("entry").alias("is_final_third"),
        F.col("into_box").alias("is_penalty_area"), F.col("switch").alias("is_switch"),
        F.col("open_play").alias("is_open_play"),
        rnd(F.col("xt0"), 6).alias("xt_start"), rnd(F.col("xt1"), 6).alias("xt_end"),
        rnd(F.col("xt1") - F.col("xt0"), 6).alias("xt_added"), "receiver_id")


def _pass_profile() -> list[Column]:
    """Length, direction and threat of base passes, for any grouping."""
    base, n = F.col("base"), F.count_if(F.col("base"))
    gain = F.when(base, F.col("v_gain"))
    threat = F.when(base, F.col("xt1") - F.col("xt0"))
    long_enough = base & (F.col("plen") != 0)
    return [
        C(base & F.col("progressive"), "progressive_passes"),
        C(base & F.col("into_box"), "penalty_area_passes"),
        ratio(exact_sum(F.when(long_enough, F.col("plen"))), F.count_if(long_enough), 2).alias("avg_pass_length"),
        ratio(exact_sum(gain), n, 2).alias("avg_vertical_gain"),
        pct(F.count_if(gain > 0), n, empty=0).alias("forward_pass_pct"),
        pct(F.count_if(gain < 0), n, empty=0).alias("backward_pass_pct"),
        F.coalesce(rnd(exact_sum(threat), 4), F.lit(0.0)).alias("xt_total"),
        F.coalesce(rnd(exact_sum(F.when(threat > 0, threat)), 4), F.lit(0.0)).alias("xt_positive"),
        ratio(exact_sum(threat), n, 6).alias("xt_per_pass"),
    ]


def _key_passes(feed: DataFrame, keys: list[str]) -> DataFrame:
    """Key passes that did not become an assist; an event id named by an assisted goal is out."""
    taken = (feed.filter((F.col("etype") == "Goal") & has_id(29) & F.col("related_event_id").isNotNull())
             .select("combo_id", F.col("related_event_id").alias("event_id")).distinct())
    return (own_teams(feed).filter(_key_pass()).join(taken, ["combo_id", "event_id"], "left_anti")
            .groupBy(*keys).agg(F.count("*").alias("key_passes"), C(open_play_pass(), "key_passes_open_play")))


def team_passing_advanced(feed: DataFrame, sides: DataFrame) -> DataFrame:
    ok, op = F.col("ok"), F.col("open_play")
    base, n = F.col("base"), F.count_if(F.col("base"))
    good = base & ok
    dx, dy = F.col("ex") - F.col("sx"), F.col("ey") - F.col("sy")
    euclid = F.when(good, F.sqrt(dx * dx + dy * dy))
    cross, corner, chance = _is_pass() & has_id(2), _is_pass() & has_id(6), _is_pass() & has("BigChanceCreated")
    assisted = (F.col("etype") == "Goal") & has_id(29)
    rows = _geometry(own_teams(feed)).groupBy(*TEAM).agg(
        *_pass_profile(),
        C(_entry(), "passes_entering_final_third"),
        C(_in_third(), "passes_in_final_third"), C(_in_third() & ok, "passes_in_final_third_accurate"),
        C(_in_third() & op, "passes_in_final_third_open_play"),
        C(_in_third() & op & ok, "passes_in_final_third_op_accurate"),
        C(base & F.col("switch"), "switches_of_play"),
        ratio(exact_sum(euclid), F.count_if(good), 2).alias("avg_pass_length_euclid"),
        pct(F.count_if(base & (F.col("v_gain") == 0)), n, empty=0).alias("lateral_pass_pct"),
        ratio(F.count_if(base & F.col("progressive")), n, 4, empty=0).alias("directness_index"),
        C(assisted, "assists"), C(chance, "big_chances_created"), C(chance & op, "big_chances_created_open_play"),
        C(cross & op, "crosses_open_play_attempted"), C(cross & op & ok, "crosses_open_play_accurate"),
        C(corner & op, "corner_deliveries_open_play"), *_press_counts(), *_tilt_counts())
    rows = spine(sides, rows)
    # An assisted goal whose linked event is missing counts as open play.
    goals = own_teams(feed).filter(assisted & F.col("related_event_id").isNotNull())
    from_play = goals.groupBy(*TEAM).agg(F.count("*").alias("_assists"))
    dead = (assists(feed).filter("link.dead_ball")
            .groupBy(*TEAM).agg(F.count("*").alias("_dead")))
    rows = left_counts(left_counts(rows, from_play, TEAM), dead, TEAM)
    rows = left_counts(rows, _key_passes(feed, TEAM), TEAM).join(tempo(feed), TEAM, "left")
    return (
        rows.withColumn("assists_open_play", F.col("_assists") - F.col("_dead"))
        .withColumn("chances_created", F.col("key_passes") + F.col("assists"))
        .withColumn("chances_created_open_play", F.col("key_passes_open_play") + F.col("assists_open_play"))
        .withColumn("ppda", ratio(opponent("_passes_out"), F.col("_actions"), 2))
        .withColumn("field_tilt_pct", pct(F.col("_tilt"), F.col("_tilt") + opponent("_tilt")))
        .drop("_assists", "_dead", "_passes_out", "_actions", "_tilt"))


def player_passing_advanced(feed: DataFrame) -> DataFrame:
    """Players with at least one base pass."""
    rows = (_geometry(with_players(feed)).filter("base").groupBy(*PLAYER)
            .agg(*_pass_profile(), C(F.col("entry"), "passes_entering_final_third")))
    rows = left_counts(rows, _key_passes(feed, PLAYER).drop("key_passes_open_play"), PLAYER)
    rows = left_counts(rows, _player_assists(feed), PLAYER).join(hold_times(feed), PLAYER, "left")
    return rows.withColumn("chances_created", F.col("key_passes") + F.col("assists"))


# -- pressing and tilt -----------------------------------------------------------

def _press_counts() -> list[Column]:
    far = xcol(0) > 33.3
    return [C(_is_pass() & far, "_passes_out"),
            C((F.col("etype").isin("Tackle", "Interception", "Foul", "Challenge") | (F.col("type_id") == 74)) & far,
              "_actions")]


def _tilt_counts() -> list[Column]:
    return [C(F.col("is_touch") & (xcol(0) >= K.FINAL_THIRD), "_tilt")]


def ppda(feed: DataFrame, sides: DataFrame) -> DataFrame:
    """Opponent passes allowed per defensive action, beyond the own third of each side's frame."""
    rows = spine(sides, own_teams(feed).groupBy(*TEAM).agg(*_press_counts()))
    return (rows.withColumn("opp_passes", opponent("_passes_out"))
            .select(*TEAM, "opp_passes", F.col("_actions").alias("def_actions"),
                    ratio(F.col("opp_passes"), F.col("_actions"), 2).alias("ppda")))


def field_tilt(feed: DataFrame, sides: DataFrame) -> DataFrame:
    """Share of the two teams' final-third touches; NULL when there are none."""
    rows = spine(sides, own_teams(feed).groupBy(*TEAM).agg(*_tilt_counts()))
    return (rows.withColumn("_all", F.col("_tilt") + opponent("_tilt"))
            .select(*TEAM, F.col("_tilt").alias("final_third_touches"),
                    pct(F.col("_tilt"), F.col("_all")).alias("field_tilt_pct")))


def average_positions(feed: DataFrame) -> DataFrame:
    n = F.count("*")
    return (with_players(feed).filter("is_touch").groupBy(*PLAYER)
            .agg(ratio(exact_sum(xcol(0)), n, 2).alias("avg_x"), ratio(exact_sum(ycol(50)), n, 2).alias("avg_y"),
                 n.alias("touch_count")))
