"""Game states: the interval spine, state tags, context events, the state aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions import fixed as K
from ..functions.expr import (
    clock, count_where as C, exact_sum, expected_threat, has, has_any, has_id, in_penalty_area, is_base_pass, man_state,
    open_play_state, pct, ratio, rnd, score_bucket, shot_on_target, xcol, ycol,
)
from .common import TEAM, linked, own_teams

_END_OF_TIME = 2**62


def _period_stats(feed: DataFrame) -> DataFrame:
    """Start, end, clock shift and last event time of each period of each match."""
    real = F.col("period").between(1, 4)
    start, t = real & (F.col("etype") == "Start"), F.col("t_s")
    raw = F.coalesce("minute", F.lit(0)) * 60 + F.coalesce("second", F.lit(0))
    return feed.groupBy("combo_id", "home_id", "away_id", "period").agg(
        F.min(F.when(start, t)).alias("start_s"),
        F.max(F.when(real & (F.col("etype") == "End"), t)).alias("end_s"),
        F.min(F.when(start, t - raw)).alias("shift_s"), F.max(t).alias("last_s"))


def period_bounds(feed: DataFrame) -> DataFrame:
    """Periods with a start and an end; a match without any gets one from 0 to its last event."""
    match = Window.partitionBy("combo_id")
    bounded = F.col("start_s").isNotNull() & F.col("end_s").isNotNull()
    rows = (_period_stats(feed).withColumn("_bounded", bounded)
            .withColumn("_any", F.max("_bounded").over(match)).withColumn("_last", F.max("last_s").over(match)))
    known = rows.filter("_bounded").select("combo_id", "home_id", "away_id", "period", "start_s", "end_s", "shift_s")
    whole = (rows.filter("NOT _any").groupBy("combo_id", "home_id", "away_id")
             .agg(F.max("_last").alias("end_s"))
             .select("combo_id", "home_id", "away_id", F.lit(1).alias("period"), F.lit(0).cast("bigint").alias("start_s"),
                     "end_s", F.lit(0).cast("bigint").alias("shift_s")))
    return known.unionByName(whole)


def _changes(feed: DataFrame) -> DataFrame:
    """Goals (own goals credit the opponent) and dismissals, with their effect on the state."""
    goal = F.col("etype") == "Goal"
    red = (F.col("etype") == "Card") & has_any(["Red", "SecondYellow"])
    own = F.col("team_id") == F.col("home_id")
    home = F.coalesce(F.when(goal & has("OwnGoal"), ~own).otherwise(own), F.lit(False))

    def one(cond: Column) -> Column:
        return F.when(cond, 1).otherwise(0)

    side = F.when(home, "home").otherwise("away")
    return feed.filter(goal | red).select(
        "combo_id", "t_s", F.struct("t_s", "event_id", "pos").alias("at"),
        one(goal & home).alias("gh"), one(goal & ~home).alias("ga"), one(~goal & home).alias("rh"), one(~goal & ~home).alias("ra"),
        F.concat(F.when(goal, "goal_").otherwise("red_card_"), side).alias("trigger"))


def state_spine(feed: DataFrame) -> DataFrame:
    """Intervals of constant score and player count, cut at goals, dismissals and period bounds."""
    bounds = period_bounds(feed)
    # At most four periods per match.
    by_match = bounds.groupBy("combo_id").agg(
        F.sort_array(F.collect_list(F.struct("period", "start_s", "end_s"))).alias("periods"))
    placed = (_changes(feed).join(by_match, "combo_id")
              .withColumn("p", F.try_element_at(F.filter("periods", lambda p: p["end_s"] >= F.col("t_s")), F.lit(1)))
              .filter(F.col("p").isNotNull()))
    effects = ["gh", "ga", "rh", "ra"]
    cuts = placed.select("combo_id", F.col("p.period").alias("period"),
                         F.greatest("t_s", "p.start_s").alias("start_s"), *effects, "at", "trigger")
    edges = bounds.select("combo_id", "period", F.explode(F.array("start_s", "end_s")).alias("start_s"))
    points = (cuts.unionByName(edges, allowMissingColumns=True).na.fill(0, effects)
              .groupBy("combo_id", "period", "start_s")
              .agg(*[F.sum(c).alias(c) for c in effects], F.max_by("trigger", "at").alias("trigger")))
    so_far = Window.partitionBy("combo_id").orderBy("period", "start_s")
    in_period = Window.partitionBy("combo_id", "period").orderBy("start_s")
    total = {c: F.sum(c).over(so_far) for c in effects}
    rows = (points.withColumn("end_s", F.lead("start_s").over(in_period))
            .withColumn("home_score", total["gh"]).withColumn("away_score", total["ga"])
            .withColumn("home_players", 11 - total["rh"]).withColumn("away_players", 11 - total["ra"])
            .filter(F.col("end_s").isNotNull())
            .withColumn("state_id", (F.row_number().over(so_far) - 1).cast("bigint")))
    rows = rows.join(bounds.select("combo_id", "period", "shift_s", "home_id", "away_id"), ["combo_id", "period"])
    sm, ss, sd = clock(F.col("start_s"), F.col("shift_s"), F.col("period"))
    em, es, ed = clock(F.col("end_s"), F.col("shift_s"), F.col("period"))
    opening = F.when(F.col("period") == 1, "kickoff").otherwise("period_start")
    return rows.select(
        "combo_id", "state_id", "period", "start_s", "end_s", (F.col("end_s") - F.col("start_s")).alias("duration_s"),
        "home_id", "away_id", "home_score", "away_score", "home_players", "away_players",
        F.coalesce("trigger", opening).alias("trigger"),
        (F.col("home_score") - F.col("away_score")).alias("home_score_diff"),
        (F.col("home_players") - F.col("away_players")).alias("man_diff_home"),
        sm.alias("start_minute"), ss.alias("start_second"), sd.alias("start_display"),
        em.alias("end_minute"), es.alias("end_second"), ed.alias("end_display"))


def team_states(spine: DataFrame) -> DataFrame:
    """The spine from the perspective of each team."""
    home = F.col("is_home")

    def pick(h: str, a: str) -> Column:
        return F.when(home, F.col(h)).otherwise(F.col(a))

    sign = F.when(home, 1).otherwise(-1)
    rows = spine.withColumn("is_home", F.explode(F.array(F.lit(True), F.lit(False))))
    rows = (rows.withColumn("score_diff", F.col("home_score_diff") * sign)
            .withColumn("man_diff", F.col("man_diff_home") * sign))
    return rows.select(
        "combo_id", "state_id", pick("home_id", "away_id").alias("team_id"),
        pick("away_id", "home_id").alias("opponent_id"), "is_home", "period", "start_s", "end_s", "duration_s",
        "start_minute", "end_minute", "start_display", "end_display",
        pick("home_score", "away_score").alias("score_for"), pick("away_score", "home_score").alias("score_against"),
        "score_diff", score_bucket(F.col("score_diff")).alias("score_bucket"),
        "man_diff", man_state(F.col("man_diff")).alias("man_state"), "trigger")


def at_state(rows: DataFrame, spine: DataFrame, time: str = "t_s") -> DataFrame:
    """Adds the struct `state`: the first interval that ends at or after `time`, else the last one.

    Forward as-of join as one pass: rows and interval ends are sorted together,
    latest first, and each row takes the interval end seen last.
    """
    last = F.lead("state_id").over(Window.partitionBy("combo_id").orderBy("state_id")).isNull()
    ends = spine.select(
        "combo_id", F.when(last, F.lit(_END_OF_TIME)).otherwise(F.col("end_s")).cast("bigint").alias("_k"), F.lit(0).alias("_row"),
        F.struct("state_id", F.col("period").alias("state_period"), "home_score_diff", "man_diff_home").alias("state"))
    order = Window.partitionBy("combo_id").orderBy(F.desc("_k"), "_row", F.desc("state.state_id"))
    both = (rows.withColumn("_k", F.col(time).cast("bigint")).withColumn("_row", F.lit(1))
            .unionByName(ends, allowMissingColumns=True))
    seen = F.last("state", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("state", seen).filter("_row = 1").drop("_k", "_row")


def _perspective(team: Column, home: Column) -> tuple[Column, Column]:
    sign = F.when(team == home, 1).otherwise(-1)
    return F.col("state.home_score_diff") * sign, F.col("state.man_diff_home") * sign


def state_tags(feed: DataFrame, spine: DataFrame) -> DataFrame:
    """State of each event from its own team's perspective."""
    tagged = at_state(own_teams(feed).select("combo_id", "pos", "t_s", "team_id", "home_id"), spine)
    score, men = _perspective(F.col("team_id"), F.col("home_id"))
    return tagged.select(
        "combo_id", "pos", "team_id", F.col("state.state_id").alias("state_id"), F.col("state.state_period").alias("period"),
        score.alias("score_diff"), score_bucket(score).alias("score_bucket"), men.alias("man_diff"), man_state(men).alias("man_state"))


def context_events(feed: DataFrame, spine: DataFrame, formations: DataFrame) -> DataFrame:
    """Goals, cards, substitutions and formation changes with the state they fell in."""
    et = F.col("etype")
    nil = F.lit(None).cast("bigint")
    own_goal = (et == "Goal") & has("OwnGoal")
    opp = F.when(F.col("team_id") == F.col("home_id"), F.col("away_id")).otherwise(F.col("home_id"))
    sub = et == "SubstitutionOn"
    kind = (F.when(own_goal, "own_goal").when((et == "Goal") & has("Penalty"), "penalty_goal").when(et == "Goal", "goal")
            .when(sub, "substitution").when(has("Red"), "red_card").when(has("SecondYellow"), "second_yellow")
            .otherwise("yellow_card"))
    from_feed = own_teams(feed).filter(et.isin("Goal", "Card", "SubstitutionOn")).select(
        "combo_id", "home_id", F.col("period").cast("int").alias("period"), F.when(own_goal, opp).otherwise(F.col("team_id")).alias("team_id"),
        F.col("t_s").alias("look_s"), F.col("t_s").alias("time_s"), kind.alias("event_type"),
        F.when(~sub, F.col("player_id")).alias("player_id"), F.when(sub, F.col("player_id")).alias("player_in_id"),
        F.when(sub, F.col("related_player_id")).alias("player_out_id"), F.lit(None).cast("string").alias("detail"))

    phase = Window.partitionBy("combo_id", "team_id").orderBy("formation_index")
    was, now = F.col("_was"), F.col("formation_name")
    bounds = period_bounds(feed)
    periods = bounds.groupBy("combo_id", "home_id").agg(
        F.sort_array(F.collect_list(F.struct("period", "start_s", "end_s"))).alias("periods"))
    changed = (formations.withColumn("_was", F.lag("formation_name").over(phase))
               .filter(was.isNotNull() & ~was.eqNullSafe(now))
               .withColumn("time_s", F.coalesce("start_minute", F.lit(0)).cast("bigint") * 60)
               .join(periods, "combo_id"))
    # A change takes effect right after the full minute: intervals that end there are over.
    within = F.filter("periods", lambda p: (p["start_s"] <= F.col("time_s")) & (p["end_s"] > F.col("time_s")))
    from_formations = changed.select(
        "combo_id", "home_id", F.coalesce(F.try_element_at(within, F.lit(1))["period"], F.lit(1)).cast("int").alias("period"), "team_id",
        (F.col("time_s") + 1).alias("look_s"), "time_s", F.lit("formation_change").alias("event_type"),
        nil.alias("player_id"), nil.alias("player_in_id"), nil.alias("player_out_id"),
        F.concat(was, F.lit("->"), F.coalesce(now, F.lit("None"))).alias("detail"))

    tagged = at_state(from_feed.unionByName(from_formations), spine, "look_s")
    shifts = _period_stats(feed).filter("shift_s IS NOT NULL").select("combo_id", "period", "shift_s")
    score, men = _perspective(F.col("team_id"), F.col("home_id"))
    minute, second, display = clock(F.col("time_s"), F.col("shift_s"), F.col("period"))
    return tagged.join(shifts, ["combo_id", "period"], "left").select(
        "combo_id", "team_id", F.col("state.state_id").alias("state_id"), score.alias("score_diff_at"),
        man_state(men).alias("man_state_at"), "period", minute.alias("minute"), second.alias("second"),
        display.alias("minute_display"), "time_s", "event_type", "player_id", "player_in_id", "player_out_id", "detail")


# -- state aggregate -------------------------------------------------------------

def _event_counts() -> list[Column]:
    et, ok, touch, shot, goal = F.col("etype"), F.col("ok"), F.col("is_touch"), F.col("is_shot"), F.col("etype") == "Goal"
    x, y = xcol(-1), ycol(-1)
    ex = F.coalesce("pass_end_x", "end_x", x)
    ey = F.coalesce("pass_end_y", "end_y", y)
    base, is_pass, made = is_base_pass(), F.col("type_id") == 1, F.col("is_assist")
    threat = F.when(base, expected_threat(ex, ey) - expected_threat(x, y))
    key = F.col("type_id").isin(1, 61) & has("KeyPass") & ~made
    big = is_pass & has("BigChanceCreated")
    foul, card = et == "Foul", et == "Card"
    return [
        C(touch, "touches"), C(touch & (x > K.FINAL_THIRD), "final_third_touches"), C(touch & in_penalty_area(x, y), "box_touches"),
        C(shot, "shots"), C(shot & shot_on_target(), "shots_on_target"), C(shot & goal, "goals"),
        C(key, "key_passes"), C(key & open_play_state(), "key_passes_open_play"), C(made, "assists"),
        C(big, "big_chances_created"), C(big & open_play_state(), "big_chances_created_open_play"),
        C(shot & has("BigChance"), "big_chances"), C(shot & has("BigChance") & goal, "big_chances_scored"),
        exact_sum(threat).alias("_xt"), exact_sum(F.when(threat > 0, threat)).alias("_xt_pos"),
        C(base, "passes"), C(base & ok, "passes_completed"), C(is_pass & has_id(2), "crosses"), C(is_pass & has_id(6), "corners"),
        C(foul & ~ok, "fouls_committed"), C(foul & ok, "fouls_won"), C(et == "OffsideGiven", "offsides"),
        C(card & has("Yellow") & ~has("SecondYellow"), "yellow_cards"), C(card & has_any(["Red", "SecondYellow"]), "red_cards"),
        C(et == "SubstitutionOn", "subs_made"), C(et == "TakeOn", "take_ons"), C((et == "TakeOn") & ok, "take_ons_won"),
        C(et == "Tackle", "tackles"), C(et == "Interception", "interceptions"), C(et == "Clearance", "clearances"),
        C((et == "Aerial") & ok, "aerials_won"), C(et == "Aerial", "aerials_total"),
        C(et.isin(*K.PRESSING_TYPES) & (x >= K.PRESS_MIN_X), "defensive_actions"),
        C(is_pass & (x <= K.FINAL_THIRD), "_open_passes"),
    ]


def _assist_marks(feed: DataFrame) -> DataFrame:
    """Event ids named by assisted goals whose linked event is by the same team."""
    goals = own_teams(feed).filter((F.col("etype") == "Goal") & has_id(29)).select(*TEAM, "pos", "related_event_id")
    return (linked(feed, goals, ["t_s", "event_id", "pos"], ["team_id"])
            .filter(F.col("link.team_id") == F.col("team_id"))
            .select("combo_id", F.col("related_event_id").alias("event_id")).distinct())


def state_aggregate(feed: DataFrame, spine: DataFrame, minutes: DataFrame) -> DataFrame:
    """Team metrics per (team, period, score bucket, man state)."""
    marks = _assist_marks(feed).withColumn("_mark", F.lit(True))
    # Marks ride along in the feed: one shuffle by match serves this and the state lookup.
    marked = (own_teams(feed).unionByName(marks, allowMissingColumns=True).repartition("combo_id")
              .withColumn("is_assist", F.coalesce(F.max("_mark").over(Window.partitionBy("combo_id", "event_id")), F.lit(False)))
              .filter(F.col("_mark").isNull()).drop("_mark"))
    key = ["combo_id", "state_id", "team_id"]
    counts = (at_state(marked, spine).withColumn("state_id", F.col("state.state_id"))
              .groupBy(*key).agg(*_event_counts()))
    values = (at_state(minutes.withColumn("t_s", F.col("minute") * 60 + 30), spine)
              .groupBy("combo_id", F.col("state.state_id").alias("state_id"), "team_id")
              .agg(exact_sum(F.col("value")).alias("_own")))

    states = team_states(spine)
    theirs = counts.select("combo_id", "state_id", F.col("team_id").alias("opponent_id"),
                           F.col("final_third_touches").alias("_opp_ft"), F.col("_open_passes").alias("_faced"))
    rows = (states.join(counts, key, "left").join(theirs, ["combo_id", "state_id", "opponent_id"], "left")
            .join(values, key, "left")
            .join(values.select("combo_id", "state_id", F.col("team_id").alias("opponent_id"), F.col("_own").alias("_opp")),
                  ["combo_id", "state_id", "opponent_id"], "left"))
    summed = [c for c in counts.columns if c not in key and not c.startswith("_")]
    grouped = rows.groupBy(*TEAM, "period", "score_bucket", "man_state").agg(
        F.array_sort(F.collect_list("state_id")).alias("state_ids"),
        rnd(F.sum("duration_s") / 60, 1).alias("minutes"),
        exact_sum(F.col("_own")).alias("_own"), exact_sum(F.col("_opp")).alias("_opp"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in summed],
        F.coalesce(rnd(exact_sum(F.col("_xt")), 4), F.lit(0.0)).alias("xt_total"),
        F.coalesce(rnd(exact_sum(F.col("_xt_pos")), 4), F.lit(0.0)).alias("xt_positive"),
        F.coalesce(F.sum("_opp_ft"), F.lit(0)).alias("_opp_ft"), F.coalesce(F.sum("_faced"), F.lit(0)).alias("_faced"))
    own = F.coalesce("_own", F.lit(0.0))
    return (
        grouped.withColumn("possession_pct", pct(own, own + F.coalesce("_opp", F.lit(0.0)), 1))
        .withColumn("field_tilt_pct", pct(F.col("final_third_touches"), F.col("final_third_touches") + F.col("_opp_ft"), 1))
        .withColumn("pass_accuracy_pct", pct(F.col("passes_completed"), F.col("passes"), 1))
        .withColumn("ppda", ratio(F.col("_faced"), F.col("defensive_actions"), 2))
        .drop("_own", "_opp", "_opp_ft", "_faced"))
