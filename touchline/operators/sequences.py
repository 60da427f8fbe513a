"""Possession sequences, stitched and chained into possessions.

All windows are keyed by match, after one shuffle by match; a match's feed is
one source document, so a window partition never exceeds one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions import fixed as K
from ..functions.expr import (
    count_where as C, exact_sum, goal_distance_m, has, in_penalty_area, is_base_pass, is_restart, pct, ratio, rnd,
)
from .common import TEAM, by_match, own_teams, spine
from .possession import field_tilt_possession, possession_share, ppda_possession

_SEQ = ["combo_id", "seq_id"]


def sequence_events(feed: DataFrame) -> DataFrame:
    """Events that belong to a raw sequence, with `seq_id` (1-based per match) and
    the sequence's end: `marker` (why it ended; NULL for an open-play change or a
    shot) and `next_type`/`next_team` of the event that followed."""
    order = Window.partitionBy("combo_id").orderBy("t_s", "event_id", "pos")
    so_far, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    et, team = F.col("etype"), F.col("team_id")
    stop = et.isin(*K.STOP_TYPES)
    own_goal = (et == "Goal") & has("OwnGoal")
    kept = by_match(feed.filter(stop | (~et.isin(*K.SKIPPED_TYPES) & team.isNotNull())), feed.count())

    def one(cond: Column) -> Column:
        return F.when(cond, 1).otherwise(0)

    rows = (
        kept.withColumn("hard", stop | (et == "Foul") | own_goal)
        .withColumn("restart", ~F.col("hard") & is_restart())
        .withColumn("shot_end", ~F.col("hard") & ~F.col("restart") & F.col("is_shot"))
        .withColumn("ord", F.row_number().over(order))
        .withColumn("seg", F.sum(one(F.col("hard") | F.col("restart"))).over(so_far)
                    + F.coalesce(F.sum(one(F.col("shot_end"))).over(before), F.lit(0))))
    seg = Window.partitionBy("combo_id", "seg").orderBy("ord")
    seg_before = seg.rowsBetween(Window.unboundedPreceding, -1)
    live = ~F.col("hard")
    first = live & (F.coalesce(F.sum(one(live)).over(seg_before), F.lit(0)) == 0)
    lost_contest = et.isin(*K.CONTESTED_TYPES) & ~F.col("ok")
    rows = (
        rows.withColumn("first", first).withColumn("weak", lost_contest & ~F.col("first"))
        .withColumn("holder", F.last(F.when(live & ~F.col("weak"), team), ignorenulls=True).over(seg_before))
        .withColumn("dropped", live & F.col("weak") & (team != F.col("holder")))
        .filter(~F.col("dropped"))
        .withColumn("starts", F.col("first") | (live & (team != F.col("holder"))))
        .withColumn("seq_id", F.sum(one(F.col("starts"))).over(so_far)))
    # What follows: the first later row that ends this sequence.
    back = Window.partitionBy("combo_id").orderBy(F.desc("ord")).rowsBetween(Window.unboundedPreceding, -1)
    boundary = F.when(F.col("hard") | F.col("starts"), F.struct("hard", "restart", "etype", "team_id", "ok", own_goal.alias("own_goal")))
    rows = rows.withColumn("after", F.last(boundary, ignorenulls=True).over(back)).filter(live)
    is_last = F.coalesce(F.lead("seq_id").over(order) != F.col("seq_id"), F.lit(True))
    fouled = (F.when(F.col("after.ok"), F.col("after.team_id"))
              .when(F.col("after.team_id") == F.col("away_id"), F.col("home_id")).otherwise(F.col("away_id")))
    marker = (F.when(F.col("shot_end"), F.lit(None))
              .when(F.col("after").isNull(), "End")
              .when(F.col("after.restart"), "Restart")
              .when(~F.col("after.hard"), F.lit(None))
              .when(F.col("after.etype") == "Foul", F.when(fouled == team, "FoulWon").otherwise("FoulConceded"))
              .when(F.col("after.own_goal"), F.when(F.col("after.team_id") != team, "OwnGoalFor").otherwise("End"))
              .otherwise(F.col("after.etype")))
    followed = ~F.col("shot_end") & ~F.col("after.hard")
    return (
        rows.withColumn("is_last", is_last)
        .withColumn("marker", F.when(F.col("is_last"), marker))
        .withColumn("next_type", F.when(F.col("is_last") & followed, F.col("after.etype")))
        .withColumn("next_team", F.when(F.col("is_last") & followed, F.col("after.team_id")))
        .drop("hard", "shot_end", "seg", "first", "weak", "holder", "dropped", "starts", "after"))


def raw_sequences(feed: DataFrame) -> DataFrame:
    """One row per raw sequence."""
    return sequence_events(feed).groupBy(*_SEQ, "team_id").agg(
        F.count("*").alias("length"), F.min_by("event_id", "ord").alias("event_id_start"),
        F.max_by("event_id", "ord").alias("event_id_end"), F.min_by("etype", "ord").alias("first_type"),
        F.max_by("is_shot", "ord").alias("ends_in_shot"),
        F.max_by(F.struct("marker", "next_type", "next_team"), "ord").alias("_end")
    ).select("*", "_end.*").drop("_end")


def stitched_events(feed: DataFrame) -> DataFrame:
    """Sequence events after stitching: `seq_id` is now the merged sequence.

    A lone reflexive touch between two fragments of the other team is left out
    and the fragments become one. Such a fragment is a single row, so its
    neighbours are the rows before and after it: no join or grouping is needed.
    """
    order = Window.partitionBy("combo_id").orderBy("ord")
    alone = F.count("*").over(Window.partitionBy(*_SEQ)) == 1
    before = F.lag("team_id").over(order)
    middle = (alone & F.col("etype").isin(*K.REFLEX_TYPES) & F.col("marker").isNull()
              & (F.col("team_id") != before) & (F.lead("team_id").over(order) == before)
              & F.lag("marker").over(order).isNull() & ~F.lag("is_shot").over(order))
    rows = sequence_events(feed).withColumn("_mid", F.coalesce(middle, F.lit(False)))
    # In a run of consecutive candidates every other one, from the first, is absorbed.
    run = F.col("seq_id") - F.row_number().over(Window.partitionBy("combo_id", "_mid").orderBy("ord"))
    rows = rows.withColumn("_run", F.when(F.col("_mid"), run))
    in_run = Window.partitionBy("combo_id", "_mid", "_run").orderBy("ord")
    rows = rows.withColumn("absorbed", F.col("_mid") & (F.row_number().over(in_run) % 2 == 1))
    starts = F.coalesce(F.lag("seq_id").over(order) != F.col("seq_id"), F.lit(True))
    opens = starts & ~F.col("absorbed") & ~F.coalesce(F.lag("absorbed").over(order), F.lit(False))
    return (rows.withColumn("_open", F.when(opens, 1).otherwise(0))
            .withColumn("seq_id", F.sum("_open").over(order)).filter(~F.col("absorbed"))
            .drop("_mid", "_run", "_open", "absorbed", "is_last"))


def stitched_sequences(events: DataFrame) -> DataFrame:
    """One row per stitched sequence, with geometry and end; `real` marks controlled ones."""
    order = Window.partitionBy(*_SEQ).orderBy("ord")
    # Movement between consecutive known x values.
    prev = F.last("x", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    step = F.col("x") - prev
    known = F.col("x").isNotNull()
    box = F.col("is_touch") & in_penalty_area(F.coalesce("x", F.lit(-1.0)), F.coalesce("y", F.lit(-1.0)))
    rows = events.withColumn("_step", step).groupBy(*_SEQ, "team_id").agg(
        F.count("*").alias("length"), F.min("t_s").alias("start_t"), F.max("t_s").alias("end_t"),
        F.min_by("x", F.when(known, F.col("ord"))).alias("x0"), F.max_by("x", F.when(known, F.col("ord"))).alias("x1"),
        F.min_by(F.struct("y", "event_id", "player_id", "etype", "restart", "x"), "ord").alias("a"),
        F.max_by(F.struct("y", "event_id", "player_id", "etype", "is_shot", has("Blocked").alias("blocked"), "marker", "next_type", "next_team"),
                 "ord").alias("z"),
        F.count_if(F.col("etype") == "Pass").alias("n_passes"),
        F.max(F.coalesce(F.col("x") > K.FINAL_THIRD, F.lit(False))).alias("reaches_third"),
        F.max(box).alias("in_box"), F.min(F.when(F.col("x") > K.FINAL_THIRD, F.col("t_s"))).alias("deep_t"),
        # In order of first appearance; as long as one sequence.
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("player_id").isNotNull(), F.struct("ord", "player_id")))),
                                     lambda e: e["player_id"])).alias("player_ids"),
        exact_sum(F.greatest("_step", F.lit(0.0))).alias("_fwd"), exact_sum(F.abs("_step")).alias("_move"))
    real = (F.col("length") >= 2) | ~F.col("a.etype").isin(*K.NOT_A_SEQUENCE)
    return (rows.withColumn("real", real)
            .withColumn("start_x", F.coalesce("x0", F.lit(50.0))).withColumn("end_x", F.coalesce("x1", F.lit(50.0)))
            .withColumn("upfield", F.coalesce(ratio(F.col("_fwd"), F.col("_move")), F.lit(0.0)))
            .drop("x0", "x1", "_fwd", "_move"))


def chained(seqs: DataFrame) -> DataFrame:
    """Real sequences with `possession_id` (0-based per match), `opens` at a possession's
    first sequence, and the possession's totals."""
    order = Window.partitionBy("combo_id").orderBy("seq_id")
    opens = ~F.col("team_id").eqNullSafe(F.lag("team_id").over(order))
    whole = Window.partitionBy("combo_id", "possession_id")
    rows = (seqs.filter("real").withColumn("opens", opens)
            .withColumn("possession_id", F.sum(F.when(F.col("opens"), 1).otherwise(0)).over(order) - 1)
            .withColumn("p_sequences", F.count("*").over(whole)).withColumn("p_end", F.max("end_t").over(whole))
            .withColumn("p_shot", F.max("z.is_shot").over(whole)).withColumn("p_deep", F.min("deep_t").over(whole)))
    # Counter-attack, read at the opening sequence: open play from the own half, in the final third soon after.
    soon = F.coalesce(F.col("p_deep") - F.col("start_t") <= K.COUNTER_SECONDS, F.lit(False))
    return rows.withColumn("p_counter", F.col("opens") & ~F.col("a.restart") & (F.coalesce("a.x", F.lit(50.0)) <= 50) & soon)


def _outcome() -> Column:
    end, marker = F.col("z"), F.col("z.marker")
    return (
        F.when(end["is_shot"], F.when(end["etype"] == "SavedShot", F.when(end["blocked"], "blocked").otherwise("saved"))
               .when(end["etype"] == "Goal", "goal").otherwise("off_target"))
        .when(marker == "FoulWon", "foul_won").when(marker == "FoulConceded", "foul_conceded")
        .when(marker == "OwnGoalFor", "goal")
        .when(marker == "Restart", F.when(end["next_team"] == F.col("team_id"), "set_piece_won").otherwise("out_of_play"))
        .when(marker == "OffsideGiven", "offside").when(marker.isin(*K.SILENT_STOPS), F.lit(None))
        .when(end["next_type"].isin(*K.BALL_WINNING_TYPES), "dispossessed")
        .when(end["next_type"].isNotNull(), "turnover"))


def _flagged(chain: DataFrame) -> DataFrame:
    """Sequence outcome (NULL for an administrative stop) and flags."""
    open_play = ~F.col("a.restart")
    ends_well = F.col("z.is_shot") | F.col("in_box")
    y0 = F.coalesce("a.y", F.lit(50.0))
    return (
        chain.withColumn("outcome", _outcome())
        .withColumn("duration_s", F.col("end_t") - F.col("start_t"))
        .withColumn("start_y", y0).withColumn("end_y", F.coalesce("z.y", F.lit(50.0)))
        .withColumn("is_open_play", open_play)
        .withColumn("is_shot", F.col("outcome").isin("goal", "saved", "blocked", "off_target"))
        .withColumn("is_ten_plus_pass", open_play & (F.col("n_passes") >= K.TEN_PLUS))
        .withColumn("is_build_up_attack", F.col("is_ten_plus_pass") & ends_well)
        .withColumn("is_direct_attack", open_play & (F.col("start_x") <= 50) & ends_well & (F.col("upfield") >= 0.5)
                    & (F.col("length") >= 2))
        .withColumn("is_high_turnover", open_play & F.col("opens")
                    & (goal_distance_m(F.col("start_x"), y0) <= K.HIGH_TURNOVER_M)))


def sequence_rows(feed: DataFrame) -> DataFrame:
    """One row per real sequence with a classified end; players in order of first appearance."""
    rows = _flagged(chained(stitched_sequences(stitched_events(feed)))).filter(F.col("outcome").isNotNull())
    return rows.select(
        "combo_id", "team_id", "seq_id", "possession_id", "length", "duration_s",
        rnd(F.col("start_x"), 1).alias("start_x"), rnd(F.col("start_y"), 1).alias("start_y"),
        rnd(F.col("end_x"), 1).alias("end_x"), rnd(F.col("end_y"), 1).alias("end_y"),
        "n_passes", "is_open_play", "is_shot", "is_ten_plus_pass", "is_build_up_attack", "is_direct_attack",
        "is_high_turnover", "outcome", F.col("a.event_id").alias("event_id_start"), F.col("z.event_id").alias("event_id_end"),
        F.col("a.player_id").alias("player_id_start"), F.col("z.player_id").alias("player_id_end"), "player_ids")


def possessions(feed: DataFrame) -> DataFrame:
    """One row per possession, with the counter-attack flag."""
    return (chained(stitched_sequences(stitched_events(feed))).filter("opens")
            .select("combo_id", "possession_id", "team_id", F.col("p_sequences").alias("sequences"),
                    (F.col("p_end") - F.col("start_t")).alias("duration_s"), F.col("p_shot").alias("has_shot"),
                    F.col("p_counter").alias("is_counter")))


def _sequence_metrics() -> list[Column]:
    """Metrics over classified sequences, and over possessions at their opening sequence."""
    done = F.col("outcome").isNotNull()
    n, op, shot = F.count_if(done), done & F.col("is_open_play"), done & F.col("is_shot")
    attack = done & F.col("reaches_third") & (F.col("length") >= 2)
    direct = op & (F.col("start_x") <= 50) & (F.col("duration_s") > 0)
    progress = F.greatest(F.lit(0.0), F.col("end_x") - F.col("start_x")) * F.lit(K.PITCH_LENGTH / 100)
    outcome, opens, counter = F.col("outcome"), F.col("opens"), F.col("p_counter")

    def mean(value: str | Column, cond: Column, digits: int = 1) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return ratio(F.sum(F.when(cond, value)), F.count_if(cond), digits)

    return [
        n.alias("sequences_total"), C(op, "open_play_sequences"),
        mean("duration_s", done).alias("avg_sequence_time_s"), mean("length", done).alias("avg_sequence_length"),
        mean("n_passes", done).alias("passes_per_sequence"),
        ratio(exact_sum(F.when(op, F.col("start_x"))) * F.lit(K.PITCH_LENGTH / 100), F.count_if(op), 1).alias("start_distance_m"),
        ratio(exact_sum(F.when(direct, progress)), F.sum(F.when(direct, F.col("duration_s"))), 2).alias("direct_speed_m_s"),
        C(done & F.col("is_ten_plus_pass"), "ten_plus_pass_sequences"), C(done & F.col("is_build_up_attack"), "build_up_attacks"),
        C(done & F.col("is_direct_attack"), "direct_attacks"), C(done & F.col("is_high_turnover"), "high_turnovers"),
        C(F.col("is_high_turnover") & shot, "high_turnover_shots"),
        C(shot, "shot_sequences"), pct(F.count_if(shot), n, 1).alias("shot_seq_pct"),
        mean("length", shot).alias("avg_shot_seq_length"), mean("duration_s", shot).alias("avg_shot_seq_duration_s"),
        mean("n_passes", shot).alias("avg_shot_seq_passes"),
        C(attack, "attack_sequences"), mean("duration_s", attack).alias("avg_attack_duration_s"),
        mean("n_passes", attack).alias("avg_attack_passes"),
        pct(F.count_if(outcome.isin("turnover", "dispossessed")), n, 1).alias("open_play_turnover_pct"),
        pct(F.count_if(outcome.isin("turnover", "dispossessed", "out_of_play")), n, 1).alias("possession_loss_pct"),
        pct(F.count_if(outcome.isin("foul_won", "set_piece_won", "foul_conceded", "offside")), n, 1).alias("set_piece_end_pct"),
        C(opens, "possessions_total"), mean(F.col("p_end") - F.col("start_t"), opens).alias("avg_possession_duration_s"),
        mean("p_sequences", opens, 2).alias("avg_sequences_per_possession"), C(counter, "counter_attack_sequences"),
        pct(F.count_if(counter & F.col("p_shot")), F.count_if(counter), 1).alias("counter_attack_shot_pct"),
    ]


def team_possession_advanced(feed: DataFrame, sides: DataFrame, minutes: DataFrame) -> DataFrame:
    """Sequence, possession, pressing and tilt metrics of each team."""
    seq = _flagged(chained(stitched_sequences(stitched_events(feed)))).groupBy(*TEAM).agg(*_sequence_metrics())
    good = own_teams(feed).groupBy(*TEAM).agg(
        C((F.col("etype") == "Pass") & is_base_pass() & F.col("ok"), "passes_accurate"),
        F.max("expanded_minute").alias("_last"))
    whole = F.max("_last").over(Window.partitionBy("combo_id"))
    base = (spine(sides, good).join(possession_share(minutes, sides), TEAM)
            .withColumn("_minutes", F.col("share") * F.coalesce(F.nullif(whole, F.lit(0)), F.lit(90)))
            .withColumn("passing_rate", ratio(F.col("passes_accurate"), F.col("_minutes"), 2))
            .withColumn("possession_minutes", rnd(F.col("_minutes"), 1)).drop("share", "_minutes", "_last"))
    out = (base.join(field_tilt_possession(feed, sides), TEAM)
           .join(ppda_possession(feed, sides).select(*TEAM, "ppda"), TEAM)
           .join(seq, TEAM, "left"))
    return out.na.fill(0, [c for c, t in seq.dtypes if t == "bigint" and c != "team_id"])
