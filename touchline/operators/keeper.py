"""Goalkeepers: one row per keeper of each squad."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.expr import count_where as C, exact_sum, goal_distance_m, has, has_id, pct, ratio, xcol, ycol
from ..functions import fixed as K
from .common import TEAM, opponent, own_teams, spine


def keepers(feed: DataFrame, sides: DataFrame, squad: DataFrame) -> DataFrame:
    et, ok, x, y = F.col("etype"), F.col("ok"), xcol(0), ycol(50)
    save = et == "Save"
    proper = save & ~has("FromShotOffTarget")
    pickup, claim, sweep, punch = et == "KeeperPickup", et == "Aerial", et == "KeeperSweeper", et == "Punch"
    kick = (et == "Pass") & ~has_id(123)
    far = kick & has("Longball")
    measured, punched = kick & F.col("length").isNotNull(), punch & F.col("length").isNotNull()
    # A missing or zero end point falls back to (0, 50); an end x of 0 never counts as progress.
    ex = F.coalesce(F.col("pass_end_x"), F.lit(0.0))
    ey = F.coalesce(F.col("pass_end_y"), F.lit(50.0))
    forward = ((et == "Pass") & ok & (ex != 0) & (x > K.OWN_THIRD_MAX)
               & (goal_distance_m(ex, ey) < goal_distance_m(x, y) * 0.75))
    n_kick, n_far = F.count_if(kick), F.count_if(far)
    who = squad.filter(F.col("position") == "GK").select(*TEAM, "player_id").distinct()
    acts = (feed.join(who.select("combo_id", "player_id").distinct(), ["combo_id", "player_id"], "left_semi")
            .groupBy("combo_id", "player_id").agg(
        C(proper, "saves"), C(save & has_id(178), "saves_standing"), C(save & has_id(179), "saves_diving"),
        C(proper & has_id(11115), "saves_in_box"), C(proper & has_id(11117), "saves_out_of_box"),
        C(save & has("Collected"), "saves_collected"), C(save & has("ParriedSafe"), "saves_parried_safe"),
        C(save & has("ParriedDanger"), "saves_parried_danger"), C(save & has("Head"), "saves_with_head"),
        C(save & has_id(21), "saves_other_body_part"),
        C(pickup, "keeper_pickups"), C(pickup & ~has_id(178), "pickups_routine"),
        C(pickup & has_id(178), "pickups_after_save"),
        C(claim, "high_claims"), C(claim & ok, "high_claims_won"),
        pct(F.count_if(claim & ok), F.count_if(claim)).alias("high_claim_win_pct"),
        C(sweep, "sweeper_actions"), ratio(exact_sum(F.when(sweep, x)), F.count_if(sweep), 2).alias("avg_sweeper_x"),
        C(punch, "punches"), C(punch & ok, "punches_accurate"),
        ratio(exact_sum(F.when(punched, F.col("length"))), F.count_if(punched), 2).alias("avg_punch_distance_m"),
        C((et == "Pass") | punch, "distributions_total"),
        n_kick.alias("passes_total"), C(kick & ok, "passes_accurate"),
        pct(F.count_if(kick & ok), n_kick).alias("distribution_accuracy_pct"),
        C((et == "Pass") & has_id(123), "keeper_throws"),
        n_far.alias("longballs"), C(far & ok, "longballs_accurate"),
        pct(F.count_if(far & ok), n_far).alias("longball_accuracy_pct"),
        C(kick & ~has("Longball"), "short_passes"), C(kick & has_id(5), "freekick_passes"),
        ratio(exact_sum(F.when(measured, F.col("length"))), F.count_if(measured), 2).alias("avg_distribution_length_m"),
        pct(n_far, n_kick).alias("long_kick_pct"), pct(F.count_if(kick & ~has("Longball")), n_kick).alias("short_kick_pct"),
        C(x > K.KEEPER_BOX_X, "touches_outside_box"), C(kick & (x > K.KEEPER_BOX_X), "passes_outside_box"),
        C(et == "Clearance", "clearances"), C(forward, "progressive_passes")))
    team = spine(sides, own_teams(feed).groupBy(*TEAM).agg(
        C(et == "Goal", "_goals"), C((et == "Pass") & has_id(124), "goal_kicks")))
    team = team.withColumn("goals_conceded", opponent("_goals")).drop("_goals")
    counts = [n for n, t in acts.dtypes if t == "bigint" and n not in ("player_id",)]
    return (who.join(acts, ["combo_id", "player_id"], "left").na.fill(0, counts).join(team, TEAM, "left")
            .withColumn("shots_on_target_faced", F.col("saves") + F.col("goals_conceded"))
            .withColumn("save_pct", pct(F.col("saves"), F.col("shots_on_target_faced"))))
