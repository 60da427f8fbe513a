"""Defending: team rows with zero-sum duels, player rows by own involvement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.expr import count_where as C, exact_sum, has, has_id, pct, ratio, third, xcol
from .common import PLAYER, TEAM, opponent, own_teams, spine, with_players
from .possession import ZONES


def _flags() -> dict[str, Column]:
    et, ok = F.col("etype"), F.col("ok")
    foul = et == "Foul"
    physical = foul & has_id(13) & ~has_id(264)
    return {
        "tackle": et == "Tackle", "challenge": et == "Challenge", "interception": et == "Interception",
        "clearance": (et == "Clearance") & ~F.col("is_keeper"), "aerial": et == "Aerial",
        "recovery": et.isin("BallRecovery", "Interception", "KeeperSweeper"), "block": et == "BlockedPass",
        "foul": foul, "aerial_foul": foul & has("AerialFoul"),
        "duel_won": (et == "Tackle") | ((et == "TakeOn") & ok) | (physical & ok) | (et == "KeeperSweeper"),
        "duel_lost": (et == "Challenge") | ((et == "TakeOn") & ~ok) | (et == "Dispossessed") | (physical & ~ok),
    }


def _metrics() -> list[Column]:
    f, ok, et, x = _flags(), F.col("ok"), F.col("etype"), xcol(50)
    zone = third(x)
    shape = f["tackle"] | f["challenge"] | f["interception"] | f["clearance"] | f["block"]
    tackled, aerial = f["tackle"] | f["challenge"], f["aerial"]
    cleared = f["clearance"] & F.col("length").isNotNull()
    out = [
        C(tackled, "tackles_total"), C(f["tackle"] & ok, "tackles_won"), C(f["tackle"] & ~ok, "tackles_lost"),
        C(f["challenge"], "dribbled_past"),
        pct(F.count_if(f["tackle"] & ok), F.count_if(tackled)).alias("tackle_success_pct"),
        C(f["tackle"] & has("Defensive"), "tackles_defensive"), C(f["tackle"] & has("Offensive"), "tackles_offensive"),
        C(f["interception"], "interceptions"), C(f["interception"] & has("Head"), "interceptions_headed"),
        C(f["interception"] & has("LastMan"), "interceptions_last_man"),
        C(f["clearance"], "clearances"), C(f["clearance"] & has("Head"), "clearances_headed"),
        C(f["clearance"] & has("BlockedCross"), "clearances_blocked_cross"),
        C(f["clearance"] & (x <= 17), "clearances_in_own_box"),
        ratio(exact_sum(F.when(cleared, F.col("length"))), F.count_if(cleared), 2).alias("avg_clearance_distance_m"),
        C(aerial & has("Defensive"), "aerials_defensive"), C(aerial & has("Offensive"), "aerials_offensive"),
        pct(F.count_if(aerial & has("Defensive") & ok), F.count_if(aerial & has("Defensive"))).alias("aerial_win_pct_defensive"),
        pct(F.count_if(aerial & has("Offensive") & ok), F.count_if(aerial & has("Offensive"))).alias("aerial_win_pct_offensive"),
        (F.count_if(aerial & ok) + F.count_if(f["aerial_foul"] & ok)).alias("aerials_won"),
        (F.count_if(aerial) + F.count_if(f["aerial_foul"])).alias("_aerials"),
        C(f["recovery"] & (et != "Interception"), "_recoveries"),
        C(f["block"], "blocked_passes"), C(f["foul"] & ~ok, "fouls_conceded"), C(f["foul"] & ok, "fouls_won"),
        C(et == "Dispossessed", "dispossessed"), C(et == "ShieldBallOpp", "shield_ball_opp"),
        C(et == "OffsideProvoked", "offsides_caught"),
        C((et == "Error") & has_id(169), "errors_leading_to_shot"), C((et == "Error") & has_id(170), "errors_leading_to_goal"),
        C(et == "Error", "errors_total"),
        ratio(exact_sum(F.when(shape, x)), F.count_if(shape), 2).alias("avg_defensive_line_height"),
        C(f["duel_won"], "_gd_won"), C(f["duel_lost"], "_gd_lost"),
        # Zero-sum pool: the keeper's part is the smother, a save (type 10) with qualifier 54.
        (F.count_if(f["duel_won"] & (et != "KeeperSweeper")) + F.count_if((F.col("type_id") == 10) & has_id(54))).alias("_pool_won"),
        C((et == "SavedShot") & has_id(82), "_blocked_own"),
    ]
    for z in ZONES:
        here = zone == z
        duels = (f["duel_won"] | f["duel_lost"]) & here
        out += [
            C(tackled & here, f"tackles_{z}"), C(f["tackle"] & ok & here, f"tackles_won_{z}"),
            pct(F.count_if(f["tackle"] & ok & here), F.count_if(tackled & here)).alias(f"tackle_success_pct_{z}"),
            C(f["interception"] & here, f"interceptions_{z}"), C(aerial & here, f"aerials_{z}"),
            pct(F.count_if(aerial & ok & here), F.count_if(aerial & here)).alias(f"aerial_win_pct_{z}"),
            C(f["recovery"] & here, f"recoveries_{z}"), C(shape & here, f"press_actions_{z}"),
            C(duels, f"ground_duels_{z}"),
            pct(F.count_if(f["duel_won"] & here), F.count_if(duels)).alias(f"ground_duel_win_pct_{z}"),
        ]
    return out


def _finish(rows: DataFrame, ground: Column, ground_won: Column, aerials: Column, blocked_shots: Column) -> DataFrame:
    """Duel totals and the defensive-action total, for given pools."""
    return (
        rows.withColumn("_ground", ground).withColumn("_ground_won", ground_won).withColumn("aerials_total", aerials)
        .withColumn("blocked_shots", blocked_shots)
        .withColumn("ground_duels", F.col("_ground")).withColumn("ground_duels_won", F.col("_ground_won"))
        .withColumn("ground_duels_lost", F.col("ground_duels") - F.col("ground_duels_won"))
        .withColumn("ground_duel_win_pct", pct(F.col("ground_duels_won"), F.col("ground_duels")))
        .withColumn("aerials_lost", F.col("aerials_total") - F.col("aerials_won"))
        .withColumn("aerial_win_pct", pct(F.col("aerials_won"), F.col("aerials_total")))
        .withColumn("total_duels", F.col("ground_duels") + F.col("aerials_total"))
        .withColumn("total_duels_won", F.col("ground_duels_won") + F.col("aerials_won"))
        .withColumn("total_duels_lost", F.col("total_duels") - F.col("total_duels_won"))
        .withColumn("duel_win_pct", pct(F.col("total_duels_won"), F.col("total_duels")))
        .withColumn("ball_recoveries", F.col("_recoveries") + F.col("interceptions"))
        .withColumn("defensive_actions_total", F.col("clearances") + F.col("blocked_passes") + F.col("blocked_shots")
                    + F.col("interceptions") + F.col("tackles_won"))
        .drop("_ground", "_ground_won", "_aerials", "_recoveries", "_gd_won", "_gd_lost", "_pool_won", "_blocked_own"))


def mark_keepers(feed: DataFrame, squad: DataFrame) -> DataFrame:
    """Adds `is_keeper` to clearances made by a goalkeeper of the match's squads.

    Only clearances depend on it, so only they (a few percent of the feed) are joined.
    """
    clearance = F.col("etype") == "Clearance"
    keepers = (squad.filter(F.col("position") == "GK").select("combo_id", "player_id").distinct()
               .withColumn("is_keeper", F.lit(True)))
    joined = (feed.filter(clearance).join(keepers, ["combo_id", "player_id"], "left").na.fill(False, ["is_keeper"]))
    return feed.filter(~clearance).withColumn("is_keeper", F.lit(False)).unionByName(joined)


def team_defending(feed: DataFrame, sides: DataFrame, squad: DataFrame) -> DataFrame:
    rows = spine(sides, mark_keepers(own_teams(feed), squad).groupBy(*TEAM).agg(*_metrics()))
    match = Window.partitionBy("combo_id")
    return _finish(rows, F.sum("_pool_won").over(match), F.col("_pool_won"),
                   F.sum("aerials_won").over(match), opponent("_blocked_own"))


_TRACKED = ["Tackle", "Challenge", "Interception", "Clearance", "Aerial", "BallRecovery", "BlockedPass", "Dispossessed",
            "ShieldBallOpp", "OffsideProvoked", "KeeperSweeper", "TakeOn", "Foul", "Error"]


def player_defending(feed: DataFrame, squad: DataFrame) -> DataFrame:
    """Keepers always have a row; others need a defensive action, an error, a foul or a recovery."""
    acts = with_players(feed).filter(F.col("etype").isin(*_TRACKED))
    # A stub row per keeper keeps them in the grouping without a join.
    keepers = (squad.filter(F.col("position") == "GK")
               .select("combo_id", "team_id", "player_id", F.lit(True).alias("is_keeper"), F.lit("").alias("etype")))
    all_rows = mark_keepers(acts, squad).unionByName(keepers, allowMissingColumns=True)
    grouped = all_rows.groupBy(*PLAYER).agg(*_metrics(), F.max("is_keeper").alias("_keeper"))
    rows = _finish(grouped, F.col("_gd_won") + F.col("_gd_lost"), F.col("_gd_won"), F.col("_aerials"),
                   F.lit(0).cast("bigint"))
    busy = ((F.col("defensive_actions_total") > 0) | (F.col("errors_total") > 0)
            | (F.col("fouls_conceded") > 0) | (F.col("ball_recoveries") > 0))
    return rows.filter(F.col("_keeper") | busy).drop("_keeper")
