"""Fouls, cards and offsides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expr import card_type, count_where as C, foul_zone, has_id, pct, ratio, xcol, ycol
from .common import PLAYER, TEAM, linked, own_teams, spine, with_players


def _metrics() -> list[Column]:
    et, ok, first = F.col("etype"), F.col("ok"), F.col("period") == 1
    made, zone, card = (et == "Foul") & ~ok, foul_zone(xcol(50)), card_type()
    carded = et == "Card"
    return [
        C(made, "fouls_committed"), C((et == "Foul") & ok, "fouls_won"),
        C(made & has_id(285), "fouls_defensive"), C(made & has_id(286) & ~has_id(285), "fouls_offensive"),
        C(made & has_id(264), "fouls_aerial"),
        *[C(made & (zone == z), f"fouls_{z}") for z in ("own_box", "own_half", "midfield", "danger_area")],
        C(made & first, "fouls_first_half"), C(made & ~F.coalesce(first, F.lit(False)), "fouls_second_half"),
        C(made & (F.col("expanded_minute") >= 75), "fouls_late_game"),
        C(carded & (card == "Yellow"), "yellow_cards"),
        C(carded & card.isin("Red", "SecondYellow"), "red_cards"),
        C(carded & (card == "SecondYellow"), "second_yellow_cards"),
        C(et == "OffsideGiven", "offsides_committed"),
    ]


def team_discipline(feed: DataFrame, sides: DataFrame) -> DataFrame:
    rows = spine(sides, own_teams(feed).groupBy(*TEAM).agg(
        *_metrics(), C(F.col("etype") == "OffsideProvoked", "offsides_caught"),
        C((F.col("etype") == "OffsidePass") & has_id(8), "goals_disallowed_offside")))
    made = F.col("fouls_committed")
    return (
        rows.withColumn("dangerous_foul_rate_pct", pct(F.col("fouls_own_box") + F.col("fouls_danger_area"), made))
        .withColumn("foul_escalation_rate", ratio(F.col("fouls_second_half"), F.col("fouls_first_half"), 2))
        .withColumn("foul_to_card_ratio", ratio(made, F.col("yellow_cards") + F.col("red_cards"), 1)))


def player_discipline(feed: DataFrame) -> DataFrame:
    """Players with at least one foul event; cards and offsides of others are left out."""
    return (with_players(feed).filter(F.col("etype").isin("Foul", "Card", "OffsideGiven"))
            .groupBy(*PLAYER).agg(*_metrics(), C(F.col("etype") == "Foul", "_fouls"))
            .filter("_fouls > 0").drop("_fouls"))


def cards(feed: DataFrame) -> DataFrame:
    """One row per card, with the place of the foul that caused it."""
    rows = own_teams(feed).filter(F.col("etype") == "Card")
    causes = (linked(feed, rows.select("combo_id", "pos", "related_event_id"), ["pos"], ["x", "y"])
              .select("combo_id", "pos", F.coalesce("link.x", F.lit(0.0)).alias("foul_x"),
                      F.coalesce("link.y", F.lit(0.0)).alias("foul_y")))
    return (rows.select("combo_id", "pos", "team_id", "player_id", card_type().alias("card_type"), "minute",
                        "expanded_minute", "period", xcol(0).alias("x"), ycol(0).alias("y"))
            .join(causes, ["combo_id", "pos"], "left")
            .withColumn("foul_zone", F.when(F.col("foul_x").isNotNull(), foul_zone(F.col("foul_x")))))
