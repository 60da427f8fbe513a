"""Properties that must hold on any feed."""

from pyspark.sql import functions as F

from touchline.operators import defending, passing, possession, shooting, states
from touchline.operators.common import TEAM


def none_left(df, cond):
    assert df.filter(cond).count() == 0


def test_length_bands_sum_to_passes(tables):
    none_left(passing.team_passing(tables.feed, tables.sides), "passes_short + passes_medium + passes_long_band <> passes_total")


def test_team_rows_are_the_sum_of_player_rows(tables):
    cols = ["passes_total", "passes_accurate", "crosses_attempted", "big_chances_created"]
    team = passing.team_passing(tables.feed, tables.sides).select(*TEAM, *cols)
    players = passing.player_passing(tables.feed).groupBy(*TEAM).agg(*[F.sum(c).alias(c) for c in cols])
    assert team.exceptAll(players).count() == 0


def test_duels_are_zero_sum(tables):
    rows = defending.team_defending(tables.feed, tables.sides, tables["squad"])
    none_left(rows, "ground_duels_won + ground_duels_lost <> ground_duels")
    both = rows.groupBy("combo_id").agg(F.sum("ground_duels_won").alias("won"), F.max("ground_duels").alias("pool"), F.sum("aerials_won").alias("aw"),
                                        F.max("aerials_total").alias("ap"))
    none_left(both, "won <> pool OR aw <> ap")


def test_losses_do_not_exceed_touches(tables):
    none_left(possession.team_possession(tables.feed, tables.sides, tables["possession_minutes"]), "ball_losses > touches_total")


def test_states_add_up_to_the_match(tables):
    agg = states.state_aggregate(tables.feed, states.state_spine(tables.feed), tables["possession_minutes"])
    total = agg.groupBy(*TEAM).agg(F.sum("passes").alias("p"), F.sum("shots").alias("s"))
    base = passing.team_passing(tables.feed, tables.sides).select(*TEAM, "passes_total")
    shots = shooting.team_shooting(tables.feed).select(*TEAM, "total_shots")
    none_left(total.join(base, TEAM).join(shots, TEAM, "left"), "p <> passes_total OR s <> coalesce(total_shots, 0)")


def test_metrics_do_not_depend_on_partitioning(tables):
    one = passing.team_passing_advanced(tables.feed, tables.sides)
    other = passing.team_passing_advanced(tables.feed.repartition(7, "event_id"), tables.sides)
    assert one.exceptAll(other).count() == 0
