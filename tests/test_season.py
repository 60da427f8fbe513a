"""Refreshed season aggregates equal full ones, and take untouched seasons over."""

from pyspark.sql import functions as F

from touchline.plans import season
from touchline.plans.catalog import raw_table
from touchline.plans.load_keys import ENTITY_TABLES
from touchline.plans.marts import Marts
from touchline.sinks.shared import written
from touchline.sources.adapter import Tables


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def test_only_touched_seasons_are_made_again(spark):
    """Matches of four seasons; a load replaces the lineups of some matches of one of them, and a player changes position."""
    t = Tables(spark, "/root/testdata/sf0.01")
    four = F.regexp_extract("combo_id", r"(\d+)$", 1).cast("bigint") % 4

    def source(reloaded: bool):
        def raw(name):
            df = raw_table(t, name)
            if name == "rd_matches":
                df = df.withColumn("season_id", four)
            if name == "rd_lineups" and not reloaded:
                df = df.withColumn("minutes_played", F.when(four == 2, F.col("minutes_played") - 5).otherwise(F.col("minutes_played")))
            return df
        return raw

    before, now = Marts(source(False), min_minutes=20), Marts(source(True), min_minutes=20)
    known = {"player_xwalk": before.player_xwalk, "team_xwalk": before.team_xwalk, "dim_player": before.dim_player(), "dim_match": before.dim_match()}
    matches = t["ev_match_meta"].filter(four == 2)
    seasons = written(season.touched_seasons(now, matches, known), "seasons")
    assert [r.season_uid for r in seasons.collect()] == [2]
    for name in ("agg_player_season", "agg_team_season"):
        old = written(getattr(before, name)(), "old")
        # A mark on the old rows shows which of them are taken over.
        marked = old.withColumn("goals", F.when(F.col("season_uid") != 2, F.col("goals") + 1000).otherwise(F.col("goals")))
        got, full = season.refreshed(now, name, marked, seasons), getattr(now, name)()
        assert rows(got.withColumn("goals", F.when(F.col("season_uid") != 2, F.col("goals") - 1000).otherwise(F.col("goals")))) == rows(full)
        assert got.filter("season_uid <> 2 and goals < 1000").count() == 0
    assert ENTITY_TABLES <= {"rd_tournaments", "rd_seasons", "rd_teams", "rd_players", "rd_referees", "rd_managers"}
