"""Season aggregates after a load: only touched seasons are summed and ranked again.

A peer group of a percent rank lies within one season of a competition, so a load changes the rows of the seasons that its
matches belong or belonged to, and of those in which a player or team appears whose identity or position the load changed.
The rows of all other seasons are taken over as they are, and no match of another season is read for the totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .load_keys import ENTITY_TABLES
from .marts import Marts

SEASON = ["season_uid", "competition_uid"]


def _same_season(rows: DataFrame, seasons: DataFrame) -> Column:
    return rows[SEASON[0]].eqNullSafe(seasons[f"_{SEASON[0]}"]) & rows[SEASON[1]].eqNullSafe(seasons[f"_{SEASON[1]}"])


def _named(seasons: DataFrame) -> DataFrame:
    return seasons.select(*[F.col(c).alias(f"_{c}") for c in SEASON]).distinct()


def _changed(now: DataFrame, before: DataFrame, what: str) -> DataFrame:
    """Values of column `what` in rows that only one of the two tables has."""
    cols = [c for c in now.columns if c in before.columns]
    now, before = now.select(*cols), before.select(*cols)
    return now.exceptAll(before).unionByName(before.exceptAll(now)).select(what).distinct()


def touched_seasons(now: Marts, matches: DataFrame, before: dict[str, DataFrame]) -> DataFrame:
    """Seasons that a load of `matches` changes. `before` has the published player_xwalk, team_xwalk, dim_player and dim_match."""
    places = now.season_of_match()
    lineups = now.raw("ev_lineups")
    moved = _changed(now.dim_player().select("player_uid", "position"), before["dim_player"].select("player_uid", "position"), "player_uid")
    players = _changed(now.player_xwalk, before["player_xwalk"], "ev_player_id").select(F.col("ev_player_id").alias("player_id")).unionByName(
        now.player_xwalk.join(moved, "player_uid", "left_semi").select(F.col("ev_player_id").alias("player_id")))
    teams = _changed(now.team_xwalk, before["team_xwalk"], "ev_team_id").select(F.col("ev_team_id").alias("team_id"))
    affected = (matches.select("combo_id").unionByName(lineups.join(players.distinct(), "player_id", "left_semi").select("combo_id"))
                .unionByName(lineups.join(teams, "team_id", "left_semi").select("combo_id"))).distinct()
    were = before["dim_match"].select("combo_id", *SEASON).join(affected, "combo_id", "left_semi")
    return places.join(affected, "combo_id", "left_semi").select(*SEASON).unionByName(were.select(*SEASON)).distinct()


def of_seasons(now: Marts, seasons: DataFrame) -> Marts:
    """The marts of the matches of some seasons; identities and players are those of all matches."""
    places, named = now.season_of_match(), _named(seasons)
    matches = now.keep(places.join(named, _same_season(places, named), "left_semi").select("combo_id"), "season_matches")

    def raw(name: str) -> DataFrame:
        df = now.raw(name)
        return df if name in ENTITY_TABLES or "combo_id" not in df.columns else df.join(matches, "combo_id", "left_semi")

    part = Marts(raw, min_minutes=now.min_minutes, keep=now.keep)
    part.player_xwalk, part.team_xwalk, part.dim_player = now.player_xwalk, now.team_xwalk, now.dim_player
    return part


def refreshed(now: Marts, name: str, old: DataFrame, seasons: DataFrame) -> DataFrame:
    """The aggregate `name` after a load that touched `seasons`, from its rows before."""
    named = _named(seasons)
    fresh = getattr(of_seasons(now, seasons), name)()
    return old.join(named, _same_season(old, named), "left_anti").unionByName(fresh)
