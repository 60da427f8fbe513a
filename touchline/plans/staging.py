"""Staged views: one per raw table, with the conformed player and team ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators.reshape import cast_text_numeric, passthrough


@dataclass(frozen=True)
class Rule:
    """player/team: which conformed ids the view carries. keep_text: set for tables
    whose text columns become numbers, with the columns that stay text."""

    player: bool = False
    team: bool = False
    keep_text: tuple[str, ...] | None = None


_BOTH, _TEAM, _PLAIN, _PLAYER = Rule(True, True), Rule(team=True), Rule(), Rule(player=True)

STAGED: dict[str, Rule] = {
    "ev_avg_positions": _BOTH, "ev_context_events": _BOTH, "ev_formations": _TEAM, "ev_game_states": _PLAIN,
    "ev_lineups": _BOTH, "ev_match_meta": _PLAIN, "ev_pass_map": _BOTH, "ev_pass_network": _TEAM,
    "ev_player_defending": _BOTH, "ev_player_discipline": _BOTH, "ev_player_goalkeep": _BOTH, "ev_player_passing": _BOTH,
    "ev_player_passing_adv": _BOTH, "ev_player_possession": _BOTH, "ev_player_shooting": _BOTH, "ev_sequences": _TEAM,
    "ev_shots": _BOTH, "ev_team_defending": _TEAM, "ev_team_discipline": _TEAM, "ev_team_passing": _TEAM,
    "ev_team_passing_adv": _TEAM, "ev_team_poss_adv": _TEAM, "ev_team_possession": _TEAM, "ev_team_shooting": _TEAM,
    "ev_team_state_agg": _TEAM, "ev_team_states": _TEAM,
    "xg_lineups": _BOTH, "xg_match": _PLAIN,
    "xg_player_stats": Rule(True, True, ("combo_id", "player_name", "team_name")), "xg_shots": _BOTH, "xg_spatial": _PLAIN,
    "xg_team_stats": Rule(keep_text=("combo_id", "period")),
    "rd_lineups": _BOTH, "rd_managers": _PLAIN, "rd_match_stats": Rule(keep_text=("combo_id", "period")),
    "rd_matches": _PLAIN, "rd_missing_players": _BOTH, "rd_odds": _PLAIN,
    "rd_player_stats": Rule(True, True, ("combo_id", "position")), "rd_players": _PLAYER, "rd_referees": _PLAIN,
    "rd_seasons": _PLAIN, "rd_shots": _PLAYER, "rd_spatial": _PLAIN, "rd_teams": _TEAM, "rd_tournaments": _PLAIN,
    "od_odds": _PLAIN,
}


def _attach(df: DataFrame, xwalk: DataFrame, provider: str, what: str) -> DataFrame:
    """Adds `<what>_uid`. The anchor falls back to its own id; other providers may stay NULL."""
    own, uid = f"{what}_id", f"{what}_uid"
    lookup = xwalk.filter(F.col(f"{provider}_{what}_id").isNotNull()).select(F.col(f"{provider}_{what}_id").alias(own), uid)
    out = df.join(lookup, own, "left")
    return out.withColumn(uid, F.coalesce(uid, own)) if provider == "ev" else out


def stage(name: str, raw: DataFrame, players: DataFrame | None = None, teams: DataFrame | None = None) -> DataFrame:
    rule, provider = STAGED[name], name[:2]
    df = passthrough(raw)
    if rule.keep_text is not None:
        df = cast_text_numeric(df, rule.keep_text)
    if rule.player:
        df = _attach(df, players, provider, "player")
    if rule.team:
        df = _attach(df, teams, provider, "team")
    return df
