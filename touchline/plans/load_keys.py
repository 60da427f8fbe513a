"""Natural keys of the raw tables."""

from __future__ import annotations

#: Tables with a natural key of their own are upserted; all others are replaced by match.
ENTITY_KEYS = {"rd_tournaments": ["tournament_id"], "rd_seasons": ["season_id"], "rd_teams": ["team_id"], "rd_players": ["player_id"],
               "rd_referees": ["referee_id"], "rd_managers": ["manager_id"]}
ENTITY_TABLES = frozenset(ENTITY_KEYS)


def match_keys(name: str) -> list[str] | None:
    """Natural key of a table whose rows are upserted one by one; None where the rows of a match are replaced as a whole."""
    if name == "ev_pass_network":
        return ["combo_id", "passer_id", "receiver_id"]
    if name.startswith("ev_team_") and name not in ("ev_team_states", "ev_team_state_agg"):
        return ["combo_id", "team_id"]
    if name.startswith("ev_player_") or name == "ev_lineups":
        return ["combo_id", "player_id"]
    return None
