"""The 26 tables made from the event provider's feed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from ..operators import defending, discipline, keeper, passing, possession, runs, sequences, shooting, states
from ..sinks.shared import written


@dataclass
class MatchData:
    """Feed and side tables of a set of matches (see `sources.event_docs` for their columns)."""

    feed: DataFrame
    sides: DataFrame
    squad: DataFrame
    formations: DataFrame
    minutes: DataFrame
    meta: DataFrame
    lineups: DataFrame

    @cached_property
    def spine(self) -> DataFrame:
        """State intervals: a few rows per match that several tables look up, so they are written once."""
        return written(states.state_spine(self.feed), "spine")


EVENT_TABLES: dict[str, Callable[[MatchData], DataFrame]] = {
    "ev_match_meta": lambda d: d.meta,
    "ev_lineups": lambda d: d.lineups,
    "ev_formations": lambda d: d.formations,
    "ev_team_passing": lambda d: passing.team_passing(d.feed, d.sides),
    "ev_player_passing": lambda d: passing.player_passing(d.feed),
    "ev_team_passing_adv": lambda d: passing.team_passing_advanced(d.feed, d.sides),
    "ev_player_passing_adv": lambda d: passing.player_passing_advanced(d.feed),
    "ev_pass_map": lambda d: passing.pass_map(d.feed),
    "ev_pass_network": lambda d: runs.pass_network(d.feed),
    "ev_avg_positions": lambda d: passing.average_positions(d.feed),
    "ev_shots": lambda d: shooting.shots_with_creators(d.feed),
    "ev_team_shooting": lambda d: shooting.team_shooting_full(d.feed),
    "ev_player_shooting": lambda d: shooting.player_shooting_full(d.feed),
    "ev_team_possession": lambda d: possession.team_possession(d.feed, d.sides, d.minutes),
    "ev_player_possession": lambda d: possession.player_possession(d.feed),
    "ev_team_poss_adv": lambda d: sequences.team_possession_advanced(d.feed, d.sides, d.minutes),
    "ev_sequences": lambda d: sequences.sequence_rows(d.feed),
    "ev_team_defending": lambda d: defending.team_defending(d.feed, d.sides, d.squad),
    "ev_player_defending": lambda d: defending.player_defending(d.feed, d.squad),
    "ev_team_discipline": lambda d: discipline.team_discipline(d.feed, d.sides),
    "ev_player_discipline": lambda d: discipline.player_discipline(d.feed),
    "ev_player_goalkeep": lambda d: keeper.keepers(d.feed, d.sides, d.squad),
    "ev_game_states": lambda d: d.spine,
    "ev_team_states": lambda d: states.team_states(d.spine),
    "ev_context_events": lambda d: states.context_events(d.feed, d.spine, d.formations),
    "ev_team_state_agg": lambda d: states.state_aggregate(d.feed, d.spine, d.minutes),
}


def with_names(df: DataFrame, names: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds player names: `columns` maps an id column to the name column it gets.

    `names` has one row per (combo_id, player_id).
    """
    for pid, name in columns.items():
        lookup = names.select("combo_id", names["player_id"].alias(pid), names["player_name"].alias(name))
        df = df.join(lookup, ["combo_id", pid], "left")
    return df
