"""Dimensions, facts and season aggregates over the staged views."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expr import exact_sum, ratio, shot_key
from ..operators import identity
from ..operators.ranking import percent_ranks
from ..operators.reshape import join_new, optional
from ..sinks.shared import written
from .staging import STAGED, stage

_SEASON = ["season_uid", "competition_uid", "match_date"]


class Marts:
    """Marts over a source of raw tables: `raw(name)` returns the raw DataFrame.

    Staged views and marts are lazy. The crosswalks and the season totals are
    written once (`keep`), as many views read them.
    """

    def __init__(self, raw: Callable[[str], DataFrame], player_alias: DataFrame | None = None,
                 team_alias: DataFrame | None = None, min_minutes: int = 450,
                 keep: Callable[[DataFrame, str], DataFrame] = written, player_votes: DataFrame | None = None):
        self._player_votes = player_votes
        self.raw, self.min_minutes, self.keep = raw, min_minutes, keep
        self._player_alias, self._team_alias = player_alias, team_alias
        self._staged: dict[str, DataFrame] = {}

    # -- identity and staging --------------------------------------------------

    @cached_property
    def player_xwalk(self) -> DataFrame:
        return self.keep(identity.player_crosswalk(
            self.raw("ev_lineups"), self.raw("rd_lineups"), self.raw("rd_players"), self.raw("xg_lineups"),
            self._player_alias, self._player_votes), "player_xwalk")

    @cached_property
    def team_xwalk(self) -> DataFrame:
        return self.keep(identity.team_crosswalk(
            self.raw("ev_lineups"), self.raw("rd_lineups"), self.raw("xg_lineups"), self._team_alias), "team_xwalk")

    def staged(self, name: str) -> DataFrame:
        if name not in self._staged:
            rule = STAGED[name]
            self._staged[name] = stage(name, self.raw(name), self.player_xwalk if rule.player else None,
                                       self.team_xwalk if rule.team else None)
        return self._staged[name]

    # -- dimensions ------------------------------------------------------------

    def dim_competition(self) -> DataFrame:
        return self.staged("rd_tournaments").select(F.col("tournament_id").alias("competition_uid"), "name", "country", "tier")

    def dim_season(self) -> DataFrame:
        return self.staged("rd_seasons").select(F.col("season_id").alias("season_uid"), "name", "year",
                                                F.col("tournament_id").alias("competition_uid"))

    def dim_referee(self) -> DataFrame:
        return self.staged("rd_referees").select(F.col("referee_id").alias("referee_uid"), "name", "nationality", "games",
                                                 "yellow_cards", "red_cards", "double_yellow_cards")

    def dim_coach(self) -> DataFrame:
        votes = identity.coach_crosswalk(self.staged("xg_match"), self.staged("rd_matches"))
        return (self.staged("rd_managers").join(votes, "manager_id", "left")
                .select(F.col("manager_id").alias("coach_uid"), "name", "shortname", "slug", "xg_coach_id"))

    def dim_team(self) -> DataFrame:
        named = self.staged("ev_lineups").groupBy("team_uid").agg(F.max("team_name").alias("_own_name"))
        ref = self.staged("rd_teams").drop("team_id")
        return (self.team_xwalk.join(ref, "team_uid", "left").join(named, "team_uid", "left")
                .select("team_uid", "ev_team_id", "rd_team_id", "xg_team_id", F.coalesce("name", "_own_name").alias("name"),
                        "country", "city", "stadium", "stadium_capacity", "founded_date"))

    def dim_match(self) -> DataFrame:
        teams = self.team_xwalk

        def role(side: str) -> DataFrame:
            return teams.select(F.col("ev_team_id").alias(f"{side}_team_id"), F.col("team_uid").alias(f"{side}_team_uid"))

        xg = self.staged("xg_match")
        rd = self.staged("rd_matches").select(
            "combo_id", F.col("home_manager_id").alias("home_coach_uid"), F.col("away_manager_id").alias("away_coach_uid"),
            F.col("referee_id").alias("referee_uid"), F.col("tournament_id").alias("competition_uid"),
            F.col("season_id").alias("season_uid"), "winnercode", "has_shotmap", "has_xg", "home_formation", "away_formation")
        wanted = ["match_round", "home_score", "away_score", "match_date", "stadium_name", "stadium_city", "stadium_capacity",
                  "home_color", "away_color", "home_color_dark", "away_color_dark", "home_font_color", "away_font_color",
                  "home_font_dark", "away_font_dark", "has_shot_data", "has_momentum_data", "motm_id", "motm_name", "motm_rating"]
        xg = xg.select("combo_id", *[c for c in wanted if c in xg.columns])
        return (self.staged("ev_match_meta").select("combo_id", "home_team_id", "away_team_id", "attendance")
                .join(xg, "combo_id", "left").join(rd, "combo_id", "left")
                .join(role("home"), "home_team_id", "left").join(role("away"), "away_team_id", "left")
                .drop("home_team_id", "away_team_id"))

    def dim_player(self) -> DataFrame:
        dates = self._dates().select("combo_id", "match_date")

        def latest(rows: DataFrame, value: str, alias: str) -> DataFrame:
            # An aggregate, not a window: a player's whole history never sits in one task.
            # Rows without a date lose to any date; equal dates go to the larger match key.
            when = F.struct(F.col("match_date").isNotNull(), "match_date", "combo_id")
            return (rows.join(dates, "combo_id").filter(F.col("player_uid").isNotNull())
                    .groupBy("player_uid").agg(F.max_by(value, when).alias(alias)))

        xg = self.staged("xg_lineups").withColumn("_pos", F.coalesce("position", "usual_position"))
        pos = latest(xg.filter(F.col("_pos").isNotNull()), "_pos", "_position")
        ev = self.staged("ev_lineups")
        team = latest(ev, "team_uid", "most_recent_team_uid")
        named = ev.groupBy("player_uid").agg(F.max("player_name").alias("_own_name"))
        ref = self.staged("rd_players").select("player_uid", "name", "birth_date", "nationality",
                                               F.col("position").alias("_ref_position"))
        out = self.player_xwalk
        for side in (ref, named, pos, team):
            out = out.join(side, "player_uid", "left")
        return out.select("player_uid", "ev_player_id", "rd_player_id", "xg_player_id",
                          F.coalesce("name", "_own_name").alias("full_name"), "birth_date", "nationality",
                          F.coalesce("_position", "_ref_position").alias("position"), "most_recent_team_uid")

    def dim_spatial(self) -> DataFrame:
        """Payloads of both providers per match, also when only one has any."""
        return (self.staged("rd_spatial").join(self.staged("xg_spatial"), "combo_id", "full")
                .select("combo_id", *[F.col(c).alias(f"rd_{c}") for c in (
                    "average_positions", "home_heatmap", "away_heatmap", "full_player_heatmaps", "match_momentum_graph", "commentary")],
                    F.col("momentum_data").alias("xg_momentum_data")))

    # -- facts -----------------------------------------------------------------

    def _dates(self) -> DataFrame:
        """Season, competition and date of each match: dim_match without its team lookups."""
        rd = self.staged("rd_matches").select("combo_id", F.col("season_id").alias("season_uid"),
                                              F.col("tournament_id").alias("competition_uid"))
        return (self.staged("ev_match_meta").select("combo_id").join(rd, "combo_id", "left")
                .join(self.staged("xg_match").select("combo_id", "match_date"), "combo_id", "left"))

    def season_of_match(self) -> DataFrame:
        return self._dates().select("combo_id", "season_uid", "competition_uid")

    def _dated(self, df: DataFrame) -> DataFrame:
        return df.join(self._dates(), "combo_id", "left")

    def fct_player_match(self) -> DataFrame:
        ev = self.staged("ev_lineups").select(
            "combo_id", "player_uid", "team_uid", "player_name", "is_home_team", "is_starter", "is_captain",
            F.col("position").alias("ev_position"), "subbed_in_minute", "subbed_out_minute")
        xg = self.staged("xg_lineups").select(
            "combo_id", "player_uid", F.col("position").alias("xg_position"), F.col("usual_position").alias("xg_usual_position"),
            F.col("position_id").alias("xg_position_id"), F.col("usual_position_id").alias("xg_usual_position_id"),
            F.col("rating").alias("xg_rating"))
        rd = self.staged("rd_lineups").select("combo_id", "player_uid", F.col("position").alias("rd_position"), "minutes_played")
        stats = self.staged("rd_player_stats")
        rating = stats.select("combo_id", "player_uid", optional(stats, "match_rating").alias("rd_rating"))
        key = ["combo_id", "player_uid"]
        return self._dated(ev.join(xg, key, "left").join(rd, key, "left").join(rating, key, "left"))

    def _player_shooting(self) -> DataFrame:
        xg = (self.staged("xg_shots").groupBy("combo_id", "player_uid")
              .agg(exact_sum(F.col("xg")).alias("xg"), exact_sum(F.col("xgot")).alias("xgot")))
        return self.staged("ev_player_shooting").join(xg, ["combo_id", "player_uid"], "left")

    def fct_player_shooting(self) -> DataFrame:
        return self._dated(self._player_shooting())

    def fct_player_passing(self) -> DataFrame:
        return self._dated(join_new(self.staged("ev_player_passing"), self.staged("ev_player_passing_adv"), ["combo_id", "player_uid"]))

    def fct_player_possession(self) -> DataFrame:
        return self._dated(self.staged("ev_player_possession"))

    def fct_player_defending(self) -> DataFrame:
        return self._dated(self.staged("ev_player_defending"))

    def fct_player_discipline(self) -> DataFrame:
        return self._dated(self.staged("ev_player_discipline"))

    def fct_player_goalkeeping(self) -> DataFrame:
        return self._dated(self.staged("ev_player_goalkeep"))

    def fct_shots(self) -> DataFrame:
        ev = self.staged("ev_shots")
        moved = ["x", "y", "goal_mouth_y", "goal_mouth_z"]
        own = ev.withColumnsRenamed({c: f"ev_{c}" for c in moved}).drop("expanded_minute", "pos")
        xg = self.staged("xg_shots").select(
            "combo_id", "row_id", F.col("minute").alias("expanded_minute"), "minute_added", "xg", "xgot",
            *[F.col(c).alias(f"xg_{c}") for c in ("x", "y", "goal_crossed_y", "goal_crossed_z", "blocked_x", "blocked_y",
                                                  "shot_type", "situation", "keeper_id")])
        rd = self.staged("rd_shots").select("combo_id", "row_id", F.col("shot_id").alias("rd_shot_id"),
                                            F.col("xg").alias("rd_xg"), F.col("xgot").alias("rd_xgot"))
        key = ["combo_id", "row_id"]
        return self._dated(own.join(xg, key, "left").join(rd, key, "left")
                           .withColumn("shot_uid", shot_key(F.col("combo_id"), F.col("row_id"))))

    def fct_odds(self) -> DataFrame:
        return self._dated(self.staged("od_odds").select("combo_id", "market_name", "period_name", "line", "outcome_name",
                                                         "odds_value", "odds_direction"))

    def fct_team_match(self) -> DataFrame:
        match = self.dim_match().select("combo_id", "home_team_uid", "away_team_uid", *_SEASON)
        return self.staged("xg_team_stats").join(match, "combo_id", "left")

    def fct_team_shooting(self) -> DataFrame:
        return self._dated(self.staged("ev_team_shooting"))

    def fct_team_defending(self) -> DataFrame:
        return self._dated(self.staged("ev_team_defending"))

    def fct_team_discipline(self) -> DataFrame:
        return self._dated(self.staged("ev_team_discipline"))

    def fct_team_match_state(self) -> DataFrame:
        return self._dated(self.staged("ev_team_state_agg"))

    def fct_team_passing(self) -> DataFrame:
        return self._dated(join_new(self.staged("ev_team_passing"), self.staged("ev_team_passing_adv"), ["combo_id", "team_uid"]))

    def fct_team_possession(self) -> DataFrame:
        return self._dated(join_new(self.staged("ev_team_possession"), self.staged("ev_team_poss_adv"), ["combo_id", "team_uid"]))

    # -- season aggregates -----------------------------------------------------

    def agg_player_season(self) -> DataFrame:
        """Totals, per-90 rates and percent ranks among players of the same position."""
        key, join = ["player_uid", "season_uid", "competition_uid"], ["combo_id", "player_uid"]
        shooting = self._player_shooting().select(*join, "goals", "total_shots", "xg")
        touches = self.staged("ev_player_possession").select(*join, "touches", "dribbles_won")
        position = self.dim_player().select("player_uid", "position")
        rows = self.fct_player_match().join(shooting, join, "left").join(touches, join, "left")

        def total(c: str) -> Column:
            return F.sum(F.coalesce(c, F.lit(0))).alias

        base = rows.groupBy(*key).agg(
            F.sum("minutes_played").alias("minutes"), F.count("*").alias("matches"), total("goals")("goals"),
            total("total_shots")("shots"), F.coalesce(exact_sum(F.col("xg")), F.lit(0.0)).alias("xg"),
            total("touches")("touches"), total("dribbles_won")("dribbles"))
        per90 = (base.filter(F.col("minutes") >= self.min_minutes).join(position, "player_uid", "left")
                 .withColumn("n90", F.nullif(F.col("minutes"), F.lit(0)) / F.lit(90.0)))
        for m in ("goals", "shots", "xg", "touches", "dribbles"):
            per90 = per90.withColumn(f"{m}_p90", ratio(F.col(m), F.col("n90")))
        return percent_ranks(self.keep(per90, "player_season"), key, ["season_uid", "competition_uid", "position"],
                             ["goals_p90", "xg_p90", "touches_p90", "dribbles_p90"])

    def agg_team_season(self) -> DataFrame:
        key = ["team_uid", "season_uid", "competition_uid"]
        base = self._dated(self.staged("ev_team_shooting").select("combo_id", "team_uid", "goals", "total_shots")).groupBy(*key).agg(
            F.count("*").alias("matches"), F.sum(F.coalesce("goals", F.lit(0))).alias("goals"),
            F.sum(F.coalesce("total_shots", F.lit(0))).alias("shots"))
        base = base.withColumn("goals_per_match", ratio(F.col("goals"), F.col("matches")))
        return percent_ranks(self.keep(base, "team_season"), key, ["season_uid", "competition_uid"], ["goals", "shots"])


MARTS = [
    "dim_competition", "dim_season", "dim_referee", "dim_coach", "dim_team", "dim_match", "dim_player", "dim_spatial",
    "fct_player_match", "fct_player_shooting", "fct_player_passing", "fct_player_possession", "fct_player_defending",
    "fct_player_discipline", "fct_player_goalkeeping", "fct_shots", "fct_odds", "fct_team_match", "fct_team_shooting",
    "fct_team_defending", "fct_team_discipline", "fct_team_match_state", "fct_team_passing", "fct_team_possession",
    "agg_player_season", "agg_team_season",
]
