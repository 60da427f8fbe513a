"""Match data derived from the star-schema test tables.

Each table is one SELECT over other tables of this module or over the parquet
inputs. The text is plain SQL with integer arithmetic only, so that any SQL
engine derives the same rows. `Tables` builds them lazily as DataFrames.

The tables of matches grow with `events` (500 events make one match) or with `part`; teams, players, referees,
competitions and seasons are a fixed few. Twenty matches in a row belong to one season and competition.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import fixed as K
from ..functions.expr import constant_map, with_flags
from ..operators.common import by_match
from ..sinks.shared import input_state, written

INPUTS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_MATCH_KEY = "concat('M', lpad(cast(mno AS string), cast(greatest(5, length(cast(mno AS string))) AS int), '0'))"

TABLES: dict[str, tuple[list[str], str]] = {}


def _table(name: str, deps: list[str], sql: str) -> None:
    TABLES[name] = (deps, sql.strip())


_table("feed_base", ["events"], f"""
SELECT f.*,
  etype IN ('Goal','SavedShot','MissedShots','ShotOnPost') AS is_shot,
  etype NOT IN ('Start','End','Card','OffsideGiven','CornerAwarded','SubstitutionOn','Foul') AS is_touch,
  CASE WHEN period = 2 THEN expanded_minute - 3 ELSE expanded_minute END AS minute,
  CASE WHEN etype IN ('Pass','Clearance') THEN
    cast(round(cast(sqrt(((end_x - x) * 1.05) * ((end_x - x) * 1.05) + ((end_y - y) * 0.68) * ((end_y - y) * 0.68)) AS decimal(28,12)), 1) AS double)
  END AS length,
  CASE WHEN etype = 'Pass' THEN CASE m WHEN 0 THEN 'Cross' WHEN 1 THEN 'ThrowIn' WHEN 2 THEN 'KeeperThrow' WHEN 3 THEN 'CornerTaken'
         WHEN 4 THEN 'FreekickTaken' WHEN 5 THEN 'GoalKick' WHEN 6 THEN 'IndirectFreekickTaken' WHEN 7 THEN 'Longball'
         WHEN 8 THEN 'Throughball' WHEN 9 THEN 'KeyPass' WHEN 10 THEN 'BigChanceCreated' WHEN 11 THEN 'HeadPass' WHEN 12 THEN 'LayOff' END
       WHEN etype = 'TakeOn' THEN CASE WHEN m < 20 THEN 'Offensive' WHEN m < 28 THEN 'Defensive' WHEN m < 32 THEN 'OverRun' END
       WHEN etype IN ('Tackle','Aerial') THEN CASE WHEN m < 20 THEN 'Defensive' ELSE 'Offensive' END
       WHEN etype = 'Foul' THEN CASE WHEN m < 24 THEN 'Foul' WHEN m < 32 THEN 'AerialFoul' END
       WHEN etype = 'Card' THEN CASE WHEN m < 30 THEN 'Yellow' WHEN m < 36 THEN 'Red' ELSE 'SecondYellow' END
       WHEN etype = 'Goal' THEN CASE WHEN m < 20 THEN 'Assisted' WHEN m >= 37 THEN 'OwnGoal' WHEN m >= 34 THEN 'Penalty' END
       WHEN etype = 'SavedShot' AND m < 15 THEN 'Blocked'
       WHEN etype = 'ShotOnPost' AND m < 8 THEN 'FreekickTaken'
       WHEN etype = 'Save' THEN CASE WHEN m < 15 THEN 'DivingSave' WHEN m < 30 THEN 'StandingSave' ELSE 'FromShotOffTarget' END
       WHEN etype IN ('Clearance','Interception') AND m < 12 THEN 'Head' END AS qa,
  CASE WHEN etype = 'Pass' AND m = 3 THEN 'Cross'
       WHEN etype IN ('Goal','SavedShot','MissedShots','ShotOnPost') THEN
         CASE m % 4 WHEN 0 THEN 'RightFoot' WHEN 1 THEN 'LeftFoot' WHEN 2 THEN 'Head' ELSE 'BigChance' END END AS qb,
  CASE WHEN (etype = 'Goal' AND m < 20) OR (etype = 'Card' AND event_id > 0) THEN event_id - 1 END AS rel_event_id,
  CASE WHEN etype = 'SubstitutionOn' THEN team_id * 100 + player_id % 100 % 14 + 1 END AS related_player_id
FROM (
  SELECT mno, {_MATCH_KEY} AS combo_id, pos, event_id % 250 AS event_id, t_s,
    cast(floor(t_s / 60) AS bigint) AS expanded_minute, t_s % 60 AS second, period,
    home_id, away_id,
    CASE WHEN side = 0 THEN home_id ELSE away_id END AS team_id,
    CASE WHEN side = 0 THEN away_id ELSE home_id END AS opp_id,
    (CASE WHEN side = 0 THEN home_id ELSE away_id END) * 100 + user_id % 14 + 1 AS player_id,
    CASE WHEN pos IN (0, 250) THEN 'Start' WHEN pos IN (249, 499) THEN 'End'
      WHEN k < 52 THEN 'Pass' WHEN k < 57 THEN 'BallTouch' WHEN k < 62 THEN 'TakeOn' WHEN k < 66 THEN 'Tackle'
      WHEN k < 68 THEN 'Challenge' WHEN k < 71 THEN 'Interception' WHEN k < 75 THEN 'Clearance' WHEN k < 79 THEN 'Aerial'
      WHEN k < 83 THEN 'BallRecovery' WHEN k < 85 THEN 'BlockedPass' WHEN k < 87 THEN 'Dispossessed' WHEN k < 90 THEN 'Foul'
      WHEN k < 91 THEN 'Card' WHEN k < 92 THEN 'OffsideGiven' WHEN k < 93 THEN 'CornerAwarded' WHEN k < 94 THEN 'Save'
      WHEN k < 95 THEN 'KeeperPickup' WHEN k < 96 THEN 'SubstitutionOn' WHEN k < 97 THEN 'SavedShot'
      WHEN k < 98 THEN 'MissedShots' WHEN k < 99 THEN 'Goal' ELSE 'ShotOnPost' END AS etype,
    q % 5 < 4 AS ok, x, y, end_x, end_y, m
  FROM (
    SELECT b.*,
      1 + mno % 8 AS home_id,
      1 + (mno % 8 + 1 + cast(floor(mno / 8) AS bigint) % 7) % 8 AS away_id,
      cast(floor((pos - pos % 8) * 576 / 50) AS bigint) + cast(floor(pos % 8 / 2) AS bigint) * 3
        + CASE WHEN pos < 250 THEN 0 ELSE 24 END AS t_s,
      CASE WHEN pos < 250 THEN 1 ELSE 2 END AS period,
      (cast(floor(pos / 17) AS bigint) + CASE WHEN user_id % 11 = 0 THEN 1 ELSE 0 END) % 2 AS side,
      (event_id * 31 + user_id * 17 + c) % 100 AS k,
      (event_id * 13 + c * 3) % 100 AS q,
      (event_id * 7 + user_id * 3 + c) % 40 AS m,
      cast(c % 1000 AS double) / 10 AS x, cast((c * 7 + event_id * 3) % 1000 AS double) / 10 AS y,
      cast((c * 3 + event_id * 11) % 1000 AS double) / 10 AS end_x,
      cast((c * 11 + event_id * 5) % 1000 AS double) / 10 AS end_y
    FROM (
      SELECT event_id, user_id, cast(floor(event_id / 500) AS bigint) AS mno, event_id % 500 AS pos,
             cast(round(value * 100) AS bigint) AS c
      FROM {{events}}) b) t) f
""")

_table("matches", ["events"], f"""
SELECT mno, {_MATCH_KEY} AS combo_id, 1 + mno % 8 AS home_id,
  1 + (mno % 8 + 1 + cast(floor(mno / 8) AS bigint) % 7) % 8 AS away_id,
  2024 + cast(floor(mno / 60) AS bigint) % 2 AS season_uid, 10 + cast(floor(mno / 20) AS bigint) % 3 AS competition_uid, match_date
FROM (SELECT cast(floor(event_id / 500) AS bigint) AS mno, cast(min(ts) AS date) AS match_date
      FROM {{events}} GROUP BY 1) d
""")

_table("sides", ["matches"], """
SELECT combo_id, mno, home_id AS team_id, away_id AS opp_id, true AS is_home FROM {matches}
UNION ALL SELECT combo_id, mno, away_id, home_id, false FROM {matches}
""")

# Squads: everybody seen in the feed. Shirt 1 keeps goal; shirts above 11 are substitutes.
_table("squad", ["feed_base", "part"], """
SELECT l.combo_id, l.mno, l.is_home, l.team_id, l.player_id, l.player_id % 100 AS shirt,
  concat(p.p_name, ' ', chr(cast(96 + l.player_id % 100 AS int)), chr(cast(96 + l.team_id AS int))) AS player_name,
  concat('Club ', chr(cast(64 + l.team_id AS int))) AS team_name,
  CASE WHEN l.player_id % 100 = 1 THEN 'GK' WHEN l.player_id % 100 <= 5 THEN 'DEF'
       WHEN l.player_id % 100 <= 9 THEN 'MID' ELSE 'FWD' END AS position,
  CASE WHEN l.player_id % 100 <= 11 THEN 90 ELSE 30 END AS minutes_played
FROM (SELECT DISTINCT combo_id, mno, team_id = home_id AS is_home, team_id, player_id FROM {feed_base}) l
JOIN {part} p ON p.p_partkey = l.player_id % 200
""")

_PROVIDER_SHIRT = """CASE WHEN r = 0 AND mno % 3 = 0 THEN NULL WHEN r IN (0, 5) AND mno % 3 = 1 THEN NULL
  WHEN r = 0 AND mno % 3 = 2 THEN shirt + 40
  WHEN r = 2 AND mno % 3 = 2 THEN shirt % 14 + 1 WHEN r = 3 AND mno % 3 = 2 THEN (shirt + 12) % 14 + 1
  ELSE shirt END"""

_table("ev_lineups", ["squad"], """
SELECT combo_id, is_home AS is_home_team, team_id, team_name, player_id, player_name, shirt AS shirt_number, position,
  shirt <= 11 AS is_starter, shirt = 4 AS is_captain,
  CASE WHEN shirt > 11 THEN 60 END AS subbed_in_minute, CASE WHEN shirt IN (9, 10, 11) THEN 60 END AS subbed_out_minute
FROM {squad}
""")

_table("xg_lineups", ["squad"], f"""
SELECT combo_id, is_home AS is_home_team, team_id + 7000 AS team_id, player_id + 50000 AS player_id,
  upper(player_name) AS player_name, {_PROVIDER_SHIRT} AS shirt_number,
  CASE WHEN shirt <= 11 THEN position END AS position, position AS usual_position,
  CASE WHEN shirt <= 11 THEN shirt + 30 END AS position_id, shirt % 4 AS usual_position_id,
  cast(60 + (shirt * 7 + mno) % 40 AS double) / 10 AS rating
FROM (SELECT s.*, (player_id + mno) % 14 AS r FROM {{squad}} s) n WHERE NOT (r = 9 AND mno % 5 = 0)
""")

_table("rd_lineups", ["squad"], f"""
SELECT combo_id, is_home AS is_home_team, team_id + 8000 AS team_id, player_id + 60000 AS player_id,
  {_PROVIDER_SHIRT} AS shirt_number, substr(position, 1, 1) AS position, minutes_played,
  shirt <= 11 AS is_starter, shirt = 4 AS is_captain
FROM (SELECT s.*, (player_id + mno + 3) % 14 AS r FROM {{squad}} s) n WHERE NOT (r = 9 AND mno % 5 = 0)
""")

_table("rd_players", ["rd_lineups", "squad"], """
SELECT s.player_id + 60000 AS player_id, max(s.player_name) AS name, substr(max(s.position), 1, 1) AS position,
  concat('Nation ', cast(max(s.player_id) % 25 AS string)) AS nationality,
  cast(max(s.player_id) * 10000 - 4000000 AS bigint) AS birth_date
FROM {squad} s GROUP BY s.player_id
""")

_table("rd_teams", ["squad"], """
SELECT team_id + 8000 AS team_id, concat(max(team_name), ' FC') AS name, 'Country' AS country,
  concat('City ', cast(team_id AS string)) AS city, concat('Ground ', cast(team_id AS string)) AS stadium,
  20000 + team_id * 1000 AS stadium_capacity, 1900 + team_id AS founded_date
FROM {squad} WHERE team_id <> 3 GROUP BY team_id
""")

_table("rd_managers", ["sides"], """
SELECT team_id * 10 + 1 AS manager_id, concat('Coach ', cast(team_id AS string)) AS name,
  concat('C', cast(team_id AS string)) AS shortname, concat('coach-', cast(team_id AS string)) AS slug
FROM {sides} GROUP BY team_id
""")

_table("rd_referees", ["matches"], """
SELECT mno % 12 AS referee_id, concat('Referee ', cast(mno % 12 AS string)) AS name, 'Nation 1' AS nationality,
  count(*) AS games, 3 * count(*) AS yellow_cards, cast(floor(count(*) / 4) AS bigint) AS red_cards, 0 AS double_yellow_cards
FROM {matches} GROUP BY mno % 12
""")

_table("rd_tournaments", ["matches"], """
SELECT competition_uid AS tournament_id, concat('League ', cast(competition_uid AS string)) AS name, 'Country' AS country, 1 AS tier
FROM {matches} GROUP BY competition_uid
""")

_table("rd_seasons", ["matches"], """
SELECT season_uid AS season_id, concat('Season ', cast(season_uid AS string)) AS name, cast(season_uid AS string) AS year,
  min(competition_uid) AS tournament_id
FROM {matches} GROUP BY season_uid
""")

_table("ev_match_meta", ["matches"], """
SELECT combo_id, home_id AS home_team_id, away_id AS away_team_id, 20000 + mno % 1000 AS attendance, cast(match_date AS string) AS start_time
FROM {matches}
""")

_table("xg_match", ["matches"], """
SELECT combo_id, home_id + 7000 AS home_team_id, away_id + 7000 AS away_team_id, 1 + mno % 38 AS match_round,
  mno % 4 AS home_score, mno % 3 AS away_score, cast(match_date AS string) AS match_date,
  concat('Ground ', cast(home_id AS string)) AS stadium_name, concat('City ', cast(home_id AS string)) AS stadium_city,
  20000 + home_id * 1000 AS stadium_capacity, '#000000' AS home_color, '#ffffff' AS away_color,
  mno % 7 <> 6 AS has_shot_data, mno % 5 <> 4 AS has_momentum_data,
  home_id * 100 + 50004 AS motm_id, cast(70 + mno % 30 AS double) / 10 AS motm_rating,
  CASE WHEN mno % 9 = 8 THEN home_id + 900 ELSE home_id + 500 END AS ht_coach_id,
  CASE WHEN mno % 11 = 10 THEN NULL ELSE away_id + 500 END AS at_coach_id
FROM {matches}
""")

_table("rd_matches", ["matches"], """
SELECT combo_id, mno + 100000 AS match_id, competition_uid AS tournament_id, season_uid AS season_id, mno % 12 AS referee_id,
  home_id + 8000 AS home_team_id, away_id + 8000 AS away_team_id,
  home_id * 10 + 1 AS home_manager_id, away_id * 10 + 1 AS away_manager_id,
  1 + mno % 3 AS winnercode, mno % 7 <> 6 AS has_shotmap, mno % 7 <> 6 AS has_xg, '4-3-3' AS home_formation, '4-4-2' AS away_formation
FROM {matches}
""")

# Shots as the other providers list them; every seventh match lacks its last shot.
_table("provider_shots", ["feed_base"], """
SELECT * FROM (
  SELECT combo_id, mno, event_id, player_id, team_id, x, y, expanded_minute, m, pos, etype,
    row_number() OVER (PARTITION BY combo_id ORDER BY pos) - 1 AS row_id,
    count(*) OVER (PARTITION BY combo_id) AS n_shots
  FROM {feed_base} WHERE is_shot) s
WHERE NOT (mno % 7 = 3 AND row_id = n_shots - 1)
""")

_table("xg_shots", ["provider_shots"], """
SELECT combo_id, cast(row_id AS bigint) AS row_id, team_id + 7000 AS team_id, player_id + 50000 AS player_id, x * 1.05 AS x, y * 0.68 AS y,
  expanded_minute AS minute, CASE WHEN expanded_minute > 90 THEN expanded_minute - 90 END AS minute_added,
  cast(m + 1 AS double) / 50 AS xg, cast(m + 1 AS double) / 60 AS xgot,
  x AS goal_crossed_y, y AS goal_crossed_z, x AS blocked_x, y AS blocked_y, etype AS shot_type,
  CASE WHEN m < 10 THEN 'FromCorner' ELSE 'RegularPlay' END AS situation, team_id * 100 + 50001 AS keeper_id
FROM {provider_shots}
""")

_table("rd_shots", ["provider_shots"], """
SELECT combo_id, cast(row_id AS bigint) AS row_id, player_id + 60000 AS player_id, mno * 1000 + row_id AS shot_id,
  cast(m + 2 AS double) / 50 AS xg, cast(m + 2 AS double) / 60 AS xgot
FROM {provider_shots}
""")

_table("xg_player_stats", ["squad"], """
SELECT combo_id, player_id + 50000 AS player_id, team_id + 7000 AS team_id, player_name, team_name,
  concat(cast(shirt + mno % 30 AS string), '/', cast(shirt + mno % 30 + 5 AS string), ' (', cast(50 + shirt AS string), '%)') AS accurate_passes,
  CASE WHEN shirt = 2 THEN '-' WHEN shirt = 3 THEN '' ELSE concat(cast(shirt * 3 AS string), '%') END AS duels_won
FROM {squad}
""")

_table("rd_player_stats", ["squad"], """
SELECT combo_id, player_id + 60000 AS player_id, team_id + 8000 AS team_id, substr(position, 1, 1) AS position,
  concat('7.', cast((shirt * 7 + mno) % 10 AS string)) AS match_rating, cast(shirt * 4 + mno % 9 AS string) AS totalpass
FROM {squad}
""")

_table("team_stat_items", ["feed_base"], """
SELECT combo_id, concat('p', cast(period AS string)) AS period, etype AS stat_key, min(pos) AS pos,
  cast(sum(CASE WHEN team_id = home_id THEN 1 ELSE 0 END) AS string) AS home_value,
  concat(cast(sum(CASE WHEN team_id = home_id THEN 0 ELSE 1 END) AS string), '%') AS away_value
FROM {feed_base} WHERE etype IN ('Pass', 'Tackle', 'Foul', 'Aerial')
GROUP BY combo_id, period, etype
""")

_table("xg_team_stats", ["team_stat_items"], """
SELECT combo_id, period,
  max(CASE WHEN stat_key = 'Pass' THEN home_value END) AS pass_home, max(CASE WHEN stat_key = 'Pass' THEN away_value END) AS pass_away,
  max(CASE WHEN stat_key = 'Tackle' THEN home_value END) AS tackle_home, max(CASE WHEN stat_key = 'Tackle' THEN away_value END) AS tackle_away
FROM {team_stat_items} GROUP BY combo_id, period
""")

_table("rd_match_stats", ["team_stat_items"], """
SELECT combo_id, CASE WHEN period = 'p1' THEN 'FIRST-HALF' ELSE 'SECOND-HALF' END AS period,
  max(CASE WHEN stat_key = 'Foul' THEN home_value END) AS fouls_homevalue, max(CASE WHEN stat_key = 'Foul' THEN away_value END) AS fouls_awayvalue
FROM {team_stat_items} GROUP BY combo_id, period
""")

_table("rd_missing_players", ["squad"], """
SELECT combo_id, player_id + 60000 AS player_id, team_id + 8000 AS team_id, is_home AS is_home_team, player_name AS name,
  'missing' AS type, shirt % 3 AS reason
FROM {squad} WHERE (shirt + mno) % 13 = 5
""")

_table("rd_odds", ["matches"], """
SELECT combo_id, mno + 100000 AS match_id, concat(cast(1 + mno % 5 AS string), '/', cast(1 + mno % 7 AS string)) AS full_time_1x2_1,
  concat(cast(1 + mno % 3 AS string), '/', cast(1 + mno % 4 AS string)) AS full_time_1x2_2
FROM {matches}
""")

_table("rd_spatial", ["matches"], """
SELECT combo_id, concat('{{"avg":', cast(mno AS string), '}}') AS average_positions, concat('{{"home":', cast(mno AS string), '}}') AS home_heatmap,
  concat('{{"away":', cast(mno AS string), '}}') AS away_heatmap, '{{"None":null}}' AS full_player_heatmaps,
  concat('[', cast(mno AS string), ']') AS match_momentum_graph, '[]' AS commentary
FROM {matches} WHERE mno % 4 <> 1
""")

_table("xg_spatial", ["matches"], """
SELECT combo_id, concat('[', cast(mno * 2 AS string), ']') AS momentum_data FROM {matches} WHERE mno % 5 <> 4
""")

# Odds: each part is one outcome of a market; a hundred parts make one match.
_table("odds_items", ["part", "matches"], """
SELECT m.combo_id, m.mno, p.p_partkey, p.p_type AS market_name, p.p_size % 2 AS period_id,
  CASE WHEN p.p_size % 2 = 0 THEN 'Full Time' ELSE concat('Period ', cast(p.p_size % 2 AS string)) END AS period_name,
  CASE WHEN p.p_size % 3 = 0 THEN cast(p.p_size AS string) END AS line,
  1 + p.p_partkey % 3 AS outcome_no,
  CASE WHEN p.p_partkey % 3 = 0 THEN 'Home' WHEN p.p_partkey % 3 = 1 THEN 'Draw' ELSE 'o3' END AS outcome_name,
  p.p_retailprice AS odds_value, p.p_size % 5 - 2 AS odds_direction
FROM {part} p JOIN {matches} m ON m.mno = cast(floor(p.p_partkey / 100) AS bigint)
""")

_table("od_odds", ["odds_items"], """
SELECT combo_id, market_name, period_name, line, outcome_name, odds_value, odds_direction FROM {odds_items}
""")

# Three formation phases per side.
_table("formations", ["sides"], """
SELECT combo_id, team_id, is_home, cast(0 AS bigint) AS formation_index, CASE WHEN (mno + team_id) % 2 = 0 THEN '433' ELSE '442' END AS formation_name, cast(0 AS bigint) AS start_minute FROM {sides}
UNION ALL SELECT combo_id, team_id, is_home, 1, CASE WHEN (mno + team_id) % 3 = 0 THEN '433' ELSE '352' END, 46 + mno % 10 FROM {sides}
UNION ALL SELECT combo_id, team_id, is_home, 2, CASE WHEN (mno + team_id) % 5 < 3 THEN '352' ELSE '541' END, 70 + mno % 10 FROM {sides}
""")

_table("possession_minutes", ["feed_base"], """
SELECT combo_id, team_id, expanded_minute AS minute, cast(sum(CASE WHEN is_touch THEN 1 ELSE 0 END) AS double) AS value
FROM {feed_base} GROUP BY combo_id, team_id, expanded_minute
""")


def duck_ctes(names: list[str]) -> list[tuple[str, str]]:
    """The named tables and what they need, as (name, SQL) in dependency order."""
    seen: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in seen or name in INPUTS:
            return
        deps, sql = TABLES[name]
        for d in deps:
            visit(d)
        seen[name] = sql.format(**{d: d for d in deps})

    for n in names:
        visit(n)
    return list(seen.items())


_DERIVED = ["type_id", "pass_end_x", "pass_end_y", "end_x", "end_y", "goal_mouth_y", "goal_mouth_z", "related_event_id", "qids", "qnames",
            "base_pass", "dead_ball", "dead_ball_state", "restart_event"]
_STORED: dict[tuple, DataFrame] = {}


class Tables:
    """Lazily derived tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}
        #: Tables kept for other queries belong to one application and to the input files as they are.
        self.version = (spark.sparkContext.applicationId, sf_dir, *(input_state(spark, os.path.join(sf_dir, f"{n}.parquet")) for n in sorted(INPUTS)))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in INPUTS:
                df = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
            elif name == "feed_base":
                both = {"raw_end_x": "end_x", "raw_end_y": "end_y"}
                df = self._stored.select(*[F.col(c).alias(both.get(c, c)) for c in self._stored.columns if c not in _DERIVED])
            else:
                deps, sql = TABLES[name]
                df = self.spark.sql(sql, **{d: self[d] for d in deps})
                if name == "squad":
                    df = self.once(name, by_match(df, self._stored.count()))
            self._made[name] = df
        return self._made[name]

    def once(self, name: str, df: DataFrame) -> DataFrame:
        """Writes a table that others are derived from once per application and input directory."""
        key = (*self.version, name)
        if key not in _STORED:
            _STORED[key] = written(df, name)
        return _STORED[key]

    @property
    def _stored(self) -> DataFrame:
        """The derived feed as a table, clustered by match: derived once per application, then
        read by column, as the load plan does with feeds that come from documents."""
        key = (*self.version, "feed")
        if key not in _STORED:
            base = self.spark.sql(TABLES["feed_base"][1], events=self["events"])
            ids, types = constant_map(K.QUALIFIER_ID), constant_map(K.TYPE_ID)
            is_pass, none = F.col("etype") == "Pass", F.lit(None).cast("double")
            full = base.withColumnsRenamed({"end_x": "raw_end_x", "end_y": "raw_end_y"}).withColumns({
                "type_id": F.try_element_at(types, "etype"), "pass_end_x": F.when(is_pass, F.col("raw_end_x")),
                "pass_end_y": F.when(is_pass, F.col("raw_end_y")), "end_x": none, "end_y": none, "goal_mouth_y": none, "goal_mouth_z": none,
                "related_event_id": F.col("rel_event_id"),
                "qids": F.array_compact(F.array(F.try_element_at(ids, "qa"), F.try_element_at(ids, "qb"))),
                "qnames": F.array_compact(F.array("qa", "qb"))})
            _STORED[key] = written(with_flags(full).repartition("combo_id"), "feed")
        return _STORED[key]

    @property
    def feed(self) -> DataFrame:
        """Canonical event feed, with the columns `event_docs.feed` gives."""
        return self._stored.drop("mno", "m", "qa", "qb", "raw_end_x", "raw_end_y", "rel_event_id")

    @property
    def sides(self) -> DataFrame:
        """Both teams of every match: combo_id, team_id, opp_id, is_home."""
        return self["sides"].drop("mno")
