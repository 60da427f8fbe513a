"""Expected-goals provider documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.expr import clean_key, position_label, usual_position
from ..operators.reshape import pivot_keys, team_stats_wide
from .documents import file_id, parse
from .schemas import XG_DOC


def xg_documents(texts: DataFrame) -> DataFrame:
    return parse(texts.filter("provider = 'xg'"), XG_DOC).withColumn("xg_match_id", file_id(F.col("file")))


def match(docs: DataFrame) -> DataFrame:
    """Match row with coverage flags and both coaches."""
    def at(path: str, name: str) -> Column:
        return F.col(f"doc.{path}").alias(name)

    def team(i: int) -> Column:
        return F.try_element_at("doc.header.teams", F.lit(i))

    def filled(path: str) -> Column:
        return F.coalesce(F.size(f"doc.{path}") > 0, F.lit(False))

    g, facts, lu = "general", "content.matchFacts", "content.lineup"
    box, motm = f"{facts}.infoBox", f"{facts}.playerOfTheMatch"
    colors = [at(f"{g}.teamColors.{mode}.{side}", f"{side}_{name}") for mode, name in (
        ("lightMode", "color"), ("darkMode", "color_dark"), ("fontLightMode", "font_color"), ("fontDarkMode", "font_dark")) for side in ("home", "away")]
    return docs.select(
        "combo_id", "xg_match_id", at(f"{g}.matchName", "match_name"), at(f"{g}.matchRound", "match_round"), at(f"{g}.leagueId", "league_id"),
        at(f"{g}.leagueName", "league_name"), at(f"{g}.leagueRoundName", "league_round_name"), at(f"{facts}.countryCode", "country_code"),
        *[team(i)[f].alias(f"{s}_{n}") for i, s in ((1, "home"), (2, "away")) for f, n in (("id", "team_id"), ("name", "team_name"), ("score", "score"))],
        at(f"{box}.`Match Date`.utcTime", "match_date"), at(f"{box}.Stadium.name", "stadium_name"), at(f"{box}.Stadium.city", "stadium_city"),
        at(f"{box}.Stadium.country", "stadium_country"), at(f"{box}.Stadium.capacity", "stadium_capacity"), at(f"{box}.Attendance", "attendance"),
        at(f"{box}.Referee.text", "referee_name"), at(f"{box}.Referee.country", "referee_country"),
        at(f"{motm}.id", "motm_id"), at(f"{motm}.name.fullName", "motm_name"), at(f"{motm}.rating.num", "motm_rating"), *colors,
        filled("content.shotmap.shots").alias("has_shot_data"), filled("content.momentum.main.data").alias("has_momentum_data"),
        at(f"{lu}.homeTeam.coach.id", "ht_coach_id"), at(f"{lu}.homeTeam.coach.name", "ht_coach_name"),
        at(f"{lu}.awayTeam.coach.id", "at_coach_id"), at(f"{lu}.awayTeam.coach.name", "at_coach_name"))


def lineups(docs: DataFrame) -> DataFrame:
    """Starters, substitutes and unavailable players; only starters have a place on the pitch."""
    def part(side: str, group: str, role: str) -> DataFrame:
        starter, out = role == "starter", role == "unavailable"
        rows = docs.select("combo_id", "xg_match_id", F.col(f"doc.content.lineup.{side}").alias("t"),
                           F.explode(f"doc.content.lineup.{side}.{group}").alias("p"))
        return rows.select(
            "combo_id", "xg_match_id", F.col("p.id").alias("player_id"), F.col("p.name").alias("player_name"), F.col("t.id").alias("team_id"),
            F.col("t.name").alias("team_name"), F.lit(side == "homeTeam").alias("is_home_team"), F.lit(role).alias("role"),
            (F.lit(None).cast("bigint") if out else F.col("p.shirtNumber")).alias("shirt_number"), F.col("p.positionId").alias("position_id"),
            position_label(F.col("p.positionId"), F.col("p.horizontalLayout.y") if starter else None).alias("position"),
            F.col("p.usualPlayingPositionId").alias("usual_position_id"), usual_position(F.col("p.usualPlayingPositionId")).alias("usual_position"),
            (F.lit(False) if out else F.coalesce("p.isCaptain", F.lit(False))).alias("is_captain"), F.col("p.age").alias("age"),
            F.col("p.countryName").alias("country"), F.col("p.countryCode").alias("country_code"),
            (F.lit(None).cast("double") if out else F.col("p.performance.rating")).alias("rating"), F.col("t.formation").alias("formation"),
            (F.col("p.unavailability.type") if out else F.lit(None).cast("string")).alias("unavailable_type"),
            (F.col("p.unavailability.reason") if out else F.lit(None).cast("string")).alias("unavailable_reason"))

    parts = [part(s, g, r) for s in ("homeTeam", "awayTeam") for g, r in (("starters", "starter"), ("subs", "sub"), ("unavailable", "unavailable"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def player_stat_items(docs: DataFrame) -> DataFrame:
    """Long player statistics: cleaned key, value, and `<key>_total` where a total exists."""
    who = ["combo_id", "xg_match_id", "player_id", "player_name", "team_id", "team_name", "is_goalkeeper", "shirt_number", "position_id"]
    players = docs.select("combo_id", "xg_match_id", F.explode("doc.content.playerStats").alias("_k", "p")).select(
        "combo_id", "xg_match_id", F.col("p.id").alias("player_id"), F.col("p.name").alias("player_name"), F.col("p.teamId").alias("team_id"),
        F.col("p.teamName").alias("team_name"), F.coalesce("p.isGoalkeeper", F.lit(False)).alias("is_goalkeeper"),
        F.col("p.shirtNumber").alias("shirt_number"), F.col("p.positionId").alias("position_id"), F.col("p.stats").alias("groups"))
    groups = players.select(*who, F.posexplode_outer("groups").alias("pos", "g"))
    stats = groups.select(*who, "pos", F.explode_outer("g.stats").alias("name", "s"))
    key = clean_key(F.coalesce(F.nullif("s.key", F.lit("")), F.nullif("s.title", F.lit("")), "name"))
    pair = F.array(F.struct(key.alias("stat_key"), F.col("s.stat.value").alias("value")),
                   F.struct(F.concat(key, F.lit("_total")).alias("stat_key"), F.col("s.stat.total").alias("value")))
    return (stats.select(*who, "pos", F.inline(pair))
            .filter(~F.coalesce(F.col("stat_key").endswith("_total") & F.col("value").isNull(), F.lit(False))))


def player_stat_cells(docs: DataFrame) -> DataFrame:
    return player_stat_items(docs).select(F.col("stat_key").alias("key"), "value")


def player_stats(docs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per player and match, one column per statistic; a later group wins."""
    items = player_stat_items(docs)
    keys = pivot_keys(items, "stat_key") if keys is None else keys
    who = [c for c in items.columns if c not in ("pos", "stat_key", "value")]
    return items.groupBy(*who).agg(F.count("*").alias("_n"), *[F.max_by("value", F.when(F.col("stat_key") == k, F.col("pos"))).alias(k) for k in keys]).drop("_n")


def team_stat_items(docs: DataFrame) -> DataFrame:
    """Long team statistics per period, without section titles; `pos` keeps the document's order."""
    periods = docs.select("combo_id", "xg_match_id", F.explode("doc.content.stats.Periods").alias("period", "p"))
    groups = periods.select("combo_id", "xg_match_id", "period", F.posexplode("p.stats").alias("gi", "g"))
    items = groups.select("combo_id", "xg_match_id", "period", "gi", F.col("g.title").alias("stat_group"), F.posexplode("g.stats").alias("ii", "i"))
    return items.filter(~F.coalesce(F.col("i.type") == "title", F.lit(False))).select(
        "combo_id", "xg_match_id", "period", "stat_group", F.col("i.key").alias("stat_key"), F.col("i.title").alias("stat_title"),
        F.try_element_at("i.stats", F.lit(1)).alias("home_value"), F.try_element_at("i.stats", F.lit(2)).alias("away_value"),
        F.col("i.format").alias("stat_format"), F.col("i.highlighted").alias("highlighted"), F.struct("gi", "ii").alias("pos"))


def team_stat_cells(docs: DataFrame) -> DataFrame:
    return team_stat_items(docs).select(F.col("stat_key").alias("key"), F.explode(F.array("home_value", "away_value")).alias("value"))


def team_stats(docs: DataFrame, stats: list[str] | None = None) -> DataFrame:
    return team_stats_wide(team_stat_items(docs), ["combo_id", "xg_match_id", "period"], stats)


def shots(docs: DataFrame) -> DataFrame:
    """Shots with their chronological 0-based `row_id`; equal minutes keep the document's order."""
    rows = docs.select("combo_id", "xg_match_id", F.posexplode("doc.content.shotmap.shots").alias("pos", "s"))
    order = Window.partitionBy("combo_id").orderBy(F.coalesce("s.min", F.lit(0)), F.coalesce("s.minAdded", F.lit(0)), "pos")
    names = {"id": "shot_id", "eventType": "event_type", "teamId": "team_id", "playerId": "player_id", "playerName": "player_name", "x": "x", "y": "y",
             "min": "minute", "minAdded": "minute_added", "period": "period", "isBlocked": "is_blocked", "isOnTarget": "is_on_target",
             "isOwnGoal": "is_own_goal", "isFromInsideBox": "is_from_inside_box", "isSavedOffLine": "is_saved_off_line", "blockedX": "blocked_x",
             "blockedY": "blocked_y", "goalCrossedY": "goal_crossed_y", "goalCrossedZ": "goal_crossed_z", "expectedGoals": "xg",
             "expectedGoalsOnTarget": "xgot", "shotType": "shot_type", "situation": "situation", "keeperId": "keeper_id", "onGoalShot": "on_goal_shot"}
    return rows.select("combo_id", "xg_match_id", (F.row_number().over(order) - 1).cast("bigint").alias("row_id"),
                       *[F.col(f"s.{k}").alias(v) for k, v in names.items()])


def momentum(docs: DataFrame) -> DataFrame:
    """Momentum payload as JSON text, for matches that have any."""
    data = F.col("doc.content.momentum.main.data")
    return docs.filter(F.size(data) > 0).select("combo_id", "xg_match_id", F.concat(F.lit("["), F.concat_ws(",", data), F.lit("]")).alias("momentum_data"))


TABLES = {"xg_match": match, "xg_lineups": lineups, "xg_player_stats": player_stats, "xg_team_stats": team_stats, "xg_shots": shots, "xg_spatial": momentum}
