"""Reference-data provider documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from ..functions import fixed as K
from ..functions.expr import parse_when
from ..operators.reshape import pivot_keys
from . import schemas as S
from .documents import parse

_SPATIAL = {"average_positions": "average_positions", "comments": "commentary", "graph": "match_momentum_graph",
            "heatmap_home_team": "home_heatmap", "heatmap_away_team": "away_heatmap"}


class ReferenceDocs:
    """The documents of all matches, one DataFrame per kind, read from file texts."""

    def __init__(self, texts: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df):
        """`keep` may write the parsed documents, so that the tables made from them do not parse again."""
        self._texts, self._keep = texts.filter("provider = 'reference'"), keep
        self.lineups = self._of("lineups", S.RD_LINEUPS, "home")
        self.event = self._of("main_event_data", S.RD_EVENT, "event")
        self.event_fields = self._of("main_event_data", S.RD_EVENT_FIELDS, "event")
        self.managers = self._of("managers", S.RD_MANAGERS, "homeManager")
        self.best = self._of("best_players_summary", S.RD_BEST)
        self.shotmap = self._of("shotmap", S.RD_SHOTS, "shotmap")
        self.statistics = self._of("statistics", S.RD_STATISTICS, "statistics")
        self.odds = self._of("odds_all", S.RD_ODDS)

    def _of(self, kind: str, schema: str, required: str | None = None) -> DataFrame:
        return self._keep(parse(self._texts.filter(F.col("file").contains(kind)), schema, required).select("combo_id", "doc"), kind)

    def text(self, kind: str) -> DataFrame:
        return self._texts.filter(F.col("file").contains(kind)).select("combo_id", "value")


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every leaf of every nested struct as a column named by its path."""
    def leaves(dtype: T.StructType, path: list[str]) -> list[Column]:
        out = []
        for f in dtype.fields:
            here = [*path, f.name]
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here)))
        return out
    return df.select(*leaves(df.schema, []))


def _ids(docs: ReferenceDocs) -> DataFrame:
    e = F.col("doc.event")
    return docs.event.select("combo_id", e["id"].alias("match_id"), e["homeTeam"]["id"].alias("home_team_id"), e["awayTeam"]["id"].alias("away_team_id"))


def _people(docs: ReferenceDocs, field: str) -> DataFrame:
    """Rows of an array of both sides of the lineups, with match and team ids."""
    def side(name: str) -> DataFrame:
        return docs.lineups.select("combo_id", F.lit(name == "home").alias("is_home_team"), F.explode(f"doc.{name}.{field}").alias("p"))
    rows = side("home").unionByName(side("away")).join(_ids(docs), "combo_id")
    return rows.withColumn("team_id", F.when(F.col("is_home_team"), F.col("home_team_id")).otherwise(F.col("away_team_id")))


def players(docs: ReferenceDocs) -> DataFrame:
    def side(name: str) -> DataFrame:
        return docs.lineups.select("combo_id", F.explode(f"doc.{name}.players").alias("p"))
    return side("home").unionByName(side("away")).select(
        "combo_id", F.col("p.player.id").alias("player_id"), F.col("p.player.name").alias("name"), F.col("p.position").alias("position"),
        F.col("p.player.country.name").alias("nationality"), parse_when(F.col("p.player.dateOfBirthTimestamp")).alias("birth_date"))


def tournaments(docs: ReferenceDocs) -> DataFrame:
    t = F.col("doc.event.tournament")
    return docs.event.select(
        "combo_id", t["uniqueTournament"]["id"].alias("tournament_id"), t["name"].alias("name"),
        F.coalesce(F.nullif(t["category"]["country"]["name"], F.lit("")), t["category"]["name"]).alias("country"), t["competitionType"].alias("tier"))


def seasons(docs: ReferenceDocs) -> DataFrame:
    s = F.col("doc.event.season")
    return docs.event.select("combo_id", s["id"].alias("season_id"), s["name"].alias("name"), s["year"].alias("year"),
                             F.col("doc.event.tournament.uniqueTournament.id").alias("tournament_id"))


def teams(docs: ReferenceDocs) -> DataFrame:
    t = F.col("t")
    return docs.event.select("combo_id", F.explode(F.array("doc.event.homeTeam", "doc.event.awayTeam")).alias("t")).select(
        "combo_id", t["id"].alias("team_id"), t["name"].alias("name"), t["venue"]["stadium"]["name"].alias("stadium"),
        t["venue"]["stadium"]["capacity"].alias("stadium_capacity"), t["country"]["name"].alias("country"), t["venue"]["city"]["name"].alias("city"),
        t["venue"]["venueCoordinates"]["latitude"].alias("latitude"), t["venue"]["venueCoordinates"]["longitude"].alias("longitude"),
        parse_when(t["foundationDateTimestamp"]).alias("founded_date"))


def referees(docs: ReferenceDocs) -> DataFrame:
    r = F.col("doc.event.referee")
    return docs.event.filter(r["id"].isNotNull()).select(
        "combo_id", r["id"].alias("referee_id"), r["name"].alias("name"), r["country"]["name"].alias("nationality"), r["redCards"].alias("red_cards"),
        r["yellowCards"].alias("yellow_cards"), r["yellowRedCards"].alias("double_yellow_cards"), r["games"].alias("games"))


def managers(docs: ReferenceDocs) -> DataFrame:
    m = F.col("m")
    return docs.managers.select("combo_id", F.explode(F.array("doc.homeManager", "doc.awayManager")).alias("m")).select(
        "combo_id", m["id"].alias("manager_id"), m["name"].alias("name"), m["shortName"].alias("shortname"), m["slug"].alias("slug"))


_SHOT_FIELDS = {"id": "bigint", "shotType": "string", "situation": "string", "bodyPart": "string", "xg": "double", "xgot": "double", "time": "bigint", "isHome": "boolean",
                "goalMouthLocation": "string", "incidentType": "string", "goalType": "string", "addedTime": "bigint", "playerCoordinates": "string",
                "goalMouthCoordinates": "string", "blockCoordinates": "string", "draw": "string"}
_EVENT_FIELDS = ["id", "tournament", "season", "homeTeam", "awayTeam", "venue", "referee", "winnerCode", "startTimestamp", "homeScore", "awayScore", "time"]


def _other(fields: Column, known: list[str]) -> Column:
    """The fields that have no column of their own, as JSON text; NULL if there is none."""
    left = F.map_filter(fields, lambda k, v: ~k.isin(*known) & v.isNotNull())
    return F.when(F.size(left) > 0, F.to_json(left))


def shots(docs: ReferenceDocs) -> DataFrame:
    """Shots oldest first: the provider lists the newest first. All fields are kept; nested ones as JSON text."""
    rows = docs.shotmap.select("combo_id", F.posexplode(F.reverse("doc.shotmap")).alias("row_id", "s")).join(_ids(docs).select("combo_id", "match_id"), "combo_id")
    names = {"id": "shot_id"}
    return rows.select("combo_id", "match_id", F.col("row_id").cast("bigint").alias("row_id"), F.get_json_object(F.col("s.player"), "$.id").try_cast("bigint").alias("player_id"),
                       F.get_json_object(F.col("s.player"), "$.name").alias("player_name"),
                       *[F.try_element_at("s", F.lit(k)).try_cast(kind).alias(names.get(k, k.lower())) for k, kind in _SHOT_FIELDS.items()],
                       _other(F.col("s"), ["player", *_SHOT_FIELDS]).alias("other_fields"))


def matches(docs: ReferenceDocs) -> DataFrame:
    """Match row: ids, coaches, formations, player of the match, flattened event leaves, coverage flags."""
    e, best = F.col("doc.event"), F.col("doc.playerOfTheMatch")
    core = docs.event.select(
        "combo_id", e["id"].alias("match_id"), e["tournament"]["uniqueTournament"]["id"].alias("tournament_id"), e["season"]["id"].alias("season_id"),
        e["venue"]["name"].alias("venue"), e["referee"]["id"].alias("referee_id"), e["homeTeam"]["id"].alias("home_team_id"),
        e["awayTeam"]["id"].alias("away_team_id"), e["winnerCode"].alias("winnercode"), F.timestamp_seconds(e["startTimestamp"]).alias("starttimestamp"),
        e["homeScore"].alias("homescore"), e["awayScore"].alias("awayscore"),
        F.timestamp_seconds(e["time"]["currentPeriodStartTimestamp"]).alias("time_currentperiodstarttimestamp"))
    coaches = docs.managers.select("combo_id", F.col("doc.homeManager.id").alias("home_manager_id"), F.col("doc.awayManager.id").alias("away_manager_id"))
    shape = docs.lineups.select("combo_id", F.col("doc.home.formation").alias("home_formation"), F.col("doc.away.formation").alias("away_formation"))
    motm = docs.best.select("combo_id", best["value"].alias("motm_rating"), best["player"]["name"].alias("motm_player_name"), best["player"]["id"].alias("motm_player_id"))
    cover = shots(docs).groupBy("combo_id").agg(F.lit(True).alias("has_shotmap"), F.max(F.col("xg").isNotNull()).alias("has_xg"))
    rest = docs.event_fields.select("combo_id", _other(F.col("doc.event"), _EVENT_FIELDS).alias("other_fields"))
    out = flatten_struct(core)
    for side in (coaches, shape, motm, cover, rest):
        out = out.join(side, "combo_id", "left")
    return out.na.fill(False, ["has_shotmap", "has_xg"])


def player_stat_cells(docs: ReferenceDocs) -> DataFrame:
    """Statistics of players, key by key; the list of ratings is no statistic."""
    rows = _people(docs, "players").filter(F.size("p.statistics") > 0).select(F.explode("p.statistics").alias("key", "value"))
    return rows.filter("key <> 'ratingVersions'")


def player_stats(docs: ReferenceDocs, keys: list[str] | None = None) -> DataFrame:
    """One column per statistic; a missing one is 0. The original rating wins over the plain one."""
    rows = _people(docs, "players").filter(F.size("p.statistics") > 0)
    stats = F.col("p.statistics")
    rating = F.coalesce(F.get_json_object(stats["ratingVersions"], "$.original").try_cast("double"), stats["rating"].try_cast("double"), F.lit(0.0))
    base = rows.select("combo_id", "match_id", "team_id", "is_home_team", F.col("p.player.id").alias("player_id"),
                       F.col("p.position").alias("position"), rating.alias("match_rating"), stats.alias("stats"))
    if keys is None:
        keys = pivot_keys(player_stat_cells(docs), "key")
    return base.select(*base.columns[:-1], *[F.coalesce(F.try_element_at("stats", F.lit(k)).try_cast("double"), F.lit(0.0)).alias(k.lower()) for k in keys])


def lineups(docs: ReferenceDocs) -> DataFrame:
    stats = F.col("p.statistics")
    return _people(docs, "players").select(
        "combo_id", "match_id", "team_id", "is_home_team", F.col("p.player.id").alias("player_id"), (~F.col("p.substitute")).alias("is_starter"),
        F.col("p.captain").isNotNull().alias("is_captain"),
        F.when(F.coalesce(F.size(stats), F.lit(0)) > 0, stats["minutesPlayed"].try_cast("bigint")).otherwise(F.lit(0)).alias("minutes_played"),
        F.col("p.shirtNumber").alias("shirt_number"), F.col("p.position").alias("position"))


def missing_players(docs: ReferenceDocs) -> DataFrame:
    return _people(docs, "missingPlayers").select(
        "combo_id", "match_id", "team_id", "is_home_team", F.col("p.player.id").alias("player_id"), F.col("p.player.name").alias("name"),
        F.col("p.type").alias("type"), F.col("p.reason").alias("reason"), F.col("p.description").alias("description"),
        F.col("p.externalType").alias("external_type"), parse_when(F.col("p.expectedEndDate")).alias("expected_end_date"))


def _match_stat_items(docs: ReferenceDocs) -> DataFrame:
    """Team statistics per period, one row per statistic and side. Periods after the third have the document's name."""
    names = F.array(F.lit("FULL-TIME"), F.lit("FIRST-HALF"), F.lit("SECOND-HALF"))
    periods = docs.statistics.select("combo_id", F.posexplode("doc.statistics").alias("i", "p"))
    periods = periods.withColumn("period", F.coalesce(F.get(names, F.col("i")), F.col("p.period"), F.concat(F.lit("PERIOD-"), F.col("i") + 1)))
    items = (periods.select("combo_id", "i", "period", F.posexplode("p.groups").alias("gi", "g"))
             .select("combo_id", "i", "period", "gi", F.posexplode("g.statisticsItems").alias("ii", "s")))
    key = F.regexp_replace(F.lower(F.trim(F.coalesce("s.name", F.lit("")))), r"\W+", "_")
    return items.select("combo_id", "i", "period", F.struct("gi", "ii").alias("pos"), F.inline(F.array(*[
        F.struct(F.concat(key, F.lit("_" + k.lower())).alias("col"), F.col(f"s.{k}").alias("value"))
        for k in ("homeValue", "awayValue", "homeTotal", "awayTotal")]))).filter(F.col("value").isNotNull())


def match_stat_cells(docs: ReferenceDocs) -> DataFrame:
    return _match_stat_items(docs).select(F.col("col").alias("key"), "value")


def match_stats(docs: ReferenceDocs, columns: list[str] | None = None) -> DataFrame:
    """Team statistics per period: a column per statistic and side."""
    long = _match_stat_items(docs)
    columns = pivot_keys(long, "col") if columns is None else columns
    wide = long.groupBy("combo_id", "i", "period").agg(F.count("*").alias("_n"), *[F.max_by("value", F.when(F.col("col") == c, F.col("pos"))).alias(c) for c in columns])
    return (wide.join(_ids(docs).select("combo_id", "match_id"), "combo_id", "left")
            .select("combo_id", "match_id", "period", F.col("i").cast("bigint").alias("row_id"), *columns))


def _odds_items(docs: ReferenceDocs) -> DataFrame:
    """Prices and winning choices of the markets, named `{period}_{group}_{choice}{name}`."""
    m, c = F.col("m"), F.col("c")
    rows = docs.odds.select("combo_id", F.posexplode("doc.markets").alias("mi", "m")).filter(m["marketGroup"].isin(*K.ODDS_GROUPS))
    prefix = F.concat(m["marketPeriod"], F.lit("_"), m["marketGroup"], F.lit("_"),
                      F.coalesce(F.concat(F.nullif(m["choiceGroup"], F.lit("")), F.lit("_")), F.lit("")))
    return rows.select("combo_id", "mi", prefix.alias("prefix"), F.posexplode(m["choices"]).alias("ci", "c")).select(
        "combo_id", F.struct("mi", "ci").alias("pos"), F.inline(F.array(
            F.struct(F.concat("prefix", c["name"]).alias("col"), c["fractionalValue"].alias("value")),
            F.struct(F.concat("prefix", F.lit("winning")).alias("col"), F.when(c["winning"], c["name"]).alias("value"))))).filter(F.col("value").isNotNull())


def odds_cells(docs: ReferenceDocs) -> DataFrame:
    return _odds_items(docs).select(F.col("col").alias("key"), "value")


def odds(docs: ReferenceDocs, columns: list[str] | None = None) -> DataFrame:
    """One row per match: a column per price, and the winning choice of each market."""
    cells = _odds_items(docs)
    columns = pivot_keys(cells, "col") if columns is None else columns
    wide = cells.groupBy("combo_id").agg(F.count("*").alias("_n"), *[F.max_by("value", F.when(F.col("col") == k, F.col("pos"))).alias(k.lower()) for k in columns]).drop("_n")
    return docs.odds.select("combo_id", F.col("doc.eventId").alias("match_id")).join(wide, "combo_id", "left")


def spatial(docs: ReferenceDocs) -> DataFrame:
    """Payload texts of a match, only when all of them exist."""
    out = _ids(docs).select("combo_id", "match_id")
    for kind, name in _SPATIAL.items():
        out = out.join(docs.text(kind).withColumnRenamed("value", name), "combo_id")
    return out.withColumn("full_player_heatmaps", F.lit('{"None": null}'))


TABLES = {"rd_tournaments": tournaments, "rd_seasons": seasons, "rd_teams": teams, "rd_players": players, "rd_referees": referees, "rd_managers": managers,
          "rd_matches": matches, "rd_lineups": lineups, "rd_missing_players": missing_players, "rd_player_stats": player_stats, "rd_shots": shots,
          "rd_match_stats": match_stats, "rd_odds": odds, "rd_spatial": spatial}
