"""Event-provider documents: canonical feed, meta, lineups, formations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expr import with_flags
from ..plans.event_tables import MatchData
from .documents import file_id, parse, rejected
from .schemas import EVENT_DOC


def event_documents(texts: DataFrame) -> DataFrame:
    return parse(texts.filter("provider = 'events'"), EVENT_DOC, "home").withColumn("ev_match_id", file_id(F.col("file")))


def rejected_documents(texts: DataFrame) -> DataFrame:
    """Event files that are left out or read in part, with the reason."""
    return rejected(texts.filter("provider = 'events'"), EVENT_DOC, "home")


def _both_sides(docs: DataFrame, field: str) -> DataFrame:
    """Rows of an array field of both sides, with team columns; `i` is the place in the array."""
    def side(name: str) -> DataFrame:
        return docs.select("combo_id", "ev_match_id", F.col(f"doc.{name}.teamId").alias("team_id"), F.col(f"doc.{name}.name").alias("team_name"),
                           F.lit(name == "home").alias("is_home_team"), F.col(f"doc.{name}.formations").alias("_forms"),
                           F.col("doc.playerIdNameDictionary").alias("_names"), F.posexplode(f"doc.{name}.{field}").alias("i", "r"))
    return side("home").unionByName(side("away"))


def match_meta(docs: DataFrame) -> DataFrame:
    return docs.select(
        "combo_id", "ev_match_id", F.col("doc.home.name").alias("home_team"), F.col("doc.home.teamId").alias("home_team_id"),
        F.col("doc.away.name").alias("away_team"), F.col("doc.away.teamId").alias("away_team_id"), F.col("doc.score").alias("score"),
        F.col("doc.htScore").alias("ht_score"), F.col("doc.venueName").alias("venue"), F.col("doc.attendance").alias("attendance"),
        F.col("doc.referee.name").alias("referee"), F.col("doc.startTime").alias("start_time"))


def lineups(docs: DataFrame) -> DataFrame:
    """Both squads; the captain is the one of the first formation."""
    captain = F.try_element_at("_forms", F.lit(1))["captainPlayerId"]
    no = F.lit(False)
    return _both_sides(docs, "players").select(
        "combo_id", "ev_match_id", F.col("r.playerId").alias("player_id"), F.col("r.name").alias("player_name"), "team_id", "team_name",
        "is_home_team", F.col("r.shirtNo").alias("shirt_number"), F.col("r.position").alias("position"),
        F.coalesce("r.isFirstEleven", no).alias("is_starter"), F.coalesce(F.col("r.playerId") == captain, no).alias("is_captain"),
        F.coalesce("r.isManOfTheMatch", no).alias("is_man_of_the_match"), F.col("r.age").alias("age"), F.col("r.height").alias("height_cm"),
        F.col("r.weight").alias("weight_kg"), F.col("r.subbedInExpandedMinute").alias("subbed_in_minute"),
        F.col("r.subbedInPlayerId").alias("subbed_in_for"), F.col("r.subbedOutExpandedMinute").alias("subbed_out_minute"),
        F.col("r.subbedOutPlayerId").alias("subbed_out_for"))


def formations(docs: DataFrame) -> DataFrame:
    return _both_sides(docs, "formations").select(
        "combo_id", "ev_match_id", "team_id", "team_name", "is_home_team", F.col("i").cast("bigint").alias("formation_index"),
        F.col("r.formationName").alias("formation_name"), F.col("r.formationId").alias("formation_id"),
        F.col("r.startMinuteExpanded").alias("start_minute"), F.col("r.endMinuteExpanded").alias("end_minute"),
        F.col("r.captainPlayerId").alias("captain_player_id"),
        F.try_element_at("_names", F.col("r.captainPlayerId").cast("string")).alias("captain_name"),
        F.col("r.subOnPlayerId").alias("sub_on_player_id"), F.col("r.subOffPlayerId").alias("sub_off_player_id"),
        F.col("r.playerIds").alias("player_ids"), F.col("r.jerseyNumbers").alias("jersey_numbers"))


def _value(qid: int, name: str) -> Column:
    """Value of the first qualifier with the id or name."""
    hits = F.filter("e.qualifiers", lambda q: (q["type"]["value"] == qid) | (q["type"]["displayName"] == name))
    return F.try_element_at(hits, F.lit(1))["value"]


def _id(col: str) -> Column:
    return F.nullif(F.col(col), F.lit(0))


def feed(docs: DataFrame) -> DataFrame:
    """Canonical feed: one row per event, `pos` is its place in the document."""
    rows = docs.select("combo_id", F.col("doc.home.teamId").alias("home_id"), F.col("doc.away.teamId").alias("away_id"),
                       F.posexplode("doc.events").alias("pos", "e"))
    team, none = _id("e.teamId"), F.array()
    quals = F.col("e.qualifiers")
    return with_flags(rows.select(
        "combo_id", F.col("pos").cast("bigint").alias("pos"), F.col("e.eventId").alias("event_id"),
        (F.coalesce("e.expandedMinute", F.lit(0)) * 60 + F.coalesce("e.second", F.lit(0))).alias("t_s"),
        F.col("e.minute").alias("minute"), F.col("e.second").alias("second"), F.col("e.expandedMinute").alias("expanded_minute"),
        F.col("e.period.value").alias("period"), "home_id", "away_id", team.alias("team_id"),
        F.when(team == F.col("home_id"), F.col("away_id")).when(team == F.col("away_id"), F.col("home_id")).alias("opp_id"),
        _id("e.playerId").alias("player_id"), F.col("e.relatedPlayerId").alias("related_player_id"),
        F.col("e.type.value").alias("type_id"), F.coalesce("e.type.displayName", F.lit("")).alias("etype"),
        F.coalesce(F.col("e.outcomeType.displayName") == "Successful", F.lit(False)).alias("ok"),
        F.col("e.x").alias("x"), F.col("e.y").alias("y"),
        _value(140, "PassEndX").try_cast("double").alias("pass_end_x"), _value(141, "PassEndY").try_cast("double").alias("pass_end_y"),
        F.col("e.endX").alias("end_x"), F.col("e.endY").alias("end_y"), _value(212, "Length").try_cast("double").alias("length"),
        _value(-1, "GoalMouthY").try_cast("double").alias("goal_mouth_y"), _value(-1, "GoalMouthZ").try_cast("double").alias("goal_mouth_z"),
        _value(55, "RelatedEventId").try_cast("double").cast("bigint").alias("related_event_id"),
        F.coalesce("e.isTouch", F.lit(False)).alias("is_touch"), F.coalesce("e.isShot", F.lit(False)).alias("is_shot"),
        F.coalesce(F.array_compact(F.transform(quals, lambda q: q["type"]["value"])), none.cast("array<int>")).alias("qids"),
        F.coalesce(F.array_compact(F.transform(quals, lambda q: q["type"]["displayName"])), none.cast("array<string>")).alias("qnames")))


def possession_minutes(docs: DataFrame) -> DataFrame:
    """Per-minute possession values of both teams."""
    def side(name: str) -> DataFrame:
        return docs.select("combo_id", F.col(f"doc.{name}.teamId").alias("team_id"),
                           F.explode(f"doc.{name}.stats.possession").alias("minute", "value"))
    return (side("home").unionByName(side("away")).withColumn("minute", F.col("minute").try_cast("bigint"))
            .filter(F.col("minute").isNotNull() & F.col("value").isNotNull()))


def match_data(docs: DataFrame) -> MatchData:
    """Everything the event metrics need, from a set of event documents."""
    meta, lu, forms = match_meta(docs), lineups(docs), formations(docs)
    sides = meta.select("combo_id", F.inline(F.array(
        F.struct(F.col("home_team_id").alias("team_id"), F.col("away_team_id").alias("opp_id"), F.lit(True).alias("is_home")),
        F.struct(F.col("away_team_id").alias("team_id"), F.col("home_team_id").alias("opp_id"), F.lit(False).alias("is_home")))))
    squad = lu.select("combo_id", "team_id", "player_id", "player_name", "position", F.col("is_home_team").alias("is_home"))
    return MatchData(feed(docs), sides, squad, forms, possession_minutes(docs), meta, lu)
