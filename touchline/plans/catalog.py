"""Registered queries: each takes the adapter tables and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import (
    defending, discipline, identity, keeper, passing, possession, runs, sca, sequences, shooting, states,
)
from ..functions import expr
from ..operators import reshape
from ..sinks import tables
from ..sinks.layers import Layer, namespace
from ..sinks.shared import shared_dir, written
from ..sinks.store import Store
from ..sources import documents, dynamic, event_docs, odds_docs, rd_docs, sample_docs, xg_docs
from ..sources.adapter import Tables
from . import manifest, quality, season, votes
from .event_tables import EVENT_TABLES, MatchData
from .load_keys import ENTITY_TABLES
from .marts import MARTS, Marts
from .staging import STAGED

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}


def query(name: str):
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = fn
        return fn
    return register


def joined_arrays(df: DataFrame) -> DataFrame:
    """Id lists as comma-separated text, so that any engine can compare them."""
    return df.select(*[
        F.concat_ws(",", F.transform(F.col(c), lambda v: v.cast("string"))).alias(c) if t.startswith("array<") else F.col(c)
        for c, t in df.dtypes])


def as_spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: joined_arrays(fn(Tables(spark, sf_dir)))

    return {name: bind(fn) for name, fn in QUERIES.items()}


# -- feed metrics ----------------------------------------------------------------

query("a01_team_passing")(lambda t: passing.team_passing(t.feed, t.sides))
query("a02_player_passing")(lambda t: passing.player_passing(t.feed))
query("a03_pass_map")(lambda t: passing.pass_map(t.feed))
query("a04_team_passing_adv")(lambda t: passing.team_passing_advanced(t.feed, t.sides))
query("a05_ppda")(lambda t: passing.ppda(t.feed, t.sides))
query("a06_ppda_poss")(lambda t: possession.ppda_possession(t.feed, t.sides))
query("a07_field_tilt")(lambda t: passing.field_tilt(t.feed, t.sides))
query("a08_field_tilt_poss")(lambda t: possession.field_tilt_possession(t.feed, t.sides))
query("a09_player_passing_adv")(lambda t: passing.player_passing_advanced(t.feed))
query("a10_avg_position")(lambda t: passing.average_positions(t.feed))
query("a11_pass_network")(lambda t: runs.pass_network(t.feed))
query("a12_shots")(lambda t: shooting.shots(t.feed))
query("a13_team_shooting")(lambda t: shooting.team_shooting(t.feed))
query("a13_player_shooting")(lambda t: shooting.player_shooting(t.feed))
query("a14_sca_totals")(lambda t: shooting.sca_totals(t.feed))
query("a12_shots_with_creators")(lambda t: shooting.shots_with_creators(t.feed))
query("a14_team_shooting_full")(lambda t: shooting.team_shooting_full(t.feed))
query("a14_player_shooting_full")(lambda t: shooting.player_shooting_full(t.feed))
query("a15_team_possession")(lambda t: possession.team_possession(t.feed, t.sides, t["possession_minutes"]))
query("a16_player_possession")(lambda t: possession.player_possession(t.feed))
query("a17_team_defending")(lambda t: defending.team_defending(t.feed, t.sides, t["squad"]))
query("a18_player_defending")(lambda t: defending.player_defending(t.feed, t["squad"]))
query("a19_team_discipline")(lambda t: discipline.team_discipline(t.feed, t.sides))
query("a20_player_discipline")(lambda t: discipline.player_discipline(t.feed))
query("a21_cards")(lambda t: discipline.cards(t.feed))
query("a22_keepers")(lambda t: keeper.keepers(t.feed, t.sides, t["squad"]))
query("a23_team_poss_adv")(lambda t: sequences.team_possession_advanced(t.feed, t.sides, t["possession_minutes"]))
query("a24_state_agg")(lambda t: states.state_aggregate(t.feed, match_data(t).spine, t["possession_minutes"]))

# -- ordered events ----------------------------------------------------------------

query("w01_sca")(lambda t: sca.shot_creating_actions(t.feed))
query("w02_runs")(lambda t: runs.runs(t.feed).select("combo_id", "pos", "team_id", "run_id"))
query("w03_receivers")(lambda t: runs.receivers(runs.runs(t.feed)).filter("type_id = 1").select("combo_id", "pos", "player_id", "receiver_id"))
query("w04_tempo")(lambda t: runs.tempo(t.feed))
query("w05_hold")(lambda t: runs.hold_times(t.feed))
query("w06_sequences")(lambda t: sequences.raw_sequences(t.feed).drop("next_team"))
query("w07_stitched")(lambda t: sequences.stitched_sequences(sequences.stitched_events(t.feed)).select(
    "combo_id", "seq_id", "team_id", "length", "start_t", "end_t", "real", F.col("z.marker").alias("marker")))
query("w09_possessions")(lambda t: sequences.possessions(t.feed))
query("w10_sequence_rows")(lambda t: sequences.sequence_rows(t.feed))
query("w12_states")(lambda t: states.state_spine(t.feed))
query("w13_team_states")(lambda t: states.team_states(match_data(t).spine))
query("w14_context")(lambda t: states.context_events(t.feed, match_data(t).spine, t["formations"]))
query("w15_state_tags")(lambda t: states.state_tags(t.feed, match_data(t).spine))

# -- identity ----------------------------------------------------------------------

query("x01_observations")(lambda t: identity.observations(identity.lineup_keys(t["ev_lineups"]), identity.lineup_keys(t["xg_lineups"])))
query("x02_vote")(lambda t: identity.vote(identity.observations(identity.lineup_keys(t["ev_lineups"]), identity.lineup_keys(t["xg_lineups"]))))
@query("x06_counted_vote")
def _x06(t: Tables) -> DataFrame:
    """Winners from stored counts after three loads: matches with wrong provider ids, other matches, and the first ones again as they are."""
    store, ev, xg, even = _store(t), t["ev_lineups"], t["xg_lineups"], F.regexp_extract("combo_id", r"(\d)$", 1).cast("int") % 2 == 0
    wrong = xg.withColumn("player_id", F.col("player_id") + 1)
    for lineups, cond in ((wrong, even), (xg, ~even), (xg, even)):
        here = {"ev": ev.filter(cond), "xg": lineups.filter(cond)}
        votes.count_matches(store, here["ev"], votes.match_pairs(here))
        store.compact_due()
    store.commit()
    return identity.winners(Store(t.spark, store.root).read(votes.COUNTS).filter("votes > 0"))


@query("x08_player_alias")
def _x08(t: Tables) -> DataFrame:
    """Overrides: every seventh anchor player is another one's double."""
    ids = t["ev_lineups"].select(F.col("player_id").alias("bad_id")).distinct().filter("bad_id % 7 = 3")
    alias = ids.select("bad_id", (F.col("bad_id") - 1).alias("canonical_id"))
    return identity.player_crosswalk(t["ev_lineups"], t["rd_lineups"], t["rd_players"], t["xg_lineups"], alias)


query("x03_player_xwalk")(lambda t: player_xwalk(t))
query("x04_team_xwalk")(lambda t: team_xwalk(t))
query("x05_coach_xwalk")(lambda t: identity.coach_crosswalk(t["xg_match"], t["rd_matches"]))


def player_xwalk(t: Tables) -> DataFrame:
    return identity.player_crosswalk(t["ev_lineups"], t["rd_lineups"], t["rd_players"], t["xg_lineups"])


def team_xwalk(t: Tables) -> DataFrame:
    return identity.team_crosswalk(t["ev_lineups"], t["rd_lineups"], t["xg_lineups"])


# -- staging and marts ---------------------------------------------------------------

def match_data(t: Tables) -> MatchData:
    return MatchData(t.feed, t.sides, t["squad"], t["formations"], t["possession_minutes"], t["ev_match_meta"], t["ev_lineups"])


def raw_table(t: Tables, name: str) -> DataFrame:
    return EVENT_TABLES[name](match_data(t)) if name in EVENT_TABLES else t[name]


_KEPT: dict[tuple, DataFrame] = {}
#: The test tables have short seasons: the floor of 450 minutes would leave no player.
QUERY_MINUTES = 60


def marts(t: Tables) -> Marts:
    """Marts of one input directory. Its crosswalks are tables: the queries of one application share them."""
    def keep(df: DataFrame, name: str) -> DataFrame:
        if not name.endswith("_xwalk"):
            return written(df, name)
        key = (*t.version, name)
        if key not in _KEPT:
            _KEPT[key] = written(df, name)
        return _KEPT[key]

    return Marts(lambda name: raw_table(t, name), min_minutes=QUERY_MINUTES, keep=keep)


for _i, _name in enumerate(STAGED, 1):
    query(f"g{_i:02d}_{_name}")(lambda t, _name=_name: marts(t).staged(_name))

for _i, _name in enumerate(MARTS, 1):
    query(f"m{_i:02d}_{_name}")(lambda t, _name=_name: getattr(marts(t), _name)())


@query("a26_refreshed_season")
def _a26(t: Tables) -> DataFrame:
    """Season totals and ranks after the matches ending in 7 have been loaded on top of the others."""
    new = F.col("combo_id").endswith("7")

    def raw(name: str) -> DataFrame:
        df = raw_table(t, name)
        return df if name in ENTITY_TABLES or "combo_id" not in df.columns else df.filter(~new)

    before, now = Marts(raw, min_minutes=QUERY_MINUTES), marts(t)
    known = {"player_xwalk": before.player_xwalk, "team_xwalk": before.team_xwalk, "dim_player": written(before.dim_player(), "dim_player"), "dim_match": before.dim_match()}
    seasons = written(season.touched_seasons(now, t["ev_match_meta"].filter(new), known), "seasons")
    return season.refreshed(now, "agg_player_season", written(before.agg_player_season(), "before"), seasons)


# -- checks --------------------------------------------------------------------------

@query("t01_not_null")
def _t01(t: Tables) -> DataFrame:
    m = marts(t)
    return (quality.not_null(m.player_xwalk, "player_uid", "player_xwalk.player_uid")
            .unionByName(quality.not_null(m.staged("xg_lineups"), "shirt_number", "xg_lineups.shirt_number")))


@query("t02_unique_anchor")
def _t02(t: Tables) -> DataFrame:
    m = marts(t)
    return (quality.unique(m.player_xwalk, "ev_player_id", "player_xwalk.ev_player_id")
            .unionByName(quality.unique(m.raw("ev_lineups"), "player_id", "ev_lineups.player_id")))


@query("t03_unique_provider")
def _t03(t: Tables) -> DataFrame:
    m = marts(t)
    return (quality.unique(m.player_xwalk, "rd_player_id", "player_xwalk.rd_player_id")
            .unionByName(quality.unique(m.raw("rd_lineups"), "shirt_number", "rd_lineups.shirt_number")))


@query("t04_unique_keys")
def _t04(t: Tables) -> DataFrame:
    m = marts(t)
    return (quality.unique(m.dim_match(), "combo_id", "dim_match.combo_id", "warn")
            .unionByName(quality.unique(m.dim_team(), "country", "dim_team.country", "warn")))


def planted(df: DataFrame, columns: list[str], nulls: list[str]) -> DataFrame:
    """The columns of a table with failures: rows whose value ends in 7 come twice, values that end in 3 are missing."""
    def ends(c: str, digit: str) -> Column:
        return F.coalesce(F.right(F.col(c).cast("string"), F.lit(1)) == digit, F.lit(False))

    rows = df.select(*columns)
    twice = ends(columns[0], "7")
    for c in columns[1:]:
        twice = twice | ends(c, "7")
    return rows.unionByName(rows.filter(twice)).select(*[F.when(~ends(c, "3"), F.col(c)).alias(c) if c in nulls else F.col(c) for c in columns])


def checked_columns() -> dict[str, tuple[list[str], list[str]]]:
    """Tables of the standard checks: their checked columns, and those that must not be null."""
    every = [*quality.NOT_NULL, *[(t, c) for t, c, _ in quality.UNIQUE]]
    return {t: (list(dict.fromkeys(c for n, c in every if n == t)), [c for n, c in quality.NOT_NULL if n == t]) for t, _ in every}


@query("t06_all_checks")
def _t06(t: Tables) -> DataFrame:
    """The whole check list over tables with planted failures."""
    m, columns = marts(t), checked_columns()
    return quality.key_failures(lambda name: planted(quality.table(m, name), *columns[name])).unionByName(quality.drifted(m))


query("t06_checks_of_the_marts")(lambda t: quality.run_checks(marts(t)))
query("t05_shot_counts")(lambda t: quality.shot_counts(shooting.shots(t.feed), t["xg_shots"], t["rd_shots"]))


# -- reshapes --------------------------------------------------------------------------

query("p02_cast_text")(lambda t: reshape.cast_text_numeric(
    t["xg_player_stats"], keep_text=["combo_id", "player_name", "team_name"], drop=["team_name"], display=["accurate_passes"]))
query("p03_new_columns")(lambda t: reshape.join_new(
    passing.team_passing(t.feed, t.sides), passing.team_passing_advanced(t.feed, t.sides), ["combo_id", "team_id"]))
query("p04_pivot")(lambda t: reshape.pivot_wide(t["orders"], ["o_custkey"], "o_orderpriority", "o_totalprice"))
query("p05_team_stats_wide")(lambda t: reshape.team_stats_wide(t["team_stat_items"], ["combo_id", "period"]))
query("x07_bad_sides")(lambda t: identity.bad_sides(t["ev_lineups"]))


# -- documents -----------------------------------------------------------------------
# The documents are made from the adapter tables and read back by the provider readers.

def _paths(t: Tables) -> DataFrame:
    """The paths of the sample documents: a table, as a query may list them several times."""
    paths = sample_docs.all_texts(t).select(F.concat_ws("/", F.lit("/data"), "combo_id", "provider", F.concat("file", F.lit(".json"))).alias("path"))
    return t.once("paths", paths)


def _events(t: Tables) -> DataFrame:
    return event_docs.event_documents(sample_docs.event_texts(t))


def _xg(t: Tables) -> DataFrame:
    return xg_docs.xg_documents(sample_docs.xg_texts(t))


def _rd(t: Tables) -> rd_docs.ReferenceDocs:
    return rd_docs.ReferenceDocs(sample_docs.reference_texts(t))


def _columns(t: Tables, name: str) -> list[str]:
    """The columns of one dynamic table, found as a load finds them."""
    return dynamic.columns_of(dynamic.keys_and_types({name: dynamic.document_cells(_xg(t), _rd(t))[name]}), [name])[name]


query("s01_scan")(lambda t: documents.descriptors(_paths(t)))
query("s02_incremental")(lambda t: documents.not_loaded(documents.descriptors(_paths(t)), t["matches"].filter("mno % 2 = 0")).select("combo_id", "ev_id"))


def _listed(t: Tables, changed: str | None = None) -> DataFrame:
    """The sample files as a listing gives them; those where `changed` holds were written again later."""
    listed = _paths(t).select("path", F.timestamp_seconds(F.lit(1000)).alias("modified"), F.length("path").cast("bigint").alias("length"))
    return manifest.described(listed if changed is None else listed.withColumn("modified", F.when(F.expr(changed), F.timestamp_seconds(F.lit(2000))).otherwise(F.col("modified"))))


@query("s02_manifest")
def _s02_manifest(t: Tables) -> DataFrame:
    """What a second listing adds: files of matches whose number ends in 3 were missing, those in 5 have changed."""
    known = _listed(t).filter("combo_id not like '%3'")
    return manifest.unseen(_listed(t, "path like '/data/M____5/%'"), known).filter("provider in ('events', 'xg')").select("combo_id", "provider", "file")


@query("l01_held_matches")
def _l01(t: Tables) -> DataFrame:
    """Three arrivals: event documents of matches ending in 1 and 2 are late, those in 2 come with the second, those in 1 never;
    the third brings odds again for matches ending in 4. After each arrival the due matches are loaded, those in 6 fail once."""
    late = F.col("provider") == "events"
    arrivals = [_listed(t).filter(~(late & F.col("combo_id").rlike("[12]$"))), _listed(t).filter(late & F.col("combo_id").endswith("2")),
                _listed(t).filter((F.col("provider") == "odds") & F.col("combo_id").endswith("4"))]
    seen, loads, out = None, t.spark.createDataFrame([], manifest.LOADS), None
    for i, files in enumerate(arrivals, 1):
        files = files.withColumn("arrival", F.lit(i).cast("bigint"))
        seen = files if seen is None else seen.unionByName(files)
        found = written(manifest.due(seen, loads, changed=True), "due")
        step = found.select("combo_id", F.lit(i).cast("bigint").alias("arrival"))
        out = step if out is None else out.unionByName(step)
        loads = loads.unionByName(step.withColumn("failed", F.col("combo_id").endswith("6") & (F.col("arrival") == 1)))
    return out


@query("s03_reject")
def _s03(t: Tables) -> DataFrame:
    """Broken and blocked documents of some matches are left out."""
    broken = (F.when(F.col("combo_id").endswith("1"), F.substring("value", 1, 300))
              .when(F.col("combo_id").endswith("2"), F.lit('{"code": "TURNSTILE_REQUIRED"}')).otherwise(F.col("value")))
    docs = event_docs.event_documents(sample_docs.event_texts(t).withColumn("value", broken))
    return docs.select("combo_id", F.size("doc.events").cast("bigint").alias("n_events"))


@query("s03_odd_types")
def _s03_odd(t: Tables) -> DataFrame:
    """An attendance that is no number costs that field only, not the document."""
    odd = F.regexp_extract("combo_id", r"(\d+)$", 1).cast("bigint") % 3 == 0
    texts = sample_docs.event_texts(t).withColumn("value", F.when(odd, F.regexp_replace("value", r'"attendance":(\d+)', '"attendance":"$1 people"')).otherwise(F.col("value")))
    docs = event_docs.event_documents(texts)
    return docs.select("combo_id", F.col("doc.attendance").alias("attendance"), F.size("doc.events").cast("bigint").alias("n_events"), F.col("doc._corrupt_record").isNotNull().alias("flawed"))


@query("s03_rejected")
def _s03_rejected(t: Tables) -> DataFrame:
    """What is left out or read in part, with the reason."""
    last = F.right("combo_id", F.lit(1))
    value = (F.when(last == "1", F.substring("value", 1, 300)).when(last == "2", F.lit('{"code": "TURNSTILE_REQUIRED"}'))
             .when(last == "3", F.regexp_replace("value", r'"attendance":\d+', '"attendance":"many"')).otherwise(F.col("value")))
    return event_docs.rejected_documents(sample_docs.event_texts(t).withColumn("value", value)).select("combo_id", "provider", "reason")


query("s03_feed")(lambda t: event_docs.feed(_events(t)).select(
    "combo_id", "pos", "event_id", "t_s", "minute", "second", "period", "home_id", "away_id", "team_id", "opp_id", "player_id", "related_player_id", "etype", "ok",
    "x", "y", "pass_end_x", "pass_end_y", "length", "related_event_id", "is_touch", "is_shot", F.try_element_at("qnames", F.lit(1)).alias("first_name")))
query("s05_match_meta")(lambda t: event_docs.match_meta(_events(t)).select("combo_id", "ev_match_id", "home_team_id", "away_team_id", "attendance", "referee", "start_time"))
query("s06_lineups")(lambda t: event_docs.lineups(_events(t)).select(
    "combo_id", "player_id", "player_name", "team_id", "team_name", "is_home_team", "shirt_number", "position", "is_starter", "is_captain", "subbed_in_minute"))
query("s07_formations")(lambda t: event_docs.formations(_events(t)).select(
    "combo_id", "team_id", "is_home_team", "formation_index", "formation_name", "start_minute", "captain_player_id"))
query("s08_xg_match")(lambda t: xg_docs.match(_xg(t)).select(
    "combo_id", "match_round", "home_team_id", "away_team_id", "home_score", "away_score", "match_date", "stadium_name", "stadium_city", "stadium_capacity",
    "home_color", "away_color", "has_shot_data", "has_momentum_data", "motm_id", "motm_rating"))
query("s09_xg_lineups")(lambda t: xg_docs.lineups(_xg(t)).select(
    "combo_id", "player_id", "team_id", "is_home_team", "role", "shirt_number", "position_id", "position", "usual_position_id", "usual_position", "rating"))
query("s10_coaches")(lambda t: xg_docs.match(_xg(t)).select("combo_id", "ht_coach_id", "ht_coach_name", "at_coach_id", "at_coach_name"))
query("s11_xg_shots")(lambda t: xg_docs.shots(_xg(t)).select("combo_id", "row_id", "team_id", "player_id", "minute", "minute_added", "xg", "xgot", "shot_type"))
query("p05_team_stats_docs")(lambda t: xg_docs.team_stats(_xg(t), _columns(t, "xg_team_stats")).drop("xg_match_id"))
query("p06_team_stat_items")(lambda t: xg_docs.team_stat_items(_xg(t)).select("combo_id", "period", "stat_group", "stat_key", "home_value", "away_value"))
query("p07_player_stats")(lambda t: xg_docs.player_stats(_xg(t), _columns(t, "xg_player_stats")).drop(
    "xg_match_id", "team_name", "is_goalkeeper", "shirt_number", "position_id"))
query("s28_momentum")(lambda t: xg_docs.momentum(_xg(t)).select("combo_id", "momentum_data"))
query("s18_players")(lambda t: rd_docs.players(_rd(t)).select("player_id", "name", "nationality").distinct())
query("s18_teams")(lambda t: rd_docs.teams(_rd(t)).select("team_id", "name", "stadium", "stadium_capacity", "country", "city").distinct())
query("s18_tournaments")(lambda t: rd_docs.tournaments(_rd(t)).select("tournament_id", "name", "country", "tier").distinct())
query("s18_seasons")(lambda t: rd_docs.seasons(_rd(t)).select("season_id", "name", "year", "tournament_id").distinct())
query("s18_managers")(lambda t: rd_docs.managers(_rd(t)).select("manager_id", "name").distinct())
query("s18_referees")(lambda t: rd_docs.referees(_rd(t)).drop("combo_id"))
query("s19_epoch")(lambda t: rd_docs.players(_rd(t)).select("player_id", F.unix_timestamp("birth_date").alias("birth_s")).distinct())
query("s20_rd_matches")(lambda t: rd_docs.matches(_rd(t)).select(
    "combo_id", "match_id", "tournament_id", "season_id", "venue", "referee_id", "home_team_id", "away_team_id", "home_manager_id", "away_manager_id", "winnercode",
    "homescore_current", "homescore_period1", "awayscore_current", "home_formation", "motm_player_id", F.unix_timestamp("starttimestamp").alias("start_s"), "has_shotmap"))
query("s21_coverage")(lambda t: rd_docs.matches(_rd(t)).select("combo_id", "has_shotmap", "has_xg"))
query("s22_rd_shots")(lambda t: rd_docs.shots(_rd(t)).select(
    "combo_id", "row_id", "player_id", "shot_id", "xg", "xgot", "goalmouthlocation", "incidenttype", "goaltype", "addedtime", "playercoordinates", "blockcoordinates", "other_fields"))
query("s23_rd_player_stats")(lambda t: rd_docs.player_stats(_rd(t), _columns(t, "rd_player_stats")).drop("position"))
query("s24_rd_lineups")(lambda t: rd_docs.lineups(_rd(t)).select(
    "combo_id", "team_id", "is_home_team", "player_id", "is_starter", "is_captain", "minutes_played", "shirt_number", "position"))
query("s24_missing_players")(lambda t: rd_docs.missing_players(_rd(t)).select("combo_id", "team_id", "is_home_team", "player_id", "name", "type", "reason"))
query("s25_spatial")(lambda t: rd_docs.spatial(_rd(t)).select("combo_id", "average_positions", "home_heatmap", "away_heatmap", "match_momentum_graph", "commentary"))
query("s27_odds_wide")(lambda t: rd_docs.odds(_rd(t), _columns(t, "rd_odds")))
query("p08_match_stats")(lambda t: rd_docs.match_stats(_rd(t), _columns(t, "rd_match_stats")).drop("match_id"))
query("p09_dynamic_keys")(lambda t: dynamic.keys_and_types(dynamic.document_cells(_xg(t), _rd(t))))
query("s26_odds_long")(lambda t: odds_docs.odds(odds_docs.odds_documents(sample_docs.odds_texts(t))).select(
    "combo_id", "market_name", "period_name", "line", "outcome_name", "odds_value", "odds_direction"))

# -- load semantics --------------------------------------------------------------------


def _orders(t: Tables, cond: str) -> DataFrame:
    return t["orders"].filter(cond)


@query("s12_upsert")
def _s12(t: Tables) -> DataFrame:
    """Status and price of each customer's latest order; later batches lack the status column."""
    old = tables.upsert(None, _orders(t, "o_orderkey % 3 = 0").select("o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderkey").alias("load_seq")), ["o_custkey"])
    new = _orders(t, "o_orderkey % 3 <> 0").select("o_custkey", "o_totalprice", "o_orderpriority", F.col("o_orderkey").alias("load_seq"))
    return tables.upsert(old, new, ["o_custkey"])


query("s13_conditional_upsert")(lambda t: tables.upsert_larger(
    None, t["orders"].select("o_custkey", "o_orderkey", F.floor(F.col("o_totalprice") / 10000).alias("games"), F.col("o_orderkey").alias("load_seq")),
    ["o_custkey"], "games"))
query("s14_overwrite")(lambda t: tables.replace_matches(
    _orders(t, "o_orderkey % 3 <> 1").select("o_custkey", "o_orderkey"), _orders(t, "o_orderkey % 3 = 1").select("o_custkey", "o_orderkey"), "o_custkey"))
query("s15_extend_schema")(lambda t: tables.replace_matches(
    _orders(t, "o_orderkey % 3 <> 1").select("o_custkey", "o_orderkey"), _orders(t, "o_orderkey % 3 = 1").select("o_custkey", "o_orderkey", "o_orderstatus"), "o_custkey"))
# -- stored tables: several batches, with compactions between them -----------------------


def _store(t: Tables, bucket_bytes: int = 32 << 10) -> Store:
    """An empty store in the shared folder. Small buckets, so that the tables have several."""
    return Store(t.spark, f"{shared_dir(t.spark)}/touchline/store-{uuid.uuid4().hex}", bucket_bytes)


@query("s12_store_upsert")
def _s12_store(t: Tables) -> DataFrame:
    """Customers in three batches of different columns: what a batch lacks stays as it was."""
    store = _store(t)
    for i, cols in enumerate((["o_orderstatus", "o_totalprice"], ["o_totalprice", "o_orderpriority"], ["o_orderstatus"])):
        latest = tables.upsert(None, _orders(t, f"o_orderkey % 3 = {i}").select("o_custkey", *cols, F.col("o_orderkey").alias("load_seq")), ["o_custkey"])
        store.append("customers", latest, ["o_custkey"])
        if i == 1:
            store.compact("customers")
    store.commit()
    return Store(t.spark, store.root).read("customers")


@query("s13_store_larger")
def _s13_store(t: Tables) -> DataFrame:
    """Cumulative records: the larger count wins whichever batch brings it, the first of equal ones stays."""
    store = _store(t)
    for i in (2, 0, 1):
        rows = _orders(t, f"o_orderkey % 3 = {i}").select("o_custkey", "o_orderkey", F.floor(F.col("o_totalprice") / 10000).alias("games"), F.col("o_orderkey").alias("load_seq"))
        store.append("records", tables.upsert_larger(None, rows, ["o_custkey"], "games"), ["o_custkey"], measure="games")
        if i == 0:
            store.compact("records")
    store.commit()
    return Store(t.spark, store.root).read("records")


@query("s14_store_reload")
def _s14_store(t: Tables) -> DataFrame:
    """Orders of customers, of which later batches reload some as a whole; the table is dealt out anew on the way."""
    store = _store(t)
    for i, cond in enumerate(("o_orderkey % 3 <> 1", "o_orderkey % 3 = 1 and o_custkey % 5 = 0", "o_orderkey % 7 = 0 and o_custkey % 10 = 0")):
        store.append("orders", _orders(t, cond).select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], whole=True)
        if i == 1:
            store.compact("orders")
            store.bucket_bytes *= 4
            store.compact("orders")
    store.commit()
    return Store(t.spark, store.root).read("orders")


@query("s15_type_conflicts")
def _s15_store(t: Tables) -> DataFrame:
    """A column that comes as a long, then as a double, then as text, then not at all."""
    store = _store(t)
    for i, extra in enumerate((F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderpriority"), None)):
        rows = _orders(t, f"o_orderkey % 4 = {i}").select("o_orderkey", "o_custkey", *([] if extra is None else [extra.alias("extra")]))
        store.append("orders", rows, ["o_orderkey"], whole=True)
        if i == 1:
            store.compact("orders")
    store.commit()
    return Store(t.spark, store.root).read("orders")


@query("s33_truncate")
def _s33(t: Tables) -> DataFrame:
    """An emptied table keeps its columns and takes the next batch."""
    store = _store(t)
    store.append("orders", _orders(t, "o_orderkey % 2 = 0").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], whole=True)
    store.compact("orders")
    store.truncate("orders")
    store.append("orders", _orders(t, "o_orderkey % 5 = 0").select("o_custkey", "o_orderkey"), ["o_custkey"], whole=True)
    store.commit()
    return Store(t.spark, store.root).read("orders")


query("s16_normalize")(lambda t: tables.normalized(t["events"].select(
    F.col("event_id").alias("Event_ID"), F.col("ts").alias("TS"), F.when(F.col("event_id") % 7 != 0, F.col("value")).otherwise(F.lit("NaN").cast("double")).alias("Value"),
    F.array("event_id", "user_id").alias("Ids"))))
query("s17_natural_id")(lambda t: tables.natural_id(t["rd_referees"].withColumnRenamed("referee_id", "id"), "rd_referees"))
@query("s30_published")
def _s30(t: Tables) -> DataFrame:
    """A crosswalk published as a table of its layer, read through the catalog."""
    layer = Layer(t.spark, f"{shared_dir(t.spark)}/touchline/warehouse-{uuid.uuid4().hex}", "staging")
    layer.write("team_xwalk", team_xwalk(t), ["team_uid"])
    layer.publish()
    return t.spark.table(f"{namespace('staging')}.team_xwalk")


query("k04_preview")(lambda t: tables.preview(t["xg_shots"].select("combo_id", "row_id", "player_id", "xg").orderBy("combo_id", "row_id")))
query("s32_of_match")(lambda t: tables.of_match(t["xg_shots"], "M00001").select("combo_id", "row_id", "player_id", "xg"))

# -- scalar functions ------------------------------------------------------------------

query("f01_normalize_name")(lambda t: t["part"].select("p_partkey", expr.normalize_name(F.concat(F.col("p_name"), F.lit(" É-9 "), F.col("p_type"))).alias("nname")))


@query("f02_leading_number")
def _f02(t: Tables) -> DataFrame:
    n, k = F.floor("value").cast("string"), F.col("event_id") % 6
    text = (F.when(k == 0, F.concat(n, F.lit("%"))).when(k == 1, F.concat(n, F.lit("/"), n, F.lit(" (60%)"))).when(k == 2, F.lit("-")).when(k == 3, F.lit(""))
            .when(k == 4, F.concat(F.lit("-"), n)))
    return t["events"].select("event_id", expr.leading_number(text).alias("number"))


query("f03_geometry")(lambda t: t.feed.select(
    "combo_id", "pos", expr.rnd(expr.goal_distance_m(F.col("x"), F.col("y")), 2).alias("dist_m"), expr.goal_distance_units(F.col("x"), F.col("y")).alias("dist_units"),
    expr.shot_angle(expr.rnd(expr.goal_distance_m(F.col("x"), F.col("y")), 2)).alias("angle"), expr.expected_threat(F.col("x"), F.col("y")).alias("xt"),
    expr.third(F.col("x")).alias("third"), expr.foul_zone(F.col("x")).alias("foul_zone"), expr.touch_in_box(F.col("x"), F.col("y")).alias("box_touch"),
    expr.pass_into_box(F.col("x"), F.col("y")).alias("box_pass"), expr.in_penalty_area(F.col("x"), F.col("y")).alias("box_area"),
    expr.length_band(F.col("length")).alias("band")))


@query("f16_clock")
def _f16(t: Tables) -> DataFrame:
    m, s, d = expr.clock(F.col("t_s"), F.lit(180) * (F.col("period") - 1), F.col("period"))
    return t.feed.select("combo_id", "pos", m.alias("m"), s.alias("s"), d.alias("display"))


query("f17_positions")(lambda t: t["xg_lineups"].select(
    "combo_id", "player_id", expr.position_label(F.col("position_id"), F.col("shirt_number") / 14).alias("label"), expr.usual_position(F.col("usual_position_id")).alias("usual")))
query("f21_number_or")(lambda t: t["orders"].select("o_orderkey", expr.number_or(F.col("o_orderpriority").substr(1, 2), 50).alias("bad"),
                                                     expr.number_or(F.col("o_orderpriority").substr(1, 1), 50).alias("good")))
