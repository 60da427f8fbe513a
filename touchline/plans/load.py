"""Loading matches from documents into raw tables, and building the warehouse from them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import fields
from functools import lru_cache, partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sinks import tables as sink
from ..sinks.layers import Layer, namespace
from ..sinks.shared import job_tables, written
from ..sinks.store import Store, reading
from ..sources import documents, dynamic, event_docs, odds_docs, rd_docs, xg_docs
from . import manifest, season, votes
from .load_keys import ENTITY_KEYS, match_keys
from .event_tables import EVENT_TABLES, MatchData, with_names
from .marts import MARTS, Marts
from .quality import NOT_NULL, drifted, key_failures, table
from .staging import STAGED

def event_data(texts: DataFrame) -> MatchData:
    """Event documents, parsed once: the feed and its side tables are written as columns,
    so that each metric table reads only the columns it needs instead of the JSON."""
    data = event_docs.match_data(event_docs.event_documents(texts))
    return MatchData(*[written(getattr(data, f.name), f.name) for f in fields(MatchData)])


def raw_frames(texts: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> dict[str, Callable[[], DataFrame]]:
    """Builders of all 47 raw tables of the documents. `keep` may write the parsed documents of the other providers."""
    shared = lru_cache(maxsize=None)(lambda: event_data(texts))
    xg = lru_cache(maxsize=None)(lambda: keep(xg_docs.xg_documents(texts), "xg-documents"))
    rd = lru_cache(maxsize=None)(lambda: rd_docs.ReferenceDocs(texts, keep))

    def named(name: str) -> DataFrame:
        data = shared()
        df = EVENT_TABLES[name](data)
        names = data.lineups.select("combo_id", "player_id", "player_name")
        if name.startswith("ev_player_") or name == "ev_shots":
            return with_names(df, names, {"player_id": "player_name"})
        if name == "ev_pass_network":
            return with_names(df, names, {"passer_id": "passer_name", "receiver_id": "receiver_name"})
        return df

    # The columns of all tables that have them from their documents, found together.
    columns = lru_cache(maxsize=None)(lambda: dynamic.document_columns(xg(), rd()))

    def from_docs(docs, make, name: str) -> DataFrame:
        spread = any(name in tables for tables in dynamic.CELLS.values())
        return make(docs(), columns()[name]) if spread else make(docs())

    out: dict[str, Callable[[], DataFrame]] = {name: partial(named, name) for name in EVENT_TABLES}
    out.update({name: partial(from_docs, xg, make, name) for name, make in xg_docs.TABLES.items()})
    out.update({name: partial(from_docs, rd, make, name) for name, make in rd_docs.TABLES.items()})
    out["od_odds"] = lambda: odds_docs.odds(odds_docs.odds_documents(texts))
    return out


AUDIT = "combo_id string, provider string, table string, rows bigint, error string"
PROVIDERS = {"ev": "events", "xg": "xg", "rd": "reference", "od": "odds"}


def audit_path(base: str) -> str:
    return sink.table_path(base, "raw", "load_audit")


def raw_store(spark: SparkSession, base: str) -> Store:
    return Store(spark, sink.table_path(base, "raw", "").rstrip("/"))


def load_texts(texts: DataFrame, base: str, only: list[str] | None = None) -> DataFrame:
    """Writes the raw tables of the documents; returns the audit of this batch (match, provider, table, rows, error).

    All tables of the batch are staged first and become visible with one commit of the store. If a table fails, the matches that have
    documents of its provider are held back as a whole: nothing of them is published, and as
    the audit, which is written last, has their error, the next load tries them again. Files
    that are left out or read in part are in the audit too; only a lost event document holds
    its match back.
    """
    spark = texts.sparkSession
    with job_tables(spark):
        texts = written(texts, "texts")
        parsed = written(event_docs.event_documents(texts).select("combo_id").distinct(), "matches")
        flawed = written(event_docs.rejected_documents(texts).select("combo_id", "provider", "reason"), "flawed")
        present = written(texts.select("combo_id", "provider").distinct(), "present")
        texts = texts.join(parsed, "combo_id", "left_semi")
        staged: dict[str, DataFrame] = {}
        audit = (flawed.select("combo_id", "provider", F.lit("documents").alias("table"), F.lit(0).cast("bigint").alias("rows"),
                               F.when(F.col("reason") != "odd field", F.col("reason")).alias("error")))
        held: DataFrame | None = None
        for name, make in raw_frames(texts, written).items():
            if only is not None and name not in only:
                continue
            provider = PROVIDERS[name[:2]]
            of_provider = present.filter(F.col("provider") == provider).join(parsed, "combo_id", "left_semi")
            note = of_provider.select("combo_id", "provider", F.lit(name).alias("table"))
            try:
                staged[name] = written(make(), name)
                counts = staged[name].groupBy("combo_id").agg(F.count("*").alias("rows"))
                audit = audit.unionByName(note.join(counts, "combo_id").withColumn("error", F.lit(None).cast("string")))
            except Exception as e:
                audit = audit.unionByName(note.withColumn("rows", F.lit(0).cast("bigint")).withColumn("error", F.lit(f"{type(e).__name__}: {e}")))
                held = of_provider.select("combo_id") if held is None else held.union(of_provider.select("combo_id"))
        good = parsed if held is None else written(parsed.join(held.distinct(), "combo_id", "left_anti"), "complete")
        nothing = held is not None and good.isEmpty()
        store = raw_store(spark, base)
        for name, df in ({} if nothing else staged).items():
            _append(store, name, df.join(good, "combo_id", "left_semi"))
        if not nothing and "ev_lineups" in staged:
            votes.count_load(store, good)
        store.compact_due()
        store.commit()
        last = spark.read.parquet(audit_path(base)).agg(F.max("batch")).first()[0] if _exists(spark, audit_path(base)) else None
        number = 0 if last is None else last + 1
        audit.select("combo_id", "provider", "table", "rows", "error", F.lit(number).cast("bigint").alias("batch")).write.mode("append").parquet(audit_path(base))
    return spark.read.schema(AUDIT + ", batch bigint").parquet(audit_path(base)).filter(F.col("batch") == number).drop("batch")


def _append(store: Store, name: str, df: DataFrame) -> None:
    if name not in ENTITY_KEYS:
        keys = match_keys(name)
        store.append(name, df, keys or ["combo_id"], whole=keys is None)
        return
    keys = ENTITY_KEYS[name]
    if name == "rd_referees":
        # Cumulative records; the earlier of two equal ones stays.
        best = F.max_by(F.struct(*[c for c in df.columns if c not in (*keys, "combo_id")]), F.struct("games", "combo_id"))
        store.append(name, df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*"), keys, measure="games")
    else:
        # Within a batch the larger match key (they start with the date) is the later writer.
        store.append(name, sink.upsert(None, df.withColumn(sink.SEQ, F.col("combo_id")).drop("combo_id"), keys), keys)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise


def load(spark: SparkSession, root: str, base: str, force_reload: bool = False, only: list[str] | None = None,
         changed: bool = False, batch_bytes: int = manifest.BATCH_BYTES) -> DataFrame:
    """Loads the matches under `root` that are not loaded yet, with `changed` also those with new or changed files.
    Returns the audit of this load."""
    manifest.discover(spark, root, base)
    return load_due(spark, root, base, force_reload, only, changed, batch_bytes)


def load_due(spark: SparkSession, root: str, base: str, force_reload: bool = False, only: list[str] | None = None,
             changed: bool = False, batch_bytes: int = manifest.BATCH_BYTES) -> DataFrame:
    """Loads what the manifest says is due, in portions of bounded size."""
    root = root.rstrip("/")
    seen = manifest.files(spark, base).filter(F.col("root") == root)
    audits = spark.createDataFrame([], AUDIT)
    with job_tables(spark):
        found = written(manifest.due(seen, manifest.loads(spark, base), changed, force_reload), "due")
        for some in manifest.portions(found, batch_bytes):
            audit = load_texts(documents.read_texts(spark, [f"{root}/{combo}" for combo, _ in some]), base, only)
            failed = audit.filter("error is not null").select("combo_id")
            tried = spark.createDataFrame([(c,) for c, _ in some], "combo_id string")
            manifest.note(spark, base, some, tried.join(failed, "combo_id", "left_anti"))
            audits = audits.unionByName(audit)
    return audits


def build(spark: SparkSession, base: str, min_minutes: int = 450, only: list[str] | None = None,
          player_alias: DataFrame | None = None, team_alias: DataFrame | None = None) -> DataFrame:
    """Writes crosswalks and marts from the raw tables and publishes them together, unless a check of severity `error` fails.

    Returns the failed checks, a table of their own. Nulls of key columns are counted while the tables are written;
    crosswalks are tables of the staging layer, staged tables are views of the session, marts are tables of theirs. Season
    aggregates that a build has published before are brought up to date: only the seasons touched since are ranked again.
    """
    staging, marts_layer = Layer(spark, base, "staging"), Layer(spark, base, "marts")
    must = {}
    for name, column in NOT_NULL:
        must.setdefault(name, []).append(column)

    def keep(df: DataFrame, name: str) -> DataFrame:
        return staging.write(name, df, must.get(name, [])) if name.endswith("_xwalk") else written(df, name)

    store = raw_store(spark, base)
    loaded = spark.read.schema(AUDIT + ", batch bigint").parquet(audit_path(base)) if _exists(spark, audit_path(base)) else None
    now = {"batch": loaded.agg(F.max("batch")).first()[0] if loaded is not None else None, "min_minutes": min_minutes}
    marts = Marts(reading(store), player_alias, team_alias, min_minutes, keep, store.read(votes.COUNTS) if votes.COUNTS in store.layouts else None)
    with job_tables(spark):
        wanted = sorted(only or MARTS, key=MARTS.index)
        seasons = None
        for name in wanted:
            last = marts_layer.current.get(name, {}).get("note") if name.startswith("agg_") and player_alias is None and team_alias is None else None
            if last and last["min_minutes"] == min_minutes and now["batch"] is not None and _published(staging, marts_layer):
                if seasons is None:
                    published = Layer(spark, base, "staging"), Layer(spark, base, "marts")
                    before = {t: published["dim_" in t].read(t) for t in ("player_xwalk", "team_xwalk", "dim_player", "dim_match")}
                    new = loaded.filter(F.col("batch") > last["batch"]).select("combo_id").distinct()
                    seasons = written(season.touched_seasons(marts, new, before), "seasons")
                made = season.refreshed(marts, name, published[1].read(name), seasons)
            else:
                made = getattr(marts, name)()
            marts_layer.write(name, made, must.get(name, []), now if player_alias is None and team_alias is None else None)

        def result(name: str) -> DataFrame:
            return marts_layer.read(name) if name in wanted else table(marts, name)

        counted = [(t, c) for t, c in NOT_NULL if t in wanted or t.endswith("_xwalk")]
        keys = key_failures(result, [x for x in NOT_NULL if x not in counted])
        nulls = [(f"not_null:{t}.{c}", "error", None, n) for t, c in counted
                 if (n := (staging if t.endswith("_xwalk") else marts_layer).counts(t)[f"null:{c}"])]
        keys = keys.unionByName(drifted(marts)).unionByName(spark.createDataFrame(nulls, "check string, severity string, key string, n bigint"))
        report = Layer(spark, base, "marts")
        failures = report.write("failed_checks", keys)
        report.publish()
        if failures.filter("severity = 'error'").isEmpty():
            marts_layer.version = report.version
            staging.publish()
            marts_layer.publish()
            attach(spark, base, marts)
    return failures


def _published(staging: Layer, marts: Layer) -> bool:
    """Whether a build before this one has published what a refresh of season aggregates compares with."""
    return {"player_xwalk", "team_xwalk"} <= set(staging.current) and {"dim_player", "dim_match"} <= set(marts.current)


def attach(spark: SparkSession, base: str, marts: Marts | None = None) -> None:
    """Declares a warehouse in this session: the published layers as tables, staged tables as views `staging_<name>`, season
    aggregates also as views of their name."""
    for layer in ("staging", "marts"):
        Layer(spark, base, layer).attach()
    store = raw_store(spark, base)
    if marts is None:
        xwalks = Layer(spark, base, "staging")
        marts = Marts(reading(store), keep=lambda df, name: xwalks.read(name) if name in xwalks.current else written(df, name))
    for name in STAGED:
        if name in store.layouts and {"ev_lineups", "rd_lineups", "rd_players", "xg_lineups"} <= set(store.layouts):
            marts.staged(name).createOrReplaceTempView(f"staging_{name}")
    for name, entry in Layer(spark, base, "marts").current.items():
        if name.startswith("agg_"):
            spark.table(f"{namespace('marts')}.{name}").createOrReplaceTempView(name)
