"""From files to marts: scan, load, reload, checks, stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from touchline.plans.load import build, load, load_texts, raw_frames, raw_store
from touchline.plans.staging import STAGED
from touchline.sinks.layers import Layer
from touchline.sinks.tables import table_path
from touchline.sources import documents, event_docs, sample_docs
from touchline.streaming.ingest import ingest

SOME = ["ev_match_meta", "ev_lineups", "ev_shots", "ev_pass_network"]


@pytest.fixture(scope="module")
def root(tables, tmp_path_factory):
    """Two matches on disk; a third folder has no event document."""
    base = tmp_path_factory.mktemp("docs")
    for r in sample_docs.all_texts(tables).collect():
        folder = base / r.combo_id / r.provider
        os.makedirs(folder, exist_ok=True)
        (folder / f"{r.file}.json").write_text(r.value)
    os.makedirs(base / "M99999" / "odds")
    (base / "M99999" / "odds" / "1_odds_x.json").write_text(json.dumps({"generated_at": "x", "message": ["none"]}))
    return str(base)


def test_scan_needs_an_event_document(spark, root):
    found = documents.scan(spark, root).collect()
    assert sorted(r.combo_id for r in found) == ["M00000", "M00001"]
    assert all(r.has_xg_data and r.has_reference_data and r.ev_id == 700000 + int(r.combo_id[1:]) for r in found)


def test_incremental_discovery(spark, root):
    found = documents.scan(spark, root)
    loaded = spark.createDataFrame([("M00000",)], "combo_id string")
    assert [r.combo_id for r in documents.not_loaded(found, loaded).collect()] == ["M00001"]
    assert documents.not_loaded(found, loaded, force_reload=True).count() == 2


def test_broken_documents_are_rejected(spark):
    texts = spark.createDataFrame([("a", "events", "events_1", "{broken"), ("b", "events", "events_2", '{"code": "TURNSTILE_REQUIRED"}'),
                                   ("c", "events", "events_3", '{"home": {"teamId": 1}, "away": {"teamId": 2}, "events": []}')],
                                  "combo_id string, provider string, file string, value string")
    assert [r.combo_id for r in event_docs.event_documents(texts).collect()] == ["c"]


def test_an_odd_field_costs_only_itself(spark):
    good = '{"attendance": "54,000", "home": {"teamId": 1, "players": [{"playerId": 5, "age": "old"}]}, "away": {"teamId": 2}, "events": [{"eventId": 5, "minute": 3}]}'
    texts = spark.createDataFrame([("a", "events", "events_1", good), ("b", "events", "events_2", "{broken"), ("c", "events", "events_3", '{"code": "TURNSTILE_REQUIRED"}'),
                                   ("d", "events", "events_4", '{"away": {"teamId": 2}}')], "combo_id string, provider string, file string, value string")
    doc = event_docs.event_documents(texts).first().doc
    assert (doc.attendance, doc.home.teamId, doc.home.players[0].playerId, doc.home.players[0].age, doc.events[0].minute) == (None, 1, 5, None, 3)
    assert event_docs.event_documents(texts).count() == 1
    reasons = {r.combo_id: r.reason for r in event_docs.rejected_documents(texts).collect()}
    assert reasons == {"a": "odd field", "b": "not JSON", "c": "block page", "d": "required field missing"}


def test_missing_fields_of_events(spark):
    doc = {"home": {"teamId": 1}, "away": {"teamId": 2}, "events": [{"eventId": 5, "teamId": 0, "playerId": 0, "type": {"value": 1, "displayName": "Pass"}}]}
    texts = spark.createDataFrame([("c", "events", "events_3", json.dumps(doc))], "combo_id string, provider string, file string, value string")
    row = event_docs.feed(event_docs.event_documents(texts)).first()
    assert (row.t_s, row.team_id, row.player_id, row.qids, row.is_touch, row.base_pass) == (0, None, None, [], False, True)


FOR_MARTS = ["ev_match_meta", "ev_lineups", "ev_shots", "ev_player_shooting", "ev_player_possession", "xg_match", "xg_lineups", "xg_shots", "rd_players",
             "rd_lineups", "rd_player_stats", "rd_shots", "rd_matches", "rd_managers", "rd_referees", "rd_teams"]


def test_load_and_build_marts(spark, root, tables, tmp_path):
    base = str(tmp_path / "w")
    audit = load(spark, root, base, only=FOR_MARTS)
    assert [r.error for r in audit.filter("error IS NOT NULL").collect()] == []
    assert audit.select("table").distinct().count() == len(FOR_MARTS)
    shots = raw_store(spark, base).read("ev_shots")
    assert shots.count() == tables.feed.filter("is_shot").count()
    assert shots.filter("player_name IS NULL").count() == 0
    failures = build(spark, base, min_minutes=60, only=["dim_match", "fct_shots", "agg_player_season"])
    assert failures.filter("severity = 'error'").count() == 0
    marts = Layer(spark, base, "marts")
    assert marts.read("fct_shots").count() == marts.counts("fct_shots")["rows"] == spark.table("touchline_marts.fct_shots").count() == shots.count()
    assert spark.table("agg_player_season").count() > 0 and spark.table("staging_ev_shots").filter("player_uid is null").count() == 0
    assert spark.table("touchline_staging.player_xwalk").columns == ["player_uid", "ev_player_id", "rd_player_id", "xg_player_id"]
    # nothing new: nothing is loaded again
    assert load(spark, root, base).count() == 0


def test_a_failing_table_holds_its_matches_back(spark, root, tmp_path, monkeypatch):
    from touchline.plans import load as module

    base = str(tmp_path / "w")
    real = module.EVENT_TABLES["ev_shots"]

    def broken(data):
        raise ValueError("no shots today")

    monkeypatch.setitem(module.EVENT_TABLES, "ev_shots", broken)
    audit = load(spark, root, base, only=SOME)
    assert {r.table for r in audit.filter("error IS NOT NULL").collect()} == {"ev_shots"}
    assert raw_store(spark, base).layouts == {}
    monkeypatch.setitem(module.EVENT_TABLES, "ev_shots", real)
    again = load(spark, root, base, only=SOME)
    assert again.filter("error IS NOT NULL").count() == 0 and again.select("combo_id").distinct().count() == 2
    assert raw_store(spark, base).read("ev_shots").count() > 0
    assert load(spark, root, base, only=SOME).count() == 0


def test_an_unreadable_event_document_holds_its_match_back(spark, root, tmp_path):
    import shutil

    src, base = tmp_path / "in", str(tmp_path / "w")
    shutil.copytree(root, src)
    path = src / "M00001" / "events" / "events_700001.json"
    text = path.read_text()
    path.write_text(text[:500])
    audit = load(spark, str(src), base, only=[*SOME, "xg_match"])
    assert [(r.combo_id, r.error) for r in audit.filter("error IS NOT NULL").collect()] == [("M00001", "not JSON")]
    assert [r.combo_id for r in raw_store(spark, base).read("xg_match").collect()] == ["M00000"]
    path.write_text(text)
    assert {r.combo_id for r in load(spark, str(src), base, only=[*SOME, "xg_match"]).collect()} == {"M00001"}
    assert raw_store(spark, base).read("xg_match").count() == 2


def test_shared_folder_is_asked_for_outside_local_sessions(spark, monkeypatch, tmp_path):
    from types import SimpleNamespace

    from touchline.sinks import shared

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_dir(far)
    with shared.job_tables(spark):
        path = shared.written(spark.range(3), "gone").inputFiles()[0]
    assert not os.path.exists(path.removeprefix("file://"))


def test_all_raw_tables_have_builders(spark):
    texts = spark.createDataFrame([], "combo_id string, provider string, file string, value string")
    assert set(raw_frames(texts)) == set(STAGED)


def test_stream_loads_each_file_once_and_reloads_changed_matches(spark, root, tmp_path):
    base, checkpoint = str(tmp_path / "w"), str(tmp_path / "c")
    src = tmp_path / "in"
    import shutil

    shutil.copytree(os.path.join(root, "M00000"), src / "M00000")
    ingest(spark, str(src), base, checkpoint, SOME)
    assert [r.combo_id for r in raw_store(spark, base).read("ev_match_meta").collect()] == ["M00000"]
    shutil.copytree(os.path.join(root, "M00001"), src / "M00001")
    ingest(spark, str(src), base, checkpoint, SOME)
    ingest(spark, str(src), base, checkpoint, SOME)
    assert sorted(r.combo_id for r in raw_store(spark, base).read("ev_match_meta").collect()) == ["M00000", "M00001"]


def test_reloading_gives_the_same_tables(spark, root, tmp_path):
    base = str(tmp_path / "w")
    texts = documents.read_texts(spark, root)
    load_texts(texts, base, SOME)
    first = raw_store(spark, base).read("ev_pass_network")
    n = first.agg(F.sum("pass_count"), F.count("*")).first()
    load_texts(texts, base, SOME)
    assert raw_store(spark, base).read("ev_pass_network").agg(F.sum("pass_count"), F.count("*")).first() == n
