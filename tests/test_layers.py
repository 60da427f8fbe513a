"""Layers, key checks in one pass, manifest, keys of dynamic tables."""

import pytest
from pyspark.sql import functions as F

from touchline.plans import manifest, quality
from touchline.sinks.layers import Layer
from touchline.sources import dynamic


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_layer_switches_all_its_tables_at_once(spark, tmp_path):
    layer = Layer(spark, str(tmp_path), "marts")
    for name in ("dim_a", "dim_b"):
        layer.write(name, spark.createDataFrame([(1, None), (2, "x")], "k int, v string"), ["k", "v"])
    assert layer.counts("dim_a") == {"rows": 2, "null:k": 0, "null:v": 1}
    assert Layer(spark, str(tmp_path), "marts").current == {}
    layer.publish()
    assert spark.table("touchline_marts.dim_a").count() == 2
    again = Layer(spark, str(tmp_path), "marts")
    again.write("dim_a", spark.createDataFrame([(3, "y", 1.5)], "k int, v string, w double"))
    assert rows(again.read("dim_a")) == [(3, "y", 1.5)] and Layer(spark, str(tmp_path), "marts").read("dim_a").count() == 2
    assert spark.table("touchline_marts.dim_a").count() == 2
    again.publish()
    assert rows(spark.table("touchline_marts.dim_a")) == [(3, "y", 1.5)] and spark.table("touchline_marts.dim_b").count() == 2
    assert again.vacuum() == 1 and rows(Layer(spark, str(tmp_path), "marts").read("dim_a")) == [(3, "y", 1.5)]
    again.truncate("dim_b")
    assert spark.table("touchline_marts.dim_b").columns == ["k", "v"] and spark.table("touchline_marts.dim_b").count() == 0
    with pytest.raises(ValueError, match="no layer"):
        Layer(spark, str(tmp_path), "gold")


def test_key_checks(spark):
    tables = {"a": spark.createDataFrame([(1, "x"), (1, None), (None, "x"), (2, "x")], "k int, v string"), "b": spark.createDataFrame([(1,), (2,)], "k int")}
    found = quality.key_failures(tables.__getitem__, [("a", "k"), ("a", "v"), ("b", "k")], [("a", "k", "error"), ("a", "v", "warn"), ("b", "k", "error")])
    assert rows(found) == [("not_null:a.k", "error", None, 1), ("not_null:a.v", "error", None, 1), ("unique:a.k", "error", "1", 2), ("unique:a.v", "warn", "x", 3)]
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1


def seen(spark, *found):
    return spark.createDataFrame([(c, p, f, f"/{c}/{p}/{f}", n, a) for c, p, f, n, a in found], "combo_id string, provider string, file string, path string, length bigint, arrival bigint")


def test_due_matches(spark):
    files = seen(spark, ("a", "events", "events_1", 10, 1), ("a", "xg", "xg_1", 5, 1), ("b", "xg", "xg_2", 5, 1), ("c", "events", "events_3", 7, 1), ("d", "events", "other", 1, 1),
                 ("e", "events", "events_5", 3, 1), ("e", "odds", "1_odds", 2, 3), ("e", "odds", "1_odds", 4, 4))
    none = spark.createDataFrame([], manifest.LOADS)
    assert rows(manifest.due(files, none)) == [("a", 1, 15), ("c", 1, 7), ("e", 4, 7)]
    loads = spark.createDataFrame([("a", 1, False), ("c", 1, False), ("c", 1, True), ("e", 3, False)], manifest.LOADS)
    assert rows(manifest.due(files, loads)) == [] and rows(manifest.due(files, loads, changed=True)) == [("e", 4, 7)]
    assert len(rows(manifest.due(files, loads, force=True))) == 3
    assert rows(manifest.due(files, spark.createDataFrame([("a", 1, True), ("c", 1, False), ("e", 4, False)], manifest.LOADS))) == [("a", 1, 15)]


def test_portions_are_bounded(spark):
    found = spark.range(200).select(F.concat(F.lit("m"), "id").alias("combo_id"), F.lit(1).cast("bigint").alias("arrival"), F.lit(10).cast("bigint").alias("bytes"))
    parts = list(manifest.portions(found, 100))
    assert len(parts) > 10 and max(map(len, parts)) < 40 and sorted(c for p in parts for c, _ in p) == sorted(f"m{i}" for i in range(200))
    assert list(manifest.portions(found.limit(0))) == []


def test_discovery_enters_each_file_once(spark, tmp_path):
    root, base = tmp_path / "in", str(tmp_path / "w")
    for c in ("m1", "m2", "m3"):
        (root / c / "events").mkdir(parents=True)
        (root / c / "events" / "events_1.json").write_text("{}")
    (root / "m1" / "notes.txt").write_text("no document")
    assert manifest.discover(spark, str(root), base, at_a_time=2) == 1 and manifest.files(spark, base).count() == 3
    assert manifest.discover(spark, str(root), base) == 1 or manifest.files(spark, base).count() == 3
    (root / "m2" / "events" / "events_1.json").write_text('{"a": 1}')
    (root / "m2" / "xg").mkdir()
    (root / "m2" / "xg" / "xg_1.json").write_text("{}")
    manifest.discover(spark, str(root), base)
    assert sorted((r.combo_id, r.file) for r in manifest.files(spark, base).filter("arrival > 1").collect()) == [("m2", "events_1"), ("m2", "xg_1")]


def test_keys_and_types_of_dynamic_tables(spark):
    cells = {"t": spark.createDataFrame([("a", "1"), ("a", "2.5"), ("b", "x"), ("b", "1"), ("c", None), (None, "1"), ("d", "true"), ("e", "7")], "key string, value string"),
             "u": spark.createDataFrame([("a", "12")], "key string, value string"), "v": spark.createDataFrame([], "key string, value string")}
    found = dynamic.keys_and_types(cells)
    assert rows(found) == [("t", "a", "double"), ("t", "b", "string"), ("t", "c", "void"), ("t", "d", "boolean"), ("t", "e", "bigint"), ("u", "a", "bigint")]
    assert dynamic.columns_of(found, ["t", "u", "v"]) == {"t": ["a", "b", "c", "d", "e"], "u": ["a"], "v": []}
    with pytest.raises(ValueError, match="not columns"):
        dynamic.columns_of(found, ["t", "u", "v"], 2)


def test_a_stream_holds_matches_and_skips_repeated_batches(spark, tmp_path, monkeypatch):
    from touchline.streaming import ingest

    base, loaded = str(tmp_path / "w"), []

    def load_due(spark, root, base, only=None, changed=False):
        found = rows(manifest.due(manifest.files(spark, base), manifest.loads(spark, base), changed))
        loaded.append([c for c, *_ in found])
        if found:
            tried = [(c, a) for c, a, _ in found]
            manifest.note(spark, base, tried, spark.createDataFrame([(c,) for c, _ in tried], "combo_id string"))
        return spark.createDataFrame([], "combo_id string, table string, error string")

    monkeypatch.setattr(ingest, "load_due", load_due)

    def batch(*paths):
        return spark.createDataFrame([(p, 5) for p in paths], "path string, length bigint").withColumn("modified", F.timestamp_seconds(F.lit(1)))

    arrivals = [batch("/r/m1/events/events_1.json", "/r/m2/xg/xg_2.json"), batch("/r/m2/odds/1_odds.json"), batch("/r/m2/events/events_2.json"), batch("/r/m1/odds/1_odds.json")]
    for i, b in enumerate(arrivals):
        ingest.take(b, i, "/r", base, "stream")
    ingest.take(arrivals[3], 3, "/r", base, "stream")
    assert loaded == [["m1"], [], ["m2"], ["m1"], []] and manifest.files(spark, base).count() == 5
