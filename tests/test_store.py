"""Raw tables in batches: replacement, types that change, compaction, buckets, commits."""

import os
import random

import pytest

from touchline.sinks.store import Store, cast_to, plain_type, widened


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "raw"), bucket_bytes=1500)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=str)


def test_widening():
    assert [widened(*p) for p in (("int", "bigint"), ("bigint", "double"), ("double", "string"), ("boolean", "int"), ("void", "date"), ("decimal(9,2)", "bigint"), ("date", "string"),
                                  ("array<int>", "array<int>"), ("array<int>", "bigint"))] == ["bigint", "double", "string", "string", "date", "double", "string", "array<int>", "string"]
    names = ["boolean", "int", "bigint", "double", "string", "void", "timestamp", "decimal(10,1)"]
    for a in names:
        for b in names:
            assert widened(a, b) == widened(b, a) and widened(widened(a, b), b) == widened(a, b)
            for c in ("bigint", "double", "string"):
                assert widened(widened(a, b), c) == widened(a, widened(b, c))
    assert plain_type("float") == "double"


@pytest.mark.parametrize("fold", [(), (0,), (1,), (2,), (0, 1, 2)])
def test_a_column_that_is_long_then_double_then_text(spark, store, fold):
    """The rows do not depend on when the table was compacted."""
    batches = [([("a", 5), ("b", None)], "combo_id string, v bigint"), ([("c", 2.5), ("d", 3.0), ("b", 1.0)], "combo_id string, v double"),
               ([("e", "x"), ("f", None)], "combo_id string, v string"), ([("g", 1)], "combo_id string, other int"), ([("a", True)], "combo_id string, v boolean")]
    for i, (data, schema) in enumerate(batches):
        store.append("t", spark.createDataFrame(data, schema), ["combo_id"], whole=True)
        if i in fold:
            store.compact("t")
        if i == 1:
            assert dict(store.read("t").dtypes)["v"] == "double" and rows(store.read("t"), "combo_id", "v")[:2] == [("a", 5.0), ("b", 1.0)]
    assert rows(store.read("t")) == [("a", "true", None), ("b", "1", None), ("c", "2.5", None), ("d", "3", None), ("e", "x", None), ("f", None, None), ("g", None, 1)]


def test_values_as_text(spark):
    one = spark.range(1)
    from pyspark.sql import functions as F

    cases = [(F.lit(3.0), "double", "3"), (F.lit(2.5), "double", "2.5"), (F.lit(float("nan")), "double", "NaN"), (F.lit(1e20), "double", "1.0E20"), (F.expr("cast(7 as decimal(9,2))"), "decimal(9,2)", "7"),
             (F.array(F.lit(1)), "array<int>", "[1]"), (F.expr("timestamp'2020-01-02 03:04:05'"), "timestamp", "2020-01-02T03:04:05"), (F.expr("date'2020-01-02'"), "date", "2020-01-02")]
    for c, have, want in cases:
        assert one.select(cast_to(c, have, "string")).first()[0] == want


def test_columns_that_differ_in_case_are_refused(spark, store):
    store.append("t", spark.createDataFrame([("a", 1)], "combo_id string, v int"), ["combo_id"], whole=True)
    with pytest.raises(ValueError, match="case"):
        store.append("t", spark.createDataFrame([("a", 1)], "combo_id string, V int"), ["combo_id"], whole=True)


def test_odd_column_names(spark, store):
    df = spark.createDataFrame([("a", 1, 2)], ["combo_id", "Full time_1X2.1", "a b"])
    for _ in range(2):
        store.append("t", df, ["combo_id", "a b"])
        store.compact("t")
        store.append("t", df, ["combo_id", "a b"])
    assert rows(store.read("t")) == [("a", 1, 2)]


def replaced(state, batch):
    touched = {r[0] for r in batch}
    return [r for r in state if r[0] not in touched] + batch


def test_matches_are_replaced_as_a_whole(spark, store):
    rng, state = random.Random(1), []
    for i in range(12):
        batch = [(f"m{m}", rng.randint(0, 9), i) for m in rng.sample(range(30), rng.randint(0, 6)) for _ in range(rng.randint(1, 4))]
        store.append("t", spark.createDataFrame(batch, "combo_id string, a int, b int"), ["combo_id"], whole=True)
        state = replaced(state, batch)
        if i in (3, 4, 9):
            store.compact("t")
        assert rows(store.read("t")) == sorted(state, key=str)


def test_rows_are_replaced_by_key_and_column(spark, store):
    rng, state, loose = random.Random(2), {}, {}
    for i in range(10):
        keys = rng.sample([(f"m{m}", p) for m in range(5) for p in range(4)], rng.randint(0, 8))
        names = rng.choice([["a"], ["b"], ["a", "b"], ["b", "a"], ["c"]])
        batch = [(*k, *(rng.choice([None, rng.randint(0, 9)]) for _ in names)) for k in keys]
        if i % 3 == 0:
            batch.append((f"m{i}", None, *([i] * len(names))))
        store.append("t", spark.createDataFrame(batch, "combo_id string, p int, " + ", ".join(f"{n} int" for n in names)), ["combo_id", "p"])
        for r in batch:
            target = loose.setdefault(r[0], {}) if r[1] is None else state.setdefault(r[:2], {})
            if r[1] is None:
                target.clear()
            target.update(zip(names, r[2:]))
        if i in (2, 6):
            store.compact("t")
    got = store.read("t")
    cols = [c for c in ("a", "b", "c") if c in got.columns]
    expected = [(*k, *(v.get(c) for c in cols)) for k, v in state.items()] + [(m, None, *(v.get(c) for c in cols)) for m, v in loose.items()]
    assert rows(got, "combo_id", "p", *cols) == sorted(expected, key=str)


@pytest.mark.parametrize("fold", [True, False])
def test_larger_records_replace_smaller_ones(spark, store, fold):
    for batch in ([(1, 10, "old"), (2, None, "old"), (3, 5, "old")], [(1, 10, "same"), (2, None, "none"), (3, 6, "more"), (4, None, "x")], [(3, 4, "less"), (4, 0, "y")]):
        store.append("t", spark.createDataFrame(batch, "k int, games int, v string"), ["k"], measure="games")
        if fold:
            store.compact("t")
    assert rows(store.read("t")) == [(1, 10, "old"), (2, None, "none"), (3, 6, "more"), (4, 0, "y")]


def test_the_base_is_not_dealt_out_again(spark, store):
    """Merging shuffles the batch only, and a compaction that keeps its buckets writes without another shuffle of the base."""
    store.bucket_bytes = 12_000
    df = spark.range(4000).selectExpr("concat('m', id % 500) as combo_id", "id as p", "id * 7 as v", "uuid() as w")
    store.append("t", df, ["combo_id", "p"])
    store.compact("t")
    assert store.layouts["t"].buckets >= 8
    store.append("t", df.filter("p < 40").withColumn("v", df.p), ["combo_id", "p"])
    plan = store._merged(store.layouts["t"], store._base(store.layouts["t"]), store._by_key(store.layouts["t"], store._deltas(store.layouts["t"])))
    lines = plan._jdf.queryExecution().executedPlan().toString().split("\n")
    join = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
    scan = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    assert join < scan and not any("Exchange" in x for x in lines[join:scan]) and any("Exchange" in x for x in lines[scan:])
    before = store.layouts["t"].buckets
    store.compact("t")
    assert store.layouts["t"].buckets == before and store.read("t").count() == 4000
    assert rows(store.read("t").filter("p in (39, 40)"), "p", "v") == [(39, 39), (40, 280)]


def test_buckets_follow_the_bytes(spark, store):
    store.bucket_bytes, counts = 50_000, []
    for n in (10, 2000, 20000):
        store.append("t", spark.range(n).selectExpr("concat('m', id) as combo_id", "uuid() as v"), ["combo_id"], whole=True)
        store.compact("t")
        counts.append(store.layouts["t"].buckets)
        assert store.read("t").count() == n
    assert counts[0] == 1 and counts[0] < counts[1] < counts[2]
    store.bucket_bytes = 1 << 30
    store.compact("t")
    assert store.layouts["t"].buckets == 1 and store.read("t").count() == 20000


def test_batches_write_their_own_rows_only(spark, store):
    store.append("t", spark.range(5000).selectExpr("concat('m', id) as combo_id", "uuid() as v"), ["combo_id"], whole=True)
    assert store.due("t")
    store.compact("t")
    base = store.layouts["t"].base
    store.append("t", spark.createDataFrame([("m1", "x")], "combo_id string, v string"), ["combo_id"], whole=True)
    assert not store.due("t") and store.layouts["t"].base == base and store.layouts["t"].deltas[0]["bytes"] < store.layouts["t"].base_bytes / 10
    for i in range(33):
        store.append("t", spark.createDataFrame([("m1", str(i))], "combo_id string, v string"), ["combo_id"], whole=True)
    assert store.compact_due() == ["t"] and store.layouts["t"].deltas == []
    assert store.read("t").filter("combo_id = 'm1'").collect()[0].v == "32"


def test_only_commits_are_seen(spark, store):
    store.append("t", spark.createDataFrame([("a", 1)], "combo_id string, v int"), ["combo_id"], whole=True)
    store.append("u", spark.createDataFrame([("a", 1)], "combo_id string, v int"), ["combo_id"], whole=True)
    assert Store(spark, store.root).layouts == {}
    store.commit()
    other = Store(spark, store.root)
    assert set(other.layouts) == {"t", "u"} and rows(other.read("t")) == [("a", 1)]
    other.append("t", spark.createDataFrame([("a", 2)], "combo_id string, v int"), ["combo_id"], whole=True)
    assert rows(Store(spark, store.root).read("t")) == [("a", 1)]  # a writer that dies before its commit leaves nothing behind
    other.compact("t")
    other.commit()
    last = Store(spark, store.root)
    assert rows(last.read("t")) == [("a", 2)] and rows(last.read("u")) == [("a", 1)]
    kept = {last.layouts["t"].base.rsplit("/", 1)[1]}
    assert last.vacuum() >= 2 and set(os.listdir(f"{store.root}/t")) == kept
    assert rows(Store(spark, store.root).read("t")) == [("a", 2)]


def test_truncate_keeps_the_columns(spark, store):
    store.append("t", spark.createDataFrame([("a", 1)], "combo_id string, v int"), ["combo_id"], whole=True)
    store.compact("t")
    store.truncate("t")
    assert store.read("t").dtypes == [("combo_id", "string"), ("v", "int")] and store.read("t").count() == 0
    store.append("t", spark.createDataFrame([("b", 2.5)], "combo_id string, v double"), ["combo_id"], whole=True)
    assert rows(store.read("t")) == [("b", 2.5)]
