"""Scalar functions, percent ranks, identity, load semantics and checks."""

import random

import pytest
from pyspark.sql import Row, functions as F
from pyspark.sql.window import Window

from touchline.functions import expr
from touchline.operators import identity, reshape
from touchline.operators.ranking import percent_ranks
from touchline.plans import quality
from touchline.sinks import tables as sink


@pytest.mark.parametrize("text,number", [("67%", 67.0), ("12/20 (60%)", 12.0), ("1.8", 1.8), ("-", None), ("", None), (None, None), ("-5", -5.0), ("-5%", None),
                                         ("x 3\ny", 3.0)])
def test_leading_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(expr.leading_number(F.col("t")).alias("n")).first()["n"] == number


def test_rounding_and_ratios(spark):
    row = spark.range(1).select(expr.rnd(F.lit(1.005), 2).alias("a"), expr.rnd(F.lit(0.1) + F.lit(0.2), 1).alias("b"), expr.ratio(F.lit(1), F.lit(0)).alias("c"),
                                expr.pct(F.lit(1), F.lit(0), empty=50).alias("d"), expr.pct(F.lit(1), F.lit(3)).alias("e")).first()
    assert row.asDict() == {"a": 1.01, "b": 0.3, "c": None, "d": 50.0, "e": 33.33}


def test_expected_threat_corners(spark):
    row = spark.range(1).select(expr.expected_threat(F.lit(0.0), F.lit(0.0)).alias("a"), expr.expected_threat(F.lit(100.0), F.lit(100.0)).alias("b"),
                                expr.expected_threat(F.lit(-9.0), F.lit(-1.0)).alias("c")).first()
    assert tuple(row) == (0.00638, 0.37805, 0.00638)


def test_position_labels(spark):
    df = spark.createDataFrame([(73, 0.79), (75, 0.5), (77, 0.21), (83, 0.83), (64, 0.5), (11, None), (999, 0.1)], "p int, y double")
    got = [r[0] for r in df.select(expr.position_label(F.col("p"), F.col("y"))).collect()]
    assert got == ["RCM", "CM", "LCM", "RW", "CDM", "GK", None]


def test_names_and_keys(spark):
    df = spark.createDataFrame([("Müller-Öz J.", "Accurate passes (%)")], "n string, k string")
    assert tuple(df.select(expr.normalize_name(F.col("n")), expr.clean_key(F.col("k"))).first()) == ("mllerzj", "accurate_passes")
    assert expr.pivot_column_name("Duels won+ 1.5-x") == "duels_wonplus_1_5_x"


def test_percent_ranks_with_one_extreme_value(spark):
    """Ranges follow the values: one far value does not put all others into one range."""
    rows = spark.range(4000).selectExpr("id", "1 AS g", "CASE WHEN id = 0 THEN 1e12 ELSE CAST(id % 1500 AS double) END AS u")
    want = rows.withColumn("u_pct", F.percent_rank().over(Window.partitionBy("g").orderBy(F.col("u").asc_nulls_last())))
    assert percent_ranks(rows, ["id"], ["g"], ["u"], ranges=16).exceptAll(want.select("id", "g", "u", "u_pct")).isEmpty()
    bounds = rows.select("u").distinct().agg(F.percentile_approx("u", [i / 16 for i in range(1, 16)])).first()[0]
    sizes = rows.select("u").distinct().groupBy(F.size(F.filter(F.lit(bounds), lambda b: b < F.col("u")))).count().agg(F.max("count")).first()[0]
    assert sizes < 2 * 1500 / 16


def test_kept_tables_follow_their_input_files(spark, tmp_path):
    from touchline.sinks.shared import input_state

    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    before = input_state(spark, path)
    spark.range(4).write.mode("append").parquet(path)
    assert input_state(spark, path) != before and input_state(spark, str(tmp_path / "none")) == (0, 0, 0)


def test_percent_ranks_equal_the_window_function(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice(["a", "b", None]), float(rng.choice([0, 0, 0, 1, 2, rng.random()])), rng.choice([None, rng.random() * 50])) for i in range(3000)]
    rows.append((9999, "alone", 1.0, None))
    df = spark.createDataFrame(rows, "id bigint, g string, u double, v double")
    want = df
    for c in ("u", "v"):
        want = want.withColumn(f"{c}_pct", F.percent_rank().over(Window.partitionBy("g").orderBy(F.col(c).asc_nulls_last())))
    got = percent_ranks(df, ["id"], ["g"], ["u", "v"])
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == len(rows)


def lineup(rows):
    return [Row(combo_id=m, is_home_team=True, shirt_number=s, id=i, nname=n) for m, s, i, n in rows]


def test_identity_ladder_and_vote(spark):
    schema = "combo_id string, is_home_team boolean, shirt_number bigint, id bigint, nname string"
    anchor = spark.createDataFrame(lineup([("m1", 1, 10, "ann"), ("m1", 2, 20, "bob"), ("m1", 3, 30, "cy"), ("m2", 1, 10, "ann"), ("m2", 2, 20, "bob"), ("m3", 1, 10, "ann")]), schema)
    prov = spark.createDataFrame(lineup([("m1", 1, 110, "ann"), ("m1", None, 120, "bob"), ("m1", None, 130, "cy"),
                                         ("m2", 1, 110, "ann"), ("m2", None, 120, "zzz"), ("m3", 1, 999, "x")]), schema)
    got = {(r.combo_id, r.anchor_id, r.prov_id): r.tier for r in identity.observations(anchor, prov).collect()}
    assert got == {("m1", 10, 110): "exact", ("m1", 20, 120): "name", ("m1", 30, 130): "name", ("m2", 10, 110): "exact", ("m2", 20, 120): "elimination", ("m3", 10, 999): "exact"}
    votes = {r.anchor_id: (r.prov_id, r.votes) for r in identity.vote(identity.observations(anchor, prov)).collect()}
    assert votes == {10: (110, 2), 20: (120, 2), 30: (130, 1)}


def test_vote_tie_goes_to_the_smaller_id(spark):
    pairs = spark.createDataFrame([(1, 7), (1, 5), (1, 9)], "anchor_id bigint, prov_id bigint")
    assert identity.vote(pairs).first().prov_id == 5


def test_alias_overrides_the_uid(spark):
    rows = spark.createDataFrame([("m", True, 1), ("m", False, 2)], "combo_id string, is_home_team boolean, team_id bigint")
    alias = spark.createDataFrame([(2, 1)], "bad_id bigint, canonical_id bigint")
    got = {r.ev_team_id: r.team_uid for r in identity.team_crosswalk(rows, rows, rows, alias).collect()}
    assert got == {1: 1, 2: 1}


def test_upsert_keeps_absent_columns_and_takes_nulls(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(1, None, 5, 1), (3, "c", 6, 1), (3, "d", 7, 2)], "k int, v string, extra int, load_seq int")
    got = {r.k: (r.v, r.w, r.extra) for r in sink.upsert(old, new, ["k"]).collect()}
    assert got == {1: (None, "x", 5), 2: ("b", "y", None), 3: ("d", None, 7)}


def test_cumulative_upsert(spark):
    old = spark.createDataFrame([(1, 10, "old"), (2, None, "old"), (3, 5, "old")], "k int, games int, v string")
    new = spark.createDataFrame([(1, 10, "same", 1), (2, None, "none", 1), (3, 6, "more", 1), (3, 4, "less", 2)], "k int, games int, v string, load_seq bigint")
    got = {r.k: r.v for r in sink.upsert_larger(old, new, ["k"], "games").collect()}
    assert got == {1: "old", 2: "none", 3: "more"}


def test_normalized_rows(spark):
    df = spark.createDataFrame([(1.0, [1, 2])], "Val double, Ids array<int>").union(spark.createDataFrame([(float("nan"), None)], "Val double, Ids array<int>"))
    assert [tuple(r) for r in sink.normalized(df, "m1").collect()] == [(1.0, "[1,2]", "m1"), (None, None, "m1")]


def test_reshapes(spark):
    df = spark.createDataFrame([("g", "A b", "1"), ("g", "A b", "3"), ("g", "c+", "x")], "g string, k string, v string")
    assert reshape.pivot_wide(df, ["g"], "k", "v").first().asDict() == {"g": "g", "a_b": 3.0, "cplus": None}
    t = spark.createDataFrame([("m", "50%", "z")], "combo_id string, s string, gone string")
    assert reshape.cast_text_numeric(t, ["combo_id"], ["gone"], ["s"]).first().asDict() == {"combo_id": "m", "s": 50.0, "s_display": "50%"}


def test_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert [r.n for r in quality.not_null(df, "k", "c").collect()] == [1]
    assert [(r.key, r.n) for r in quality.unique(df, "k", "c").collect()] == [("1", 2)]
    assert quality.not_null(df.filter("k = 1"), "k", "c").count() == 0
