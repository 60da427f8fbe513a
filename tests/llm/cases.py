"""Small tables with the cases that every operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

import duckdb
import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()), T.StructField("score", T.StringType()), T.StructField("n_removed", T.StringType()),
    T.StructField("_id", T.LongType()), T.StructField("token", T.StringType()), T.StructField("shard", T.LongType())])

_rng = random.Random(5)
SYLLABLES = ["an", "the", "ing", "ou", "re", "st", "wh", "ti", "on", "ed", "es", "ble", "ha", "er"]


def word():
    return "".join(_rng.choice(SYLLABLES) for _ in range(_rng.randint(1, 4)))


def prose(n):
    out = []
    for i in range(n):
        out.append(word() + ("." if _rng.random() < 0.1 else "") + ("\n" if _rng.random() < 0.06 else ""))
    return " ".join(out)


def texts():
    base = prose(120)
    passage = " ".join(word() for _ in range(60))
    near = base.split(" ")
    near[40] = "changed"
    far = base.split(" ")
    for i in range(0, 100, 9):
        far[i] = f"x{i}"
    line = "This line of text is long enough to be compared with others."
    return [None, "", " \n\t ", "one", "one two", "ONE two", base, base, base.upper(), " ".join(near), " ".join(far), prose(90) + " " + passage, passage + " " + prose(70),
            passage, prose(9000), line + "\n" + prose(20), line.replace("long", "lung") + "\n" + line + "\n" + prose(30), "\n".join([line] * 5), "a " * 400, "#$% " * 60,
            "é ü ñ ß " * 30, "\x0b\x0cword\x1cjoined\xa0still  two", "12 34 56", "ab\n\n\ncd"] + [prose(_rng.randint(3, 80)) for _ in range(30)]


def documents(spark, unique_ids=True, rows=None):
    rng = random.Random(7)
    made = []
    for i, t in enumerate(rows if rows is not None else texts()):
        made.append((i * 3, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "S10", None]), len(t or ""), "x", None, "y", i, "t", 1))
    if not unique_ids:
        made += [made[6], made[6], (made[9][0], "another text of the same id", None, None, None, *made[9][5:]), (None, "no id here", "en", "s1", 1, *made[0][5:]),
                 (None, None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(made, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).repartition(3).cache()


@pytest.fixture(scope="module")
def odd_docs(spark):
    return documents(spark, unique_ids=False).repartition(3).cache()


@pytest.fixture(scope="module")
def no_docs(spark):
    return empty(spark)


@pytest.fixture()
def duck(docs):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    return con
