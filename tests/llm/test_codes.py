"""op12: codes against plain k-means rounds, its SQL, pruning, odd rows."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from oracle_check import compare
from touchline.llm import codes, queries

SCHEMA = "vec_id long, embedding array<double>, label int, part string, entry string, v string, error string"
COLUMNS = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def plain(rows, parts=16, entries=64, rounds=2):
    kept = [(i, tuple(math.floor(256 * x) for x in v), label) for i, v, label in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = [[r[1][j * w:(j + 1) * w] for j in range(parts)] for r in kept]
    books = [[c[j] for c in cut[:entries]] for j in range(parts)]

    def near(j, p):
        return min((sum((a - b) ** 2 for a, b in zip(p, e)), i) for i, e in enumerate(books[j]))

    for _ in range(rounds):
        for j in range(parts):
            got = {}
            for c in cut:
                got.setdefault(near(j, c[j])[1], []).append(c[j])
            for i, members in got.items():
                books[j][i] = tuple(sum(x) // len(members) for x in zip(*members)) if i not in () else None
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, totals = [], {}
    for (i, _, label), c in zip(kept, cut):
        best = [near(j, p) for j, p in enumerate(c)]
        error = sum(d for d, _ in best)
        totals[label] = totals.get(label, 0) + error
        out.append([i, "".join(f"{e:02x}" for _, e in best), error, label, sha])
    return sorted(((i, code, e, totals[label], s) for i, code, e, label, s in out), key=str)


def found(spark, tmp_path, rows):
    path = str(tmp_path)
    df = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(3)
    df.write.parquet(f"{path}/embeddings.parquet")
    got = queries.QUERIES["op12_vector_codes"](spark, path)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=str)


def vectors(n, width=16, seed=1):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(7)]
    return [(i * 3, [x + rng.gauss(0, 0.1) for x in rng.choice(centres)], rng.choice([1, 2, None])) for i in range(n)]


def test_odd_rows(spark, tmp_path):
    rows = vectors(150, 32)
    rows += [(1, None, 1), (2, [], 1), (4, [0.5] * 31, 1), (5, [None] * 32, 1), (7, [math.nan] + [0.0] * 31, 1), (8, [math.inf] * 32, 2), (10, [0.5] * 16, 2), (11, [0.25] * 48, 2),
             (None, [0.1] * 32, None), (None, [0.1] * 32, 1), rows[0], rows[0], (3, [-0.001] * 32, 3), (13, [300000.0, -300000.0] * 16, 3)]
    assert found(spark, tmp_path, rows) == plain(rows)


def test_few_vectors_and_ties(spark, tmp_path):
    rows = [(i, [float(i % 3)] * 16, 0) for i in range(10)] + [(20, [0.5] * 16, 0)]
    assert found(spark, tmp_path, rows) == plain(rows)


def test_no_vectors(spark, tmp_path):
    assert found(spark, tmp_path, [(1, None, 1), (2, [math.nan] * 16, 2)]) == []


def test_components_saturate(spark):
    df = spark.createDataFrame([(1, [1e300, -1e300, 524288.5, -0.1], 1)], "vec_id long, embedding array<double>, label int")
    assert codes.kept(df, parts=4).first().v == [codes.LIMIT, -codes.LIMIT, codes.LIMIT, -26]


@pytest.mark.parametrize("spread", [1, 50, 10 ** 6])
def test_bounds_never_change_the_nearest_entry(spread):
    rng = np.random.default_rng(spread)
    part, entries = rng.integers(-spread, spread + 1, (500, 4)), rng.integers(-spread, spread + 1, (64, 4))
    entries[10] = entries[3]
    pivots = codes.far_apart(entries[None])[0]
    to_pivots = np.stack([codes.squared(part, p) for p in pivots], 1)
    chosen, best, tried = codes.nearest(part, to_pivots, entries, pivots)
    d = ((part[:, None] - entries[None]) ** 2).sum(2)
    assert (chosen == d.argmin(1)).all() and (best == d.min(1)).all()
    assert tried < d.size * (0.35 if spread > 1 else 1.01)


def test_most_distances_are_never_computed(spark):
    """In all rounds on the test vectors the bounds leave less than a third of the exact evaluations."""
    stored, books, pivots = codes.fitted(codes.kept(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")))
    tried, total = codes.evaluations(stored, books, pivots)
    assert total == 500 * 16 * 64 and tried < total / 3


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '/root/testdata/{sf}/embeddings.parquet'")
    assert compare(queries.QUERIES["op12_vector_codes"](spark, f"/root/testdata/{sf}"), con, queries.ORACLES["op12_vector_codes"]) is None
