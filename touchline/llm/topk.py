"""Exact top-k inner products through a pivot-distance index.

Vectors become integers, floor(1024 * component). Each is keyed by its nearest pivot and its distance to it; sorted by
that key they are cut into annuli of at most `block_rows` vectors, one index row each (`build_index`). With q's distance D
to the annulus' pivot and r in [lo, hi], the triangle inequality gives |q - x| >= gap = max(0, lo - D, D - hi), hence
<q, x> <= (|q|^2 + max|x|^2 - gap^2) / 2. A query first expands the annuli of its own pivot around its own distance; the
k-th score found there is its threshold, and of all other annuli only those are opened whose bound reaches it.

Pivots are picked on a bounded sample, `sample_rows` vectors with the smallest hashed ids, and only steer the search: all
vectors are indexed and the result is exact. Queries travel in blocks; a pair of blocks gives at most k rows a query.

Null vectors, vectors with a null or non-finite component and rows without an id take no part; an empty vector has
score 0 with every other empty one. Vectors of another length than the query's are no candidates. If an id is repeated,
one of its vectors (least by bytes) stands for it. Ties go to the smaller id. Other columns are not read. Integers whose
products could pass 2^53 are multiplied as 64-bit integers, which must hold the scores.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.sinks.shared import shared_dir

K, SCALE, PIVOTS, SAMPLE_ROWS, BLOCK_ROWS, QUERY_ROWS, SLOTS = 10, 1024, 32, 2048, 1024, 128, 32
BLOCK = "dim int, pivot int, lo double, hi double, norm double, block string, ids binary, vectors binary"


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, dim and the integers of each vector that takes part, one row per id."""

    def task(batches):
        for batch in batches:
            lists, ids, out = batch.column("v"), batch.column("vec_id").to_pylist(), []
            values = lists.values.to_numpy(zero_copy_only=False).astype(float)
            at = lists.offsets.to_numpy()
            for i, (a, b, there) in enumerate(zip(at[:-1], at[1:], lists.is_valid().to_pylist())):
                x = values[a:b]
                if there and ids[i] is not None and np.isfinite(x).all():
                    out.append((ids[i], b - a, np.floor(scale * x).astype("<i8").tobytes()))
            columns = list(zip(*out)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.binary()))], names=["vec_id", "dim", "v"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    found = rows.mapInArrow(task, "vec_id long, dim int, v binary")
    return found.groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("_v")).select("vec_id", "_v.dim", "_v.v")


def pick_pivots(sample: list[tuple[int, bytes]], pivots: int = PIVOTS) -> dict[int, np.ndarray]:
    """For each length, vectors of the sample that lie far from one another."""
    by_dim: dict[int, list[np.ndarray]] = {}
    for dim, v in sample:
        by_dim.setdefault(dim, []).append(np.frombuffer(v, "<i8").astype(float))
    out = {}
    for dim, rows in by_dim.items():
        x = np.array(rows).reshape(len(rows), dim)
        chosen = [x.mean(0)]
        far = ((x - chosen[0]) ** 2).sum(1)
        while len(chosen) < min(pivots, len(x)) and far.max() > 0:
            chosen.append(x[int(far.argmax())])
            far = np.minimum(far, ((x - chosen[-1]) ** 2).sum(1))
        out[dim] = np.array(chosen).reshape(len(chosen), dim)
    return out


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (x ** 2).sum(1)[:, None] + (pivots ** 2).sum(1) - 2 * x @ pivots.T))


def _near(pivots: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return pivots.get(dim, np.zeros((1, dim)))


def blocks(rows: DataFrame, pivots: dict[int, np.ndarray], block_rows: int) -> DataFrame:
    """Annuli of (vec_id, dim, v) rows: neighbours by (dim, pivot, distance), at most `block_rows` in one row."""

    def assign(batches):
        for batch in batches:
            dims, raw = batch.column("dim").to_numpy(), batch.column("v").to_pylist()
            pivot, dist = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                d = distances(np.frombuffer(b"".join(raw[i] for i in at), "<i8").reshape(len(at), dim).astype(float), _near(pivots, int(dim)))
                pivot[at], dist[at] = d.argmin(1), d.min(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(dist)], names=["vec_id", "dim", "v", "pivot", "dist"])

    def cut(batches):
        held: list[tuple] = []
        made = 0

        def flush():
            nonlocal made
            ids, dims, raw, piv, dist = zip(*held)
            x = np.frombuffer(b"".join(raw), "<i8").reshape(len(ids), dims[0]).astype(float)
            row = (dims[0], piv[0], min(dist), max(dist), float(np.sqrt((x ** 2).sum(1).max())), f"{dims[0]}-{piv[0]}-{dist[0]!r}-{ids[0]}-{made}",
                   np.array(ids, "<i8").tobytes(), b"".join(raw))
            made += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, (pa.int32(), pa.int32(), *[pa.float64()] * 3, pa.string(), pa.binary(), pa.binary()))],
                                              names=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "dim", "v", "pivot", "dist"))):
                if held and (len(held) == block_rows or held[0][1] != row[1] or held[0][3] != row[3]):
                    yield flush()
                held.append(row)
        if held:
            yield flush()

    keyed = rows.mapInArrow(assign, "vec_id long, dim int, v binary, pivot int, dist double")
    order = ["dim", "pivot", "dist", "vec_id"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, BLOCK)


def build_index(rows: DataFrame, path: str, pivots: dict[int, np.ndarray], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Writes the index of all rows as a table and returns it."""
    blocks(rows, pivots, block_rows).write.parquet(path)
    return rows.sparkSession.read.schema(BLOCK).parquet(path)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1])
    return (q.astype(float) @ x.astype(float).T).astype(np.int64) if top < 2.0 ** 53 else q @ x.T


def _best(q_ids, q, x_ids, x, k, least=None):
    """(query_id, vec_id, score) of the k best of each query in one block, ties to the smaller id, none under its threshold."""
    scores = _products(q, x)
    order = np.argsort(x_ids, kind="stable")
    x_ids, scores = x_ids[order], scores[:, order]
    for i, query in enumerate(q_ids):
        row, ids = scores[i], x_ids
        own = ids != query
        row, ids = row[own], ids[own]
        if least is not None:
            reach = row >= least[i]
            row, ids = row[reach], ids[reach]
        if len(row) > k:
            floor = np.partition(row, len(row) - k)[len(row) - k]
            row, ids = row[row >= floor], ids[row >= floor]
        top = np.argsort(-row, kind="stable")[:k]
        yield from zip([int(query)] * len(top), ids[top].tolist(), row[top].tolist())


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


FOUND = "query_id long, vec_id long, score long"


def search(queries: DataFrame, index: DataFrame, pivots: dict[int, np.ndarray], k: int = K, query_rows: int = QUERY_ROWS, slots: int = SLOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of the index for each (vec_id, dim, v) row of `queries`."""
    spark, home = queries.sparkSession, f"{shared_dir(queries.sparkSession)}/touchline/topk-{uuid.uuid4().hex}"
    blocks(queries, pivots, query_rows).write.parquet(f"{home}/queries")
    asked = spark.read.schema(BLOCK).parquet(f"{home}/queries").toDF(*(f"q_{c.split()[0]}" for c in BLOCK.split(", ")))
    near = (F.col("q_dim") == F.col("dim")) & (F.col("q_pivot") == F.col("pivot")) & (F.col("lo") <= F.col("q_hi")) & (F.col("hi") >= F.col("q_lo"))

    def load(row, side):
        ids = np.frombuffer(row[f"{side}ids"], "<i8")
        return ids, np.frombuffer(row[f"{side}vectors"], "<i8").reshape(len(ids), row[f"{side}dim"])

    def first(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield _found(list(_best(*load(row, "q_"), *load(row, ""), k)))

    asked.join(index, near).mapInArrow(first, FOUND).write.parquet(f"{home}/first")
    started = spark.read.schema(FOUND).parquet(f"{home}/first")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # the k-th score so far; queries that have fewer results yet keep no threshold
    known = started.withColumn("_r", F.row_number().over(by_query)).where(F.col("_r") == k).select("query_id", F.col("score").alias("least"))

    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["q_ids"], "<i8")
                yield pa.RecordBatch.from_arrays([pa.array([row["q_block"]] * len(ids)), pa.array(ids), pa.array(range(len(ids)), pa.int32())], names=["b", "query_id", "i"])

    least = (asked.select("q_block", "q_ids").mapInArrow(unpack, "b string, query_id long, i int").join(known, "query_id", "left")
             .groupBy("b").agg(F.array_sort(F.collect_list(F.struct("i", "least"))).alias("least")))
    asked = asked.join(least, F.col("q_block") == F.col("b")).drop("b")

    def reach(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                _, q = load(row, "q_")
                q = q.astype(float)
                d = distances(q, _near(pivots, row["dim"])[row["pivot"]][None])[:, 0]
                gap = np.maximum(0.0, np.maximum(row["lo"] - d, d - row["hi"]))
                bound = np.minimum(((q ** 2).sum(1) + row["norm"] ** 2 - gap ** 2) / 2, np.sqrt((q ** 2).sum(1)) * row["norm"])
                least = np.array([-np.inf if x["least"] is None else x["least"] for x in row["least"]])
                if (bound * (1 + 1e-9) + 1 >= least).any():  # the slack covers rounding of the distances
                    out.append((row["q_block"], row["block"]))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in range(2)], names=["qb", "b"])

    # every query block meets the outline of every annulus, dealt over slots
    outline = index.select("dim", "pivot", "lo", "hi", "norm", "block", F.pmod(F.xxhash64("block"), F.lit(slots)).alias("slot"))
    dealt = asked.withColumn("q_slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long")))).join(
        outline, (F.col("q_dim") == F.col("dim")) & (F.col("q_slot") == F.col("slot")) & ~near)
    dealt.select("q_block", "q_dim", "q_ids", "q_vectors", "least", "dim", "pivot", "lo", "hi", "norm", "block").mapInArrow(reach, "qb string, b string").write.parquet(f"{home}/pairs")
    pairs = spark.read.schema("qb string, b string").parquet(f"{home}/pairs")

    def rest(batches):
        for batch in batches:
            for row in batch.to_pylist():
                least = [np.iinfo(np.int64).min if x["least"] is None else x["least"] for x in row["least"]]
                yield _found(list(_best(*load(row, "q_"), *load(row, ""), k, least)))

    opened = pairs.join(asked, F.col("qb") == F.col("q_block")).join(index.select("block", "dim", "ids", "vectors"), F.col("b") == F.col("block"))
    late = opened.select("q_dim", "q_ids", "q_vectors", "least", "dim", "ids", "vectors").mapInArrow(rest, FOUND)
    ranked = started.unionByName(late).withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    home = f"{shared_dir(spark)}/touchline/vectors-{uuid.uuid4().hex}"
    vectors.write.parquet(f"{home}/rows")
    vectors = spark.read.schema("vec_id long, dim int, v binary").parquet(f"{home}/rows")
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("dim", "v").collect()
    pivots = pick_pivots([(r.dim, bytes(r.v)) for r in sample])
    return search(vectors.where(F.col("vec_id") % 100 == 0), build_index(vectors, f"{home}/index", pivots), pivots)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, len(embedding) AS n, [floor(1024 * x::DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND c.n = q.n)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
