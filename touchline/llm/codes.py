"""Vector codes: one codebook entry per part of a vector, found by LAESA.

Vectors become integers, floor(256 * component), and are cut into equal consecutive parts. For every part position a few
pivots stay fixed, far apart among the first entries of its codebook; the squared distances of every part to its pivots
are computed once and stored beside the integers (`pivoted`). In a round only the distances between pivots and the
current entries are new. |d(part, pivot) - d(pivot, entry)| is a lower bound of d(part, entry), the largest over the pivots
orders the entries of each part, and exact integer distances are evaluated in that order until the bound passes the best
one found. `evaluations` reports how many were needed.

Every round is one pass over the stored table. Tasks add up each entry's parts themselves, so that a round shuffles one row
per task, part position and entry, and the driver gets one row per position and entry, whatever the size of the table.

Vectors that are null or hold null or non-finite components are dropped, and so are those whose length is not that of the
first kept vector, or not a positive multiple of the number of parts. The first vectors are those with the smallest ids,
null ids last, ties by their components. Repeated rows are rows of their own. With fewer vectors than entries the codebooks
are that much smaller. Components saturate at +-2^27 integer steps, so that every sum of squares fits into 64 bits. Equal
distances go to the lower entry. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.tables import result_of, sized
from touchline.sinks.shared import written

PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 16, 64, 2, 256, 4
LIMIT = 1 << 27
BATCH_PARTS = 4096


def kept(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """vec_id, label and the integer components `v` of the vectors that take part, whatever their length."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.alias("x"))
    # NaN is greater than every number in this order, so one test covers it and infinity.
    sound = F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    steps = F.transform("x", lambda c: F.floor(F.least(F.greatest(c * scale, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int"))
    size = F.size("x")
    return rows.where(F.col("x").isNotNull() & (size > 0) & (size % parts == 0)).where(sound).select("vec_id", "label", steps.alias("v"))


def first_entries(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """The codebooks to start with, (parts, entries, width); None without vectors."""
    order = [F.col("vec_id").asc_nulls_last(), "v"]
    top = rows.orderBy(*order).select(F.size("v")).first()
    if top is None:
        return None
    first = rows.where(F.size("v") == top[0]).orderBy(*order).select("v").limit(entries).collect()
    books = np.array([r.v for r in first], np.int64).reshape(len(first), parts, top[0] // parts)
    return np.ascontiguousarray(books.transpose(1, 0, 2))


def far_apart(books: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """For each part position the pivots: the first entry, then always the entry farthest from those chosen."""
    out = []
    for entries in books:
        chosen, nearest = [0], np.full(len(entries), np.iinfo(np.int64).max)
        for _ in range(min(pivots, len(entries)) - 1):
            nearest = np.minimum(nearest, squared(entries, entries[chosen[-1]]))
            chosen.append(int(nearest.argmax()))
        out.append(entries[chosen])
    return np.stack(out)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(-1)


def pivoted(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Rows of the codebooks' width with the squared distances of each part to its pivots, (parts, pivots) in one list."""
    parts, count, width = pivots.shape

    def task(batches):
        for batch in batches:
            v = _matrix(batch.column("v"), parts, width)
            d = np.stack([squared(v, pivots[None, :, p]) for p in range(count)], 2) if len(v) else np.zeros((0, parts, count), np.int64)
            ends = np.arange(len(v) + 1, dtype=np.int32) * (parts * count)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "label", "v")), pa.ListArray.from_arrays(pa.array(ends), pa.array(d.reshape(-1)))],
                                             names=["vec_id", "label", "v", "to_pivots"])

    rows = rows.where(F.size("v") == parts * width)
    return rows.mapInArrow(task, f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, v array<int>, to_pivots array<long>")


def _matrix(lists: pa.Array, parts: int, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), parts, width)


def nearest(part: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For parts (n, width) their nearest entry and its squared distance, and how many distances were evaluated.

    The roots of exact squares are off by less than a part in 10^15, so bounds are lowered by one in 10^9 before they rule
    an entry out.
    """
    n, count = len(part), len(entries)
    bound = np.zeros((n, count))
    roots = np.sqrt(to_pivots.astype(float))
    for p, pivot in enumerate(pivots):
        from_pivot = np.sqrt(squared(entries, pivot).astype(float))
        high = np.maximum(roots[:, p, None], from_pivot)
        np.maximum(bound, np.abs(roots[:, p, None] - from_pivot) - 1e-9 * high, out=bound)
    np.maximum(bound, 0, out=bound)
    order = bound.argsort(1, kind="stable")
    at = np.arange(n)
    best, chosen, tried = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64), 0
    for step in range(count):
        entry = order[at, step]
        live = bound[at, entry] ** 2 * (1 - 1e-9) <= best[at]
        at, entry = at[live], entry[live]
        if not len(at):
            break
        d = squared(part[at], entries[entry])
        tried += len(at)
        closer = (d < best[at]) | ((d == best[at]) & (entry < chosen[at]))
        best[at[closer]], chosen[at[closer]] = d[closer], entry[closer]
    return chosen, best, tried


def _assigned(batch: pa.RecordBatch, books: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Integers, chosen entries and squared distances (n, parts) of a batch, and the number of evaluations."""
    parts, count, width = pivots.shape
    v = _matrix(batch.column("v"), parts, width)
    d = batch.column("to_pivots").flatten().to_numpy(zero_copy_only=False).reshape(len(v), parts, count)
    chosen, error, tried = np.zeros((len(v), parts), np.int64), np.zeros((len(v), parts), np.int64), 0
    for lo in range(0, len(v), BATCH_PARTS):
        rows = slice(lo, lo + BATCH_PARTS)
        for j in range(parts):
            chosen[rows, j], error[rows, j], n = nearest(v[rows, j], d[rows, j], books[j], pivots[j])
            tried += n
    return v, chosen, error, tried


def improved(rows: DataFrame, books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floor of the mean of its parts; entries without parts stay."""
    parts, count, width = books.shape

    def task(batches):
        sums, counts = np.zeros((parts, count, width), np.int64), np.zeros((parts, count), np.int64)
        for batch in batches:
            v, chosen, _, _ = _assigned(batch, books, pivots)
            for j in range(parts):
                np.add.at(sums[j], chosen[:, j], v[:, j])
                counts[j] += np.bincount(chosen[:, j], minlength=count)
        part, entry = counts.nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(counts[part, entry]), *(pa.array(sums[part, entry, i]) for i in range(width))],
                                         names=["part", "entry", "n", *(f"s{i}" for i in range(width))])

    names = [f"s{i}" for i in range(width)]
    partial = rows.mapInArrow(task, ", ".join(f"{c} long" for c in ("part", "entry", "n", *names)))
    out = books.copy()
    for r in partial.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *names)]).collect():
        out[r.part, r.entry] = [r[c] // r.n for c in names]
    return out


def encoded(rows: DataFrame, books: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """vec_id, label, code (bytes, one index per part) and error of each row, and the number of distances evaluated."""

    def task(batches):
        for batch in batches:
            _, chosen, error, _ = _assigned(batch, books, pivots)
            codes = [c.tobytes() for c in chosen.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.binary()), pa.array(error.sum(1))], names=["vec_id", "label", "code", "error"])

    return rows.mapInArrow(task, f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code binary, error long")


def evaluations(rows: DataFrame, books: np.ndarray, pivots: np.ndarray) -> tuple[int, int]:
    """Exact distances that one pass evaluates, and all there are."""

    def task(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_assigned(batch, books, pivots)[3]]), pa.array([batch.num_rows * books.shape[0] * books.shape[1]])], names=["tried", "all"])

    done = rows.mapInArrow(task, "tried long, all long").agg(F.sum("tried"), F.sum("all")).first()
    return done[0] or 0, done[1] or 0


def fitted(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray, np.ndarray] | None:
    """The stored table with pivot distances, the final codebooks and the pivots; None without vectors. At most 256 entries."""
    books = first_entries(rows, parts, entries)
    if books is None:
        return None
    fixed = far_apart(books, pivots)
    stored = written(pivoted(rows, fixed), "codes-pivots")
    for _ in range(rounds):
        books = improved(stored, books, fixed)
    return stored, books, fixed


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kept(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

    def digest(codes: DataFrame, sha: Column) -> DataFrame:
        totals = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
        return codes.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error").join(
            sized(written(totals.withColumnRenamed("label", "_label"), "codes-labels"), 32), F.col("label").eqNullSafe(F.col("_label"))).select(
            "vec_id", "code", "error", "label_error", sha.alias("codebooks_sha256"))

    def work() -> DataFrame:
        found = fitted(rows)
        if found is None:
            return digest(rows.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), F.lit(""))
        stored, books, pivots = found
        return digest(written(encoded(stored, books, pivots), "codes"), F.lit(codebooks_sha256(books)))

    return result_of(spark, work, "codes")


def _sql_round(number: int) -> str:
    return f"""
near{number} AS (
  SELECT p.row, p.part, p.v, arg_min(b.entry, (b.d, b.entry)) AS entry, min(b.d) AS d
  FROM parts p JOIN LATERAL (
    SELECT b.entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM books{number} b WHERE b.part = p.part) b ON true
  GROUP BY p.row, p.part, p.v)"""


def _sql_books(number: int) -> str:
    return f"""
books{number} AS (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM books{number - 1} b LEFT JOIN (
    SELECT part, entry, list(CAST((s - (((s % n) + n) % n)) // n AS BIGINT) ORDER BY i) AS v
    FROM (SELECT part, entry, i, sum(v[i]) AS s, count(*) AS n FROM near{number - 1}, range(1, len(v) + 1) t(i) GROUP BY part, entry, i) z GROUP BY part, entry) m USING (part, entry))"""


OP12_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
    row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {PARTS} = 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT row, j AS part, v[j * (len(v) // {PARTS}) + 1 : (j + 1) * (len(v) // {PARTS})] AS v
  FROM kept, range({PARTS}) t(j) WHERE len(v) = (SELECT len(v) FROM kept WHERE row = 1)),
books0 AS (SELECT part, row - 1 AS entry, v FROM parts WHERE row <= {ENTRIES}),
{_sql_round(0)},{_sql_books(1)},{_sql_round(1)},{_sql_books(2)},{_sql_round(2)},
codes AS (SELECT row, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near2 GROUP BY row)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM books2) AS codebooks_sha256
FROM kept k JOIN codes c USING (row)
"""
