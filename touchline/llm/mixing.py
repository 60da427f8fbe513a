r"""Mixing sources to target weights.

The mixture has `budget` times the words of all sources. Sources are ordered by code point, null last, and weigh
`weights` in turn; a target never passes `max_repeats` times its source's words, the excess is shared anew by weight.

Each source is cut into 4096 blocks by a hash of (seed, id). A source's quota is a number of block draws: whole passes
over all its blocks, then blocks in permuted order until the rest is reached, the last one in part. A splitting tree
divides the quotas of all sources exactly among `shards` output shards: at every node a multivariate hypergeometric draw
says how many of each source's blocks go left. Each shard then takes its own interval of the source's permuted draws, so
no draw is used twice, and rows are shuffled within their shard. Reruns agree: everything follows from the seed.

Only one row per source reaches the driver; the plan of the blocks is broadcast if it is small. All other work is grouped by (source, block), so a hot source is spread.
A null or empty text has size 0 and is taken with 0 words; repeated rows are mixed each on its own; a source without
words has target 0. Columns besides id, text and source are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.tables import sized
from touchline.sinks.shared import written

BUDGET, WEIGHTS, MAX_REPEATS = 1.5, (3, 1, 2), 2
SEED, SHARDS, BLOCK_DIGITS = "mix", 64, 3
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], budget: float = BUDGET, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> list[float]:
    """Words per source, by weight, none above `max_repeats` times its size."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    total, open_w = budget * sum(sizes), sum(w)
    level = 0.0
    left = total
    for i in sorted(range(len(sizes)), key=lambda i: (max_repeats * sizes[i] / w[i], i)):
        level = left / open_w
        if max_repeats * sizes[i] / w[i] >= level:
            break
        left -= max_repeats * sizes[i]
        open_w -= w[i]
    return [min(float(max_repeats * s), level * x) for s, x in zip(sizes, w)]


def split_quotas(draws: list[int], shards: int, seed: str = SEED) -> np.ndarray:
    """(source, shard) numbers of block draws with these row sums and even column sums."""
    rng = np.random.default_rng(list(seed.encode()))
    out = np.zeros((len(draws), shards), np.int64)

    def node(counts: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            out[:, lo] = counts
            return
        mid = (lo + hi) // 2
        n = int(counts.sum()) * (mid - lo) // (hi - lo)
        left = rng.multivariate_hypergeometric(counts, n, method="marginals") if n else np.zeros_like(counts)
        node(left, lo, mid)
        node(counts - left, mid, hi)

    if draws:
        node(np.array(draws, np.int64), 0, shards)
    return out


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, *more: Column) -> DataFrame:
    rows = docs.select(*more, F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("th"), F.col(source_col).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"))).alias("_key"))
    return rows.withColumn("_block", F.substring("_key", 1, BLOCK_DIGITS))


def _planned(rows: DataFrame, seed: str, shards: int, budget: float, weights: tuple[int, ...], max_repeats: int) -> tuple[DataFrame, DataFrame]:
    """What is drawn of each block, and where the draws of each source end in each shard."""
    spark = rows.sparkSession
    blocks = written(rows.groupBy("source", "_block").agg(F.sum("size").alias("_words")), "mix-blocks")
    found = blocks.groupBy("source").agg(F.sum("_words").alias("s"), F.count("*").alias("n")).orderBy(F.col("source").asc_nulls_last()).collect()
    sizes = [r.s for r in found]
    wanted = targets(sizes, budget, weights, max_repeats)
    passes = [int(t // s) if s else 0 for t, s in zip(wanted, sizes)]
    rest = [int(t - p * s + 0.5) for t, p, s in zip(wanted, passes, sizes)]
    plan = spark.createDataFrame([(r.source, s, t, p, x) for r, s, t, p, x in zip(found, sizes, wanted, passes, rest)],
                                 "_source string, source_size long, target double, _passes long, _rest long")
    before = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (blocks.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
              .withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
              .withColumn("_nth", F.row_number().over(Window.partitionBy("source").orderBy("_block")))
              .withColumn("_n", F.count("*").over(Window.partitionBy("source"))))
    drawn = {r.source: r.d for r in blocks.groupBy("source").agg(F.sum(F.col("_passes") + (F.col("_before") < F.col("_rest")).cast("long")).alias("d")).collect()}
    quotas = split_quotas([drawn[r.source] for r in found], shards, seed)
    ends = spark.createDataFrame([(r.source, np.cumsum(q).tolist()) for r, q in zip(found, quotas)], "_of string, _ends array<long>")
    whole = F.col("_before") + F.col("_words") <= F.col("_rest")
    blocks = blocks.select(F.col("source").alias("_source"), F.col("_block").alias("_b"), "source_size", "target", "_passes", "_rest", "_before", "_nth", "_n",
                           whole.alias("_whole"), (~whole & (F.col("_before") < F.col("_rest"))).alias("_cut"))
    return sized(written(blocks, "mix-plan"), 160), ends


def _placed(rows: DataFrame, blocks: DataFrame, ends: DataFrame) -> DataFrame:
    rows = rows.join(blocks, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_block") == F.col("_b")))
    return rows.join(ends, F.col("source").eqNullSafe(F.col("_of")))


def _uncut(placed: DataFrame) -> DataFrame:
    """The rows of blocks whose rest is drawn as a whole or not at all, with the words of their last draw."""
    return placed.where(~F.col("_cut")).withColumn("_last", F.when(F.col("_whole"), F.col("size")).otherwise(F.lit(0).cast("long")))


def _draws(seed: str) -> Column:
    shard = lambda nth: F.size(F.filter("_ends", lambda e: e < nth))
    draw = lambda i: F.struct(shard(i * F.col("_n") + F.col("_nth")).alias("shard"),
                              F.md5(F.concat_ws(":", F.lit(seed), i.cast("string"), "_key")).alias("place"),
                              F.when(i < F.col("_passes"), F.col("size")).otherwise(F.col("_last")).alias("words"))
    return F.filter(F.transform(F.sequence(F.lit(0).cast("long"), F.col("_passes")), draw), lambda d: d["words"] > 0)


def _mixed(placed: DataFrame, seed: str) -> DataFrame:
    inner = Window.partitionBy("source", "_block").orderBy("_key", "doc_id", "size", "th").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_rest") - F.col("_before") - F.coalesce(F.sum("size").over(inner), F.lit(0))
    base = _uncut(placed).unionByName(placed.where("_cut").withColumn("_last", F.greatest(F.lit(0), F.least("size", left)).cast("long")))
    return base.select("doc_id", "th", "source", "size", "source_size", "target", (F.col("_passes") * F.col("size") + F.col("_last")).alias("taken"), _draws(seed).alias("draws"), "_cut")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, shards: int = SHARDS,
        budget: float = BUDGET, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per input row: doc_id, th (hash of its text), source, size, source_size, target, taken and `draws`, an array of (shard, place, words)."""
    rows = written(_keyed(docs, id_col, text_col, source_col, seed), "mix-rows")
    return _mixed(_placed(rows, *_planned(rows, seed, shards, budget, weights, max_repeats)), seed).drop("_cut")


def _repeated(rows: DataFrame) -> DataFrame:
    """Id and text hash that several rows have in common."""
    again = rows.groupBy("doc_id", "th").agg(F.count("*").alias("n")).where("n > 1")
    return sized(written(again.select(F.col("doc_id").alias("__again_id"), F.col("th").alias("__again_th")), "mix-repeated"), 24)


def _taken(docs: DataFrame, mixed: DataFrame, again: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs` once a draw, whole or cut, with the draw."""
    draws = mixed.select("doc_id", "th", "size", F.explode("draws").alias("draw")).toDF("__mix_id", "__mix_th", "__mix_size", "__mix_draw")
    th = F.xxhash64(F.col(text_col).cast("string"))
    repeated = F.col(id_col).eqNullSafe(F.col("__again_id")) & (th == F.col("__again_th"))
    one = docs.join(again, repeated, "left_semi").groupBy(F.col(id_col).alias("__mix_id"), th.alias("__mix_th")).agg(F.min(F.struct(*docs.columns)).alias("r")).select("r.*")
    rows = docs.join(again, repeated, "left_anti").unionByName(one)
    first = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)), F.lit(1), F.col("__mix_draw.words").cast("int")), " ")
    text = F.when(F.col("__mix_draw.words") < F.col("__mix_size"), first).otherwise(F.col(text_col))
    out = rows.join(draws, F.col(id_col).eqNullSafe(F.col("__mix_id")) & (th == F.col("__mix_th")))
    return out.withColumn(text_col, text).select(*docs.columns, "__mix_draw")


def _dealt(taken: DataFrame) -> DataFrame:
    return taken.repartition("__mix_draw.shard").sortWithinPartitions("__mix_draw.shard", "__mix_draw.place").drop("__mix_draw")


def mixture(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mixture itself: the rows of `docs` as often as drawn, shuffled within each shard. A text drawn in part is its first words, joined by blanks.

    Rows are told apart by id and text. Of rows that have both in common one stands for all, with the draws of every one of them."""
    return _dealt(_taken(docs, mixed, _repeated(mixed), id_col, text_col))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, shards: int = SHARDS,
                    budget: float = BUDGET, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The `mixture` of `mix`, with one shuffle of the texts: a row learns its draws from its block's plan, where it is read.

    Only the rows of blocks that are drawn in part and rows that have id and text in common are joined with their draws."""
    rows = written(_keyed(docs, id_col, text_col, source_col, seed), "mix-rows")
    plan = _planned(rows, seed, shards, budget, weights, max_repeats)
    again = _repeated(rows)
    repeated = F.col("doc_id").eqNullSafe(F.col("__again_id")) & (F.col("th") == F.col("__again_th"))
    placed = _placed(_keyed(docs, id_col, text_col, source_col, seed, F.struct(*docs.columns).alias("_row")), *plan).join(again, repeated, "left_anti")
    alone = _uncut(placed).select("_row", F.explode(_draws(seed)).alias("__mix_draw")).select("_row.*", "__mix_draw")

    mixed = _mixed(_placed(rows, *plan), seed)
    mixed = mixed.join(again, repeated, "left_semi").unionByName(mixed.where("_cut").join(again, repeated, "left_anti"))
    key, th = F.col(id_col), F.xxhash64(F.col(text_col).cast("string"))
    apart = sized(written(mixed.select(F.col("doc_id").alias("__apart_id"), F.col("th").alias("__apart_th")).distinct(), "mix-apart"), 24)
    joined = docs.join(apart, key.eqNullSafe(F.col("__apart_id")) & (th == F.col("__apart_th")), "left_semi")
    return _dealt(alone.unionByName(_taken(joined, mixed, again, id_col, text_col)))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(concat_ws(':', 'mix', doc_id)) AS k FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS s, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w,
    row_number() OVER (ORDER BY source ASC NULLS LAST) AS i FROM rows GROUP BY source),
steps AS (
  SELECT *, 2 * s / w::DOUBLE AS r,
    (1.5::DOUBLE * sum(s) OVER () - coalesce(sum(2 * s) OVER (ORDER BY 2 * s / w::DOUBLE, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 2 * s / w::DOUBLE, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level FROM sources),
level AS (SELECT coalesce((SELECT level FROM steps WHERE r >= level ORDER BY r, i LIMIT 1), (SELECT max_by(level, r) FROM steps)) AS level),
plan AS (
  SELECT source, s, least(2.0 * s, level.level * w)::DOUBLE AS target, CASE WHEN s > 0 THEN floor(least(2.0 * s, level.level * w) / s) ELSE 0 END::BIGINT AS passes FROM sources, level),
ordered AS (
  SELECT r.*, p.s AS source_size, p.target, p.passes, floor(p.target - p.passes * p.s + 0.5)::BIGINT AS rest,
    coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.k, r.doc_id, r.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (passes * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM ordered
"""
