"""Percent rank that does not need a whole peer group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

RANGES = 256


def percent_ranks(df: DataFrame, key: list[str], peers: list[str], metrics: list[str],
                  suffix: str = "_pct", ranges: int = RANGES) -> DataFrame:
    """Adds `<metric>_pct`, the percent rank of each metric within its peers (NULLs last).

    Counts per distinct value are pre-aggregated, so ties of any size collapse
    to one row. The distinct values of a peer group are then split into `ranges`
    ranges of about as many values each, whatever the values are; the running
    count is taken inside a range, plus the total of the ranges below it. Only
    the per-range totals (at most `ranges` + 1 rows) of a group ever meet in one
    window. Peers may be NULL: NULL is a group of its own.
    """
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
    long = df.select(*peers, values.alias("_v")).select(*peers, "_v.metric", "_v.value")
    group = [*peers, "metric"]
    counts = long.groupBy(*group, "value").agg(F.count("*").alias("n"))
    shares = [i / ranges for i in range(1, ranges)]
    spread = counts.groupBy(*group).agg(F.percentile_approx("value", shares).alias("bounds"), F.sum("n").alias("size"))

    def same(left: DataFrame, right: DataFrame, cols: list[str]):
        cond = F.lit(True)
        for c in cols:
            cond = cond & left[c].eqNullSafe(right[f"_{c}"])
        return cond

    def renamed(rows: DataFrame, cols: list[str]) -> DataFrame:
        return rows.withColumnsRenamed({c: f"_{c}" for c in cols})

    s = renamed(spread, group)
    placed = counts.join(s, same(counts, s, group)).drop(*[f"_{c}" for c in group])
    bucket = F.size(F.filter("bounds", lambda bound: bound < F.col("value")))
    placed = placed.withColumn("bucket", F.when(F.col("value").isNull(), F.lit(ranges)).otherwise(bucket)).drop("bounds")

    totals = placed.groupBy(*group, "bucket").agg(F.sum("n").alias("inside"))
    lower = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    below = totals.select(*group, "bucket", F.coalesce(F.sum("inside").over(lower), F.lit(0)).alias("below"))
    b = renamed(below, [*group, "bucket"])
    in_bucket = Window.partitionBy(*group, "bucket").orderBy(F.col("value").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (placed.withColumn("_less", F.coalesce(F.sum("n").over(in_bucket), F.lit(0)))
              .join(b, same(placed, b, [*group, "bucket"])))
    rank = F.when(F.col("size") == 1, F.lit(0.0)).otherwise(
        (F.col("below") + F.col("_less")).cast("double") / (F.col("size") - 1))
    ranked = ranked.select(*group, "value", rank.alias("rank"))

    # Back to the rows: one lookup for all metrics, then one row per key again.
    rows = df.select(F.struct(*df.columns).alias("_row"), *peers, values.alias("_v")).select(
        "_row", *peers, "_v.metric", "_v.value")
    r = renamed(ranked, [*group, "value"])
    return (rows.join(r, same(rows, r, [*group, "value"]))
            .groupBy(*[F.col(f"_row.{c}").alias(f"_key_{c}") for c in key])
            .agg(F.first("_row").alias("_row"),
                 *[F.max(F.when(F.col("metric") == m, F.col("rank"))).alias(m + suffix) for m in metrics])
            .select("_row.*", *[m + suffix for m in metrics]))
