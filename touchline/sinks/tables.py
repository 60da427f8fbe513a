"""Rows of raw tables: normalise, upsert, overwrite by match (S12-S17, S32). `store.py` keeps them on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

SEQ = "load_seq"

# Provider-native `id` becomes the natural key.
NATURAL_ID = {"rd_matches": "match_id", "rd_seasons": "season_id", "rd_referees": "referee_id", "rd_managers": "manager_id", "rd_shots": "shot_id"}


def normalized(df: DataFrame, combo_id: str | None = None) -> DataFrame:
    """Lower-case names, nested values as JSON text, NaN as NULL, timestamps as ISO text."""
    def plain(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        return c.alias(f.name.lower())
    out = df.select(*[plain(f) for f in df.schema.fields])
    return out if combo_id is None or "combo_id" in out.columns else out.withColumn("combo_id", F.lit(combo_id))


def natural_id(df: DataFrame, table: str) -> DataFrame:
    return df.withColumnRenamed("id", NATURAL_ID[table]) if table in NATURAL_ID and "id" in df.columns else df


def upsert(existing: DataFrame | None, incoming: DataFrame, keys: list[str], seq: str = SEQ) -> DataFrame:
    """Last writer wins, column by column.

    `incoming` carries `seq`, the order of its rows. A column the batch does
    not have keeps its stored value; a NULL the batch has overwrites. New
    columns are added. An aggregate per key: partial results are merged before
    the shuffle, so a key with very many versions is no hot spot.
    """
    batch = incoming.columns
    new = incoming.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in batch if c not in (*keys, seq)]), seq).alias("_new"))
    fresh = [c for c in batch if c not in (*keys, seq)]
    if existing is None:
        return new.select(*keys, *[F.col(f"_new.{c}").alias(c) for c in fresh])
    kept = [c for c in existing.columns if c not in keys]
    joined = existing.select(*keys, F.struct(*kept).alias("_old")).join(new, keys, "full")
    came = F.col("_new").isNotNull()
    cols = []
    for c in [*kept, *[c for c in fresh if c not in kept]]:
        if c not in fresh:
            cols.append(F.col(f"_old.{c}").alias(c))
        elif c not in kept:
            cols.append(F.col(f"_new.{c}").alias(c))
        else:
            cols.append(F.when(came, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c))
    return joined.select(*keys, *cols)


def upsert_larger(existing: DataFrame | None, incoming: DataFrame, keys: list[str], measure: str, seq: str = SEQ) -> DataFrame:
    """Cumulative records: a row is only replaced by one with a larger measure, or
    when it has none. Of equal ones the first stays."""
    rows = incoming if existing is None else existing.withColumn(seq, F.lit(-1).cast("bigint")).unionByName(incoming, allowMissingColumns=True)
    cols = [c for c in rows.columns if c not in (*keys, seq)]
    # While the stored measure is NULL any later row replaces it, so among rows without one the last wins.
    known = F.col(measure).isNotNull()
    order = F.struct(known, F.col(measure), F.when(known, -F.col(seq)).otherwise(F.col(seq)))
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def replace_matches(existing: DataFrame, incoming: DataFrame, key: str = "combo_id") -> DataFrame:
    """Rows of the matches in the batch are replaced; a match without new rows keeps its old ones."""
    loaded = incoming.select(key).distinct()
    return existing.join(loaded, key, "left_anti").unionByName(incoming, allowMissingColumns=True)


def publish(df: DataFrame, path: str) -> None:
    """Full refresh of a dimension, fact or crosswalk."""
    df.write.mode("overwrite").parquet(path)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def of_match(df: DataFrame, combo_id: str) -> DataFrame:
    return df.filter(F.col("combo_id") == combo_id)


def table_path(base: str, layer: str, name: str) -> str:
    """Layers are plain folders: raw, staging, marts."""
    return f"{base.rstrip('/')}/{layer.strip()}/{name}"
