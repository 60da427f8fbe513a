"""Projections and reshapes over tables whose columns are only known at run time."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expr import leading_number, pivot_column_name

MAX_PIVOT_KEYS = 10_000


def passthrough(df: DataFrame, exclude: Iterable[str] = ("id", "ingested_at")) -> DataFrame:
    return df.drop(*exclude)


def cast_text_numeric(df: DataFrame, keep_text: Iterable[str] = (), drop: Iterable[str] = (),
                      display: Iterable[str] = ()) -> DataFrame:
    """Text columns become their leading number, except `keep_text`; `display`
    columns also stay readable as `<name>_display`."""
    keep, gone, shown = set(keep_text), set(drop), set(display)
    out: list[Column] = []
    for name, dtype in df.dtypes:
        if name in gone:
            continue
        col = F.col(f"`{name}`")
        out.append(leading_number(col).alias(name) if dtype == "string" and name not in keep else col)
        if name in shown:
            out.append(col.alias(f"{name}_display"))
    return df.select(*out)


def new_columns(base: DataFrame, other: DataFrame) -> list[str]:
    """Columns of `other` that `base` does not have: the base definition wins."""
    have = set(base.columns)
    return [c for c in other.columns if c not in have]


def join_new(base: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Left join that only brings in the other table's own columns."""
    return base.join(other.select(*keys, *new_columns(base, other)), keys, "left")


def optional(df: DataFrame, name: str, dtype: str = "double") -> Column:
    """The column if the table has it, else a typed NULL."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def pivot_keys(df: DataFrame, key: str, most: int = MAX_PIVOT_KEYS) -> list[str]:
    """Distinct keys, which become column names; refuses more than `most`, as a table cannot have any number of columns."""
    rows = df.filter(F.col(key).isNotNull()).select(key).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} distinct values in {key}: not a pivot key")
    return sorted(r[0] for r in rows)


def pivot_wide(df: DataFrame, group: list[str], key: str, value: str, keys: list[str] | None = None,
               cast: str = "double") -> DataFrame:
    """Long to wide, one cleaned column per key, largest value wins."""
    keys = pivot_keys(df, key) if keys is None else keys
    cells = [F.max(F.when(F.col(key) == k, F.col(value).try_cast(cast))).alias(pivot_column_name(k)) for k in keys]
    return df.groupBy(*group).agg(F.count("*").alias("_n"), *cells).drop("_n")


def team_stats_wide(items: DataFrame, group: list[str], stats: list[str] | None = None) -> DataFrame:
    """`<stat>_home` and `<stat>_away` per group; the last item of a stat, by `pos`, wins."""
    stats = pivot_keys(items, "stat_key") if stats is None else stats
    cells = []
    for s in stats:
        at = F.when(F.col("stat_key") == s, F.col("pos"))
        cells += [F.max_by(f"{side}_value", at).alias(f"{s}_{side}") for side in ("home", "away")]
    return items.groupBy(*group).agg(F.count("*").alias("_n"), *cells).drop("_n")
