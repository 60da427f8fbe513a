"""Tables whose columns are the keys of their documents: all their keys and types in one pass.

Each of these tables is a list of cells (key, value) before it is spread out. The cells of all of them are one union, and
one aggregate gives every key with the type that holds its values, read as variants. The store keeps the columns of a
table over loads: a key that a later batch lacks stays a column, and a type that grows is widened there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.reshape import MAX_PIVOT_KEYS
from . import rd_docs, xg_docs

_TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "FLOAT": "double", "BOOLEAN": "boolean", "VOID": "void"}

#: Cells of the dynamic tables, by provider.
CELLS = {"xg": {"xg_player_stats": xg_docs.player_stat_cells, "xg_team_stats": xg_docs.team_stat_cells},
         "rd": {"rd_player_stats": rd_docs.player_stat_cells, "rd_match_stats": rd_docs.match_stat_cells, "rd_odds": rd_docs.odds_cells}}


def keys_and_types(cells: dict[str, DataFrame]) -> DataFrame:
    """table, key and type of all keys; a key whose values are no JSON scalars of one kind is text."""
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("table"), "key", F.col("value").cast("string").alias("value")) for name, df in cells.items()])
    value = F.try_parse_json("value")
    found = rows.filter(F.col("key").isNotNull()).groupBy("table", "key").agg(
        F.schema_of_variant_agg(value).alias("kind"), F.count_if(F.col("value").isNotNull() & value.isNull()).alias("odd"))
    kind = F.when(F.col("odd") > 0, "string").when(F.col("kind").startswith("DECIMAL"), "double")
    for have, want in _TYPES.items():
        kind = kind.when(F.col("kind") == have, want)
    return found.select("table", "key", kind.otherwise("string").alias("type"))


def document_cells(xg: DataFrame, rd: rd_docs.ReferenceDocs) -> dict[str, DataFrame]:
    return {name: make(xg) for name, make in CELLS["xg"].items()} | {name: make(rd) for name, make in CELLS["rd"].items()}


def columns_of(found: DataFrame, tables: list[str], most: int = MAX_PIVOT_KEYS) -> dict[str, list[str]]:
    """The keys of each table, sorted. They become column names, so there cannot be any number of them."""
    rows = found.limit(most * len(tables) + 1).collect()
    out: dict[str, list[str]] = {name: [] for name in tables}
    for r in rows:
        out[r.table].append(r.key)
    for name, keys in out.items():
        if len(keys) > most or len(rows) > most * len(tables):
            raise ValueError(f"more than {most} keys in {name}: not columns")
    return {name: sorted(keys) for name, keys in out.items()}


def document_columns(xg: DataFrame, rd: rd_docs.ReferenceDocs) -> dict[str, list[str]]:
    cells = document_cells(xg, rd)
    return columns_of(keys_and_types(cells), list(cells))
