"""Grouping helpers shared by the metric operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

TEAM = ["combo_id", "team_id"]
PLAYER = ["combo_id", "team_id", "player_id"]
LEAST_ROWS, MOST_ROWS = 5_000, 100_000


def by_match(rows: DataFrame, n_rows: int) -> DataFrame:
    """`rows` dealt by match into so many tasks that one gets about `MOST_ROWS` of `n_rows` events, however many there are.

    A number that is asked for is not merged by AQE, whose target is bytes of compressed shuffle: a chain of windows holds a
    task's rows once for each of its sorts."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(cores, -(-n_rows // LEAST_ROWS)), -(-n_rows // MOST_ROWS)), "combo_id")


def own_teams(feed: DataFrame) -> DataFrame:
    """Events of one of the two teams of the match."""
    return feed.filter(F.col("team_id").isin(F.col("home_id"), F.col("away_id")))


def with_players(feed: DataFrame) -> DataFrame:
    return own_teams(feed).filter(F.col("player_id").isNotNull())


def spine(sides: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each team of each match; counts of a team without rows are 0."""
    counts = [n for n, t in rows.dtypes if t in ("bigint", "int") and n not in ("team_id",)]
    return sides.select(*TEAM).join(rows, TEAM, "left").na.fill(0, counts)


def opponent(name: str) -> Column:
    """The other team's value of a per-team column (two rows per match)."""
    return F.sum(name).over(Window.partitionBy("combo_id")) - F.col(name)


def linked(feed: DataFrame, source: DataFrame, order: list[str], fields: list[str]) -> DataFrame:
    """Resolve `related_event_id` of the source events.

    Event ids repeat within a match: the last event with the id, by `order`,
    is the linked one. Adds the struct column `link`; rows without a target go.
    """
    keys = (source.filter(F.col("related_event_id").isNotNull())
            .select("combo_id", F.col("related_event_id").alias("event_id")).distinct())
    target = (feed.join(keys, ["combo_id", "event_id"], "left_semi")
              .groupBy("combo_id", F.col("event_id").alias("related_event_id"))
              .agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("link")))
    return source.join(target, ["combo_id", "related_event_id"])


def left_counts(base: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of extra per-key counts; missing counts become 0."""
    return base.join(extra, keys, "left").na.fill(0, [c for c in extra.columns if c not in keys])
