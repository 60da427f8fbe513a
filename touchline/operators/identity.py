"""One identity across providers: match-side ladder, global vote, crosswalks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.expr import normalize_name

_SIDE = ["combo_id", "is_home_team"]


def lineup_keys(lineups: DataFrame, name: str = "player_name") -> DataFrame:
    """Lineup rows as the ladder reads them: match side, shirt, id, normalised name."""
    return lineups.select(*_SIDE, "shirt_number", F.col("player_id").alias("id"), normalize_name(F.col(name)).alias("nname"))


def observations(anchor: DataFrame, provider: DataFrame) -> DataFrame:
    """(anchor_id, prov_id, tier) pairs seen in the matches.

    Tier 1: same shirt. Tier 2: exactly one player left on both sides.
    Tier 3: same non-empty normalised name among the rest.
    """
    a = anchor.select(*_SIDE, F.col("shirt_number"), F.col("id").alias("anchor_id"), "nname")
    p = provider.select(*_SIDE, F.col("shirt_number"), F.col("id").alias("prov_id"), "nname")
    pair = [*_SIDE, "anchor_id", "prov_id"]

    exact = (a.filter(F.col("shirt_number").isNotNull()).join(p.drop("nname"), [*_SIDE, "shirt_number"]).select(*pair))
    a1 = a.join(exact, [*_SIDE, "anchor_id"], "left_anti")
    p1 = p.join(exact, [*_SIDE, "prov_id"], "left_anti")

    # A side with one player left: the group's minimum is that player.
    def lone(rows: DataFrame, who: str) -> DataFrame:
        return (rows.groupBy(*_SIDE).agg(F.count("*").alias("_n"), F.min(who).alias(who))
                .filter("_n = 1").drop("_n"))

    alone = lone(a1, "anchor_id").join(lone(p1, "prov_id"), _SIDE).select(*pair)
    a2 = a1.join(alone, [*_SIDE, "anchor_id"], "left_anti")
    p2 = p1.join(alone, [*_SIDE, "prov_id"], "left_anti")
    named = (a2.filter(F.length("nname") > 0).drop("shirt_number")
             .join(p2.drop("shirt_number"), [*_SIDE, "nname"]).select(*pair))
    return (exact.withColumn("tier", F.lit("exact"))
            .unionByName(alone.withColumn("tier", F.lit("elimination")))
            .unionByName(named.withColumn("tier", F.lit("name"))))


def vote(pairs: DataFrame, by: str = "anchor_id", choice: str = "prov_id") -> DataFrame:
    """Most frequent choice per key; ties go to the smaller id.

    Counts are pre-aggregated, and the winner is an aggregate too, so a key
    with very many observations never sits in one window.
    """
    counted = (pairs.filter(F.col(by).isNotNull() & F.col(choice).isNotNull())
               .groupBy(by, choice).agg(F.count("*").alias("votes")))
    return winners(counted, by, choice)


def winners(counted: DataFrame, by: str = "anchor_id", choice: str = "prov_id") -> DataFrame:
    """The choice with most votes of each key, from counts (by, choice, votes)."""
    return (counted.groupBy(by).agg(F.max_by(F.struct(choice, "votes"), F.struct("votes", -F.col(choice))).alias("_w"))
            .select(by, F.col(f"_w.{choice}").alias(choice), F.col("_w.votes").alias("votes")))


def _aliased(rows: DataFrame, alias: DataFrame | None, anchor: str, uid: str) -> DataFrame:
    """Adds the uid: the canonical id of the alias table, else the anchor id itself."""
    if alias is None:
        return rows.withColumn(uid, F.col(anchor))
    renamed = alias.select(F.col("bad_id").alias(anchor), F.col("canonical_id").alias("_canonical"))
    return rows.join(renamed, anchor, "left").withColumn(uid, F.coalesce("_canonical", anchor)).drop("_canonical")


def named(rd_lineups: DataFrame, rd_players: DataFrame) -> DataFrame:
    """Lineups of the reference data, whose names are in the table of players."""
    return rd_lineups.join(rd_players.select("player_id", F.col("name").alias("player_name")), "player_id", "left")


def player_crosswalk(ev_lineups: DataFrame, rd_lineups: DataFrame, rd_players: DataFrame, xg_lineups: DataFrame,
                     alias: DataFrame | None = None, counted: DataFrame | None = None) -> DataFrame:
    """player_uid with the winning reference-data and expected-goals ids of each anchor player.

    With `counted`, the stored votes of all matches, lineups are read for their players only.
    """
    anchor = lineup_keys(ev_lineups)

    def won(provider: str, lineups: DataFrame) -> DataFrame:
        found = vote(observations(anchor, lineup_keys(lineups))) if counted is None else winners(counted.filter((F.col("provider") == provider) & (F.col("votes") > 0)))
        return found.select("anchor_id", F.col("prov_id").alias(f"{provider}_player_id"))

    rows = (anchor.select(F.col("id").alias("anchor_id")).distinct()
            .join(won("rd", named(rd_lineups, rd_players)), "anchor_id", "left")
            .join(won("xg", xg_lineups), "anchor_id", "left")
            .withColumnRenamed("anchor_id", "ev_player_id"))
    return _aliased(rows, alias, "ev_player_id", "player_uid").select(
        "player_uid", "ev_player_id", "rd_player_id", "xg_player_id")


def team_crosswalk(ev_lineups: DataFrame, rd_lineups: DataFrame, xg_lineups: DataFrame,
                   alias: DataFrame | None = None) -> DataFrame:
    """team_uid by home/away side of the same match, voted over all matches."""
    def teams(lineups: DataFrame, name: str) -> DataFrame:
        return lineups.select(*_SIDE, F.col("team_id").alias(name)).distinct()

    anchor = teams(ev_lineups, "anchor_id")

    def winners(lineups: DataFrame, name: str) -> DataFrame:
        pairs = anchor.join(teams(lineups, "prov_id"), _SIDE)
        return vote(pairs).select("anchor_id", F.col("prov_id").alias(name))

    rows = (anchor.select("anchor_id").distinct()
            .join(winners(rd_lineups, "rd_team_id"), "anchor_id", "left")
            .join(winners(xg_lineups, "xg_team_id"), "anchor_id", "left")
            .withColumnRenamed("anchor_id", "ev_team_id"))
    return _aliased(rows, alias, "ev_team_id", "team_uid").select("team_uid", "ev_team_id", "rd_team_id", "xg_team_id")


def coach_crosswalk(xg_match: DataFrame, rd_matches: DataFrame) -> DataFrame:
    """Coach id of the expected-goals provider per manager; ties go to the smaller id."""
    both = xg_match.join(rd_matches, "combo_id")
    pairs = (both.select(F.col("home_manager_id").alias("manager_id"), F.col("ht_coach_id").alias("xg_coach_id"))
             .unionByName(both.select(F.col("away_manager_id").alias("manager_id"), F.col("at_coach_id").alias("xg_coach_id"))))
    return vote(pairs, "manager_id", "xg_coach_id").select("manager_id", "xg_coach_id")


def bad_sides(lineups: DataFrame) -> DataFrame:
    """Matches whose lineups do not show exactly one home and one away side."""
    return (lineups.groupBy("combo_id").agg(F.count_distinct("is_home_team").alias("n_sides"))
            .filter("n_sides <> 2"))
