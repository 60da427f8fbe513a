"""Provider documents made from the adapter tables, in the layout the readers expect.

Returns the same rows as `documents.read_texts`: combo_id, provider, file, value.
A document is one match of one provider, so the arrays gathered here are as
long as one match (500 events).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expr import constant_map
from ..functions import fixed as K
from .adapter import Tables


def _gather(df: DataFrame, order: str | list[str], item: Column, name: str, keys: list[str]) -> DataFrame:
    """Ordered array of structs per key."""
    order = [order] if isinstance(order, str) else order
    both = F.struct(F.struct(*order).alias("_o"), item.alias("_item"))
    # Compared by place only: items may hold maps, which have no order.
    placed = F.array_sort(F.collect_list(both), lambda a, b: F.when(a["_o"] < b["_o"], -1).when(a["_o"] > b["_o"], 1).otherwise(0))
    return df.groupBy(*keys).agg(F.transform(placed, lambda s: s["_item"]).alias(name))


def _s(**fields: Column | str) -> Column:
    return F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()])


def _code(value: Column, name: Column) -> Column:
    return _s(value=value, displayName=name)


def _file(df: DataFrame, provider: str, file: Column, doc: Column) -> DataFrame:
    return df.select("combo_id", F.lit(provider).alias("provider"), file.alias("file"), F.to_json(doc).alias("value"))


def event_texts(t: Tables) -> DataFrame:
    ids, types = constant_map(K.QUALIFIER_ID), constant_map(K.TYPE_ID)

    def qual(name: Column, value: Column, cond: Column) -> Column:
        return F.when(cond, _s(type=_code(F.try_element_at(ids, name), name), value=value))

    none, is_pass = F.lit(None).cast("string"), F.col("etype") == "Pass"
    quals = F.array_compact(F.array(
        qual(F.col("qa"), none, F.col("qa").isNotNull()), qual(F.col("qb"), none, F.col("qb").isNotNull()),
        qual(F.lit("PassEndX"), F.col("end_x").cast("string"), is_pass), qual(F.lit("PassEndY"), F.col("end_y").cast("string"), is_pass),
        qual(F.lit("Length"), F.col("length").cast("string"), F.col("length").isNotNull()),
        qual(F.lit("RelatedEventId"), F.col("rel_event_id").cast("string"), F.col("rel_event_id").isNotNull())))
    event = _s(eventId="event_id", teamId="team_id", playerId="player_id", relatedPlayerId="related_player_id", minute="minute", second="second",
               expandedMinute="expanded_minute", x="x", y="y", isTouch="is_touch", isShot="is_shot",
               type=_code(F.try_element_at(types, "etype"), F.col("etype")),
               outcomeType=_code(F.col("ok").cast("int"), F.when(F.col("ok"), "Successful").otherwise("Unsuccessful")),
               period=_code(F.col("period"), F.when(F.col("period") == 1, "FirstHalf").otherwise("SecondHalf")), qualifiers=quals)
    events = _gather(t["feed_base"], "pos", event, "events", ["combo_id"])
    key = ["combo_id", "team_id"]
    lu = t["ev_lineups"]
    squads = _gather(lu, "player_id", _s(playerId="player_id", name="player_name", shirtNo="shirt_number", position="position",
                                         isFirstEleven="is_starter", subbedInExpandedMinute="subbed_in_minute",
                                         subbedOutExpandedMinute="subbed_out_minute"), "players", key)
    caps = lu.filter("is_captain").groupBy(*key).agg(F.min("player_id").alias("_captain"))
    forms = _gather(t["formations"].join(caps, key, "left"), "formation_index", _s(
        formationName="formation_name", startMinuteExpanded="start_minute", captainPlayerId="_captain"), "formations", key)
    poss = t["possession_minutes"].groupBy(*key).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("minute").cast("string"), "value"))).alias("possession"))
    side = (t.sides.join(squads, key).join(forms, key).join(poss, key, "left").select("combo_id", "is_home", _s(
        teamId="team_id", name=F.concat(F.lit("Club "), F.char(F.col("team_id") + 64)), players="players", formations="formations",
        stats=_s(possession="possession")).alias("side")))
    home = side.filter("is_home").select("combo_id", F.col("side").alias("home"))
    away = side.filter("NOT is_home").select("combo_id", F.col("side").alias("away"))
    docs = t["ev_match_meta"].join(home, "combo_id").join(away, "combo_id").join(events, "combo_id").join(t["matches"].select("combo_id", "mno"), "combo_id")
    return _file(docs, "events", F.concat(F.lit("events_"), F.col("mno") + 700000), _s(
        startTime="start_time", attendance="attendance", referee=_s(name=F.lit("R")), home="home", away="away", events="events"))


def xg_texts(t: Tables) -> DataFrame:
    lu = t["xg_lineups"].withColumn("starter", F.col("position").isNotNull())
    player = _s(id="player_id", name="player_name", shirtNumber="shirt_number", positionId="position_id", usualPlayingPositionId="usual_position_id",
                horizontalLayout=F.when(F.col("starter"), _s(y=(F.col("player_id") % 10 / 10))), performance=_s(rating="rating"))
    key = ["combo_id", "team_id", "is_home_team"]
    starters, subs = (_gather(lu.filter(c), "player_id", player, n, key) for c, n in (("starter", "starters"), ("NOT starter", "subs")))
    m = t["xg_match"]
    coach = m.select("combo_id", F.inline(F.array(F.struct(F.lit(True).alias("is_home_team"), F.col("ht_coach_id").alias("coach_id")),
                                                  F.struct(F.lit(False).alias("is_home_team"), F.col("at_coach_id").alias("coach_id")))))
    side = (starters.join(subs, key, "full").join(coach, ["combo_id", "is_home_team"]).select("combo_id", "is_home_team", _s(
        id="team_id", name=F.concat(F.lit("T"), F.col("team_id")), formation=F.lit("4-3-3"), starters="starters", subs="subs",
        coach=F.when(F.col("coach_id").isNotNull(), _s(id="coach_id", name=F.concat(F.lit("Coach "), F.col("coach_id"))))).alias("side")))
    home = side.filter("is_home_team").select("combo_id", F.col("side").alias("h"))
    away = side.filter("NOT is_home_team").select("combo_id", F.col("side").alias("a"))
    shots = _gather(t["xg_shots"], "row_id", _s(
        id=F.col("row_id") + 10, teamId="team_id", playerId="player_id", x="x", y="y", min="minute", minAdded="minute_added", expectedGoals="xg",
        expectedGoalsOnTarget="xgot", shotType="shot_type", situation="situation", keeperId="keeper_id"), "shots", ["combo_id"])
    group = _s(stats=F.create_map(
        F.lit("Accurate passes"), _s(key=F.lit("accurate_passes "), stat=_s(value="accurate_passes", total=F.lit("9"))),
        F.lit("Duels Won (%)"), _s(key=F.lit(None).cast("string"), stat=_s(value="duels_won", total=F.lit(None).cast("string")))))
    stats = t["xg_player_stats"].groupBy("combo_id").agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("player_id").cast("string"), _s(id="player_id", name="player_name", teamId="team_id", teamName="team_name", stats=F.array(group))))).alias("playerStats"))
    item = _s(key="stat_key", type=F.lit("number"), stats=F.array("home_value", "away_value"))
    title = _s(key=F.lit("head"), type=F.lit("title"), stats=F.array(F.lit(None).cast("string"), F.lit(None).cast("string")))
    items = _gather(t["team_stat_items"], "pos", item, "items", ["combo_id", "period"])
    periods = items.groupBy("combo_id").agg(F.map_from_entries(F.collect_list(F.struct("period", _s(stats=F.array(
        _s(title=F.lit("Head"), stats=F.array(title)), _s(title=F.lit("All"), stats=F.col("items"))))))).alias("Periods"))
    spatial = t["xg_spatial"].select("combo_id", F.from_json("momentum_data", "array<int>").alias("momentum"))
    docs = m
    for part in (home, away, shots, stats, periods, spatial):
        docs = docs.join(part, "combo_id", "left")
    return _file(docs, "xg", F.concat(F.lit("xg_"), F.col("match_round") + 800000), _s(
        general=_s(matchRound=F.col("match_round").cast("string"), teamColors=_s(lightMode=_s(home="home_color", away="away_color"))),
        header=_s(teams=F.array(_s(id="home_team_id", score="home_score"), _s(id="away_team_id", score="away_score"))),
        content=_s(matchFacts=_s(infoBox=F.struct(_s(utcTime="match_date").alias("Match Date"),
                                                  _s(name="stadium_name", city="stadium_city", capacity="stadium_capacity").alias("Stadium")),
                                 playerOfTheMatch=_s(id="motm_id", rating=_s(num="motm_rating"))),
                   lineup=_s(homeTeam="h", awayTeam="a"), playerStats="playerStats", stats=_s(Periods="Periods"), shotmap=_s(shots="shots"),
                   momentum=_s(main=_s(data="momentum")))))


def reference_texts(t: Tables) -> DataFrame:
    m = t["rd_matches"].join(t["matches"].select("combo_id", "mno", "home_id", "away_id"), "combo_id")
    player = _s(player=_s(id="player_id", name=F.concat(F.lit("P"), F.col("player_id")), country=_s(name=F.concat(F.lit("N"), F.col("player_id") % 7)),
                          dateOfBirthTimestamp=((F.col("player_id") - 60500) * 1000000).cast("string")),
                position="position", shirtNumber="shirt_number", substitute=~F.col("is_starter"), captain=F.when(F.col("is_captain"), F.lit(True)),
                statistics=F.when(F.col("player_id") % 14 != 3, F.create_map(
                    F.lit("minutesPlayed"), F.col("minutes_played").cast("string"),
                    F.when(F.col("player_id") % 2 == 0, F.lit("totalPass")).otherwise("rating"), (F.col("player_id") % 90).cast("string"),
                    F.when(F.col("player_id") % 3 == 0, F.lit("ratingVersions")).otherwise("keyPass"),
                    F.when(F.col("player_id") % 3 == 0, F.lit('{"original":7.5,"alternative":7}')).otherwise("2"))))
    key = ["combo_id", "is_home_team"]
    lu = _gather(t["rd_lineups"], "player_id", player, "players", key)
    away_list = _gather(t["rd_missing_players"], "player_id", _s(player=_s(id="player_id", name="name"), type="type", reason=F.col("reason").cast("string")),
                        "missingPlayers", key)
    side = lu.join(away_list, key, "left").select(*key, _s(formation=F.lit("4-3-3"), players="players", missingPlayers="missingPlayers").alias("side"))
    sides = (side.filter("is_home_team").select("combo_id", F.col("side").alias("h"))
             .join(side.filter("NOT is_home_team").select("combo_id", F.col("side").alias("a")), "combo_id"))
    out = [_file(sides, "reference", F.lit("m_lineups"), _s(home="h", away="a"))]

    def team(id_col: str, no: str) -> Column:
        return _s(id=id_col, name=F.concat(F.lit("FC "), F.col(no)), country=_s(name=F.lit("Country")), foundationDateTimestamp=F.lit("-2208988800"),
                  venue=_s(city=_s(name=F.lit("City")), stadium=_s(name=F.concat(F.lit("Ground "), F.col(no)), capacity=F.col(no) * 1000)))

    event = _s(id="match_id", tournament=_s(name=F.concat(F.lit("League "), F.col("tournament_id")), competitionType=F.lit("1"),
                                            uniqueTournament=_s(id="tournament_id"), category=_s(name=F.lit("Europe"), country=_s(name=F.lit("")))),
               season=_s(id="season_id", name=F.concat(F.lit("S "), F.col("season_id")), year=F.col("season_id").cast("string")),
               homeTeam=team("home_team_id", "home_id"), awayTeam=team("away_team_id", "away_id"), venue=_s(name=F.lit("Ground")),
               referee=_s(id="referee_id", name=F.concat(F.lit("R "), F.col("referee_id")), country=_s(name=F.lit("X")), redCards=F.lit(1),
                          yellowCards=F.col("mno") * 3, yellowRedCards=F.lit(0), games=F.col("mno") % 5),
               winnerCode="winnercode", startTimestamp=F.col("mno") * 86400, homeScore=_s(current=F.col("mno") % 4, period1=F.lit(0)),
               awayScore=_s(current=F.col("mno") % 3), time=_s(currentPeriodStartTimestamp=F.col("mno") * 86400 + 60))
    out.append(_file(m, "reference", F.lit("m_main_event_data"), _s(event=event)))
    boss = [_s(id=f"{s}_manager_id", name=F.concat(F.lit("Coach "), F.col(f"{s}_id")), shortName=F.lit("C"), slug=F.lit("c")) for s in ("home", "away")]
    out.append(_file(m, "reference", F.lit("m_managers"), _s(homeManager=boss[0], awayManager=boss[1])))
    out.append(_file(m, "reference", F.lit("m_best_players_summary"), _s(playerOfTheMatch=F.when(
        F.col("mno") % 2 == 0, _s(value=F.lit("8.1"), player=_s(id=F.col("home_id") + 60000, name=F.lit("Best")))))))
    shots = _gather(t["rd_shots"].withColumn("_back", -F.col("row_id")), "_back", _s(
        id="shot_id", player=_s(id="player_id", name=F.lit("n")), xg="xg", xgot="xgot", incidentType=F.when(F.col("shot_id") % 2 == 0, "shot").otherwise("goal"),
        goalMouthLocation=F.when(F.col("shot_id") % 3 == 0, "low-left").when(F.col("shot_id") % 3 == 1, "high-right"), goalType=F.when(F.col("shot_id") % 5 == 0, "penalty"),
        addedTime=F.when(F.col("shot_id") % 4 == 0, F.col("shot_id") % 6), playerCoordinates=_s(x=F.col("shot_id") % 100), gear=(F.col("shot_id") % 7).cast("string")),
        "shotmap", ["combo_id"])
    out.append(_file(shots, "reference", F.lit("m_shotmap"), _s(shotmap="shotmap")))
    items = _gather(t["team_stat_items"], "pos", _s(name=F.concat("stat_key", F.lit(" count")), homeValue="home_value", awayValue="away_value"),
                    "items", ["combo_id", "period"])
    # Every other match has two more periods.
    later = items.join(m.select("combo_id", "mno"), "combo_id").filter("mno % 2 = 0").select("combo_id", F.when(F.col("period") == "p1", "p3").otherwise("p4").alias("period"), "items")
    stats = _gather(items.unionByName(later), "period", _s(period="period", groups=F.array(_s(statisticsItems="items"))), "statistics", ["combo_id"])
    out.append(_file(stats, "reference", F.lit("m_statistics"), _s(statistics="statistics")))
    choice = [_s(name=F.lit("1"), fractionalValue="full_time_1x2_1", winning=F.col("match_id") % 2 == 0),
              _s(name=F.lit("2"), fractionalValue="full_time_1x2_2", winning=F.col("match_id") % 2 == 1)]
    out.append(_file(t["rd_odds"], "reference", F.lit("m_odds_all"), _s(eventId="match_id", markets=F.array(
        _s(marketPeriod=F.lit("Full time"), marketGroup=F.lit("1X2"), choices=F.array(*choice)),
        _s(marketPeriod=F.lit("Full time"), marketGroup=F.lit("Corners"), choices=F.array(*choice))))))
    sp = t["rd_spatial"]
    for file, col in (("average_positions", "average_positions"), ("comments", "commentary"), ("graph", "match_momentum_graph"),
                      ("heatmap_home_team", "home_heatmap"), ("heatmap_away_team", "away_heatmap")):
        out.append(sp.select("combo_id", F.lit("reference").alias("provider"), F.lit(f"m_{file}").alias("file"), F.col(col).alias("value")))
    texts = out[0]
    for o in out[1:]:
        texts = texts.unionByName(o)
    return texts


def odds_texts(t: Tables) -> DataFrame:
    """One file per match and market; lines in `alternative`, the others in `odds`."""
    items = t["odds_items"].withColumn("slug", F.regexp_replace(F.lower("market_name"), "[^a-z0-9]+", "-"))
    price = F.struct(F.concat(F.lit("o"), "outcome_no").alias("k"), _s(odds_value="odds_value", odds_direction="odds_direction", bookie_name=F.lit("b")))
    # A map holds one price per outcome, so each part is a file of its own.
    rows = items.withColumn("prices", F.map_from_entries(F.array(price)))
    body = _s(odds=F.when(F.col("line").isNull(), F.col("prices")), alternative=F.when(F.col("line").isNotNull(), F.array(_s(name="line", odds="prices"))))
    doc = _s(data=_s(market_name="market_name", market_group_id=F.col("p_partkey") % 9, has_handicap=F.when(F.col("line").isNull(), "0").otherwise("1"),
                     outcome_names=F.array(F.lit("Home"), F.lit("Draw")), periods=F.array(_s(id=F.lit("0"), name=F.lit("Full Time"))),
                     odds=F.map_from_entries(F.array(F.struct(F.col("period_id").cast("string"), body)))))
    return _file(rows, "odds", F.concat(F.col("p_partkey").cast("string"), F.lit("_odds_"), "slug"), doc)


def all_texts(t: Tables) -> DataFrame:
    return event_texts(t).unionByName(xg_texts(t)).unionByName(reference_texts(t)).unionByName(odds_texts(t))
