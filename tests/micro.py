"""Hand-written feeds: one event per line, with defaults for what a case does not care about."""

from touchline.functions import fixed as K
from touchline.functions.expr import with_flags

SCHEMA = """combo_id string, pos bigint, event_id bigint, t_s bigint, minute bigint, second bigint, expanded_minute bigint, period int, home_id bigint,
  away_id bigint, team_id bigint, opp_id bigint, player_id bigint, related_player_id bigint, type_id int, etype string, ok boolean, x double, y double,
  pass_end_x double, pass_end_y double, end_x double, end_y double, length double, goal_mouth_y double, goal_mouth_z double, related_event_id bigint,
  is_touch boolean, is_shot boolean, qids array<int>, qnames array<string>"""
NAMES = [part.split()[0] for part in SCHEMA.replace("\n", " ").split(",")]


def feed(spark, events, match="M1"):
    """Events are (team, type, extras); home is team 1, away is team 2. A team of None means no team."""
    rows = []
    for i, (team, etype, extra) in enumerate(events):
        quals = extra.get("q", [])
        t = extra.get("t", i * 2)
        row = dict.fromkeys(NAMES)
        row.update(combo_id=match, pos=i, event_id=i, t_s=t, minute=t // 60, second=t % 60, expanded_minute=t // 60, period=1, home_id=1, away_id=2,
                   team_id=team, opp_id={1: 2, 2: 1}.get(team), player_id=None if team is None else team * 100 + extra.get("p", i % 7),
                   type_id=K.TYPE_ID.get(etype), etype=etype, ok=extra.get("ok", True), x=50.0, y=50.0, is_shot=etype in K.SHOT_TYPES,
                   is_touch=etype not in ("Start", "End", "Card", "Foul"), qnames=quals, qids=[K.QUALIFIER_ID[q] for q in quals if q in K.QUALIFIER_ID])
        row.update({k: v for k, v in extra.items() if k in NAMES})
        rows.append(tuple(row[n] for n in NAMES))
    return with_flags(spark.createDataFrame(rows, SCHEMA))
