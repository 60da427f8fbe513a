"""Plain SQL for the registered queries, one text per query.

Each text starts with the adapter tables it needs as CTEs, then the texts of
the queries it builds on, then its own SELECT.
"""

from __future__ import annotations

from ..functions import fixed as K
from ..sources.adapter import INPUTS, TABLES, duck_ctes

ORACLES: dict[str, tuple[list[str], str]] = {}
HELPERS: dict[str, tuple[list[str], str]] = {}


def oracle(name: str, needs: str, sql: str) -> None:
    ORACLES[name] = (needs.split(), sql.strip())


def helper(name: str, needs: str, sql: str) -> None:
    HELPERS[name] = (needs.split(), sql.strip())


def render(name: str) -> str:
    ctes: dict[str, str] = {}

    def add(part: str) -> None:
        if part in ctes or part in INPUTS:
            return
        if part in TABLES:
            for n, sql in duck_ctes([part]):
                ctes.setdefault(n, sql)
            return
        needs, sql = ORACLES.get(part) or HELPERS[part]
        for n in needs:
            add(n)
        ctes[part] = sql

    add(name)
    body = ctes.pop(name)
    head = ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in ctes.items())
    return f"WITH {head}\n{body}" if head and not body.startswith("WITH") else (f"{body}" if not head else f"WITH {head}, {body[5:]}")


def render_all() -> dict[str, str]:
    return {name: render(name) for name in ORACLES}


# -- text helpers ------------------------------------------------------------------

def q(*names: str) -> str:
    lst = ", ".join(f"'{n}'" for n in names)
    return f"(coalesce(qa, '') IN ({lst}) OR coalesce(qb, '') IN ({lst}))"


def n(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def cnt(**conds: str) -> str:
    return ",\n  ".join(f"{n(c)} AS {name}" for name, c in conds.items())


def rd(x: str, d: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,12)), {d}) AS DOUBLE)"


def div(a: str, b: str, d: int | None = None, scale: int = 1) -> str:
    x = f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)" + (f" * {scale}" if scale != 1 else "")
    return x if d is None else rd(x, d)


def pc(a: str, b: str, d: int = 2) -> str:
    return div(a, b, d, 100)


def xs(expr: str, cond: str = "true") -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN CAST({expr} AS DECIMAL(28,9)) END) AS DOUBLE)"


def i(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def third(x: str = "x") -> str:
    return f"CASE WHEN {x} <= 33.3 THEN 'own_third' WHEN {x} <= 66.6 THEN 'middle_third' ELSE 'final_third' END"


ZONES = ["own_third", "middle_third", "final_third"]
BASE = f"(etype = 'Pass' AND NOT {q('Cross', 'ThrowIn', 'KeeperThrow')})"
DEAD = q("FreekickTaken", "CornerTaken", "Penalty", "ThrowIn", "KeeperThrow", "GoalKick", "IndirectFreekickTaken")
DEAD_STATE = q("FreekickTaken", "CornerTaken", "ThrowIn", "KeeperThrow", "GoalKick", "IndirectFreekickTaken")
ENTRY = f"(etype = 'Pass' AND NOT {q('KeeperThrow')} AND end_x <> 0 AND x < 66.6 AND end_x >= 66.6)"
IN_THIRD = f"({BASE} AND end_x >= 66.6)"
KEY = f"(etype IN ('Pass', 'BallTouch') AND {q('KeyPass')})"
CROSS = f"(etype = 'Pass' AND {q('Cross')})"
BIG = f"(etype = 'Pass' AND {q('BigChanceCreated')})"


def xt(x: str, y: str) -> str:
    cells = "[" + ", ".join(str(v) for line in K.XT_GRID for v in line) + "]"
    row = f"greatest(least(CAST(floor({x} / 100 * 12) AS INT), 11), 0)"
    col = f"greatest(least(CAST(floor({y} / 100 * 8) AS INT), 7), 0)"
    return f"CAST(({cells})[{row} * 8 + {col} + 1] AS DOUBLE)"


# -- passing -----------------------------------------------------------------------

# Assisted goals with the last event (in feed order) that has the linked id.
helper("assist_links", "feed_base", f"""
SELECT combo_id, goal_team, goal_pos, team_id AS a_team, player_id AS a_player, dead FROM (
  SELECT g.combo_id, g.team_id AS goal_team, g.pos AS goal_pos, e.team_id, e.player_id,
    (coalesce(e.qa, '') IN ('FreekickTaken','CornerTaken','Penalty','ThrowIn','KeeperThrow','GoalKick','IndirectFreekickTaken')
     OR coalesce(e.qb, '') IN ('FreekickTaken','CornerTaken','Penalty','ThrowIn','KeeperThrow','GoalKick','IndirectFreekickTaken')) AS dead,
    row_number() OVER (PARTITION BY g.combo_id, g.pos ORDER BY e.pos DESC) AS rn
  FROM feed_base g JOIN feed_base e ON e.combo_id = g.combo_id AND e.event_id = g.rel_event_id
  WHERE g.etype = 'Goal' AND g.qa = 'Assisted') z WHERE rn = 1
""")
helper("assist_ids", "feed_base", """
SELECT DISTINCT combo_id, rel_event_id AS event_id FROM feed_base WHERE etype = 'Goal' AND qa = 'Assisted' AND rel_event_id IS NOT NULL
""")

_CORE = f"""
  {cnt(passes_total=BASE, passes_accurate=f"{BASE} AND ok", passes_inaccurate=f"{BASE} AND NOT ok")},
  coalesce({pc(n(f"{BASE} AND ok"), n(BASE))}, 0) AS pass_accuracy_pct,
  {cnt(longballs_attempted=f"{BASE} AND {q('Longball')}", longballs_accurate=f"{BASE} AND {q('Longball')} AND ok",
       throughballs=f"{BASE} AND {q('Throughball')}", head_passes=f"{BASE} AND {q('HeadPass')}", layoffs=f"{BASE} AND {q('LayOff')}",
       crosses_attempted=CROSS, crosses_accurate=f"{CROSS} AND ok", key_passes=KEY, big_chances_created=BIG,
       passes_entering_final_third=ENTRY, passes_in_final_third=IN_THIRD, passes_in_final_third_accurate=f"{IN_THIRD} AND ok")},
  {pc(n(f"{BASE} AND {q('Longball')} AND ok"), n(f"{BASE} AND {q('Longball')}"))} AS longball_accuracy_pct
"""

oracle("a01_team_passing", "feed_base assist_links", f"""
SELECT f.*, coalesce(a.assists, 0) AS assists FROM (
  SELECT combo_id, team_id, {_CORE},
  {cnt(passes_short=f"{BASE} AND length < 10", passes_medium=f"{BASE} AND length >= 10 AND length <= 32", passes_long_band=f"{BASE} AND length > 32",
       freekick_passes=f"{BASE} AND {q('FreekickTaken')}", indirect_fk_passes=f"{BASE} AND {q('IndirectFreekickTaken')}",
       goalkick_passes=f"{BASE} AND {q('GoalKick')}",
       corner_deliveries=f"etype = 'Pass' AND {q('CornerTaken')}", corner_deliveries_accurate=f"etype = 'Pass' AND {q('CornerTaken')} AND ok",
       throwins_attempted=f"etype = 'Pass' AND {q('ThrowIn')}", throwins_accurate=f"etype = 'Pass' AND {q('ThrowIn')} AND ok",
       keeper_throws_attempted=f"etype = 'Pass' AND {q('KeeperThrow')}", keeper_throws_accurate=f"etype = 'Pass' AND {q('KeeperThrow')} AND ok",
       blocked_passes="etype = 'BlockedPass'")},
  {pc(n(f"{CROSS} AND ok"), n(CROSS))} AS cross_accuracy_pct
  FROM feed_base GROUP BY combo_id, team_id) f
LEFT JOIN (SELECT combo_id, goal_team, count(*) AS assists FROM assist_links WHERE a_team = goal_team GROUP BY 1, 2) a
  ON a.combo_id = f.combo_id AND a.goal_team = f.team_id
""")

oracle("a02_player_passing", "feed_base assist_links", f"""
SELECT f.*, coalesce(a.assists, 0) AS assists FROM (
  SELECT combo_id, team_id, player_id, {_CORE}
  FROM feed_base GROUP BY combo_id, team_id, player_id HAVING {n("etype = 'Pass'")} > 0) f
LEFT JOIN (SELECT combo_id, goal_team, a_player, count(*) AS assists FROM assist_links GROUP BY 1, 2, 3) a
  ON a.combo_id = f.combo_id AND a.goal_team = f.team_id AND a.a_player = f.player_id
""")

# Runs as islands: difference of two row numbers, then ranked by their first event.
helper("in_runs", "feed_base", """
SELECT *, dense_rank() OVER (PARTITION BY combo_id ORDER BY first_o) AS run_id FROM (
  SELECT *, min(o) OVER (PARTITION BY combo_id, team_id, o - ot) AS first_o FROM (
    SELECT *, row_number() OVER (PARTITION BY combo_id ORDER BY t_s, pos) AS o,
      row_number() OVER (PARTITION BY combo_id, team_id ORDER BY t_s, pos) AS ot
    FROM feed_base WHERE etype NOT IN ('Start','End','FormationSet','FormationChange','SubstitutionOn','SubstitutionOff')) a) b
""")
oracle("w02_runs", "in_runs", "SELECT combo_id, pos, team_id, run_id FROM in_runs")
oracle("w03_receivers", "in_runs", """
SELECT p.combo_id, p.pos, p.player_id, r.receiver_id
FROM in_runs p LEFT JOIN (
  SELECT a.combo_id, a.pos, arg_min(b.player_id, b.o) AS receiver_id
  FROM in_runs a JOIN in_runs b ON b.combo_id = a.combo_id AND b.run_id = a.run_id AND b.t_s > a.t_s AND b.player_id <> a.player_id
  WHERE a.etype = 'Pass' GROUP BY 1, 2) r ON r.combo_id = p.combo_id AND r.pos = p.pos
WHERE p.etype = 'Pass'
""")

helper("pass_rows", "feed_base", f"""
SELECT *, (end_x - x) * 1.05 AS v_gain,
  sqrt((100 - x) * (100 - x) + (50 - y) * (50 - y)) AS d0, sqrt((100 - end_x) * (100 - end_x) + (50 - end_y) * (50 - end_y)) AS d1,
  {xt('x', 'y')} AS xt0, {xt('end_x', 'end_y')} AS xt1, NOT {DEAD} AS open_play
FROM feed_base WHERE {BASE}
""")
_PROGRESSIVE = "(ok AND x > 33.3 AND d1 < d0 * 0.75)"
_SWITCH = "(length > 32 AND abs(y - end_y) > 25)"
_INTO_BOX = "(ok AND end_x >= 83 AND end_y BETWEEN 21 AND 79)"

oracle("a03_pass_map", "pass_rows w03_receivers", f"""
SELECT p.combo_id, p.team_id, p.pos, p.event_id, p.player_id, minute, second, expanded_minute, period, x, y, end_x, end_y, length,
  ok AS accurate, v_gain, {rd('d0', 2)} AS dist_to_goal_start, {rd('d1', 2)} AS dist_to_goal_end,
  {_PROGRESSIVE} AS is_progressive, (x < 66.6 AND end_x >= 66.6) AS is_final_third, {_INTO_BOX} AS is_penalty_area,
  {_SWITCH} AS is_switch, open_play AS is_open_play, {rd('xt0', 6)} AS xt_start, {rd('xt1', 6)} AS xt_end, {rd('xt1 - xt0', 6)} AS xt_added,
  r.receiver_id
FROM pass_rows p JOIN w03_receivers r ON r.combo_id = p.combo_id AND r.pos = p.pos
""")

_PROFILE = f"""
  {cnt(progressive_passes=_PROGRESSIVE, penalty_area_passes=_INTO_BOX)},
  {div(xs('length', 'length <> 0'), n('length <> 0'), 2)} AS avg_pass_length,
  {div(xs('v_gain'), 'count(*)', 2)} AS avg_vertical_gain,
  {pc(n('v_gain > 0'), 'count(*)')} AS forward_pass_pct, {pc(n('v_gain < 0'), 'count(*)')} AS backward_pass_pct,
  {rd(xs('xt1 - xt0'), 4)} AS xt_total, coalesce({rd(xs('xt1 - xt0', 'xt1 > xt0'), 4)}, 0) AS xt_positive,
  {div(xs('xt1 - xt0'), 'count(*)', 6)} AS xt_per_pass
"""
helper("key_events", "feed_base assist_ids", f"""
SELECT f.combo_id, f.team_id, f.player_id, NOT {DEAD} AS open_play FROM feed_base f
WHERE {KEY} AND NOT EXISTS (SELECT 1 FROM assist_ids a WHERE a.combo_id = f.combo_id AND a.event_id = f.event_id)
""")

oracle("w04_tempo", "in_runs", f"""
SELECT combo_id, team_id, {div('sum(gap)', 'count(*)', 2)} AS avg_release_seconds,
  {pc(n('gap <= 2'), 'count(*)')} AS quick_pass_pct, {pc(n('gap > 5'), 'count(*)')} AS slow_pass_pct
FROM (SELECT combo_id, team_id, player_id, t_s - lag(t_s) OVER w AS gap, lag(player_id) OVER w AS before
      FROM in_runs WHERE {BASE} WINDOW w AS (PARTITION BY combo_id, run_id ORDER BY t_s, pos)) z
WHERE before <> player_id AND gap > 0 AND gap <= 10 GROUP BY 1, 2
""")

oracle("w05_hold", "feed_base", f"""
SELECT combo_id, team_id, player_id, {div('sum(gap)', 'count(*)', 2)} AS avg_hold_seconds FROM (
  SELECT p.combo_id, p.team_id, p.player_id, p.pos, max(p.t_s) - max(t.t_s) AS gap
  FROM feed_base p JOIN feed_base t ON t.combo_id = p.combo_id AND t.team_id = p.team_id AND t.player_id = p.player_id AND t.is_touch AND t.t_s < p.t_s
  WHERE p.etype = 'Pass' AND NOT (coalesce(p.qa, '') IN ('Cross', 'ThrowIn', 'KeeperThrow') OR coalesce(p.qb, '') IN ('Cross', 'ThrowIn', 'KeeperThrow'))
  GROUP BY 1, 2, 3, 4) z
WHERE gap > 0 AND gap <= 15 GROUP BY 1, 2, 3
""")

_FAR_ACTION = "etype IN ('Tackle', 'Interception', 'Foul', 'Challenge', 'BlockedPass') AND x > 33.3"
oracle("a05_ppda", "feed_base", f"""
WITH c AS (SELECT combo_id, team_id, opp_id, {n("etype = 'Pass' AND x > 33.3")} AS passes, {n(_FAR_ACTION)} AS acts FROM feed_base GROUP BY 1, 2, 3)
SELECT c.combo_id, c.team_id, o.passes AS opp_passes, c.acts AS def_actions, {div('o.passes', 'c.acts', 2)} AS ppda
FROM c JOIN c o ON o.combo_id = c.combo_id AND o.team_id = c.opp_id
""")
oracle("a06_ppda_poss", "feed_base", f"""
WITH c AS (SELECT combo_id, team_id, opp_id, {n("etype = 'Pass' AND x <= 66.6")} AS passes,
    {n("etype IN ('Tackle', 'Interception', 'Foul', 'Challenge', 'BlockedPass') AND x >= 33.4")} AS acts FROM feed_base GROUP BY 1, 2, 3)
SELECT c.combo_id, c.team_id, o.passes AS opp_passes, c.acts AS def_actions, {div('o.passes', 'c.acts', 2)} AS ppda
FROM c JOIN c o ON o.combo_id = c.combo_id AND o.team_id = c.opp_id
""")
oracle("a07_field_tilt", "feed_base", f"""
WITH c AS (SELECT combo_id, team_id, opp_id, {n("is_touch AND x >= 66.6")} AS k FROM feed_base GROUP BY 1, 2, 3)
SELECT c.combo_id, c.team_id, c.k AS final_third_touches, {pc('c.k', 'c.k + o.k')} AS field_tilt_pct
FROM c JOIN c o ON o.combo_id = c.combo_id AND o.team_id = c.opp_id
""")
oracle("a08_field_tilt_poss", "feed_base", f"""
WITH c AS (SELECT combo_id, team_id, opp_id, {n("is_touch AND x > 66.6")} AS k, {n("etype = 'Pass' AND ok AND x > 66.6")} AS p FROM feed_base GROUP BY 1, 2, 3)
SELECT c.combo_id, c.team_id, c.k AS final_third_touches, coalesce({pc('c.k', 'c.k + o.k', 1)}, 50) AS field_tilt_pct,
  coalesce({pc('c.p', 'c.p + o.p', 1)}, 50) AS field_tilt_passes_pct
FROM c JOIN c o ON o.combo_id = c.combo_id AND o.team_id = c.opp_id
""")

oracle("a04_team_passing_adv", "feed_base pass_rows assist_links key_events w04_tempo a05_ppda a07_field_tilt", f"""
SELECT p.*, f.* EXCLUDE (combo_id, team_id),
  coalesce(l.op, 0) AS assists_open_play, coalesce(k.key_passes, 0) AS key_passes, coalesce(k.key_op, 0) AS key_passes_open_play,
  coalesce(k.key_passes, 0) + f.assists AS chances_created, coalesce(k.key_op, 0) + coalesce(l.op, 0) AS chances_created_open_play,
  d.ppda, t.field_tilt_pct, w.avg_release_seconds, w.quick_pass_pct, w.slow_pass_pct
FROM (
  SELECT combo_id, team_id, {_PROFILE}, {cnt(switches_of_play=_SWITCH)},
    {div(xs('sqrt((end_x - x) * (end_x - x) + (end_y - y) * (end_y - y))', 'ok'), n('ok'), 2)} AS avg_pass_length_euclid,
    {pc(n('v_gain = 0'), 'count(*)')} AS lateral_pass_pct, {div(n(_PROGRESSIVE), 'count(*)', 4)} AS directness_index
  FROM pass_rows GROUP BY 1, 2) p
JOIN (
  SELECT combo_id, team_id, {cnt(passes_entering_final_third=ENTRY, passes_in_final_third=IN_THIRD,
    passes_in_final_third_accurate=f"{IN_THIRD} AND ok", passes_in_final_third_open_play=f"{IN_THIRD} AND NOT {DEAD}",
    passes_in_final_third_op_accurate=f"{IN_THIRD} AND NOT {DEAD} AND ok", assists="etype = 'Goal' AND qa = 'Assisted'",
    big_chances_created=BIG, big_chances_created_open_play=f"{BIG} AND NOT {DEAD}",
    crosses_open_play_attempted=f"{CROSS} AND NOT {DEAD}", crosses_open_play_accurate=f"{CROSS} AND NOT {DEAD} AND ok",
    corner_deliveries_open_play=f"etype = 'Pass' AND {q('CornerTaken')} AND NOT {DEAD}")}
  FROM feed_base GROUP BY 1, 2) f ON f.combo_id = p.combo_id AND f.team_id = p.team_id
LEFT JOIN (SELECT g.combo_id, g.team_id, count(*) FILTER (WHERE l.dead IS NOT TRUE) AS op
      FROM feed_base g LEFT JOIN assist_links l ON l.combo_id = g.combo_id AND l.goal_pos = g.pos
      WHERE g.etype = 'Goal' AND g.qa = 'Assisted' AND g.rel_event_id IS NOT NULL GROUP BY 1, 2) l ON l.combo_id = p.combo_id AND l.team_id = p.team_id
LEFT JOIN (SELECT combo_id, team_id, count(*) AS key_passes, {n('open_play')} AS key_op FROM key_events GROUP BY 1, 2) k
  ON k.combo_id = p.combo_id AND k.team_id = p.team_id
LEFT JOIN a05_ppda d ON d.combo_id = p.combo_id AND d.team_id = p.team_id
LEFT JOIN a07_field_tilt t ON t.combo_id = p.combo_id AND t.team_id = p.team_id
LEFT JOIN w04_tempo w ON w.combo_id = p.combo_id AND w.team_id = p.team_id
""")

oracle("a09_player_passing_adv", "pass_rows assist_links key_events w05_hold", f"""
SELECT p.*, coalesce(k.k, 0) AS key_passes, coalesce(a.a, 0) AS assists, coalesce(k.k, 0) + coalesce(a.a, 0) AS chances_created, h.avg_hold_seconds
FROM (SELECT combo_id, team_id, player_id, {_PROFILE}, {n('x < 66.6 AND end_x >= 66.6')} AS passes_entering_final_third
      FROM pass_rows GROUP BY 1, 2, 3) p
LEFT JOIN (SELECT combo_id, team_id, player_id, count(*) AS k FROM key_events GROUP BY 1, 2, 3) k
  ON k.combo_id = p.combo_id AND k.team_id = p.team_id AND k.player_id = p.player_id
LEFT JOIN (SELECT combo_id, goal_team, a_player, count(*) AS a FROM assist_links GROUP BY 1, 2, 3) a
  ON a.combo_id = p.combo_id AND a.goal_team = p.team_id AND a.a_player = p.player_id
LEFT JOIN w05_hold h ON h.combo_id = p.combo_id AND h.team_id = p.team_id AND h.player_id = p.player_id
""")
oracle("a10_avg_position", "feed_base", f"""
SELECT combo_id, team_id, player_id, {div(xs('x'), 'count(*)', 2)} AS avg_x, {div(xs('y'), 'count(*)', 2)} AS avg_y, count(*) AS touch_count
FROM feed_base WHERE is_touch GROUP BY 1, 2, 3
""")
oracle("a11_pass_network", "w03_receivers feed_base", """
SELECT f.combo_id, f.team_id, f.player_id AS passer_id, r.receiver_id, count(*) AS pass_count
FROM feed_base f JOIN w03_receivers r ON r.combo_id = f.combo_id AND r.pos = f.pos
WHERE f.ok AND r.receiver_id IS NOT NULL GROUP BY 1, 2, 3, 4
""")

# -- shooting ----------------------------------------------------------------------

_DIST = rd("sqrt(((100 - x) * 1.05) * ((100 - x) * 1.05) + ((50 - y) * 0.68) * ((50 - y) * 0.68))", 2)
oracle("a12_shots", "feed_base", f"""
SELECT *, CASE WHEN distance_m = 0 THEN 90 ELSE {rd('degrees(2 * atan(3.66 / distance_m))', 2)} END AS angle_deg FROM (
SELECT combo_id, row_number() OVER (PARTITION BY combo_id ORDER BY pos) - 1 AS row_id, pos, event_id, team_id, player_id, minute, second, expanded_minute,
  period, x, y, etype = 'Goal' AS is_goal, (etype = 'Goal' OR (etype = 'SavedShot' AND NOT {q('Blocked')})) AS is_on_target,
  (etype = 'SavedShot' AND {q('Blocked')}) AS is_blocked, etype IN ('MissedShots', 'ShotOnPost') AS is_off_target,
  NOT {q('FreekickTaken')} AS is_open_play, 'Unknown' AS location, false AS in_box, false AS six_yard_box, false AS small_box,
  {_DIST} AS distance_m, CASE WHEN qb IN ('RightFoot', 'LeftFoot', 'Head') THEN qb ELSE 'Unknown' END AS body_part,
  {q('Head')} AS is_header, {q('RightFoot')} AS is_right_foot, {q('LeftFoot')} AS is_left_foot, false AS is_volley, false AS is_first_touch,
  CASE WHEN {q('FreekickTaken')} THEN 'FreekickTaken' ELSE 'RegularPlay' END AS pattern, false AS is_from_corner,
  {q('FreekickTaken')} AS is_from_freekick, false AS is_fast_break, {q('Assisted')} AS is_assisted, false AS is_individual_play,
  {q('BigChance')} AS is_big_chance, false AS is_one_on_one, CAST(NULL AS DOUBLE) AS goal_mouth_y, CAST(NULL AS DOUBLE) AS goal_mouth_z,
  CAST(NULL AS VARCHAR) AS placement, rel_event_id AS related_event_id
FROM feed_base WHERE is_shot) s
""")
_SHOOTING = f"""
  count(*) AS total_shots, {cnt(goals='is_goal', shots_on_target='is_on_target', shots_blocked='is_blocked', shots_off_target='is_off_target',
    big_chances='is_big_chance', big_chances_scored='is_big_chance AND is_goal', one_on_ones='is_one_on_one', shots_in_box='in_box',
    shots_out_of_box='NOT in_box', shots_six_yard_box='six_yard_box', shots_right_foot='is_right_foot', shots_left_foot='is_left_foot',
    shots_header='is_header', shots_volley='is_volley', shots_first_touch='is_first_touch', shots_from_corner='is_from_corner',
    shots_from_freekick='is_from_freekick', shots_fast_break='is_fast_break', shots_assisted='is_assisted',
    shots_individual_play='is_individual_play', shots_open_play='is_open_play', goals_open_play='is_open_play AND is_goal',
    shots_on_target_open_play='is_open_play AND is_on_target', placement_top_corner="is_on_target AND placement = 'TopCorner'",
    placement_low_corner="is_on_target AND placement = 'LowCorner'", placement_centre_frame="is_on_target AND placement = 'CentreFrame'")},
  {pc(n('is_on_target'), 'count(*)')} AS shots_on_target_pct, {pc(n('is_goal'), 'count(*)')} AS conversion_rate_pct,
  coalesce({pc(n('is_goal'), n('is_on_target'))}, 0) AS goals_per_shot_on_target_pct,
  {pc(n('is_big_chance AND is_goal'), n('is_big_chance'))} AS big_chance_conversion_pct,
  {pc(n('in_box AND is_goal'), n('in_box'))} AS in_box_conversion_pct, {div(xs('distance_m'), 'count(*)', 2)} AS avg_shot_distance_m
"""
oracle("a13_team_shooting", "a12_shots", f"SELECT combo_id, team_id, {_SHOOTING} FROM a12_shots GROUP BY 1, 2")
oracle("a13_player_shooting", "a12_shots", f"SELECT combo_id, team_id, player_id, {_SHOOTING} FROM a12_shots GROUP BY 1, 2, 3")

_KIND = """CASE WHEN {a}etype = 'Pass' AND {a}ok AND (coalesce({a}qa, '') IN ('ThrowIn','CornerTaken','FreekickTaken','GoalKick','KickOff','IndirectFreekickTaken')
  OR coalesce({a}qb, '') IN ('ThrowIn','CornerTaken','FreekickTaken','GoalKick','KickOff','IndirectFreekickTaken')) THEN 'Pass (Dead)'
  WHEN {a}etype = 'Pass' AND {a}ok THEN 'Pass (Live)' WHEN {a}etype = 'TakeOn' AND {a}ok THEN 'Take-On' WHEN {a}is_shot THEN 'Shot'
  WHEN {a}etype IN ('Interception', 'Tackle') THEN {a}etype END"""
oracle("w01_sca", "feed_base", f"""
WITH ev AS (SELECT *, {_KIND.format(a='')} AS kind FROM feed_base),
near AS (
  SELECT s.combo_id, s.pos AS shot_pos, s.team_id AS st, s.pos - e.pos AS d, e.*
  EXCLUDE (combo_id) FROM ev s JOIN ev e ON e.combo_id = s.combo_id AND e.pos BETWEEN s.pos - 12 AND s.pos - 1 WHERE s.is_shot),
judged AS (
  SELECT *, (etype <> 'Foul' AND team_id <> st AND ((etype IN ('Pass', 'TakeOn') AND ok) OR is_shot OR etype = 'Interception'))
      OR (etype <> 'Foul' AND team_id = st AND kind IS NULL AND etype IN ('BallRecovery','KeeperPickup','Save','Clearance','BlockedPass')) AS stops,
    CASE WHEN etype = 'Foul' AND team_id = st AND ok THEN 'Fouled' WHEN etype <> 'Foul' AND team_id = st THEN kind END AS credit
  FROM near),
limits AS (SELECT combo_id, shot_pos, min(d) FILTER (WHERE stops) AS stop_d FROM judged GROUP BY 1, 2),
hits AS (
  SELECT j.combo_id, j.shot_pos, j.st, j.d, j.player_id, j.credit AS kind FROM judged j JOIN limits l USING (combo_id, shot_pos)
  WHERE j.credit IS NOT NULL AND (l.stop_d IS NULL OR j.d < l.stop_d)
  UNION ALL
  -- every event has a team, so the peek is the event right before the recovery
  SELECT j.combo_id, j.shot_pos, j.st, j.d, p.player_id, p.kind FROM judged j JOIN limits l ON l.combo_id = j.combo_id AND l.shot_pos = j.shot_pos AND l.stop_d = j.d
  JOIN ev p ON p.combo_id = j.combo_id AND p.pos = j.pos - 1
  WHERE j.etype = 'BallRecovery' AND j.team_id = j.st AND p.team_id = j.st AND p.kind IN ('Tackle', 'Interception')),
ranked AS (SELECT *, row_number() OVER w AS slot, first_value(kind) OVER w AS k1 FROM hits WINDOW w AS (PARTITION BY combo_id, shot_pos ORDER BY d))
SELECT combo_id, shot_pos, st AS team_id, slot, player_id, kind FROM ranked WHERE slot = 1 OR (slot = 2 AND k1 <> 'Shot')
""")
_CREDITS = cnt(sca_pass_live="kind = 'Pass (Live)'", sca_pass_dead="kind = 'Pass (Dead)'", sca_take_on="kind = 'Take-On'", sca_shot="kind = 'Shot'",
               sca_fouled="kind = 'Fouled'", sca_defense="kind IN ('Interception', 'Tackle')")
oracle("a14_sca_totals", "w01_sca", f"""
SELECT combo_id, team_id, CAST(NULL AS BIGINT) AS player_id, count(*) AS sca, {_CREDITS}, {n('slot = 1')} AS shots_with_sca FROM w01_sca GROUP BY 1, 2
UNION ALL SELECT combo_id, team_id, player_id, count(*), {", ".join(c.split(" AS ")[0] for c in _CREDITS.split(",\n  "))}, NULL FROM w01_sca GROUP BY 1, 2, 3
""")
oracle("a14_player_shooting_full", "a13_player_shooting a14_sca_totals", """
SELECT coalesce(s.combo_id, c.combo_id) AS combo_id, coalesce(s.team_id, c.team_id) AS team_id, coalesce(s.player_id, c.player_id) AS player_id,
  s.* EXCLUDE (combo_id, team_id, player_id), coalesce(c.sca, 0) AS sca, coalesce(sca_pass_live, 0) AS sca_pass_live,
  coalesce(sca_pass_dead, 0) AS sca_pass_dead, coalesce(sca_take_on, 0) AS sca_take_on, coalesce(sca_shot, 0) AS sca_shot,
  coalesce(sca_fouled, 0) AS sca_fouled, coalesce(sca_defense, 0) AS sca_defense
FROM a13_player_shooting s
FULL JOIN (SELECT * FROM a14_sca_totals WHERE player_id IS NOT NULL) c
  ON c.combo_id = s.combo_id AND c.team_id = s.team_id AND c.player_id = s.player_id
""")

# -- possession --------------------------------------------------------------------

_LOST = "(etype = 'TakeOn' AND NOT ok) OR etype = 'Dispossessed'"


def _touches(total: str) -> str:
    zones = cnt(**{f"touches_{z}": f"is_touch AND {third()} = '{z}'" for z in ZONES})
    return (f"{n('is_touch')} AS {total}, {zones}, {n('is_touch AND x > 83 AND y BETWEEN 21 AND 79')} AS touches_in_box, "
            f"{div(xs('x', 'is_touch'), n('is_touch'), 1)} AS avg_touch_x")


def _dribbles() -> str:
    d = "etype = 'TakeOn'"
    out = [cnt(dribbles_attempted=d, dribbles_won=f"{d} AND ok", dribbles_lost=f"{d} AND NOT ok", dispossessed="etype = 'Dispossessed'", ball_losses=_LOST),
           f"{pc(n(f'{d} AND ok'), n(d), 1)} AS dribble_success_pct", f"{pc(f'({n(chr(105) + chr(115) + '_touch')} - {n(_LOST)})', n('is_touch'), 1)} AS ball_retention_pct"]
    for z in ZONES:
        c = f"{d} AND {third()} = '{z}'"
        out += [cnt(**{f"dribbles_{z}": c, f"dribbles_won_{z}": f"{c} AND ok"}), f"{pc(n(f'{c} AND ok'), n(c), 1)} AS dribble_success_pct_{z}"]
    return ", ".join(out)


helper("shares", "possession_minutes", """
SELECT combo_id, team_id, own / nullif(sum(own) OVER (PARTITION BY combo_id), 0) AS share
FROM (SELECT combo_id, team_id, sum(value) AS own FROM possession_minutes GROUP BY 1, 2) z
""")
oracle("a15_team_possession", "feed_base shares", f"""
SELECT f.* EXCLUDE (good), s.possession_pct, {rd('s.possession_pct / 100 * 90', 2)} AS possession_minutes,
  {div('good', rd('s.possession_pct / 100 * 90', 2), 2)} AS passing_rate
FROM (SELECT combo_id, team_id, {_touches('touches_total')}, {_dribbles()},
  {cnt(dribbles_offensive=f"etype = 'TakeOn' AND {q('Offensive')}", dribbles_defensive=f"etype = 'TakeOn' AND {q('Defensive')}",
       dribbles_overrun=f"etype = 'TakeOn' AND {q('OverRun')}", dispossessed_offensive=f"etype = 'Dispossessed' AND {q('Offensive')}",
       dispossessed_defensive=f"etype = 'Dispossessed' AND {q('Defensive')}", shield_ball_opp="etype = 'ShieldBallOpp'",
       corners_won="etype = 'CornerAwarded' AND x > 50", corners_miss_left=f"etype = 'CornerAwarded' AND x > 50 AND {q('MissLeft')}",
       corners_miss_right=f"etype = 'CornerAwarded' AND x > 50 AND {q('MissRight')}", good=f"{BASE} AND ok")}
  FROM feed_base GROUP BY 1, 2) f
JOIN (SELECT combo_id, team_id, {rd('share * 100', 1)} AS possession_pct FROM shares) s ON s.combo_id = f.combo_id AND s.team_id = f.team_id
""")
oracle("a16_player_possession", "feed_base", f"""
SELECT combo_id, team_id, player_id, {_touches('touches')}, {_dribbles()}
FROM feed_base WHERE is_touch OR etype IN ('TakeOn', 'Dispossessed') GROUP BY 1, 2, 3
""")

# -- defending ---------------------------------------------------------------------

helper("def_feed", "feed_base squad", """
SELECT f.*, f.etype = 'Clearance' AND EXISTS (SELECT 1 FROM squad s WHERE s.combo_id = f.combo_id AND s.player_id = f.player_id AND s.position = 'GK') AS gk_clear
FROM feed_base f
""")
_CLEAR = "(etype = 'Clearance' AND NOT gk_clear)"
_SHAPE = f"(etype IN ('Tackle', 'Challenge', 'Interception', 'BlockedPass') OR {_CLEAR})"
_PHYS = f"(etype = 'Foul' AND {q('Foul')} AND NOT {q('AerialFoul')})"
_WON = f"(etype IN ('Tackle', 'KeeperSweeper') OR (etype = 'TakeOn' AND ok) OR ({_PHYS} AND ok))"
_LOSTD = f"(etype IN ('Challenge', 'Dispossessed') OR (etype = 'TakeOn' AND NOT ok) OR ({_PHYS} AND NOT ok))"
_AFOUL = f"(etype = 'Foul' AND {q('AerialFoul')})"


def _defending() -> str:
    tk = "etype IN ('Tackle', 'Challenge')"
    out = [cnt(tackles_total=tk, tackles_won="etype = 'Tackle' AND ok", tackles_lost="etype = 'Tackle' AND NOT ok", dribbled_past="etype = 'Challenge'",
               tackles_defensive=f"etype = 'Tackle' AND {q('Defensive')}", tackles_offensive=f"etype = 'Tackle' AND {q('Offensive')}",
               interceptions="etype = 'Interception'", interceptions_headed=f"etype = 'Interception' AND {q('Head')}",
               interceptions_last_man=f"etype = 'Interception' AND {q('LastMan')}", clearances=_CLEAR, clearances_headed=f"{_CLEAR} AND {q('Head')}",
               clearances_blocked_cross=f"{_CLEAR} AND {q('BlockedCross')}", clearances_in_own_box=f"{_CLEAR} AND x <= 17",
               aerials_defensive=f"etype = 'Aerial' AND {q('Defensive')}", aerials_offensive=f"etype = 'Aerial' AND {q('Offensive')}",
               aerials_won=f"(etype = 'Aerial' OR {_AFOUL}) AND ok", all_aerials=f"etype = 'Aerial' OR {_AFOUL}",
               ball_recoveries="etype IN ('BallRecovery', 'Interception', 'KeeperSweeper')", blocked_passes="etype = 'BlockedPass'",
               fouls_conceded="etype = 'Foul' AND NOT ok", fouls_won="etype = 'Foul' AND ok", dispossessed="etype = 'Dispossessed'",
               shield_ball_opp="etype = 'ShieldBallOpp'", offsides_caught="etype = 'OffsideProvoked'",
               errors_leading_to_shot="etype = 'Error' AND false", errors_leading_to_goal="etype = 'Error' AND false", errors_total="etype = 'Error'",
               won=_WON, lost=_LOSTD, blocked_own=f"etype = 'SavedShot' AND {q('Blocked')}"),
           f"{pc(n('''etype = 'Tackle' AND ok'''), n(tk))} AS tackle_success_pct",
           f"{div(xs('length', f'{_CLEAR} AND length IS NOT NULL'), n(f'{_CLEAR} AND length IS NOT NULL'), 2)} AS avg_clearance_distance_m",
           f"{div(xs('x', _SHAPE), n(_SHAPE), 2)} AS avg_defensive_line_height"]
    for kind in ("Defensive", "Offensive"):
        c = f"etype = 'Aerial' AND {q(kind)}"
        out.append(f"{pc(n(c + ' AND ok'), n(c))} AS aerial_win_pct_{kind.lower()}")
    for z in ZONES:
        h = f"{third()} = '{z}'"
        out += [cnt(**{f"tackles_{z}": f"{tk} AND {h}", f"tackles_won_{z}": f"etype = 'Tackle' AND ok AND {h}", f"interceptions_{z}": f"etype = 'Interception' AND {h}",
                       f"aerials_{z}": f"etype = 'Aerial' AND {h}", f"recoveries_{z}": f"etype IN ('BallRecovery', 'Interception', 'KeeperSweeper') AND {h}",
                       f"press_actions_{z}": f"{_SHAPE} AND {h}", f"ground_duels_{z}": f"({_WON} OR {_LOSTD}) AND {h}"}),
                f"{pc(n(f'''etype = 'Tackle' AND ok AND {h}'''), n(f'{tk} AND {h}'))} AS tackle_success_pct_{z}",
                f"{pc(n(f'''etype = 'Aerial' AND ok AND {h}'''), n(f'''etype = 'Aerial' AND {h}'''))} AS aerial_win_pct_{z}",
                f"{pc(n(f'{_WON} AND {h}'), n(f'({_WON} OR {_LOSTD}) AND {h}'))} AS ground_duel_win_pct_{z}"]
    return ", ".join(out)


_DUELS = f"""g AS ground_duels, gw AS ground_duels_won, g - gw AS ground_duels_lost, {pc('gw', 'g')} AS ground_duel_win_pct,
  a AS aerials_total, a - aerials_won AS aerials_lost, {pc('aerials_won', 'a')} AS aerial_win_pct, g + a AS total_duels,
  gw + aerials_won AS total_duels_won, g + a - gw - aerials_won AS total_duels_lost, {pc('(gw + aerials_won)', '(g + a)')} AS duel_win_pct,
  bs AS blocked_shots, clearances + blocked_passes + bs + interceptions + tackles_won AS defensive_actions_total"""
oracle("a17_team_defending", "def_feed", f"""
WITH t AS (SELECT combo_id, team_id, opp_id, {_defending()} FROM def_feed GROUP BY 1, 2, 3),
p AS (SELECT t.*, t.won AS gw, t.won + o.won AS g, t.aerials_won + o.aerials_won AS a, o.blocked_own AS bs
      FROM t JOIN t o ON o.combo_id = t.combo_id AND o.team_id = t.opp_id)
SELECT * EXCLUDE (opp_id, all_aerials, won, lost, blocked_own, gw, g, a, bs), {_DUELS} FROM p
""")
oracle("a18_player_defending", "def_feed squad", f"""
WITH t AS (SELECT combo_id, team_id, player_id, {_defending()} FROM (
    SELECT combo_id, team_id, player_id, etype, ok, qa, qb, x, length, gk_clear FROM def_feed
    UNION ALL SELECT combo_id, team_id, player_id, '', false, NULL, NULL, NULL, NULL, false FROM squad WHERE position = 'GK') u GROUP BY 1, 2, 3),
p AS (SELECT *, won AS gw, won + lost AS g, all_aerials AS a, 0::BIGINT AS bs FROM t),
r AS (SELECT * EXCLUDE (all_aerials, won, lost, blocked_own, gw, g, a, bs), {_DUELS} FROM p)
SELECT r.* FROM r WHERE defensive_actions_total > 0 OR errors_total > 0 OR fouls_conceded > 0 OR ball_recoveries > 0
  OR EXISTS (SELECT 1 FROM squad s WHERE s.combo_id = r.combo_id AND s.player_id = r.player_id AND s.position = 'GK')
""")

# -- discipline and keepers --------------------------------------------------------

_ZONE = "CASE WHEN {x} <= 17 THEN 'own_box' WHEN {x} <= 50 THEN 'own_half' WHEN {x} <= 66.6 THEN 'midfield' ELSE 'danger_area' END"
_MADE = "etype = 'Foul' AND NOT ok"
_DISCIPLINE = cnt(
    fouls_committed=_MADE, fouls_won="etype = 'Foul' AND ok", fouls_defensive=f"{_MADE} AND {q('Defensive')}", fouls_offensive=f"{_MADE} AND {q('Offensive')}",
    fouls_aerial=f"{_MADE} AND {q('AerialFoul')}", **{f"fouls_{z}": f"{_MADE} AND {_ZONE.format(x='x')} = '{z}'" for z in ("own_box", "own_half", "midfield", "danger_area")},
    fouls_first_half=f"{_MADE} AND period = 1", fouls_second_half=f"{_MADE} AND period <> 1", fouls_late_game=f"{_MADE} AND expanded_minute >= 75",
    yellow_cards="etype = 'Card' AND qa = 'Yellow'", red_cards="etype = 'Card' AND qa IN ('Red', 'SecondYellow')",
    second_yellow_cards="etype = 'Card' AND qa = 'SecondYellow'", offsides_committed="etype = 'OffsideGiven'")
oracle("a19_team_discipline", "feed_base", f"""
SELECT *, {pc('(fouls_own_box + fouls_danger_area)', 'fouls_committed')} AS dangerous_foul_rate_pct,
  {div('fouls_second_half', 'fouls_first_half', 2)} AS foul_escalation_rate, {div('fouls_committed', 'yellow_cards + red_cards', 1)} AS foul_to_card_ratio
FROM (SELECT combo_id, team_id, {_DISCIPLINE}, {cnt(offsides_caught="etype = 'OffsideProvoked'", goals_disallowed_offside="etype = 'OffsidePass'")}
      FROM feed_base GROUP BY 1, 2) z
""")
oracle("a20_player_discipline", "feed_base", f"""
SELECT combo_id, team_id, player_id, {_DISCIPLINE} FROM feed_base GROUP BY 1, 2, 3 HAVING {n("etype = 'Foul'")} > 0
""")
oracle("a21_cards", "feed_base", f"""
SELECT c.combo_id, c.pos, c.team_id, c.player_id, c.qa AS card_type, c.minute, c.expanded_minute, c.period, c.x, c.y, f.x AS foul_x, f.y AS foul_y,
  CASE WHEN f.x IS NOT NULL THEN {_ZONE.format(x='f.x')} END AS foul_zone
FROM feed_base c LEFT JOIN (
  SELECT combo_id, event_id, arg_max(x, pos) AS x, arg_max(y, pos) AS y FROM feed_base GROUP BY 1, 2) f
  ON f.combo_id = c.combo_id AND f.event_id = c.rel_event_id
WHERE c.etype = 'Card'
""")
_KICK = f"(etype = 'Pass' AND NOT {q('KeeperThrow')})"
_LONG = f"({_KICK} AND {q('Longball')})"
_SAVE = f"(etype = 'Save' AND NOT {q('FromShotOffTarget')})"
_DG = "sqrt(((100 - {x}) * 1.05) * ((100 - {x}) * 1.05) + ((50 - {y}) * 0.68) * ((50 - {y}) * 0.68))"
oracle("a22_keepers", "feed_base squad", f"""
SELECT k.combo_id, k.team_id, k.player_id, e.* EXCLUDE (combo_id, player_id), t.goal_kicks, o.goals AS goals_conceded,
  e.saves + o.goals AS shots_on_target_faced, {pc('e.saves', 'e.saves + o.goals')} AS save_pct
FROM (SELECT DISTINCT combo_id, team_id, player_id, is_home FROM squad WHERE position = 'GK') k
JOIN (SELECT combo_id, player_id, {cnt(saves=_SAVE, saves_standing=f"etype = 'Save' AND {q('StandingSave')}", saves_diving=f"etype = 'Save' AND {q('DivingSave')}",
    saves_in_box="etype = 'Save' AND false", saves_out_of_box="etype = 'Save' AND false", saves_collected=f"etype = 'Save' AND {q('Collected')}",
    saves_parried_safe=f"etype = 'Save' AND {q('ParriedSafe')}", saves_parried_danger=f"etype = 'Save' AND {q('ParriedDanger')}",
    saves_with_head=f"etype = 'Save' AND {q('Head')}", saves_other_body_part=f"etype = 'Save' AND {q('OtherBodyPart')}",
    keeper_pickups="etype = 'KeeperPickup'", pickups_routine=f"etype = 'KeeperPickup' AND NOT {q('StandingSave')}",
    pickups_after_save=f"etype = 'KeeperPickup' AND {q('StandingSave')}", high_claims="etype = 'Aerial'", high_claims_won="etype = 'Aerial' AND ok",
    sweeper_actions="etype = 'KeeperSweeper'", punches="etype = 'Punch'", punches_accurate="etype = 'Punch' AND ok",
    distributions_total="etype IN ('Pass', 'Punch')", passes_total=_KICK, passes_accurate=f"{_KICK} AND ok", keeper_throws=f"etype = 'Pass' AND {q('KeeperThrow')}",
    longballs=_LONG, longballs_accurate=f"{_LONG} AND ok", short_passes=f"{_KICK} AND NOT {q('Longball')}", freekick_passes=f"{_KICK} AND {q('FreekickTaken')}",
    touches_outside_box="x > 17", passes_outside_box=f"{_KICK} AND x > 17", clearances="etype = 'Clearance'",
    progressive_passes=f"etype = 'Pass' AND ok AND end_x <> 0 AND x > 33.3 AND {_DG.format(x='end_x', y='end_y')} < {_DG.format(x='x', y='y')} * 0.75")},
    {pc(n("etype = 'Aerial' AND ok"), n("etype = 'Aerial'"))} AS high_claim_win_pct,
    CAST(NULL AS DOUBLE) AS avg_sweeper_x, CAST(NULL AS DOUBLE) AS avg_punch_distance_m,
    {pc(n(f"{_KICK} AND ok"), n(_KICK))} AS distribution_accuracy_pct, {pc(n(f"{_LONG} AND ok"), n(_LONG))} AS longball_accuracy_pct,
    {div(xs('length', _KICK), n(_KICK), 2)} AS avg_distribution_length_m, {pc(n(_LONG), n(_KICK))} AS long_kick_pct,
    {pc(n(f"{_KICK} AND NOT {q('Longball')}"), n(_KICK))} AS short_kick_pct
  FROM feed_base GROUP BY 1, 2) e ON e.combo_id = k.combo_id AND e.player_id = k.player_id
JOIN (SELECT combo_id, team_id, opp_id, {n(f"etype = 'Pass' AND {q('GoalKick')}")} AS goal_kicks, {n("etype = 'Goal'")} AS goals FROM feed_base GROUP BY 1, 2, 3) t
  ON t.combo_id = k.combo_id AND t.team_id = k.team_id
JOIN (SELECT combo_id, team_id, {n("etype = 'Goal'")} AS goals FROM feed_base GROUP BY 1, 2) o ON o.combo_id = k.combo_id AND o.team_id = t.opp_id
""")

# -- sequences ---------------------------------------------------------------------

_STOPS = "('End','Start','FormationSet','FormationChange','SubstitutionOn','SubstitutionOff','OffsideGiven')"
_RESTART = q("ThrowIn", "FreekickTaken", "CornerTaken", "GoalKick", "KickOff")
helper("seq_segments", "feed_base", f"""
SELECT *, sum(CASE WHEN hard OR restart THEN 1 ELSE 0 END) OVER w
    + coalesce(sum(CASE WHEN NOT hard AND NOT restart AND is_shot THEN 1 ELSE 0 END) OVER (PARTITION BY combo_id ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
FROM (SELECT *, row_number() OVER (PARTITION BY combo_id ORDER BY t_s, event_id, pos) AS o,
        etype IN {_STOPS} OR etype = 'Foul' OR (etype = 'Goal' AND {q('OwnGoal')}) AS hard,
        NOT (etype IN {_STOPS} OR etype = 'Foul' OR (etype = 'Goal' AND {q('OwnGoal')})) AND {_RESTART} AS restart
      FROM feed_base WHERE etype NOT IN ('CornerAwarded', 'Card')) z
WINDOW w AS (PARTITION BY combo_id ORDER BY o)
""")
helper("seq_marked", "seq_segments", """
SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY combo_id ORDER BY o) AS seq_id FROM (
  SELECT *, NOT hard AND (o = first_o OR team_id <> holder) AS starts FROM (
    SELECT *, arg_max(CASE WHEN o = first_o OR NOT weak THEN team_id END, CASE WHEN NOT hard AND (o = first_o OR NOT weak) THEN o END)
        OVER (PARTITION BY combo_id, seg ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS holder
    FROM (SELECT *, min(CASE WHEN NOT hard THEN o END) OVER (PARTITION BY combo_id, seg) AS first_o,
            etype IN ('Tackle', 'Challenge', 'Aerial') AND NOT ok AS weak FROM seq_segments) a) b
  WHERE hard OR NOT weak OR o = first_o OR team_id = holder) c
""")
helper("seq_events", "seq_marked", """
SELECT * FROM seq_marked WHERE NOT hard
""")
# The row that ends a sequence: the first later hard stop or sequence start.
helper("seq_ends", "seq_marked seq_events", """
SELECT s.combo_id, s.seq_id, s.team_id, s.n, s.first_type, s.last_shot, s.ev0, s.ev1, s.o0, s.o1,
  CASE WHEN s.last_shot AND NOT s.last_restart THEN NULL WHEN b.o IS NULL THEN 'End' WHEN b.restart THEN 'Restart' WHEN NOT b.hard THEN NULL
       WHEN b.etype = 'Foul' THEN CASE WHEN (CASE WHEN b.ok THEN b.team_id ELSE b.opp_id END) = s.team_id THEN 'FoulWon' ELSE 'FoulConceded' END
       WHEN b.etype = 'Goal' THEN CASE WHEN b.team_id <> s.team_id THEN 'OwnGoalFor' ELSE 'End' END ELSE b.etype END AS marker,
  CASE WHEN NOT (s.last_shot AND NOT s.last_restart) AND NOT b.hard THEN b.etype END AS next_type,
  CASE WHEN NOT (s.last_shot AND NOT s.last_restart) AND NOT b.hard THEN b.team_id END AS next_team
FROM (SELECT combo_id, seq_id, team_id, count(*) AS n, arg_min(etype, o) AS first_type, arg_max(is_shot, o) AS last_shot, arg_max(restart, o) AS last_restart,
        arg_min(event_id, o) AS ev0, arg_max(event_id, o) AS ev1, min(o) AS o0, max(o) AS o1
      FROM seq_events GROUP BY 1, 2, 3) s
LEFT JOIN (SELECT e.combo_id, e.seq_id, min(m.o) AS nxt FROM (SELECT combo_id, seq_id, max(o) AS o1 FROM seq_events GROUP BY 1, 2) e
      JOIN seq_marked m ON m.combo_id = e.combo_id AND m.o > e.o1 AND (m.hard OR m.starts) GROUP BY 1, 2) x ON x.combo_id = s.combo_id AND x.seq_id = s.seq_id
LEFT JOIN seq_marked b ON b.combo_id = x.combo_id AND b.o = x.nxt
""")
oracle("w06_sequences", "seq_ends", f"""
SELECT combo_id, {i('seq_id')} AS seq_id, team_id, n AS length, ev0 AS event_id_start, ev1 AS event_id_end, first_type, last_shot AS ends_in_shot, marker, next_type
FROM seq_ends
""")
# Stitching: walk over the fragments of a match one by one.
helper("seq_stitch", "seq_ends", """
SELECT combo_id, seq_id, mid AND rnk % 2 = 1 AS absorbed FROM (
  SELECT *, row_number() OVER (PARTITION BY combo_id, mid, isl ORDER BY seq_id) AS rnk FROM (
    SELECT *, seq_id - row_number() OVER (PARTITION BY combo_id, mid ORDER BY seq_id) AS isl FROM (
      SELECT k.combo_id, k.seq_id, coalesce(k.n = 1 AND k.first_type IN ('Clearance', 'BlockedPass', 'BallTouch', 'Punch') AND k.marker IS NULL
          AND a.team_id <> k.team_id AND a.team_id = b.team_id AND a.marker IS NULL AND NOT a.last_shot, false) AS mid
      FROM seq_ends k LEFT JOIN seq_ends a ON a.combo_id = k.combo_id AND a.seq_id = k.seq_id - 1
      LEFT JOIN seq_ends b ON b.combo_id = k.combo_id AND b.seq_id = k.seq_id + 1) x) y) z
""")
helper("seq_merged", "seq_stitch", """
SELECT combo_id, seq_id, absorbed, count(*) FILTER (WHERE NOT absorbed AND NOT prev) OVER (PARTITION BY combo_id ORDER BY seq_id) AS mid
FROM (SELECT *, coalesce(lag(absorbed) OVER (PARTITION BY combo_id ORDER BY seq_id), false) AS prev FROM seq_stitch) z
""")
helper("st_events", "seq_events seq_merged", """
SELECT e.* EXCLUDE (seq_id), m.mid AS seq_id, e.seq_id AS raw_id FROM seq_events e JOIN seq_merged m ON m.combo_id = e.combo_id AND m.seq_id = e.seq_id WHERE NOT m.absorbed
""")
helper("st_seqs", "st_events seq_ends", f"""
SELECT s.*, z.marker, z.next_type, z.next_team, s.length >= 2 OR s.t0 NOT IN ('Clearance','BallTouch','BlockedPass','Punch','Aerial','Save') AS real
FROM (
  SELECT combo_id, seq_id, team_id, count(*) AS length, min(t_s) AS start_t, max(t_s) AS end_t, max(raw_id) AS last_raw,
    arg_min(x, o) AS x0, arg_max(x, o) AS x1, arg_min(y, o) AS y0, arg_max(y, o) AS y1, arg_min(event_id, o) AS e0, arg_max(event_id, o) AS e1,
    arg_min(player_id, o) AS p0, arg_max(player_id, o) AS p1, arg_min(etype, o) AS t0, arg_max(etype, o) AS t1, arg_min(restart, o) AS restart0,
    arg_max(is_shot, o) AS shot1, arg_max({q('Blocked')}, o) AS blocked1, {n("etype = 'Pass'")} AS n_passes,
    bool_or(x > 66.6) AS reaches, bool_or(is_touch AND x >= {K.BOX_X_MIN!r}::DOUBLE AND y >= {K.BOX_Y_MIN!r}::DOUBLE AND y <= {K.BOX_Y_MAX!r}::DOUBLE) AS in_box,
    {xs('dx', 'dx > 0')} AS fwd, {xs('abs(dx)')} AS move
  FROM (SELECT *, x - lag(x) OVER (PARTITION BY combo_id, seq_id ORDER BY o) AS dx FROM st_events) v GROUP BY 1, 2, 3) s
JOIN seq_ends z ON z.combo_id = s.combo_id AND z.seq_id = s.last_raw
""")
oracle("w07_stitched", "st_seqs", "SELECT combo_id, seq_id, team_id, length, start_t, end_t, real, marker FROM st_seqs")
helper("st_chain", "st_seqs", """
SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY combo_id ORDER BY seq_id) - 1 AS possession_id FROM (
  SELECT *, team_id IS DISTINCT FROM lag(team_id) OVER (PARTITION BY combo_id ORDER BY seq_id) AS opens FROM st_seqs WHERE real) z
""")
oracle("w09_possessions", "st_chain st_events", f"""
SELECT p.combo_id, {i('p.possession_id')} AS possession_id, p.team_id, p.sequences, p.end_t - p.start_t AS duration_s, p.has_shot,
  NOT p.restart0 AND p.x0 <= 50 AND coalesce(d.deep_t - p.start_t <= 10, false) AS is_counter
FROM (SELECT combo_id, possession_id, team_id, count(*) AS sequences, min(start_t) AS start_t, max(end_t) AS end_t, bool_or(shot1) AS has_shot,
        arg_min(restart0, seq_id) AS restart0, arg_min(x0, seq_id) AS x0 FROM st_chain GROUP BY 1, 2, 3) p
LEFT JOIN (SELECT e.combo_id, c.possession_id, min(e.t_s) AS deep_t FROM st_events e JOIN st_chain c ON c.combo_id = e.combo_id AND c.seq_id = e.seq_id
      WHERE e.x > 66.6 GROUP BY 1, 2) d ON d.combo_id = p.combo_id AND d.possession_id = p.possession_id
""")
helper("st_flags", "st_chain", """
SELECT *, NOT restart0 AND n_passes >= 10 AS ten, NOT restart0 AND n_passes >= 10 AND (shot1 OR in_box) AS build,
  NOT restart0 AND x0 <= 50 AND (shot1 OR in_box) AND coalesce(fwd, 0) / nullif(move, 0) >= 0.5 AND length >= 2 AS direct,
  NOT restart0 AND opens AND sqrt(((100 - x0) * 1.05) * ((100 - x0) * 1.05) + ((50 - y0) * 0.68) * ((50 - y0) * 0.68)) <= 40 AS high,
  outcome IN ('goal', 'saved', 'blocked', 'off_target') AS shot
FROM (SELECT *, CASE
    WHEN shot1 AND t1 = 'SavedShot' THEN CASE WHEN blocked1 THEN 'blocked' ELSE 'saved' END WHEN shot1 AND t1 = 'Goal' THEN 'goal' WHEN shot1 THEN 'off_target'
    WHEN marker = 'FoulWon' THEN 'foul_won' WHEN marker = 'FoulConceded' THEN 'foul_conceded' WHEN marker = 'OwnGoalFor' THEN 'goal'
    WHEN marker = 'Restart' AND next_team = team_id THEN 'set_piece_won' WHEN marker = 'Restart' THEN 'out_of_play' WHEN marker = 'OffsideGiven' THEN 'offside'
    WHEN marker IN ('End', 'SubstitutionOff', 'SubstitutionOn', 'FormationChange', 'FormationSet') THEN NULL
    WHEN next_type IN ('Tackle','Challenge','Interception','BlockedPass','BallRecovery','KeeperPickup','KeeperSweeper','Save') THEN 'dispossessed'
    WHEN next_type IS NOT NULL THEN 'turnover' END AS outcome FROM st_chain) z
WHERE outcome IS NOT NULL
""")
oracle("w10_sequence_rows", "st_flags st_events", f"""
SELECT f.combo_id, f.team_id, f.seq_id, {i('f.possession_id')} AS possession_id, f.length, f.end_t - f.start_t AS duration_s, {rd('f.x0', 1)} AS start_x, {rd('f.y0', 1)} AS start_y,
  {rd('f.x1', 1)} AS end_x, {rd('f.y1', 1)} AS end_y, f.n_passes, NOT f.restart0 AS is_open_play, f.shot AS is_shot, f.ten AS is_ten_plus_pass,
  f.build AS is_build_up_attack, coalesce(f.direct, false) AS is_direct_attack, f.high AS is_high_turnover, f.outcome, f.e0 AS event_id_start, f.e1 AS event_id_end,
  f.p0 AS player_id_start, f.p1 AS player_id_end, p.player_ids
FROM st_flags f JOIN (SELECT combo_id, seq_id, string_agg(CAST(player_id AS VARCHAR), ',' ORDER BY o) AS player_ids
  FROM (SELECT combo_id, seq_id, player_id, min(o) AS o FROM st_events GROUP BY 1, 2, 3) z GROUP BY 1, 2) p ON p.combo_id = f.combo_id AND p.seq_id = f.seq_id
""")


def _mean(v: str, c: str) -> str:
    return div(f"sum(CASE WHEN {c} THEN {v} END)", n(c), 1)


_DUR = "(end_t - start_t)"
_ATT = "(reaches AND length >= 2)"
_DS = f"(NOT restart0 AND x0 <= 50 AND {_DUR} > 0)"
oracle("a23_team_poss_adv", "st_flags w09_possessions a08_field_tilt_poss a06_ppda_poss shares feed_base", f"""
SELECT b.combo_id, b.team_id, b.good AS passes_accurate, {div('b.good', '(s.share * b.whole)', 2)} AS passing_rate, {rd('s.share * b.whole', 1)} AS possession_minutes,
  t.field_tilt_pct, t.field_tilt_passes_pct, t.final_third_touches, d.ppda, q.* EXCLUDE (combo_id, team_id), p.* EXCLUDE (combo_id, team_id)
FROM (SELECT combo_id, team_id, {n(f"{BASE} AND ok")} AS good, max(max(expanded_minute)) OVER (PARTITION BY combo_id) AS whole FROM feed_base GROUP BY 1, 2) b
JOIN shares s ON s.combo_id = b.combo_id AND s.team_id = b.team_id
JOIN a08_field_tilt_poss t ON t.combo_id = b.combo_id AND t.team_id = b.team_id
JOIN a06_ppda_poss d ON d.combo_id = b.combo_id AND d.team_id = b.team_id
JOIN (SELECT combo_id, team_id, count(*) AS sequences_total, {cnt(open_play_sequences='NOT restart0', ten_plus_pass_sequences='ten', build_up_attacks='build',
    direct_attacks='direct', high_turnovers='high', high_turnover_shots='high AND shot', shot_sequences='shot', attack_sequences=_ATT)},
    {_mean(_DUR, 'true')} AS avg_sequence_time_s, {_mean('length', 'true')} AS avg_sequence_length, {_mean('n_passes', 'true')} AS passes_per_sequence,
    {div(f"{xs('x0', 'NOT restart0')} * 1.05", n('NOT restart0'), 1)} AS start_distance_m,
    {div(xs('greatest(0, x1 - x0) * 1.05', _DS), f"sum(CASE WHEN {_DS} THEN {_DUR} END)", 2)} AS direct_speed_m_s,
    {pc(n('shot'), 'count(*)', 1)} AS shot_seq_pct, {_mean('length', 'shot')} AS avg_shot_seq_length, {_mean(_DUR, 'shot')} AS avg_shot_seq_duration_s,
    {_mean('n_passes', 'shot')} AS avg_shot_seq_passes, {_mean(_DUR, _ATT)} AS avg_attack_duration_s, {_mean('n_passes', _ATT)} AS avg_attack_passes,
    {pc(n("outcome IN ('turnover', 'dispossessed')"), 'count(*)', 1)} AS open_play_turnover_pct,
    {pc(n("outcome IN ('turnover', 'dispossessed', 'out_of_play')"), 'count(*)', 1)} AS possession_loss_pct,
    {pc(n("outcome IN ('foul_won', 'set_piece_won', 'foul_conceded', 'offside')"), 'count(*)', 1)} AS set_piece_end_pct
  FROM st_flags GROUP BY 1, 2) q ON q.combo_id = b.combo_id AND q.team_id = b.team_id
JOIN (SELECT combo_id, team_id, count(*) AS possessions_total, {_mean('duration_s', 'true')} AS avg_possession_duration_s,
    {div('sum(sequences)', 'count(*)', 2)} AS avg_sequences_per_possession, {n('is_counter')} AS counter_attack_sequences,
    {pc(n('is_counter AND has_shot'), n('is_counter'), 1)} AS counter_attack_shot_pct
  FROM w09_possessions GROUP BY 1, 2) p ON p.combo_id = b.combo_id AND p.team_id = b.team_id
""")

# -- states ------------------------------------------------------------------------

helper("bounds", "feed_base", """
SELECT combo_id, home_id, away_id, period, min(t_s) FILTER (WHERE etype = 'Start') AS s, max(t_s) FILTER (WHERE etype = 'End') AS e,
  min(t_s - minute * 60 - second) FILTER (WHERE etype = 'Start') AS shift
FROM feed_base GROUP BY 1, 2, 3, 4
""")
helper("changes", "feed_base bounds", f"""
SELECT c.combo_id, b.period, greatest(c.t_s, b.s) AS cut, c.t_s, c.event_id, c.pos, c.goal, c.home FROM (
  SELECT f.combo_id, f.t_s, f.event_id, f.pos, f.etype = 'Goal' AS goal,
    CASE WHEN f.etype = 'Goal' AND {q('OwnGoal')} THEN f.team_id <> f.home_id ELSE f.team_id = f.home_id END AS home,
    (SELECT min(b.period) FROM bounds b WHERE b.combo_id = f.combo_id AND b.e >= f.t_s) AS p
  FROM feed_base f WHERE f.etype = 'Goal' OR (f.etype = 'Card' AND {q('Red', 'SecondYellow')})) c
JOIN bounds b ON b.combo_id = c.combo_id AND b.period = c.p
""")


def _clock(t: str, shift: str, period: str) -> tuple[str, str, str]:
    c = f"greatest(0, {t} - coalesce({shift}, 0))"
    minute, second = f"CAST(floor(({c}) / 60) AS BIGINT)", f"CAST(({c}) % 60 AS BIGINT)"
    shown = f"(CASE WHEN {second} > 0 THEN {minute} + 1 ELSE greatest({minute}, 1) END)"
    nominal = f"(CASE {period} WHEN 1 THEN 45 WHEN 2 THEN 90 WHEN 3 THEN 105 ELSE 120 END)"
    display = f"CASE WHEN {shown} > {nominal} THEN concat({nominal}, '+', {shown} - {nominal}, '''') ELSE concat({shown}, '''') END"
    return minute, second, display


_SM, _SS, _SD = _clock("start_s", "shift", "period")
_EM, _ES, _ED = _clock("end_s", "shift", "period")
oracle("w12_states", "bounds changes", f"""
WITH pts AS (SELECT combo_id, period, s AS t FROM bounds UNION SELECT combo_id, period, e FROM bounds UNION SELECT combo_id, period, cut FROM changes),
iv AS (SELECT * FROM (SELECT combo_id, period, t AS start_s, lead(t) OVER (PARTITION BY combo_id, period ORDER BY t) AS end_s FROM pts) z WHERE end_s IS NOT NULL),
sc AS (
  SELECT i.combo_id, i.period, i.start_s, i.end_s, {cnt(hs='c.goal AND c.home', aws='c.goal AND NOT c.home', hr='NOT c.goal AND c.home', ar='NOT c.goal AND NOT c.home')},
    arg_max(concat(CASE WHEN c.goal THEN 'goal_' ELSE 'red_card_' END, CASE WHEN c.home THEN 'home' ELSE 'away' END), (c.t_s, c.event_id, c.pos))
      FILTER (WHERE c.period = i.period AND c.cut = i.start_s) AS trg
  FROM iv i LEFT JOIN changes c ON c.combo_id = i.combo_id AND (c.period < i.period OR (c.period = i.period AND c.cut <= i.start_s))
  GROUP BY 1, 2, 3, 4)
SELECT s.combo_id, row_number() OVER (PARTITION BY s.combo_id ORDER BY s.period, s.start_s) - 1 AS state_id, s.period, start_s, end_s, end_s - start_s AS duration_s,
  b.home_id, b.away_id, hs AS home_score, aws AS away_score, 11 - hr AS home_players, 11 - ar AS away_players,
  coalesce(trg, CASE WHEN s.period = 1 THEN 'kickoff' ELSE 'period_start' END) AS trigger, hs - aws AS home_score_diff, ar - hr AS man_diff_home,
  {_SM.replace('period', 's.period')} AS start_minute, {_SS} AS start_second, {_SD.replace('CASE period', 'CASE s.period')} AS start_display,
  {_EM} AS end_minute, {_ES} AS end_second, {_ED.replace('CASE period', 'CASE s.period')} AS end_display
FROM sc s JOIN bounds b ON b.combo_id = s.combo_id AND b.period = s.period
""")
_BUCKET = "CASE WHEN {d} <= -2 THEN 'trailing_2plus' WHEN {d} = -1 THEN 'trailing_1' WHEN {d} = 0 THEN 'level' WHEN {d} = 1 THEN 'leading_1' ELSE 'leading_2plus' END"
_MEN = "CASE WHEN {d} = 0 THEN 'even' WHEN {d} > 0 THEN 'up' ELSE 'down' END"
oracle("w13_team_states", "w12_states", f"""
SELECT combo_id, state_id, team_id, opponent_id, is_home, period, start_s, end_s, duration_s, start_minute, end_minute, start_display, end_display,
  score_for, score_against, score_for - score_against AS score_diff, {_BUCKET.format(d='(score_for - score_against)')} AS score_bucket, man_diff,
  {_MEN.format(d='man_diff')} AS man_state, trigger
FROM (SELECT *, home_id AS team_id, away_id AS opponent_id, true AS is_home, home_score AS score_for, away_score AS score_against, man_diff_home AS man_diff FROM w12_states
  UNION ALL SELECT *, away_id, home_id, false, away_score, home_score, -man_diff_home FROM w12_states) z
""")


def _at(t: str, rows: str) -> str:
    """State id at a time: first interval that ends at or after it, else the last."""
    return (f"coalesce((SELECT min(w.state_id) FROM w12_states w WHERE w.combo_id = {rows}.combo_id AND w.end_s >= {t}), "
            f"(SELECT max(w.state_id) FROM w12_states w WHERE w.combo_id = {rows}.combo_id))")


helper("event_state", "feed_base w12_states", f"SELECT f.*, {_at('f.t_s', 'f')} AS state_id FROM feed_base f")
oracle("w15_state_tags", "event_state w13_team_states", """
SELECT e.combo_id, e.pos, e.team_id, e.state_id, s.period, s.score_diff, s.score_bucket, s.man_diff, s.man_state
FROM event_state e JOIN w13_team_states s ON s.combo_id = e.combo_id AND s.state_id = e.state_id AND s.team_id = e.team_id
""")
_CM, _CS, _CD = _clock("r.time_s", "b.shift", "r.period")
oracle("w14_context", "feed_base formations bounds w12_states w13_team_states", f"""
WITH r AS (
  SELECT combo_id, CASE WHEN etype = 'Goal' AND qa = 'OwnGoal' THEN opp_id ELSE team_id END AS team_id, period, t_s AS look_s, t_s AS time_s,
    CASE WHEN etype = 'Goal' AND qa = 'OwnGoal' THEN 'own_goal' WHEN etype = 'Goal' AND qa = 'Penalty' THEN 'penalty_goal' WHEN etype = 'Goal' THEN 'goal'
         WHEN etype = 'SubstitutionOn' THEN 'substitution' WHEN qa = 'Red' THEN 'red_card' WHEN qa = 'SecondYellow' THEN 'second_yellow' ELSE 'yellow_card' END AS event_type,
    CASE WHEN etype <> 'SubstitutionOn' THEN player_id END AS player_id, CASE WHEN etype = 'SubstitutionOn' THEN player_id END AS player_in_id,
    related_player_id AS player_out_id, CAST(NULL AS VARCHAR) AS detail
  FROM feed_base WHERE etype IN ('Goal', 'Card', 'SubstitutionOn')
  UNION ALL
  SELECT combo_id, team_id, coalesce((SELECT min(b.period) FROM bounds b WHERE b.combo_id = z.combo_id AND b.s <= z.start_minute * 60 AND b.e > z.start_minute * 60), 1),
    start_minute * 60 + 1, start_minute * 60, 'formation_change', NULL, NULL, NULL, concat(was, '->', formation_name)
  FROM (SELECT *, lag(formation_name) OVER (PARTITION BY combo_id, team_id ORDER BY formation_index) AS was FROM formations) z WHERE was <> formation_name),
a AS (SELECT r.*, {_at('r.look_s', 'r')} AS state_id FROM r)
SELECT r.combo_id, r.team_id, r.state_id, s.score_diff AS score_diff_at, s.man_state AS man_state_at, r.period, {_CM} AS minute, {_CS} AS second, {_CD} AS minute_display,
  r.time_s, r.event_type, r.player_id, r.player_in_id, r.player_out_id, r.detail
FROM a r JOIN w13_team_states s ON s.combo_id = r.combo_id AND s.state_id = r.state_id AND s.team_id = r.team_id
LEFT JOIN bounds b ON b.combo_id = r.combo_id AND b.period = r.period
""")
helper("assist_marks", "feed_base", """
SELECT DISTINCT combo_id, event_id FROM (
  SELECT g.combo_id, g.rel_event_id AS event_id, g.team_id, arg_max(e.team_id, (e.t_s, e.pos)) AS a_team
  FROM feed_base g JOIN feed_base e ON e.combo_id = g.combo_id AND e.event_id = g.rel_event_id
  WHERE g.etype = 'Goal' AND g.qa = 'Assisted' GROUP BY g.combo_id, g.pos, g.rel_event_id, g.team_id) z WHERE a_team = team_id
""")
_AGG = cnt(
    touches="is_touch", final_third_touches="is_touch AND x > 66.6",
    box_touches=f"is_touch AND x >= {K.BOX_X_MIN!r}::DOUBLE AND y >= {K.BOX_Y_MIN!r}::DOUBLE AND y <= {K.BOX_Y_MAX!r}::DOUBLE", shots="is_shot",
    shots_on_target=f"etype = 'Goal' OR (etype = 'SavedShot' AND NOT {q('Blocked')})", goals="etype = 'Goal'", key_passes=f"{KEY} AND NOT made",
    key_passes_open_play=f"{KEY} AND NOT made AND NOT {DEAD_STATE}", assists="made", big_chances_created=BIG,
    big_chances_created_open_play=f"{BIG} AND NOT {DEAD_STATE}", big_chances=f"is_shot AND {q('BigChance')}", big_chances_scored=f"etype = 'Goal' AND {q('BigChance')}",
    passes=BASE, passes_completed=f"{BASE} AND ok", crosses=CROSS, corners=f"etype = 'Pass' AND {q('CornerTaken')}", fouls_committed=_MADE,
    fouls_won="etype = 'Foul' AND ok", offsides="etype = 'OffsideGiven'", yellow_cards="etype = 'Card' AND qa = 'Yellow'",
    red_cards="etype = 'Card' AND qa IN ('Red', 'SecondYellow')", subs_made="etype = 'SubstitutionOn'", take_ons="etype = 'TakeOn'", take_ons_won="etype = 'TakeOn' AND ok",
    tackles="etype = 'Tackle'", interceptions="etype = 'Interception'", clearances="etype = 'Clearance'", aerials_won="etype = 'Aerial' AND ok",
    aerials_total="etype = 'Aerial'", defensive_actions="etype IN ('Foul', 'Tackle', 'Interception', 'Challenge', 'BlockedPass') AND x >= 33.4")
_DELTA = f"({xt('end_x', 'end_y')} - {xt('x', 'y')})"
oracle("a24_state_agg", "event_state w13_team_states assist_marks possession_minutes w12_states", f"""
WITH ev AS (SELECT e.*, a.event_id IS NOT NULL AS made FROM event_state e LEFT JOIN assist_marks a ON a.combo_id = e.combo_id AND a.event_id = e.event_id),
tagged AS (SELECT ev.*, s.score_bucket AS sb, s.man_state AS ms, s.period AS sp FROM ev JOIN w13_team_states s ON s.combo_id = ev.combo_id AND s.state_id = ev.state_id AND s.team_id = ev.team_id),
opp AS (SELECT ev.combo_id, ev.opp_id AS team_id, s.score_bucket AS sb, s.man_state AS ms, s.period AS sp, {n('is_touch AND x > 66.6')} AS ft, {n("etype = 'Pass' AND x <= 66.6")} AS faced
  FROM ev JOIN w13_team_states s ON s.combo_id = ev.combo_id AND s.state_id = ev.state_id AND s.team_id = ev.opp_id GROUP BY 1, 2, 3, 4, 5),
own AS (SELECT combo_id, team_id, sb, ms, sp, {_AGG}, coalesce({rd(xs(_DELTA, BASE), 4)}, 0) AS xt_total, coalesce({rd(xs(_DELTA, f'{BASE} AND {_DELTA} > 0'), 4)}, 0) AS xt_positive
  FROM tagged GROUP BY 1, 2, 3, 4, 5),
pm AS (SELECT p.combo_id, p.team_id, p.value, {_at('p.minute * 60 + 30', 'p')} AS state_id FROM possession_minutes p),
po AS (SELECT s.combo_id, s.team_id, s.score_bucket AS sb, s.man_state AS ms, s.period AS sp, sum(pm.value) FILTER (WHERE pm.team_id = s.team_id) AS mine, sum(pm.value) AS everything
  FROM w13_team_states s JOIN pm ON pm.combo_id = s.combo_id AND pm.state_id = s.state_id GROUP BY 1, 2, 3, 4, 5),
st AS (SELECT combo_id, team_id, score_bucket AS sb, man_state AS ms, period AS sp, {rd('sum(duration_s) / 60', 1)} AS minutes, string_agg(CAST(state_id AS VARCHAR), ',' ORDER BY state_id) AS state_ids
  FROM w13_team_states GROUP BY 1, 2, 3, 4, 5)
SELECT st.combo_id, st.team_id, st.sp AS period, st.sb AS score_bucket, st.ms AS man_state, st.state_ids, st.minutes,
  {", ".join(f"coalesce(own.{c.split(' AS ')[-1]}, 0) AS {c.split(' AS ')[-1]}" for c in _AGG.split(",\n  "))},
  coalesce(own.xt_total, 0) AS xt_total, coalesce(own.xt_positive, 0) AS xt_positive,
  {pc('coalesce(po.mine, 0)', 'po.everything', 1)} AS possession_pct,
  {pc('coalesce(own.final_third_touches, 0)', '(coalesce(own.final_third_touches, 0) + coalesce(opp.ft, 0))', 1)} AS field_tilt_pct,
  {pc('own.passes_completed', 'own.passes', 1)} AS pass_accuracy_pct, {div('coalesce(opp.faced, 0)', 'own.defensive_actions', 2)} AS ppda
FROM st LEFT JOIN own USING (combo_id, team_id, sb, ms, sp) LEFT JOIN opp USING (combo_id, team_id, sb, ms, sp) LEFT JOIN po USING (combo_id, team_id, sb, ms, sp)
""")

# -- identity ----------------------------------------------------------------------

_NN = "regexp_replace(lower({c}), '[^a-z]', '', 'g')"


def _ladder(name: str, prov: str) -> None:
    oracle_or_helper = HELPERS
    oracle_or_helper[name] = (["ev_lineups", prov], f"""
SELECT combo_id, is_home_team, anchor_id, prov_id, tier FROM (
WITH w AS (SELECT combo_id, is_home_team AS h, shirt_number AS s, player_id AS a, {_NN.format(c='player_name')} AS nn FROM ev_lineups),
p AS (SELECT combo_id, is_home_team AS h, shirt_number AS s, player_id AS b, {_NN.format(c='player_name')} AS nn FROM {prov}),
ex AS (SELECT w.combo_id, w.h, a, b FROM w JOIN p ON p.combo_id = w.combo_id AND p.h = w.h AND p.s = w.s),
w1 AS (SELECT *, count(*) OVER (PARTITION BY combo_id, h) AS c FROM w WHERE (combo_id, h, a) NOT IN (SELECT combo_id, h, a FROM ex)),
p1 AS (SELECT *, count(*) OVER (PARTITION BY combo_id, h) AS c FROM p WHERE (combo_id, h, b) NOT IN (SELECT combo_id, h, b FROM ex)),
el AS (SELECT w1.combo_id, w1.h, a, b FROM w1 JOIN p1 ON p1.combo_id = w1.combo_id AND p1.h = w1.h WHERE w1.c = 1 AND p1.c = 1),
nm AS (SELECT w1.combo_id, w1.h, a, b FROM w1 JOIN p1 ON p1.combo_id = w1.combo_id AND p1.h = w1.h AND p1.nn = w1.nn AND length(w1.nn) > 0
  WHERE (w1.combo_id, w1.h, a) NOT IN (SELECT combo_id, h, a FROM el) AND (p1.combo_id, p1.h, b) NOT IN (SELECT combo_id, h, b FROM el))
SELECT combo_id, h AS is_home_team, a AS anchor_id, b AS prov_id, 'exact' AS tier FROM ex UNION ALL SELECT *, 'elimination' FROM el UNION ALL SELECT *, 'name' FROM nm) z""")


helper("rd_named", "rd_lineups rd_players", "SELECT l.*, p.name AS player_name FROM rd_lineups l LEFT JOIN rd_players p ON p.player_id = l.player_id")
_ladder("obs_xg", "xg_lineups")
_ladder("obs_rd", "rd_named")


def _winner(obs: str) -> str:
    return (f"(SELECT anchor_id, prov_id, votes FROM (SELECT anchor_id, prov_id, count(*) AS votes, row_number() OVER (PARTITION BY anchor_id "
            f"ORDER BY count(*) DESC, prov_id) AS rn FROM {obs} GROUP BY 1, 2) v WHERE rn = 1)")


oracle("x01_observations", "obs_xg", "SELECT * FROM obs_xg")
oracle("x02_vote", "obs_xg", f"SELECT * FROM {_winner('obs_xg')} z")
oracle("x03_player_xwalk", "obs_xg obs_rd ev_lineups", f"""
SELECT u.player_id AS player_uid, u.player_id AS ev_player_id, r.prov_id AS rd_player_id, x.prov_id AS xg_player_id
FROM (SELECT DISTINCT player_id FROM ev_lineups) u LEFT JOIN {_winner('obs_rd')} r ON r.anchor_id = u.player_id LEFT JOIN {_winner('obs_xg')} x ON x.anchor_id = u.player_id
""")
for _p in ("xg", "rd"):
    helper(f"team_obs_{_p}", f"ev_lineups {_p}_lineups", f"""
SELECT e.team_id AS anchor_id, p.team_id AS prov_id FROM (SELECT DISTINCT combo_id, is_home_team, team_id FROM ev_lineups) e
JOIN (SELECT DISTINCT combo_id, is_home_team, team_id FROM {_p}_lineups) p ON p.combo_id = e.combo_id AND p.is_home_team = e.is_home_team""")
oracle("x04_team_xwalk", "team_obs_xg team_obs_rd ev_lineups", f"""
SELECT u.team_id AS team_uid, u.team_id AS ev_team_id, r.prov_id AS rd_team_id, x.prov_id AS xg_team_id
FROM (SELECT DISTINCT team_id FROM ev_lineups) u LEFT JOIN {_winner('team_obs_rd')} r ON r.anchor_id = u.team_id LEFT JOIN {_winner('team_obs_xg')} x ON x.anchor_id = u.team_id
""")
oracle("x05_coach_xwalk", "xg_match rd_matches", """
SELECT manager_id, xg_coach_id FROM (
  SELECT manager_id, xg_coach_id, row_number() OVER (PARTITION BY manager_id ORDER BY count(*) DESC, xg_coach_id) AS rn FROM (
    SELECT r.home_manager_id AS manager_id, x.ht_coach_id AS xg_coach_id FROM xg_match x JOIN rd_matches r ON r.combo_id = x.combo_id
    UNION ALL SELECT r.away_manager_id, x.at_coach_id FROM xg_match x JOIN rd_matches r ON r.combo_id = x.combo_id) z
  WHERE manager_id IS NOT NULL AND xg_coach_id IS NOT NULL GROUP BY 1, 2) v WHERE rn = 1
""")


# -- shots and teams with creators ---------------------------------------------------

oracle("a12_shots_with_creators", "a12_shots w01_sca", """
SELECT s.*, a.player_id AS sca_1_player_id, a.kind AS sca_1_type, b.player_id AS sca_2_player_id, b.kind AS sca_2_type
FROM a12_shots s LEFT JOIN w01_sca a ON a.combo_id = s.combo_id AND a.shot_pos = s.pos AND a.slot = 1
LEFT JOIN w01_sca b ON b.combo_id = s.combo_id AND b.shot_pos = s.pos AND b.slot = 2
""")
oracle("a14_team_shooting_full", "a13_team_shooting a14_sca_totals", """
SELECT s.*, coalesce(c.sca, 0) AS sca_total, coalesce(sca_pass_live, 0) AS sca_pass_live, coalesce(sca_pass_dead, 0) AS sca_pass_dead,
  coalesce(sca_take_on, 0) AS sca_take_on, coalesce(sca_shot, 0) AS sca_shot, coalesce(sca_fouled, 0) AS sca_fouled, coalesce(sca_defense, 0) AS sca_defense,
  coalesce(shots_with_sca, 0) AS shots_with_sca
FROM a13_team_shooting s LEFT JOIN (SELECT * FROM a14_sca_totals WHERE player_id IS NULL) c ON c.combo_id = s.combo_id AND c.team_id = s.team_id
""")

# -- staging ---------------------------------------------------------------------------

RAW_SQL = {
    "ev_avg_positions": "a10_avg_position", "ev_context_events": "w14_context", "ev_formations": "formations", "ev_game_states": "w12_states",
    "ev_lineups": "ev_lineups", "ev_match_meta": "ev_match_meta", "ev_pass_map": "a03_pass_map", "ev_pass_network": "a11_pass_network",
    "ev_player_defending": "a18_player_defending", "ev_player_discipline": "a20_player_discipline", "ev_player_goalkeep": "a22_keepers",
    "ev_player_passing": "a02_player_passing", "ev_player_passing_adv": "a09_player_passing_adv", "ev_player_possession": "a16_player_possession",
    "ev_player_shooting": "a14_player_shooting_full", "ev_sequences": "w10_sequence_rows", "ev_shots": "a12_shots_with_creators",
    "ev_team_defending": "a17_team_defending", "ev_team_discipline": "a19_team_discipline", "ev_team_passing": "a01_team_passing",
    "ev_team_passing_adv": "a04_team_passing_adv", "ev_team_poss_adv": "a23_team_poss_adv", "ev_team_possession": "a15_team_possession",
    "ev_team_shooting": "a14_team_shooting_full", "ev_team_state_agg": "a24_state_agg", "ev_team_states": "w13_team_states",
}
_NUM = "CASE WHEN regexp_matches({c}, '[0-9]') THEN TRY_CAST(regexp_replace({c}, '^[^0-9.\\-]*([0-9]+\\.?[0-9]*).*$', '\\1') AS DOUBLE) END AS {c}"
_CAST = {"xg_player_stats": ["accurate_passes", "duels_won"], "xg_team_stats": ["pass_home", "pass_away", "tackle_home", "tackle_away"],
         "rd_match_stats": ["fouls_homevalue", "fouls_awayvalue"], "rd_player_stats": ["match_rating", "totalpass"]}
STAGE_KEY: dict[str, str] = {}
_PLAYER_UID = {"ev_pass_network": False}


def _stage_oracles() -> None:
    from .staging import STAGED

    for k, (name, rule) in enumerate(STAGED.items(), 1):
        key = STAGE_KEY[name] = f"g{k:02d}_{name}"
        src, prov = RAW_SQL.get(name, name), name[:2]
        needs, cols, joins = [src], [], ""
        cast = _CAST.get(name)
        cols.append("r.*" if not cast else "r.* REPLACE (" + ", ".join(_NUM.format(c=c) for c in cast) + ")")
        for on, what, xw, alias in ((rule.player, "player", "x03_player_xwalk", "p"), (rule.team, "team", "x04_team_xwalk", "t")):
            if on:
                needs.append(xw)
                joins += f" LEFT JOIN {xw} {alias} ON {alias}.{prov}_{what}_id = r.{what}_id"
                cols.append(f"coalesce({alias}.{what}_uid, r.{what}_id) AS {what}_uid" if prov == "ev" else f"{alias}.{what}_uid")
        oracle(key, " ".join(needs), f"SELECT {', '.join(cols)} FROM {src} r{joins}")


_stage_oracles()


def mart(key: str, staged: str, sql: str, more: str = "") -> None:
    """`{name}` in the text stands for the staged view of that name."""
    names = staged.split()
    oracle(key, " ".join(STAGE_KEY[s] for s in names) + " " + more, sql.format(**{s: STAGE_KEY[s] for s in names}))


mart("m01_dim_competition", "rd_tournaments", "SELECT tournament_id AS competition_uid, name, country, tier FROM {rd_tournaments}")
mart("m02_dim_season", "rd_seasons", "SELECT season_id AS season_uid, name, year, tournament_id AS competition_uid FROM {rd_seasons}")
mart("m03_dim_referee", "rd_referees", "SELECT referee_id AS referee_uid, name, nationality, games, yellow_cards, red_cards, double_yellow_cards FROM {rd_referees}")
mart("m04_dim_coach", "rd_managers", """
SELECT m.manager_id AS coach_uid, m.name, m.shortname, m.slug, v.xg_coach_id FROM {rd_managers} m LEFT JOIN x05_coach_xwalk v ON v.manager_id = m.manager_id
""", "x05_coach_xwalk")
mart("m05_dim_team", "rd_teams ev_lineups", """
SELECT x.team_uid, x.ev_team_id, x.rd_team_id, x.xg_team_id, coalesce(s.name, n.own) AS name, s.country, s.city, s.stadium, s.stadium_capacity, s.founded_date
FROM x04_team_xwalk x LEFT JOIN {rd_teams} s ON s.team_uid = x.team_uid LEFT JOIN (SELECT team_uid, max(team_name) AS own FROM {ev_lineups} GROUP BY 1) n ON n.team_uid = x.team_uid
""", "x04_team_xwalk")
mart("m06_dim_match", "ev_match_meta xg_match rd_matches", """
SELECT w.combo_id, hx.team_uid AS home_team_uid, ax.team_uid AS away_team_uid, s.home_manager_id AS home_coach_uid, s.away_manager_id AS away_coach_uid,
  s.referee_id AS referee_uid, s.tournament_id AS competition_uid, s.season_id AS season_uid, w.attendance, f.match_round, f.home_score, f.away_score, f.match_date,
  f.stadium_name, f.stadium_city, f.stadium_capacity, f.home_color, f.away_color, f.has_shot_data, f.has_momentum_data, f.motm_id, f.motm_rating,
  s.winnercode, s.has_shotmap, s.has_xg, s.home_formation, s.away_formation
FROM {ev_match_meta} w LEFT JOIN {xg_match} f ON f.combo_id = w.combo_id LEFT JOIN {rd_matches} s ON s.combo_id = w.combo_id
LEFT JOIN x04_team_xwalk hx ON hx.ev_team_id = w.home_team_id LEFT JOIN x04_team_xwalk ax ON ax.ev_team_id = w.away_team_id
""", "x04_team_xwalk")
mart("m07_dim_player", "rd_players ev_lineups xg_lineups", """
SELECT x.player_uid, x.ev_player_id, x.rd_player_id, x.xg_player_id, coalesce(s.name, n.own) AS full_name, s.birth_date, s.nationality,
  coalesce(p.position, s.position) AS position, t.team_uid AS most_recent_team_uid
FROM x03_player_xwalk x LEFT JOIN {rd_players} s ON s.player_uid = x.player_uid
LEFT JOIN (SELECT player_uid, max(player_name) AS own FROM {ev_lineups} GROUP BY 1) n ON n.player_uid = x.player_uid
LEFT JOIN (SELECT DISTINCT ON (l.player_uid) l.player_uid, coalesce(l.position, l.usual_position) AS position FROM {xg_lineups} l JOIN m06_dim_match d ON d.combo_id = l.combo_id
  WHERE coalesce(l.position, l.usual_position) IS NOT NULL ORDER BY l.player_uid, d.match_date DESC NULLS LAST, l.combo_id DESC) p ON p.player_uid = x.player_uid
LEFT JOIN (SELECT DISTINCT ON (l.player_uid) l.player_uid, l.team_uid FROM {ev_lineups} l JOIN m06_dim_match d ON d.combo_id = l.combo_id
  ORDER BY l.player_uid, d.match_date DESC NULLS LAST, l.combo_id DESC) t ON t.player_uid = x.player_uid
""", "x03_player_xwalk m06_dim_match")
mart("m08_dim_spatial", "rd_spatial xg_spatial", """
SELECT coalesce(s.combo_id, f.combo_id) AS combo_id, s.average_positions AS rd_average_positions, s.home_heatmap AS rd_home_heatmap, s.away_heatmap AS rd_away_heatmap,
  s.full_player_heatmaps AS rd_full_player_heatmaps, s.match_momentum_graph AS rd_match_momentum_graph, s.commentary AS rd_commentary, f.momentum_data AS xg_momentum_data
FROM {rd_spatial} s FULL JOIN {xg_spatial} f ON f.combo_id = s.combo_id
""")
_D = "d.season_uid, d.competition_uid, d.match_date"
mart("m09_fct_player_match", "ev_lineups xg_lineups rd_lineups rd_player_stats", f"""
SELECT w.combo_id, w.player_uid, w.team_uid, {_D}, w.player_name, w.is_home_team, w.is_starter, w.is_captain, s.minutes_played, w.subbed_in_minute, w.subbed_out_minute,
  w.position AS ev_position, s.position AS rd_position, f.position AS xg_position, f.usual_position AS xg_usual_position, f.position_id AS xg_position_id,
  f.usual_position_id AS xg_usual_position_id, f.rating AS xg_rating, r.match_rating AS rd_rating
FROM {{ev_lineups}} w LEFT JOIN {{xg_lineups}} f ON f.combo_id = w.combo_id AND f.player_uid = w.player_uid
LEFT JOIN {{rd_lineups}} s ON s.combo_id = w.combo_id AND s.player_uid = w.player_uid
LEFT JOIN {{rd_player_stats}} r ON r.combo_id = w.combo_id AND r.player_uid = w.player_uid LEFT JOIN m06_dim_match d ON d.combo_id = w.combo_id
""", "m06_dim_match")
mart("m10_fct_player_shooting", "ev_player_shooting xg_shots", f"""
SELECT s.*, x.xg, x.xgot, {_D} FROM {{ev_player_shooting}} s
LEFT JOIN (SELECT combo_id, player_uid, {xs('xg')} AS xg, {xs('xgot')} AS xgot FROM {{xg_shots}} GROUP BY 1, 2) x ON x.combo_id = s.combo_id AND x.player_uid = s.player_uid
LEFT JOIN m06_dim_match d ON d.combo_id = s.combo_id
""", "m06_dim_match")


def _advanced(key: str, base: str, adv: str, by: str, shared: str) -> None:
    mart(key, f"{base} {adv}", f"""
SELECT b.*, a.* EXCLUDE ({shared}), {_D} FROM {{{base}}} b LEFT JOIN {{{adv}}} a ON a.combo_id = b.combo_id AND a.{by} = b.{by}
LEFT JOIN m06_dim_match d ON d.combo_id = b.combo_id""", "m06_dim_match")


def _dated(key: str, staged: str) -> None:
    mart(key, staged, f"SELECT s.*, {_D} FROM {{{staged}}} s LEFT JOIN m06_dim_match d ON d.combo_id = s.combo_id", "m06_dim_match")


_advanced("m11_fct_player_passing", "ev_player_passing", "ev_player_passing_adv", "player_uid",
          "combo_id, team_id, player_id, player_uid, team_uid, key_passes, assists, passes_entering_final_third")
_dated("m12_fct_player_possession", "ev_player_possession")
_dated("m13_fct_player_defending", "ev_player_defending")
_dated("m14_fct_player_discipline", "ev_player_discipline")
_dated("m15_fct_player_goalkeeping", "ev_player_goalkeep")
mart("m16_fct_shots", "ev_shots xg_shots rd_shots", f"""
SELECT concat(w.combo_id, '-', w.row_id) AS shot_uid, w.* EXCLUDE (x, y, goal_mouth_y, goal_mouth_z, expanded_minute, pos), w.x AS ev_x, w.y AS ev_y,
  w.goal_mouth_y AS ev_goal_mouth_y, w.goal_mouth_z AS ev_goal_mouth_z, f.minute AS expanded_minute, f.minute_added, f.xg, f.xgot, f.x AS xg_x, f.y AS xg_y,
  f.goal_crossed_y AS xg_goal_crossed_y, f.goal_crossed_z AS xg_goal_crossed_z, f.blocked_x AS xg_blocked_x, f.blocked_y AS xg_blocked_y,
  f.shot_type AS xg_shot_type, f.situation AS xg_situation, f.keeper_id AS xg_keeper_id, o.shot_id AS rd_shot_id, o.xg AS rd_xg, o.xgot AS rd_xgot, {_D}
FROM {{ev_shots}} w LEFT JOIN {{xg_shots}} f ON f.combo_id = w.combo_id AND f.row_id = w.row_id
LEFT JOIN {{rd_shots}} o ON o.combo_id = w.combo_id AND o.row_id = w.row_id LEFT JOIN m06_dim_match d ON d.combo_id = w.combo_id
""", "m06_dim_match")
_dated("m17_fct_odds", "od_odds")
mart("m18_fct_team_match", "xg_team_stats", f"""
SELECT f.*, d.home_team_uid, d.away_team_uid, {_D} FROM {{xg_team_stats}} f LEFT JOIN m06_dim_match d ON d.combo_id = f.combo_id
""", "m06_dim_match")
_dated("m19_fct_team_shooting", "ev_team_shooting")
_dated("m20_fct_team_defending", "ev_team_defending")
_dated("m21_fct_team_discipline", "ev_team_discipline")
_dated("m22_fct_team_match_state", "ev_team_state_agg")
_advanced("m23_fct_team_passing", "ev_team_passing", "ev_team_passing_adv", "team_uid",
          "combo_id, team_id, team_uid, passes_entering_final_third, passes_in_final_third, passes_in_final_third_accurate, key_passes, assists, big_chances_created")
_advanced("m24_fct_team_possession", "ev_team_possession", "ev_team_poss_adv", "team_uid", "combo_id, team_id, team_uid, passing_rate, possession_minutes")


def _p90(m: str) -> str:
    return f"CAST({m} AS DOUBLE) / n90 AS {m}_p90"


_PEER = "PARTITION BY season_uid, competition_uid, position ORDER BY"
oracle("m25_agg_player_season", "m07_dim_player m09_fct_player_match m10_fct_player_shooting m12_fct_player_possession", f"""
WITH base AS (
  SELECT pm.player_uid, pm.season_uid, pm.competition_uid, max(dp.position) AS position, {i('sum(pm.minutes_played)')} AS minutes, count(*) AS matches,
    {i('sum(coalesce(sh.goals, 0))')} AS goals, {i('sum(coalesce(sh.total_shots, 0))')} AS shots, coalesce({xs('sh.xg')}, 0) AS xg,
    {i('sum(coalesce(po.touches, 0))')} AS touches, {i('sum(coalesce(po.dribbles_won, 0))')} AS dribbles
  FROM m09_fct_player_match pm LEFT JOIN m10_fct_player_shooting sh ON sh.combo_id = pm.combo_id AND sh.player_uid = pm.player_uid
  LEFT JOIN m12_fct_player_possession po ON po.combo_id = pm.combo_id AND po.player_uid = pm.player_uid
  LEFT JOIN m07_dim_player dp ON dp.player_uid = pm.player_uid GROUP BY 1, 2, 3),
rates AS (SELECT *, {", ".join(_p90(m) for m in ("goals", "shots", "xg", "touches", "dribbles"))} FROM (SELECT *, minutes / CAST(90 AS DOUBLE) AS n90 FROM base WHERE minutes >= 60) z)
SELECT *, {", ".join(f"percent_rank() OVER ({_PEER} {m}_p90) AS {m}_p90_pct" for m in ("goals", "xg", "touches", "dribbles"))} FROM rates
""")
oracle("m26_agg_team_season", "m19_fct_team_shooting", f"""
SELECT *, CAST(goals AS DOUBLE) / nullif(matches, 0) AS goals_per_match, percent_rank() OVER (PARTITION BY season_uid, competition_uid ORDER BY goals) AS goals_pct,
  percent_rank() OVER (PARTITION BY season_uid, competition_uid ORDER BY shots) AS shots_pct
FROM (SELECT team_uid, season_uid, competition_uid, count(*) AS matches, {i('sum(coalesce(goals, 0))')} AS goals, {i('sum(coalesce(total_shots, 0))')} AS shots
      FROM m19_fct_team_shooting GROUP BY 1, 2, 3) z
""")

# -- checks and reshapes -----------------------------------------------------------------


def _unique(table: str, col: str, check: str, severity: str) -> str:
    return (f"SELECT '{check}' AS \"check\", '{severity}' AS severity, CAST({col} AS VARCHAR) AS key, count(*) AS n FROM {table} "
            f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1")


oracle("t01_not_null", f"x03_player_xwalk {STAGE_KEY['xg_lineups']}", f"""
SELECT * FROM (SELECT 'player_xwalk.player_uid' AS "check", 'error' AS severity, CAST(NULL AS VARCHAR) AS key, count(*) FILTER (WHERE player_uid IS NULL) AS n FROM x03_player_xwalk
UNION ALL SELECT 'xg_lineups.shirt_number', 'error', NULL, count(*) FILTER (WHERE shirt_number IS NULL) FROM {STAGE_KEY['xg_lineups']}) z WHERE n > 0
""")
oracle("t02_unique_anchor", "x03_player_xwalk ev_lineups", _unique("x03_player_xwalk", "ev_player_id", "player_xwalk.ev_player_id", "error")
       + " UNION ALL " + _unique("ev_lineups", "player_id", "ev_lineups.player_id", "error"))
oracle("t03_unique_provider", "x03_player_xwalk rd_lineups", _unique("x03_player_xwalk", "rd_player_id", "player_xwalk.rd_player_id", "error")
       + " UNION ALL " + _unique("rd_lineups", "shirt_number", "rd_lineups.shirt_number", "error"))
oracle("t04_unique_keys", "m06_dim_match m05_dim_team", _unique("m06_dim_match", "combo_id", "dim_match.combo_id", "warn")
       + " UNION ALL " + _unique("m05_dim_team", "country", "dim_team.country", "warn"))
oracle("t05_shot_counts", "a12_shots xg_shots rd_shots", """
SELECT * FROM (
  SELECT combo_id, count(*) FILTER (WHERE src = 'ev') AS ev_n, count(*) FILTER (WHERE src = 'xg') AS xg_n, count(*) FILTER (WHERE src = 'rd') AS rd_n
  FROM (SELECT combo_id, 'ev' AS src FROM a12_shots UNION ALL SELECT combo_id, 'xg' FROM xg_shots UNION ALL SELECT combo_id, 'rd' FROM rd_shots) u GROUP BY 1) c
WHERE (xg_n > 0 AND ev_n <> xg_n) OR (rd_n > 0 AND ev_n <> rd_n)
""")
_CHECKED = {"player_xwalk": "x03_player_xwalk", "team_xwalk": "x04_team_xwalk", "ev_lineups": STAGE_KEY["ev_lineups"], "dim_match": "m06_dim_match", "dim_player": "m07_dim_player",
            "dim_team": "m05_dim_team", "dim_coach": "m04_dim_coach", "dim_referee": "m03_dim_referee", "fct_shots": "m16_fct_shots"}
_NOT_NULL = {"player_xwalk": ["player_uid", "ev_player_id"], "team_xwalk": ["team_uid", "ev_team_id"], "ev_lineups": ["player_uid"], "dim_match": ["combo_id"],
             "dim_player": ["player_uid"], "dim_team": ["team_uid"]}
_UNIQUE = {"player_xwalk": [("ev_player_id", "error"), ("rd_player_id", "error")], "team_xwalk": [("ev_team_id", "error")], "dim_match": [("combo_id", "warn")],
           "dim_player": [("player_uid", "warn")], "dim_team": [("team_uid", "warn")], "dim_coach": [("coach_uid", "warn")], "dim_referee": [("referee_uid", "warn")],
           "fct_shots": [("shot_uid", "warn")]}


def _checks(planted: bool) -> str:
    out = []
    for name, sql in _CHECKED.items():
        cols = list(dict.fromkeys(_NOT_NULL.get(name, []) + [c for c, _ in _UNIQUE.get(name, [])]))
        rows = f"SELECT {', '.join(cols)} FROM {sql}"
        if planted:
            rows += f" UNION ALL SELECT {', '.join(cols)} FROM {sql} WHERE " + " OR ".join(f"right(CAST({c} AS VARCHAR), 1) = '7'" for c in cols)
            gone = _NOT_NULL.get(name, [])
            rows = "SELECT " + ", ".join(f"CASE WHEN right(CAST({c} AS VARCHAR), 1) = '3' THEN NULL ELSE {c} END AS {c}" if c in gone else c for c in cols) + f" FROM ({rows}) p"
        out += [f"SELECT 'not_null:{name}.{c}' AS \"check\", 'error' AS severity, CAST(NULL AS VARCHAR) AS key, count(*) AS n FROM ({rows}) z WHERE {c} IS NULL HAVING count(*) > 0" for c in _NOT_NULL.get(name, [])]
        out += [_unique(f"({rows}) z", c, f"unique:{name}.{c}", s) for c, s in _UNIQUE.get(name, [])]
    out.append("SELECT 'shot_counts', 'warn', combo_id, ev_n FROM t05_shot_counts")
    return " UNION ALL ".join(out)


oracle("t06_all_checks", " ".join([*_CHECKED.values(), "t05_shot_counts"]), _checks(True))
oracle("t06_checks_of_the_marts", " ".join([*_CHECKED.values(), "t05_shot_counts"]), _checks(False))
oracle("p02_cast_text", "xg_player_stats", f"""
SELECT r.* EXCLUDE (team_name) REPLACE ({", ".join(_NUM.format(c=c) for c in ("accurate_passes", "duels_won"))}), r.accurate_passes AS accurate_passes_display FROM xg_player_stats r
""")
oracle("p03_new_columns", "a01_team_passing a04_team_passing_adv", """
SELECT b.*, a.* EXCLUDE (combo_id, team_id, passes_entering_final_third, passes_in_final_third, passes_in_final_third_accurate, key_passes, assists, big_chances_created)
FROM a01_team_passing b LEFT JOIN a04_team_passing_adv a ON a.combo_id = b.combo_id AND a.team_id = b.team_id
""")
oracle("p04_pivot", "orders", "SELECT o_custkey, " + ", ".join(
    f"max(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice END) AS \"{p.lower().replace(' ', '_').replace('-', '_')}\""
    for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")) + " FROM orders GROUP BY 1")
oracle("p05_team_stats_wide", "team_stat_items", "SELECT combo_id, period, " + ", ".join(
    f'arg_max(home_value, pos) FILTER (WHERE stat_key = \'{k}\') AS "{k}_home", arg_max(away_value, pos) FILTER (WHERE stat_key = \'{k}\') AS "{k}_away"'
    for k in ("Pass", "Tackle", "Foul", "Aerial")) + " FROM team_stat_items GROUP BY 1, 2")
oracle("x07_bad_sides", "ev_lineups", """
SELECT combo_id, count(DISTINCT is_home_team) AS n_sides FROM ev_lineups GROUP BY 1 HAVING count(DISTINCT is_home_team) <> 2
""")

# -- documents -------------------------------------------------------------------------

oracle("s01_scan", "matches rd_spatial odds_items", """
SELECT combo_id, concat('/data/', combo_id, '/events/events_', mno + 700000, '.json') AS ev_path, mno + 700000 AS ev_id,
  concat('/data/', combo_id, '/xg/xg_', 1 + mno % 38 + 800000, '.json') AS xg_path, 1 + mno % 38 + 800000 AS xg_id,
  true AS has_reference_data, combo_id IN (SELECT combo_id FROM odds_items) AS has_odds_data, true AS has_events, true AS has_xg_data
FROM matches
""")
oracle("s02_incremental", "matches", "SELECT combo_id, mno + 700000 AS ev_id FROM matches WHERE mno % 2 <> 0")
ORACLES["a26_refreshed_season"] = ORACLES["m25_agg_player_season"]
ORACLES["x06_counted_vote"] = ORACLES["x02_vote"]
oracle("x08_player_alias", "x03_player_xwalk", "SELECT CASE WHEN ev_player_id % 7 = 3 THEN ev_player_id - 1 ELSE ev_player_id END AS player_uid, * EXCLUDE (player_uid) FROM x03_player_xwalk")
oracle("s02_manifest", "matches", """
SELECT combo_id, unnest(['events', 'xg']) AS provider, unnest([concat('events_', mno + 700000), concat('xg_', 1 + mno % 38 + 800000)]) AS file
FROM matches WHERE right(combo_id, 1) IN ('3', '5')
""")
oracle("l01_held_matches", "matches odds_items", """
SELECT combo_id, CAST(1 AS BIGINT) AS arrival FROM matches WHERE right(combo_id, 1) NOT IN ('1', '2')
UNION ALL SELECT combo_id, 2 FROM matches WHERE right(combo_id, 1) IN ('2', '6')
UNION ALL SELECT combo_id, 3 FROM matches WHERE right(combo_id, 1) = '4' AND combo_id IN (SELECT combo_id FROM odds_items)
""")
oracle("s03_reject", "feed_base", "SELECT combo_id, count(*) AS n_events FROM feed_base WHERE right(combo_id, 1) NOT IN ('1', '2') GROUP BY 1")
oracle("s03_odd_types", "ev_match_meta matches feed_base", """
SELECT m.combo_id, CASE WHEN k.mno % 3 = 0 THEN NULL ELSE attendance END AS attendance, n.n_events, k.mno % 3 = 0 AS flawed
FROM ev_match_meta m JOIN matches k ON k.combo_id = m.combo_id JOIN (SELECT combo_id, count(*) AS n_events FROM feed_base GROUP BY 1) n ON n.combo_id = m.combo_id
""")
oracle("s03_rejected", "feed_base", """
SELECT combo_id, 'events' AS provider, CASE WHEN right(combo_id, 1) = '1' THEN 'not JSON' WHEN right(combo_id, 1) = '2' THEN 'block page' ELSE 'odd field' END AS reason
FROM (SELECT DISTINCT combo_id FROM feed_base WHERE right(combo_id, 1) IN ('1', '2', '3')) z
""")
oracle("s03_feed", "feed_base", """
SELECT combo_id, pos, event_id, t_s, minute, second, period, home_id, away_id, team_id, opp_id, player_id, related_player_id, etype, ok, x, y,
  CASE WHEN etype = 'Pass' THEN end_x END AS pass_end_x, CASE WHEN etype = 'Pass' THEN end_y END AS pass_end_y, length, rel_event_id AS related_event_id, is_touch, is_shot,
  CASE WHEN qa IS NOT NULL THEN qa WHEN qb IS NOT NULL THEN qb WHEN etype = 'Pass' THEN 'PassEndX' WHEN length IS NOT NULL THEN 'Length'
       WHEN rel_event_id IS NOT NULL THEN 'RelatedEventId' END AS first_name
FROM feed_base
""")
oracle("s05_match_meta", "ev_match_meta matches", """
SELECT m.combo_id, k.mno + 700000 AS ev_match_id, home_team_id, away_team_id, attendance, 'R' AS referee, start_time FROM ev_match_meta m JOIN matches k ON k.combo_id = m.combo_id
""")
oracle("s06_lineups", "ev_lineups", "SELECT combo_id, player_id, player_name, team_id, team_name, is_home_team, shirt_number, position, is_starter, is_captain, subbed_in_minute FROM ev_lineups")
oracle("s07_formations", "formations ev_lineups", """
SELECT f.combo_id, f.team_id, f.is_home AS is_home_team, formation_index, formation_name, start_minute, c.player_id AS captain_player_id
FROM formations f LEFT JOIN ev_lineups c ON c.combo_id = f.combo_id AND c.team_id = f.team_id AND c.is_captain
""")
oracle("s08_xg_match", "xg_match xg_shots xg_spatial", """
SELECT combo_id, CAST(match_round AS VARCHAR) AS match_round, home_team_id, away_team_id, home_score, away_score, match_date, stadium_name, stadium_city, stadium_capacity,
  home_color, away_color, combo_id IN (SELECT combo_id FROM xg_shots) AS has_shot_data, combo_id IN (SELECT combo_id FROM xg_spatial) AS has_momentum_data, motm_id, motm_rating
FROM xg_match
""")


def _position(pid: str) -> str:
    return "CASE " + " ".join(f"WHEN {pid} = {i} THEN '{label}'" for i, label in K.POSITION_LABEL.items()) + " END"


def _lateral(base: str, y: str) -> str:
    return (f"CASE WHEN {base} NOT IN ('CB', 'DM', 'CM', 'AM', 'ST') OR {y} IS NULL THEN {base} WHEN {y} > 0.65 THEN concat('R', {base}) WHEN {y} < 0.35 THEN concat('L', {base}) "
            f"WHEN {base} IN ('DM', 'AM') THEN concat('C', {base}) ELSE {base} END")


_USUAL = "CASE usual_position_id WHEN 0 THEN 'GK' WHEN 1 THEN 'DEF' WHEN 2 THEN 'MID' WHEN 3 THEN 'FWD' END"
oracle("s09_xg_lineups", "xg_lineups", f"""
SELECT combo_id, player_id, team_id, is_home_team, CASE WHEN position IS NOT NULL THEN 'starter' ELSE 'sub' END AS role, shirt_number, position_id,
  CASE WHEN base IS NULL THEN NULL ELSE {_lateral('base', 'y')} END AS position, usual_position_id, {_USUAL} AS usual_position, rating
FROM (SELECT *, {_position('position_id')} AS base, CASE WHEN position IS NOT NULL THEN CAST(player_id % 10 AS DOUBLE) / 10 END AS y FROM xg_lineups) z
""")
oracle("s10_coaches", "xg_match", """
SELECT combo_id, ht_coach_id, concat('Coach ', CAST(ht_coach_id AS VARCHAR)) AS ht_coach_name, at_coach_id,
  CASE WHEN at_coach_id IS NOT NULL THEN concat('Coach ', CAST(at_coach_id AS VARCHAR)) END AS at_coach_name FROM xg_match
""")
oracle("s11_xg_shots", "xg_shots", """
SELECT combo_id, row_number() OVER (PARTITION BY combo_id ORDER BY coalesce(minute, 0), coalesce(minute_added, 0), row_id) - 1 AS row_id, team_id, player_id, minute,
  minute_added, xg, xgot, shot_type FROM xg_shots
""")
ORACLES["p05_team_stats_docs"] = ORACLES["p05_team_stats_wide"]
oracle("p09_dynamic_keys", "team_stat_items xg_player_stats rd_lineups rd_odds", """
WITH v AS (
  SELECT 'xg_team_stats' AS "table", stat_key AS key, unnest([home_value, away_value]) AS value FROM team_stat_items
  UNION ALL SELECT 'rd_match_stats', lower(stat_key) || '_count_' || s, CASE s WHEN 'homevalue' THEN home_value ELSE away_value END FROM team_stat_items, (SELECT unnest(['homevalue', 'awayvalue']) AS s) z
  UNION ALL SELECT 'xg_player_stats', k, CASE k WHEN 'accurate_passes' THEN accurate_passes WHEN 'duels_won' THEN duels_won ELSE '9' END
    FROM xg_player_stats, (SELECT unnest(['accurate_passes', 'accurate_passes_total', 'duels_won']) AS k) z
  UNION ALL SELECT 'rd_player_stats', unnest(CASE WHEN player_id % 2 = 0 THEN ['minutesPlayed', 'totalPass'] ELSE ['minutesPlayed', 'rating'] END), '1' FROM rd_lineups WHERE player_id % 14 <> 3
  UNION ALL SELECT 'rd_player_stats', 'keyPass', '2' FROM rd_lineups WHERE player_id % 14 <> 3 AND player_id % 3 <> 0
  UNION ALL SELECT 'rd_odds', 'Full time_1X2_1', CAST(full_time_1x2_1 AS VARCHAR) FROM rd_odds
  UNION ALL SELECT 'rd_odds', 'Full time_1X2_2', CAST(full_time_1x2_2 AS VARCHAR) FROM rd_odds
  UNION ALL SELECT 'rd_odds', 'Full time_1X2_winning', '1' FROM rd_odds)
SELECT "table", key, CASE WHEN count(*) FILTER (WHERE value IS NOT NULL AND NOT regexp_full_match(value, '-?(0|[1-9][0-9]*)([.][0-9]+)?')) > 0 THEN 'string'
  WHEN count(*) FILTER (WHERE value LIKE '%.%') > 0 THEN 'double' WHEN count(value) = 0 THEN 'void' ELSE 'bigint' END AS type
FROM v WHERE key IS NOT NULL GROUP BY 1, 2
""")
oracle("p06_team_stat_items", "team_stat_items", "SELECT combo_id, period, 'All' AS stat_group, stat_key, home_value, away_value FROM team_stat_items")
oracle("p07_player_stats", "xg_player_stats", "SELECT combo_id, player_id, team_id, player_name, accurate_passes, '9' AS accurate_passes_total, duels_won FROM xg_player_stats")
oracle("s28_momentum", "xg_spatial", "SELECT * FROM xg_spatial")
oracle("s18_players", "rd_lineups", "SELECT DISTINCT player_id, concat('P', player_id) AS name, concat('N', player_id % 7) AS nationality FROM rd_lineups")
oracle("s18_teams", "sides", """
SELECT DISTINCT team_id + 8000 AS team_id, concat('FC ', team_id) AS name, concat('Ground ', team_id) AS stadium, team_id * 1000 AS stadium_capacity, 'Country' AS country, 'City' AS city FROM sides
""")
oracle("s18_tournaments", "matches", "SELECT DISTINCT competition_uid AS tournament_id, concat('League ', competition_uid) AS name, 'Europe' AS country, '1' AS tier FROM matches")
oracle("s18_seasons", "matches", "SELECT DISTINCT season_uid AS season_id, concat('S ', season_uid) AS name, CAST(season_uid AS VARCHAR) AS year, competition_uid AS tournament_id FROM matches")
oracle("s18_managers", "sides", "SELECT DISTINCT team_id * 10 + 1 AS manager_id, concat('Coach ', team_id) AS name FROM sides")
oracle("s18_referees", "matches", """
SELECT mno % 12 AS referee_id, concat('R ', mno % 12) AS name, 'X' AS nationality, CAST(1 AS BIGINT) AS red_cards, mno * 3 AS yellow_cards, CAST(0 AS BIGINT) AS double_yellow_cards,
  mno % 5 AS games FROM matches
""")
oracle("s19_epoch", "rd_lineups", "SELECT DISTINCT player_id, (player_id - 60500) * 1000000 AS birth_s FROM rd_lineups")
oracle("s20_rd_matches", "rd_matches matches rd_shots", """
SELECT r.combo_id, r.match_id, r.tournament_id, r.season_id, 'Ground' AS venue, r.referee_id, r.home_team_id, r.away_team_id, r.home_manager_id, r.away_manager_id, r.winnercode,
  m.mno % 4 AS homescore_current, CAST(0 AS BIGINT) AS homescore_period1, m.mno % 3 AS awayscore_current, '4-3-3' AS home_formation,
  CASE WHEN m.mno % 2 = 0 THEN m.home_id + 60000 END AS motm_player_id, m.mno * 86400 AS start_s, r.combo_id IN (SELECT combo_id FROM rd_shots) AS has_shotmap
FROM rd_matches r JOIN matches m ON m.combo_id = r.combo_id
""")
oracle("s21_coverage", "rd_matches rd_shots", """
SELECT combo_id, combo_id IN (SELECT combo_id FROM rd_shots) AS has_shotmap, combo_id IN (SELECT combo_id FROM rd_shots WHERE xg IS NOT NULL) AS has_xg FROM rd_matches
""")
oracle("s22_rd_shots", "rd_shots", """
SELECT combo_id, row_id, player_id, shot_id, xg, xgot, CASE shot_id % 3 WHEN 0 THEN 'low-left' WHEN 1 THEN 'high-right' END AS goalmouthlocation,
  CASE WHEN shot_id % 2 = 0 THEN 'shot' ELSE 'goal' END AS incidenttype, CASE WHEN shot_id % 5 = 0 THEN 'penalty' END AS goaltype,
  CASE WHEN shot_id % 4 = 0 THEN CAST(shot_id % 6 AS BIGINT) END AS addedtime, concat('{"x":', shot_id % 100, '}') AS playercoordinates, CAST(NULL AS VARCHAR) AS blockcoordinates,
  concat('{"gear":"', shot_id % 7, '"}') AS other_fields FROM rd_shots
""")
oracle("s23_rd_player_stats", "rd_lineups rd_matches", """
SELECT l.combo_id, m.match_id, l.team_id, l.is_home_team, l.player_id,
  CAST(CASE WHEN player_id % 3 = 0 THEN 7.5 WHEN player_id % 2 <> 0 THEN player_id % 90 ELSE 0 END AS DOUBLE) AS match_rating,
  CAST(minutes_played AS DOUBLE) AS minutesplayed, CAST(CASE WHEN player_id % 2 = 0 THEN player_id % 90 ELSE 0 END AS DOUBLE) AS totalpass,
  CAST(CASE WHEN player_id % 3 = 0 THEN 0 ELSE 2 END AS DOUBLE) AS keypass, CAST(CASE WHEN player_id % 2 = 0 THEN 0 ELSE player_id % 90 END AS DOUBLE) AS rating
FROM rd_lineups l JOIN rd_matches m ON m.combo_id = l.combo_id WHERE player_id % 14 <> 3
""")
oracle("s24_rd_lineups", "rd_lineups", """
SELECT combo_id, team_id, is_home_team, player_id, is_starter, is_captain, CASE WHEN player_id % 14 = 3 THEN 0 ELSE minutes_played END AS minutes_played, shirt_number, position FROM rd_lineups
""")
oracle("s24_missing_players", "rd_missing_players", "SELECT combo_id, team_id, is_home_team, player_id, name, type, CAST(reason AS VARCHAR) AS reason FROM rd_missing_players")
oracle("s25_spatial", "rd_spatial", "SELECT combo_id, average_positions, home_heatmap, away_heatmap, match_momentum_graph, commentary FROM rd_spatial")
oracle("s27_odds_wide", "rd_odds", """
SELECT combo_id, match_id, full_time_1x2_1 AS "full time_1x2_1", full_time_1x2_2 AS "full time_1x2_2", CASE WHEN match_id % 2 = 0 THEN '1' ELSE '2' END AS "full time_1x2_winning" FROM rd_odds
""")
oracle("p08_match_stats", "team_stat_items matches", f"""
WITH p AS (
  SELECT i.combo_id, i.stat_key, i.home_value, i.away_value, CASE i.period WHEN 'p1' THEN 0 ELSE 1 END + r AS row_id
  FROM team_stat_items i JOIN matches m ON m.combo_id = i.combo_id JOIN (SELECT 0 AS r UNION ALL SELECT 2) z ON r = 0 OR m.mno % 2 = 0)
SELECT combo_id, CASE row_id WHEN 0 THEN 'FULL-TIME' WHEN 1 THEN 'FIRST-HALF' WHEN 2 THEN 'SECOND-HALF' ELSE 'p4' END AS period, CAST(row_id AS BIGINT) AS row_id,
  {", ".join(f"max({side}_value) FILTER (WHERE stat_key = '{k}') AS {k.lower()}_count_{side}value" for k in ("Aerial", "Foul", "Pass", "Tackle") for side in ("home", "away"))}
FROM p GROUP BY combo_id, row_id
""")
oracle("s26_odds_long", "od_odds", "SELECT * FROM od_odds")

# -- load semantics ----------------------------------------------------------------------

oracle("s12_upsert", "orders", """
SELECT coalesce(o.c, n.c) AS o_custkey, o.status AS o_orderstatus, coalesce(n.price, o.price) AS o_totalprice, n.prio AS o_orderpriority
FROM (SELECT o_custkey AS c, arg_max(o_orderstatus, o_orderkey) AS status, arg_max(o_totalprice, o_orderkey) AS price FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1) o
FULL JOIN (SELECT o_custkey AS c, arg_max(o_totalprice, o_orderkey) AS price, arg_max(o_orderpriority, o_orderkey) AS prio FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1) n ON n.c = o.c
""")
oracle("s13_conditional_upsert", "orders", """
SELECT o_custkey, o_orderkey, games FROM (SELECT o_custkey, o_orderkey, CAST(floor(o_totalprice / 10000) AS BIGINT) AS games,
  row_number() OVER (PARTITION BY o_custkey ORDER BY floor(o_totalprice / 10000) DESC, o_orderkey) AS rn FROM orders) z WHERE rn = 1
""")
oracle("s14_overwrite", "orders", """
SELECT o_custkey, o_orderkey FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_custkey, o_orderkey FROM orders WHERE o_orderkey % 3 <> 1 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 1)
""")
oracle("s15_extend_schema", "orders", """
SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_custkey, o_orderkey, NULL FROM orders WHERE o_orderkey % 3 <> 1 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 1)
""")
oracle("s12_store_upsert", "orders", """
WITH a AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS status, arg_max(o_totalprice, o_orderkey) AS price FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1),
b AS (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS price, arg_max(o_orderpriority, o_orderkey) AS prio FROM orders WHERE o_orderkey % 3 = 1 GROUP BY 1),
c AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS status FROM orders WHERE o_orderkey % 3 = 2 GROUP BY 1)
SELECT o_custkey, coalesce(c.status, a.status) AS o_orderstatus, coalesce(b.price, a.price) AS o_totalprice, b.prio AS o_orderpriority
FROM (SELECT DISTINCT o_custkey FROM orders) k LEFT JOIN a USING (o_custkey) LEFT JOIN b USING (o_custkey) LEFT JOIN c USING (o_custkey)
""")
oracle("s13_store_larger", "orders", """
SELECT o_custkey, o_orderkey, games FROM (SELECT o_custkey, o_orderkey, CAST(floor(o_totalprice / 10000) AS BIGINT) AS games,
  row_number() OVER (PARTITION BY o_custkey ORDER BY floor(o_totalprice / 10000) DESC, CASE o_orderkey % 3 WHEN 2 THEN 0 WHEN 0 THEN 1 ELSE 2 END, o_orderkey) AS rn FROM orders) z WHERE rn = 1
""")
oracle("s14_store_reload", "orders", """
WITH b AS (SELECT *, CASE WHEN o_orderkey % 7 = 0 AND o_custkey % 10 = 0 THEN 2 END AS third, CASE WHEN o_orderkey % 3 = 1 AND o_custkey % 5 = 0 THEN 1 END AS second,
  CASE WHEN o_orderkey % 3 <> 1 THEN 0 END AS first FROM orders),
last AS (SELECT o_custkey, coalesce(max(third), max(second), max(first)) AS batch FROM b GROUP BY 1)
SELECT b.o_custkey, o_orderkey, o_totalprice FROM b JOIN last USING (o_custkey) WHERE batch = third OR batch = second OR batch = first
""")
oracle("s15_type_conflicts", "orders", """
SELECT o_orderkey, o_custkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) WHEN 2 THEN o_orderpriority
  WHEN 1 THEN CASE WHEN o_totalprice = floor(o_totalprice) THEN CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR) ELSE CAST(o_totalprice AS VARCHAR) END END AS extra FROM orders
""")
oracle("s33_truncate", "orders", "SELECT o_custkey, o_orderkey, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders WHERE o_orderkey % 5 = 0")
oracle("s16_normalize", "events", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, CASE WHEN event_id % 7 <> 0 THEN value END AS value, concat('[', event_id, ',', user_id, ']') AS ids FROM events
""")
oracle("s17_natural_id", "rd_referees", "SELECT * FROM rd_referees")
ORACLES["s30_published"] = ORACLES["x04_team_xwalk"]
oracle("k04_preview", "xg_shots", "SELECT combo_id, row_id, player_id, xg FROM xg_shots ORDER BY combo_id, row_id LIMIT 10")
oracle("s32_of_match", "xg_shots", "SELECT combo_id, row_id, player_id, xg FROM xg_shots WHERE combo_id = 'M00001'")

# -- scalar functions --------------------------------------------------------------------

oracle("f01_normalize_name", "part", "SELECT p_partkey, regexp_replace(lower(concat(p_name, ' É-9 ', p_type)), '[^a-z]', '', 'g') AS nname FROM part")
oracle("f02_leading_number", "events", """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN floor(value) WHEN 1 THEN floor(value) WHEN 4 THEN -floor(value) END AS number FROM events
""")
oracle("f03_geometry", "feed_base", f"""
SELECT combo_id, pos, {_DIST} AS dist_m, sqrt((100 - x) * (100 - x) + (50 - y) * (50 - y)) AS dist_units,
  CASE WHEN {_DIST} = 0 THEN 90 ELSE {rd(f'degrees(2 * atan(3.66 / {_DIST}))', 2)} END AS angle, {xt('x', 'y')} AS xt, {third()} AS third, {_ZONE.format(x='x')} AS foul_zone,
  x > 83 AND y BETWEEN 21 AND 79 AS box_touch, x >= 83 AND y BETWEEN 21 AND 79 AS box_pass,
  x >= {K.BOX_X_MIN!r}::DOUBLE AND y >= {K.BOX_Y_MIN!r}::DOUBLE AND y <= {K.BOX_Y_MAX!r}::DOUBLE AS box_area,
  CASE WHEN length < 10 THEN 'short' WHEN length <= 32 THEN 'medium' ELSE 'long' END AS band
FROM feed_base
""")
_FM, _FS, _FD = _clock("t_s", "180 * (period - 1)", "period")
oracle("f16_clock", "feed_base", f"SELECT combo_id, pos, {_FM} AS m, {_FS} AS s, {_FD} AS display FROM feed_base")
oracle("f17_positions", "xg_lineups", f"""
SELECT combo_id, player_id, CASE WHEN base IS NULL THEN NULL ELSE {_lateral('base', 'y')} END AS label, {_USUAL} AS usual
FROM (SELECT *, {_position('position_id')} AS base, CAST(shirt_number AS DOUBLE) / 14 AS y FROM xg_lineups) z
""")
oracle("f21_number_or", "orders", "SELECT o_orderkey, CAST(50 AS DOUBLE) AS bad, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS good FROM orders")
