"""Ordered-event operators: hand-written cases, and what must hold on a whole feed."""

from collections import defaultdict

from micro import feed
from touchline.functions import fixed as K
from touchline.operators import runs, sca, sequences, states


# -- shot-creating actions ---------------------------------------------------------

def credits(spark, *events):
    df = sca.shot_creating_actions(feed(spark, list(events)))
    return [(r["slot"], r["kind"]) for r in df.orderBy("shot_pos", "slot").collect()]


def test_two_actions_before_a_shot(spark):
    assert credits(spark, (1, "Pass", {}), (1, "TakeOn", {}), (1, "Goal", {})) == [(1, "Take-On"), (2, "Pass (Live)")]


def test_rebound_shot_is_the_only_credit(spark):
    got = credits(spark, (1, "Pass", {}), (1, "SavedShot", {}), (1, "Goal", {}))
    assert got == [(1, "Pass (Live)"), (1, "Shot")]  # first shot: the pass; second: only the rebound


def test_clearance_is_transparent_and_interception_is_not(spark):
    assert credits(spark, (1, "Pass", {}), (2, "Clearance", {}), (1, "Goal", {})) == [(1, "Pass (Live)")]
    assert credits(spark, (1, "Pass", {}), (2, "Interception", {}), (1, "Goal", {})) == []


def test_recovery_credits_the_tackle_before_it(spark):
    assert credits(spark, (1, "Pass", {}), (1, "Tackle", {}), (1, "BallRecovery", {}), (1, "Goal", {})) == [(1, "Tackle")]
    # an event without a team in between is skipped
    assert credits(spark, (1, "Tackle", {}), (None, "Pass", {}), (1, "BallRecovery", {}), (1, "Goal", {})) == [(1, "Tackle")]
    assert credits(spark, (1, "Pass", {}), (2, "Tackle", {}), (1, "BallRecovery", {}), (1, "Goal", {})) == []


def test_own_drawn_foul_and_dead_ball(spark):
    got = credits(spark, (1, "Foul", {"ok": True}), (2, "Foul", {"ok": False}), (1, "Pass", {"q": ["FreekickTaken"]}), (1, "Goal", {}))
    assert got == [(1, "Pass (Dead)"), (2, "Fouled")]


def test_lookback_is_twelve_events(spark):
    filler = [(2, "Aerial", {})] * 12
    assert credits(spark, (1, "Pass", {}), *filler[:11], (1, "Goal", {})) == [(1, "Pass (Live)")]
    assert credits(spark, (1, "Pass", {}), *filler, (1, "Goal", {})) == []


# -- receivers -----------------------------------------------------------------------

def test_receiver_is_strictly_later_and_somebody_else(spark):
    rows = feed(spark, [(1, "Pass", {"p": 1, "t": 0}), (1, "Pass", {"p": 2, "t": 0}), (1, "BallTouch", {"p": 1, "t": 3}), (1, "BallTouch", {"p": 3, "t": 5}),
                        (2, "Pass", {"p": 1, "t": 9}), (1, "Pass", {"p": 1, "t": 12})])
    got = {r["pos"]: r["receiver_id"] for r in runs.receivers(runs.runs(rows)).collect()}
    assert got[0] == 103  # pos 1 is in the same second, pos 2 is the passer
    assert got[1] == 101
    assert got[4] is None and got[5] is None


def test_receivers_of_hand_written_runs(spark):
    rows = feed(spark, [(1, "Pass", {"p": 1, "t": 0}), (1, "Card", {"p": 5, "t": 1}), (1, "Pass", {"p": 2, "t": 2}), (1, "Pass", {"p": 2, "t": 4}), (1, "Pass", {"p": 3, "t": 6}),
                        (2, "Pass", {"p": 4, "t": 8}), (2, "Pass", {"p": 5, "t": 8}), (2, "Pass", {"p": 6, "t": 9})])
    got = {r["pos"]: r["receiver_id"] for r in runs.receivers(runs.runs(rows)).collect()}
    assert (got[0], got[2], got[3], got[4]) == (105, 103, 103, None)  # any later event of a team mate will do, a card too; own second touch is passed over
    assert (got[5], got[6], got[7]) == (206, 206, None)


def test_receivers_share_the_run_of_the_passer(tables):
    rows = runs.receivers(runs.runs(tables.feed))
    assert rows.filter("receiver_id = player_id").count() == 0
    assert rows.filter("receiver_id is not null and team_id is not null and floor(receiver_id / 100) <> team_id").count() == 0
    last = rows.groupBy("combo_id", "run_id").agg({"t_s": "max"}).withColumnRenamed("max(t_s)", "end")
    assert rows.join(last, ["combo_id", "run_id"]).filter("t_s = end and receiver_id is not null").count() == 0


# -- sequences -------------------------------------------------------------------------

def seqs(spark, *events):
    rows = sequences.raw_sequences(feed(spark, list(events))).orderBy("seq_id").collect()
    return [(r["team_id"], r["length"], r["marker"]) for r in rows]


def test_failed_tackle_inside_a_run_is_ignored(spark):
    assert seqs(spark, (1, "Pass", {}), (2, "Tackle", {"ok": False}), (1, "Pass", {})) == [(1, 2, "End")]
    assert seqs(spark, (1, "Pass", {}), (2, "Tackle", {"ok": True}), (1, "Pass", {})) == [(1, 1, None), (2, 1, None), (1, 1, "End")]


def test_failed_tackle_first_after_a_foul_starts_a_sequence(spark):
    got = seqs(spark, (1, "Pass", {}), (2, "Foul", {"ok": False}), (2, "Tackle", {"ok": False}), (1, "Pass", {}))
    assert got == [(1, 1, "FoulWon"), (2, 1, None), (1, 1, "End")]


def test_shot_ends_a_sequence_but_a_free_kick_shot_goes_on(spark):
    assert seqs(spark, (1, "Pass", {}), (1, "SavedShot", {}), (1, "Pass", {})) == [(1, 2, None), (1, 1, "End")]
    assert seqs(spark, (1, "Pass", {}), (1, "SavedShot", {"q": ["FreekickTaken"]}), (1, "Pass", {})) == [(1, 1, "Restart"), (1, 2, "End")]


def test_own_goal_offside_and_substitution_end_sequences(spark):
    assert seqs(spark, (1, "Pass", {}), (2, "Goal", {"q": ["OwnGoal"]})) == [(1, 1, "OwnGoalFor")]
    assert seqs(spark, (1, "Pass", {}), (1, "OffsideGiven", {}), (2, "Pass", {})) == [(1, 1, "OffsideGiven"), (2, 1, "End")]
    assert seqs(spark, (1, "Pass", {}), (2, "SubstitutionOn", {}), (1, "Pass", {})) == [(1, 1, "SubstitutionOn"), (1, 1, "End")]


def stitched(spark, *events):
    df = sequences.stitched_sequences(sequences.stitched_events(feed(spark, list(events))))
    return [(r["team_id"], r["length"]) for r in df.orderBy("seq_id").collect()]


def test_lone_reflexive_touch_is_stitched_over(spark):
    a, b, c = (1, "Pass", {}), (2, "Clearance", {}), (2, "Pass", {})
    assert stitched(spark, a, b, a) == [(1, 2)]
    assert stitched(spark, a, b, a, b, a) == [(1, 3)]
    assert stitched(spark, a, c, a) == [(1, 1), (2, 1), (1, 1)]
    assert stitched(spark, a, b, b, a) == [(1, 1), (2, 2), (1, 1)]
    # a shot before the touch: no stitching
    assert stitched(spark, (1, "SavedShot", {}), b, a) == [(1, 1), (2, 1), (1, 1)]


def test_alternating_lone_touches_take_every_other(spark):
    b, a1 = (2, "Clearance", {}), (1, "BallTouch", {})
    assert stitched(spark, (1, "Pass", {}), b, a1, b, (1, "Pass", {})) == [(1, 3)]
    assert stitched(spark, (1, "Pass", {}), b, a1, (2, "Pass", {})) == [(1, 2), (2, 1)]


def test_fragments_of_a_hand_written_feed(spark):
    got = seqs(spark, (1, "Pass", {}), (None, "Pass", {}), (1, "Pass", {}), (2, "Foul", {"ok": True}), (2, "Pass", {"q": ["FreekickTaken"]}), (1, "Aerial", {"ok": False}),
               (2, "TakeOn", {}), (2, "MissedShots", {}), (1, "Pass", {"q": ["GoalKick"]}), (2, "Interception", {}), (2, "Card", {}), (2, "Pass", {}), (1, "End", {}))
    assert got == [(1, 2, "FoulConceded"), (2, 3, None), (1, 1, None), (2, 2, "End")]
    assert sum(n for _, n, _ in got) == 8  # nobody's pass, foul, lost aerial, card and whistle are in none


def test_sequences_of_a_whole_feed(tables):
    """What holds of any feed: order, one team each, a change or a marker between neighbours."""
    rows = defaultdict(list)
    for r in sequences.sequence_events(tables.feed).select("combo_id", "pos", "ord", "seq_id", "team_id", "is_shot", "restart", "is_last", "marker", "etype").orderBy("combo_id", "ord").collect():
        rows[r.combo_id].append(r)
    for events in rows.values():
        assert len({r.pos for r in events}) == len(events)
        assert [r.seq_id for r in events] == sorted(r.seq_id for r in events)
        assert not {r.etype for r in events} & {*K.STOP_TYPES, *K.SKIPPED_TYPES, "Foul"}
        for a, b in zip(events, events[1:]):
            same = a.seq_id == b.seq_id
            assert a.is_last != same and (same or a.marker or a.is_shot or a.team_id != b.team_id)
            assert not same or (a.team_id == b.team_id and (a.restart or not a.is_shot))  # a restart that is a shot does not end its sequence
        assert events[-1].is_last and events[-1].marker


def test_stitching_of_a_whole_feed(tables):
    """Stitching only drops lone touches; what is left are the same events in fewer sequences of one team each."""
    raw, left = (df.groupBy("combo_id").agg({"pos": "count", "seq_id": "max"}).orderBy("combo_id").collect()
                 for df in (sequences.sequence_events(tables.feed), sequences.stitched_events(tables.feed)))
    for r, s in zip(raw, left):
        assert s["count(pos)"] <= r["count(pos)"] and s["max(seq_id)"] <= r["max(seq_id)"]
    merged = sequences.stitched_events(tables.feed).groupBy("combo_id", "seq_id").agg({"team_id": "approx_count_distinct"})
    assert merged.filter("`approx_count_distinct(team_id)` <> 1").count() == 0


# -- states ----------------------------------------------------------------------------

def spine(spark, *events):
    rows = states.state_spine(feed(spark, list(events))).orderBy("state_id").collect()
    return [(r["period"], r["start_s"], r["end_s"], r["home_score"], r["away_score"], r["home_players"], r["away_players"], r["trigger"]) for r in rows]


def test_spine_cuts_at_goals(spark):
    got = spine(spark, (1, "Start", {"t": 0}), (1, "Goal", {"t": 100}), (2, "Goal", {"t": 100}), (2, "Goal", {"t": 300, "q": ["OwnGoal"]}), (1, "End", {"t": 600}))
    assert got == [(1, 0, 100, 0, 0, 11, 11, "kickoff"), (1, 100, 300, 1, 1, 11, 11, "goal_away"), (1, 300, 600, 2, 1, 11, 11, "goal_home")]


def test_goal_at_period_end_counts_from_the_next_period(spark):
    got = spine(spark, (1, "Start", {"t": 0}), (1, "Goal", {"t": 600}), (1, "End", {"t": 600}), (1, "Start", {"t": 700, "period": 2}), (1, "End", {"t": 900, "period": 2}))
    assert got == [(1, 0, 600, 0, 0, 11, 11, "kickoff"), (2, 700, 900, 1, 0, 11, 11, "period_start")]


def test_half_time_dismissal_applies_at_the_next_kick_off(spark):
    got = spine(spark, (1, "Start", {"t": 0}), (1, "End", {"t": 600}), (2, "Card", {"t": 650, "q": ["Red"]}), (1, "Start", {"t": 700, "period": 2}),
                (1, "End", {"t": 900, "period": 2}))
    assert got[1] == (2, 700, 900, 0, 0, 11, 10, "red_card_away")


def test_match_without_period_events_gets_one_interval(spark):
    assert spine(spark, (1, "Pass", {"t": 10}), (1, "Pass", {"t": 90})) == [(1, 0, 90, 0, 0, 11, 11, "kickoff")]


def test_state_lookup(spark):
    df = feed(spark, [(1, "Start", {"t": 0}), (1, "Goal", {"t": 100}), (1, "End", {"t": 600}), (1, "SubstitutionOn", {"t": 650, "period": 2}),
                      (1, "Start", {"t": 700, "period": 2}), (1, "End", {"t": 900, "period": 2}), (1, "Pass", {"t": 950, "period": 2})])
    tags = {r["pos"]: r["state_id"] for r in states.state_tags(df, states.state_spine(df)).collect()}
    assert tags[0] == 0 and tags[1] == 0  # a goal belongs to the state it ends
    assert tags[2] == 1 and tags[3] == 2 and tags[6] == 2
