"""Scalar building blocks. Every function takes and returns a Spark Column."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from . import fixed as K


# -- numbers -------------------------------------------------------------------

def rnd(value: Column, digits: int) -> Column:
    """Round half up on the decimal value.

    Going through a decimal absorbs the last-bit noise of sums of doubles, so
    the result does not depend on the order in which partitions are merged.
    """
    return F.round(value.cast("decimal(28,12)"), digits).cast("double")


def ratio(num: Column, den: Column, digits: int | None = None, scale: float = 1.0,
          empty: float | None = None) -> Column:
    """num / den * scale; `empty` (NULL by default) when den is 0 or NULL."""
    out = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    if scale != 1.0:
        out = out * F.lit(scale)
    if digits is not None:
        out = rnd(out, digits)
    return out if empty is None else F.coalesce(out, F.lit(float(empty)))


def pct(num: Column, den: Column, digits: int = 2, empty: float | None = None) -> Column:
    return ratio(num, den, digits, 100.0, empty)


def number_or(value: Column, default: float) -> Column:
    """Lenient cast: anything that is not a number becomes the default."""
    return F.coalesce(value.try_cast("double"), F.lit(float(default)))


def exact_sum(value: Column) -> Column:
    """Order-independent sum of a double column; each value counts with nine decimals, the documented precision of all sums."""
    return F.sum(value.cast("decimal(28,9)")).cast("double")


def leading_number(text: Column) -> Column:
    """First number of a display string: '67%' -> 67, '12/20 (60%)' -> 12, '-' -> NULL."""
    head = F.regexp_replace(text, r"(?s)^[^0-9.\-]*([0-9]+\.?[0-9]*).*$", "$1")
    return F.when(text.rlike("[0-9]"), head.try_cast("double"))


def normalize_name(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z]", "")


def clean_key(text: Column) -> Column:
    """Column-safe key: lower case, other characters to '_', runs squeezed, ends stripped."""
    return F.regexp_replace(
        F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def pivot_column_name(key: str) -> str:
    """Name of a pivoted column: '.', ' ' and '-' become '_', '+' becomes 'plus'."""
    return re.sub(r"[. \-]", "_", key.lower()).replace("+", "plus")


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds to a UTC timestamp; negative values reach before 1970."""
    return F.timestamp_seconds(seconds)


def parse_when(text: Column) -> Column:
    """Epoch seconds or a date string, whichever the text holds."""
    return F.coalesce(F.timestamp_seconds(text.try_cast("bigint")), F.try_to_timestamp(text))


# -- qualifiers ----------------------------------------------------------------

def has(name: str) -> Column:
    return F.array_contains("qnames", name)


def literals(values: Iterable) -> Column:
    """Constant array, as one expression."""
    return F.expr("array(" + ", ".join(f"{v!r}D" if isinstance(v, float) else repr(v) for v in values) + ")")


def constant_map(items: dict) -> Column:
    return F.expr("map(" + ", ".join(f"{k!r}, {v!r}" for k, v in items.items()) + ")")


def has_any(names: Iterable[str]) -> Column:
    return F.arrays_overlap("qnames", literals(names))


def has_id(qid: int) -> Column:
    return F.array_contains("qids", qid)


def has_any_id(qids: Iterable[int]) -> Column:
    return F.arrays_overlap("qids", literals(qids))


def first_of(names: Iterable[str]) -> Column:
    """First qualifier, in feed order, that is one of `names`; NULL if none."""
    wanted = literals(names)
    return F.try_element_at(F.filter("qnames", lambda n: F.array_contains(wanted, n)), F.lit(1))


def etype_in(*names: str) -> Column:
    return F.col("etype").isin(*names)


def with_flags(feed: DataFrame) -> DataFrame:
    """Feed with the qualifier tests that many metrics share, each computed once per event."""
    return feed.withColumns({
        "base_pass": (F.col("type_id") == 1) & ~has_any_id(K.NOT_BASE_PASS),
        "dead_ball": has_any_id(K.DEAD_BALL_PASS),
        "dead_ball_state": has_any_id(K.DEAD_BALL_STATE),
        "restart_event": has_any(K.RESTARTS),
    })


def is_base_pass() -> Column:
    return F.col("base_pass")


def open_play_pass() -> Column:
    return ~F.col("dead_ball")


def open_play_state() -> Column:
    return ~F.col("dead_ball_state")


def open_play_shot() -> Column:
    return ~has_any(K.SET_PIECE_SHOT)


def is_restart() -> Column:
    return F.col("restart_event")


# -- geometry ------------------------------------------------------------------

def xcol(default: float) -> Column:
    return F.coalesce(F.col("x"), F.lit(float(default)))


def ycol(default: float) -> Column:
    return F.coalesce(F.col("y"), F.lit(float(default)))


def goal_distance_m(x: Column, y: Column) -> Column:
    dx = (F.lit(100.0) - x) * F.lit(K.PITCH_LENGTH / 100)
    dy = (F.lit(50.0) - y) * F.lit(K.PITCH_WIDTH / 100)
    return F.sqrt(dx * dx + dy * dy)


def goal_distance_units(x: Column, y: Column) -> Column:
    dx, dy = F.lit(100.0) - x, F.lit(50.0) - y
    return F.sqrt(dx * dx + dy * dy)


def shot_angle(distance_m: Column) -> Column:
    """Angle of the goal frame in degrees, seen from the given distance."""
    angle = F.degrees(F.lit(2.0) * F.atan(F.lit(3.66) / F.nullif(distance_m, F.lit(0.0))))
    return F.coalesce(rnd(angle, 2), F.when(distance_m == 0, F.lit(90.0)))


def expected_threat(x: Column, y: Column) -> Column:
    rows, cols = len(K.XT_GRID), len(K.XT_GRID[0])
    cells = literals(v for line in K.XT_GRID for v in line)

    def cell(v: Column, n: int) -> Column:
        return F.greatest(F.least(F.floor(v / 100 * n), F.lit(n - 1)), F.lit(0))

    return F.get(cells, (cell(x, rows) * cols + cell(y, cols)).cast("int"))


def third(x: Column) -> Column:
    return (F.when(x <= K.OWN_THIRD_MAX, "own_third")
            .when(x <= K.FINAL_THIRD, "middle_third").otherwise("final_third"))


def foul_zone(x: Column) -> Column:
    return (F.when(x <= 17.0, "own_box").when(x <= 50.0, "own_half")
            .when(x <= K.FINAL_THIRD, "midfield").otherwise("danger_area"))


def touch_in_box(x: Column, y: Column) -> Column:
    return (x > 83) & y.between(21, 79)


def pass_into_box(end_x: Column, end_y: Column) -> Column:
    return (end_x >= 83) & end_y.between(21, 79)


def in_penalty_area(x: Column, y: Column) -> Column:
    return (x >= K.BOX_X_MIN) & y.between(K.BOX_Y_MIN, K.BOX_Y_MAX)


# -- shots, cards, states ------------------------------------------------------

def shot_on_target() -> Column:
    return (F.col("etype") == "Goal") | ((F.col("etype") == "SavedShot") & ~has_id(82))


def shot_blocked() -> Column:
    return (F.col("etype") == "SavedShot") & has_id(82)


def shot_off_target() -> Column:
    return etype_in("MissedShots", "ShotOnPost")


def shot_location() -> Column:
    hit = first_of(K.IN_BOX + K.OUT_OF_BOX)
    return (F.when(hit.isin(*K.IN_BOX), "InBox").when(hit.isNotNull(), "OutOfBox").otherwise("Unknown"))


def shot_placement() -> Column:
    hit = first_of(K.TOP_CORNER + K.LOW_CORNER + K.CENTRE_FRAME + K.MISSED)
    return (F.when(hit.isin(*K.TOP_CORNER), "TopCorner").when(hit.isin(*K.LOW_CORNER), "LowCorner")
            .when(hit.isin(*K.CENTRE_FRAME), "CentreFrame").otherwise(hit))


def length_band(length: Column) -> Column:
    return F.when(length < 10, "short").when(length <= 32, "medium").otherwise("long")


def card_type() -> Column:
    return (F.when(has_id(33), "SecondYellow").when(has_id(32), "Red")
            .when(has_id(31), "Yellow").otherwise("Unknown"))


def score_bucket(diff: Column) -> Column:
    return (F.when(diff <= -2, "trailing_2plus").when(diff == -1, "trailing_1").when(diff == 0, "level")
            .when(diff == 1, "leading_1").when(diff >= 2, "leading_2plus"))


def man_state(diff: Column) -> Column:
    return F.when(diff == 0, "even").when(diff > 0, "up").when(diff < 0, "down")


def clock(expanded_s: Column, shift_s: Column, period: Column) -> tuple[Column, Column, Column]:
    """Match clock of an expanded time: (minute, second, display like "45+3'")."""
    clock_s = F.greatest(F.lit(0), expanded_s - F.coalesce(shift_s, F.lit(0))).cast("bigint")
    minute = F.floor(clock_s / 60).cast("bigint")
    second = clock_s - minute * 60
    shown = F.when(second > 0, minute + 1).otherwise(F.greatest(minute, F.lit(1)))
    nominal = period * 45
    for p, end in K.PERIOD_END_MINUTE.items():
        nominal = F.when(period == p, F.lit(end)).otherwise(nominal)
    display = F.when(shown > nominal,
                     F.concat(nominal.cast("string"), F.lit("+"), (shown - nominal).cast("string"), F.lit("'"))
                     ).otherwise(F.concat(shown.cast("string"), F.lit("'")))
    return minute, second, display


def position_label(position_id: Column, y: Column | None = None) -> Column:
    """Position label; central labels get a side prefix when a lateral y is given."""
    base = F.try_element_at(constant_map(K.POSITION_LABEL), position_id.cast("int"))
    if y is None:
        return base
    return (F.when(~base.isin(*K.LATERAL_POSITIONS) | y.isNull(), base)
            .when(y > 0.65, F.concat(F.lit("R"), base))
            .when(y < 0.35, F.concat(F.lit("L"), base))
            .when(base.isin(*K.CENTRAL_PREFIX), F.concat(F.lit("C"), base))
            .otherwise(base))


def usual_position(position_id: Column) -> Column:
    out = F.lit(None).cast("string")
    for pid, label in K.USUAL_POSITION.items():
        out = F.when(position_id == pid, F.lit(label)).otherwise(out)
    return out


def shot_key(match: Column, row_id: Column) -> Column:
    return F.concat_ws("-", match, row_id.cast("string"))


def count_where(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)
