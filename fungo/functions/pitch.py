"""Pitch-level predicates over the staged column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event, description and pitch-type codes of the tracking feed.
HIT_EVENTS = ("single", "double", "triple", "home_run")
STRIKEOUT_EVENTS = ("strikeout", "strikeout_double_play")
WALK_EVENTS = ("walk", "intent_walk")
NOT_AT_BAT_EVENTS = (
    "walk",
    "intent_walk",
    "hit_by_pitch",
    "sac_fly",
    "sac_bunt",
    "sac_fly_double_play",
    "catcher_interf",
)
SWING_DESCRIPTIONS = (
    "hit_into_play",
    "swinging_strike",
    "foul",
    "foul_tip",
    "swinging_strike_blocked",
    "missed_bunt",
    "foul_bunt",
    "bunt_foul_tip",
)
WHIFF_DESCRIPTIONS = (
    "swinging_strike",
    "swinging_strike_blocked",
    "missed_bunt",
    "bunt_foul_tip",
)
PITCH_LABELS = {
    "FF": "four_seam",
    "SI": "sinker",
    "FC": "cutter",
    "SL": "slider",
    "ST": "sweeper",
    "CU": "curveball",
    "CH": "changeup",
    "FS": "splitter",
}
OTHER_PITCH = "other"
MIX_LABELS = (*PITCH_LABELS.values(), OTHER_PITCH)
HARD_HIT_MPH = 95
BARREL_CODE = 6


def event_in(*events: str) -> Column:
    return F.col("events").isin(*events)


def ends_at_bat() -> Column:
    """The event counts as an at-bat; null, so not counted, while there is no event."""
    return ~event_in(*NOT_AT_BAT_EVENTS)


def outcome_is(category: str) -> Column:
    return F.col("pitch_outcome_category") == category


def in_play() -> Column:
    """Ball put in play. Fouls carry an exit velocity too, so that alone does not tell."""
    return outcome_is("X")


def hard_hit() -> Column:
    return in_play() & (F.col("exit_velocity_mph") >= HARD_HIT_MPH)


def barrel() -> Column:
    return in_play() & (F.col("launch_speed_angle") == BARREL_CODE)


def swing() -> Column:
    return F.col("pitch_description").isin(*SWING_DESCRIPTIONS)


def whiff() -> Column:
    return F.col("pitch_description").isin(*WHIFF_DESCRIPTIONS)


def of_type(label: str) -> Column:
    """Pitch type test by label; ``other`` is every known type without a label of its own."""
    if label == OTHER_PITCH:
        return ~F.col("pitch_type").isin(*PITCH_LABELS)
    return F.col("pitch_type").isin(*(code for code, name in PITCH_LABELS.items() if name == label))


def club_batting(half: str, home: str, away: str) -> Column:
    """Club at bat: the visitors in the top half, in any other case the home side."""
    return F.when(F.col(half) == "Top", F.col(away)).otherwise(F.col(home))


def club_pitching(half: str, home: str, away: str) -> Column:
    return F.when(F.col(half) == "Top", F.col(home)).otherwise(F.col(away))
