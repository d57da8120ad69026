"""Player-by-game facts from staged pitches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fungo.functions import pitch, short_text
from fungo.functions.numeric import safe_divide

GAME_KEYS = ("game_id", "game_date", "game_year", "home_team", "away_team")


@dataclass(frozen=True)
class GameMetrics:
    """What to compute per player and game.

    ``appearances``: distinct plate appearances with at least one pitch that meets the test.
    ``counts``: pitches that meet the test. ``means`` and ``peaks``: average and maximum of a
    value, nulls left out. ``codes``: texts of a few letters, by maximum. ``names``: text that does not vary
    within a plate appearance, by maximum over the game.
    """

    appearances: Mapping[str, Column]
    counts: Mapping[str, Column]
    means: Mapping[str, Column]
    peaks: Mapping[str, Column]
    codes: Mapping[str, Column] = field(default_factory=dict)
    names: Mapping[str, Column] = field(default_factory=dict)


# Plate appearances of a game that share a row, as bits of two words; more than a usual game has.
WORD, TOGETHER_BITS = 64, 7


def game_facts(pitches: DataFrame, keys: Sequence[str], metrics: GameMetrics) -> DataFrame:
    """Aggregate pitches to ``keys`` in two steps, by way of the plate appearances in words of bits.

    A plate appearance is a bit, and the different ones of a game are words of bits: words joined by OR count
    none twice, however its pitches lie, so no row travels for each appearance and none is copied
    per distinct expression. The first step has a row for each 128 numbers, one for a usual game; a hot game
    with any number of them is many rows. Both steps combine on the map side before they shuffle.
    Averages travel as sum and count.

    The maximum of a text can not be kept in a hash table and would have every pitch sorted. Codes
    are therefore compared as numbers of the same order, which hold seven bytes; a longer one fails
    instead of being cut. Names are grouping keys until a game is a few rows.
    """
    number = F.col("at_bat_number")
    position = number.bitwiseAND((1 << TOGETHER_BITS) - 1)
    one = F.lit(1).cast("bigint")
    bit = F.call_function("shiftleft", one, position.bitwiseAND(WORD - 1).cast("int"))
    # Tests and bits are made once, before they meet: the code of the step has to stay so small that the JVM
    # compiles it. A pitch without a number has no bit.
    seen = {f"{name}_seen": test for name, test in metrics.appearances.items()}
    bits = {"low": F.when(position < WORD, bit), "high": F.when(position >= WORD, bit)}
    words = [f"{name}_{word}" for name in metrics.appearances for word in bits]
    named = pitches.withColumns(dict(metrics.names)).withColumns({**seen, **bits})
    together = F.shiftright(number, TOGETHER_BITS).alias("together")
    per_words = named.groupBy(*keys, *metrics.names, together).agg(
        F.count(F.lit(1)).alias("total_pitches"),
        *(F.count_if(test).alias(name) for name, test in metrics.counts.items()),
        *(F.sum(value).alias(f"{name}_sum") for name, value in metrics.means.items()),
        *(F.count(value).alias(f"{name}_n") for name, value in metrics.means.items()),
        *(F.max(value).alias(name) for name, value in metrics.peaks.items()),
        *(F.max(short_text.to_code(value)).alias(name) for name, value in metrics.codes.items()),
        *(
            F.bit_or(F.when(F.col(f"{name}_seen"), F.col(word))).alias(f"{name}_{word}")
            for name in metrics.appearances
            for word in bits
        ),
    )
    counted = per_words.withColumns(
        {name: _bits(f"{name}_low") + _bits(f"{name}_high") for name in metrics.appearances}
    ).drop(*words)
    parts = [f"{name}_{part}" for name in metrics.means for part in ("sum", "n")]
    games = counted.groupBy(*keys).agg(
        *(F.sum(name).alias(name) for name in (*metrics.appearances, "total_pitches", *metrics.counts, *parts)),
        *(F.max(name).alias(name) for name in (*metrics.peaks, *metrics.codes, *metrics.names)),
    )
    return games.withColumns(
        {
            **{name: safe_divide(F.col(f"{name}_sum"), F.col(f"{name}_n")) for name in metrics.means},
            **{name: short_text.to_text(F.col(name)) for name in metrics.codes},
        }
    )


def _bits(name: str) -> Column:
    """How many plate appearances a word has; a missing one has none."""
    return F.coalesce(F.bit_count(name), F.lit(0)).cast("bigint")


def _when_in_play(value: str) -> Column:
    return F.when(pitch.in_play(), F.col(value))


def batter_metrics() -> GameMetrics:
    return GameMetrics(
        appearances={
            "plate_appearances": F.col("events").isNotNull(),
            "at_bats": pitch.ends_at_bat(),
            "hits": pitch.event_in(*pitch.HIT_EVENTS),
            "singles": pitch.event_in("single"),
            "doubles": pitch.event_in("double"),
            "triples": pitch.event_in("triple"),
            "home_runs": pitch.event_in("home_run"),
            "strikeouts": pitch.event_in(*pitch.STRIKEOUT_EVENTS),
            "walks": pitch.event_in(*pitch.WALK_EVENTS),
        },
        counts={
            "swings": pitch.swing(),
            "whiffs": pitch.whiff(),
            "hard_hit_count": pitch.hard_hit(),
            "batted_balls": pitch.in_play(),
            "barrel_count": pitch.barrel(),
        },
        means={
            "avg_exit_velocity_mph": _when_in_play("exit_velocity_mph"),
            "avg_launch_angle_deg": _when_in_play("launch_angle_deg"),
            "avg_xba": F.col("xba"),
            "avg_xwoba": F.col("xwoba"),
            "avg_xslg": F.col("xslg"),
            "avg_bat_speed": F.col("bat_speed"),
            "avg_swing_length": F.col("swing_length"),
        },
        peaks={"max_exit_velocity_mph": _when_in_play("exit_velocity_mph")},
        codes={"batter_side": F.col("batter_side")},
    )


def pitcher_metrics() -> GameMetrics:
    return GameMetrics(
        appearances={
            "batters_faced": F.lit(True),
            "strikeouts": pitch.event_in(*pitch.STRIKEOUT_EVENTS),
            "walks": pitch.event_in(*pitch.WALK_EVENTS),
            "hits_allowed": pitch.event_in(*pitch.HIT_EVENTS),
            "home_runs_allowed": pitch.event_in("home_run"),
        },
        counts={
            "strikes": pitch.outcome_is("S"),
            "balls": pitch.outcome_is("B"),
            "called_strikes": F.col("pitch_description") == "called_strike",
            "swings": pitch.swing(),
            "whiffs": pitch.whiff(),
            **{f"cnt_{label}": pitch.of_type(label) for label in pitch.MIX_LABELS},
            "hard_hit_allowed_count": pitch.hard_hit(),
            "batted_balls_allowed": pitch.in_play(),
        },
        means={
            "avg_pitch_velocity_mph": F.col("pitch_velocity_mph"),
            "avg_spin_rate_rpm": F.col("spin_rate_rpm"),
            "avg_extension_ft": F.col("extension_ft"),
            "avg_exit_velocity_allowed": _when_in_play("exit_velocity_mph"),
            "avg_launch_angle_allowed": _when_in_play("launch_angle_deg"),
            "avg_xba_against": F.col("xba"),
            "avg_xwoba_against": F.col("xwoba"),
        },
        peaks={"max_pitch_velocity_mph": F.col("pitch_velocity_mph")},
        codes={"pitcher_throws": F.col("pitcher_throws")},
        names={"pitcher_name": F.col("pitcher_name")},
    )


def _ratio(numerator: str, denominator: str) -> Column:
    return safe_divide(F.col(numerator), F.col(denominator))


# Column order of the two fact tables.
BATTER_GAME_COLUMNS = (
    "batter_id",
    *GAME_KEYS,
    "batter_team",
    "batter_side",
    "total_pitches",
    "plate_appearances",
    "at_bats",
    "hits",
    "singles",
    "doubles",
    "triples",
    "home_runs",
    "strikeouts",
    "walks",
    "swings",
    "whiffs",
    "whiff_rate",
    "avg_exit_velocity_mph",
    "max_exit_velocity_mph",
    "avg_launch_angle_deg",
    "hard_hit_count",
    "batted_balls",
    "hard_hit_rate",
    "barrel_count",
    "barrel_rate",
    "avg_xba",
    "avg_xwoba",
    "avg_xslg",
    "avg_bat_speed",
    "avg_swing_length",
)
PITCHER_GAME_COLUMNS = (
    "pitcher_id",
    "pitcher_name",
    *GAME_KEYS,
    "pitching_team",
    "pitcher_throws",
    "total_pitches",
    "batters_faced",
    "strikeouts",
    "walks",
    "hits_allowed",
    "home_runs_allowed",
    "avg_pitch_velocity_mph",
    "max_pitch_velocity_mph",
    "avg_spin_rate_rpm",
    "avg_extension_ft",
    "strikes",
    "balls",
    "strike_pct",
    "called_strikes",
    "swings",
    "whiffs",
    "whiff_rate",
    *(f"pct_{label}" for label in pitch.MIX_LABELS),
    "avg_exit_velocity_allowed",
    "avg_launch_angle_allowed",
    "hard_hit_allowed_count",
    "batted_balls_allowed",
    "hard_hit_allowed_rate",
    "avg_xba_against",
    "avg_xwoba_against",
)


def batter_games(pitches: DataFrame) -> DataFrame:
    """One row per batter and game."""
    facts = game_facts(pitches, ("batter_id", *GAME_KEYS, "batter_team"), batter_metrics())
    return facts.withColumns(
        {
            "whiff_rate": _ratio("whiffs", "swings"),
            "hard_hit_rate": _ratio("hard_hit_count", "batted_balls"),
            "barrel_rate": _ratio("barrel_count", "batted_balls"),
        }
    ).select(*BATTER_GAME_COLUMNS)


def pitcher_games(pitches: DataFrame) -> DataFrame:
    """One row per pitcher and game, with the share of each pitch type."""
    facts = game_facts(pitches, ("pitcher_id", *GAME_KEYS, "pitching_team"), pitcher_metrics())
    return facts.withColumns(
        {
            "strike_pct": _ratio("strikes", "total_pitches"),
            "whiff_rate": _ratio("whiffs", "swings"),
            "hard_hit_allowed_rate": _ratio("hard_hit_allowed_count", "batted_balls_allowed"),
            **{
                f"pct_{label}": _ratio(f"cnt_{label}", "total_pitches")
                for label in pitch.MIX_LABELS
            },
        }
    ).select(*PITCHER_GAME_COLUMNS)
