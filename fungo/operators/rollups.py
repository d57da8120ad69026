"""Season and league roll-ups of the game facts, and the wide-to-long pitch mix.

A rate is always re-divided from summed parts. Every aggregate combines on the map side, so
a player or club with very many games costs no single task more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fungo.functions.numeric import safe_divide, weighted_mean
from fungo.functions.pitch import MIX_LABELS


def _mean(value: str, weight: str) -> Column:
    return weighted_mean(F.col(value), F.col(weight))


def _ratio(part: str, whole: str) -> Column:
    return safe_divide(F.sum(part), F.sum(whole))


def _sums(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


BATTER_SUMS = (
    "plate_appearances",
    "at_bats",
    "hits",
    "home_runs",
    "strikeouts",
    "walks",
    "batted_balls",
)
PITCHER_SUMS = (
    "total_pitches",
    "batters_faced",
    "strikeouts",
    "walks",
    "hits_allowed",
    "home_runs_allowed",
)


@dataclass(frozen=True)
class StintRollup:
    """How games become one line per stint.

    ``figures`` gives the rates of the line in order: a ratio of two sums, a mean of a value by a
    weight, or the peak of a value. ``other_means`` are kept with the parts of a line for reports
    that are made from them.
    """

    keys: tuple[str, ...]
    sums: tuple[str, ...]
    figures: Mapping[str, tuple[str, ...]]
    other_means: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def lines(self, games: DataFrame) -> DataFrame:
        """One row per stint from all its games."""
        rates = {"ratio": _ratio, "mean": _mean, "peak": F.max}
        return games.groupBy(*self.keys).agg(
            F.count_distinct("game_id").alias("games"),
            *_sums(*self.sums),
            *(rates[kind](*columns).alias(name) for name, (kind, *columns) in self.figures.items()),
        )

    @property
    def peaks(self) -> tuple[str, ...]:
        return tuple(name for name, (kind, *_) in self.figures.items() if kind == "peak")

    @property
    def means(self) -> dict[str, tuple[str, str]]:
        own = {name: rest for name, (kind, *rest) in self.figures.items() if kind == "mean"}
        return {**own, **self.other_means}

    @property
    def counts(self) -> tuple[str, ...]:
        """Columns that are added up as they are: sums of the line, parts of its ratios, weights."""
        parts = [name for kind, *columns in self.figures.values() if kind == "ratio" for name in columns]
        weights = [weight for _, weight in self.means.values()]
        return tuple(dict.fromkeys((*self.sums, *parts, *weights)))

    @property
    def adding(self) -> tuple[str, ...]:
        """What adds up over dates: the counts, and of each mean its weighted sum and how many went into it."""
        pairs = (f"{name}_{part}" for name in self.means for part in ("sum", "n"))
        return ("n_games", *self.counts, *pairs)

    def per_date(self, games: DataFrame) -> DataFrame:
        """The parts of the lines by date: what adds up, the peaks, and the ids of the games of the day."""
        weighted = {name: F.col(value) * F.col(weight) for name, (value, weight) in self.means.items()}
        peaks = {name: columns[0] for name, (kind, *columns) in self.figures.items() if kind == "peak"}
        return games.groupBy(*self.keys, "game_date").agg(
            F.count(F.lit(1)).alias("n_games"),
            *_sums(*self.counts),
            *(F.sum(product).alias(f"{name}_sum") for name, product in weighted.items()),
            *(F.count(product).alias(f"{name}_n") for name, product in weighted.items()),
            *(F.max(value).alias(name) for name, value in peaks.items()),
            F.collect_set("game_id").alias("game_ids"),
        )

    def lines_of(self, totals: DataFrame) -> DataFrame:
        """Lines from added-up parts with ``games`` and the peaks."""
        return totals.select(
            *self.keys, "games", *self.sums,
            *(self.rate(kind, name, columns).alias(name) for name, (kind, *columns) in self.figures.items()),
        )

    def rate(self, kind: str, name: str, columns: Sequence[str]) -> Column:
        """A figure from added-up parts."""
        if kind == "ratio":
            return safe_divide(F.col(columns[0]), F.col(columns[1]))
        if kind == "mean":
            # Rounding may leave a trace of values that were taken off again.
            total = F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_sum"))
            return safe_divide(total, F.col(columns[1]))
        return F.col(name)


BATTER_STINTS = StintRollup(
    keys=("batter_id", "batter_team"),
    sums=BATTER_SUMS,
    figures={
        "hard_hit_rate": ("ratio", "hard_hit_count", "batted_balls"),
        "barrel_rate": ("ratio", "barrel_count", "batted_balls"),
        "avg_exit_velocity": ("mean", "avg_exit_velocity_mph", "batted_balls"),
        "max_exit_velocity": ("peak", "max_exit_velocity_mph"),
        "avg_launch_angle": ("mean", "avg_launch_angle_deg", "batted_balls"),
        "xwoba": ("mean", "avg_xwoba", "plate_appearances"),
        "xba": ("mean", "avg_xba", "at_bats"),
        "xslg": ("mean", "avg_xslg", "at_bats"),
    },
)
PITCHER_STINTS = StintRollup(
    keys=("pitcher_id", "pitcher_name", "pitcher_throws", "pitching_team"),
    sums=PITCHER_SUMS,
    figures={
        "whiff_rate": ("ratio", "whiffs", "swings"),
        "strike_pct": ("ratio", "strikes", "total_pitches"),
        "avg_velocity": ("mean", "avg_pitch_velocity_mph", "total_pitches"),
        "max_velocity": ("peak", "max_pitch_velocity_mph"),
        "avg_spin_rate": ("mean", "avg_spin_rate_rpm", "total_pitches"),
        "avg_extension": ("mean", "avg_extension_ft", "total_pitches"),
    },
    other_means={label: (f"pct_{label}", "total_pitches") for label in MIX_LABELS},
)


def batter_stints(games: DataFrame) -> DataFrame:
    """One row per batter and club: all games with that club."""
    return BATTER_STINTS.lines(games)


def pitcher_stints(games: DataFrame) -> DataFrame:
    """One row per pitcher, name, arm and club."""
    return PITCHER_STINTS.lines(games)


def mix_long(games: DataFrame, *keep: str) -> DataFrame:
    """Nine rows per pitcher and game, one per pitch label; a missing share stays as null."""
    wide = games.select(*keep, *(F.col(f"pct_{label}").alias(label) for label in MIX_LABELS))
    return wide.unpivot(list(keep), list(MIX_LABELS), "pitch_type", "pct")


def mix_by_stint(games: DataFrame) -> DataFrame:
    """Pitch share per pitcher, club and label, weighted by the pitches of each game.

    The nine weighted sums are taken before the unpivot, so the rows that are shuffled are
    one per stint and task instead of nine per game.
    """
    stints = games.groupBy("pitcher_id", "pitcher_name", "pitching_team").agg(
        *(_mean(f"pct_{label}", "total_pitches").alias(label) for label in MIX_LABELS)
    )
    return stints.unpivot(
        ["pitcher_id", "pitcher_name", "pitching_team"],
        list(MIX_LABELS),
        "pitch_type",
        "pitch_pct",
    )


def mix_of_totals(totals: DataFrame) -> DataFrame:
    """``mix_by_stint`` from the stored totals of the pitchers' stints."""
    keys = ("pitcher_id", "pitcher_name", "pitching_team")
    parts = ["total_pitches", *(f"{label}_{part}" for label in MIX_LABELS for part in ("sum", "n"))]
    stints = totals.groupBy(*keys).agg(*_sums(*parts))
    wide = stints.select(
        *keys, *(PITCHER_STINTS.rate("mean", label, ("", "total_pitches")).alias(label) for label in MIX_LABELS)
    )
    return wide.unpivot(list(keys), list(MIX_LABELS), "pitch_type", "pitch_pct")


def league_of_totals(totals: DataFrame, rollup: StintRollup, figures: Mapping[str, str]) -> DataFrame:
    """League figures, by name the figure of a stint that they take the league's parts of."""
    league = totals.agg(*_sums(*rollup.adding))
    return league.select(
        *(
            rollup.rate(rollup.figures[figure][0], figure, rollup.figures[figure][1:]).alias(name)
            for name, figure in figures.items()
        )
    )


LEAGUE_BATTING = {
    "league_avg_exit_velocity": "avg_exit_velocity",
    "league_avg_xwoba": "xwoba",
    "league_hard_hit_rate": "hard_hit_rate",
}
LEAGUE_PITCHING = {
    "league_avg_velocity": "avg_velocity",
    "league_avg_whiff_rate": "whiff_rate",
    "league_avg_strike_pct": "strike_pct",
}


def league_batting(games: DataFrame) -> DataFrame:
    return games.agg(
        _mean("avg_exit_velocity_mph", "batted_balls").alias("league_avg_exit_velocity"),
        _mean("avg_xwoba", "plate_appearances").alias("league_avg_xwoba"),
        _ratio("hard_hit_count", "batted_balls").alias("league_hard_hit_rate"),
    )


def league_pitching(games: DataFrame) -> DataFrame:
    return games.agg(
        _mean("avg_pitch_velocity_mph", "total_pitches").alias("league_avg_velocity"),
        _ratio("whiffs", "swings").alias("league_avg_whiff_rate"),
        _ratio("strikes", "total_pitches").alias("league_avg_strike_pct"),
    )


def combined_batting(stints: DataFrame) -> DataFrame:
    """One season line per batter from the stint rows: counts summed, rates re-weighted."""
    return stints.groupBy("batter_id").agg(
        F.count(F.lit(1)).alias("stints"),
        *_sums("games", *BATTER_SUMS),
        _mean("hard_hit_rate", "batted_balls").alias("hard_hit_rate"),
        _mean("barrel_rate", "batted_balls").alias("barrel_rate"),
        _mean("avg_exit_velocity", "batted_balls").alias("avg_exit_velocity"),
        F.max("max_exit_velocity").alias("max_exit_velocity"),
        _mean("avg_launch_angle", "batted_balls").alias("avg_launch_angle"),
        _mean("xwoba", "plate_appearances").alias("xwoba"),
        _mean("xba", "at_bats").alias("xba"),
        _mean("xslg", "at_bats").alias("xslg"),
    )


def combined_pitching(games: DataFrame) -> DataFrame:
    """One season line per pitcher, from the game facts.

    The stint rows do not carry swings and whiffs, so their rates can not be recombined.
    """
    line = games.groupBy("pitcher_id").agg(
        F.count_distinct("game_id").alias("games"),
        *_sums(*PITCHER_SUMS),
        _ratio("whiffs", "swings").alias("whiff_rate"),
        _ratio("strikes", "total_pitches").alias("strike_pct"),
        _mean("avg_pitch_velocity_mph", "total_pitches").alias("avg_velocity"),
        F.max("max_pitch_velocity_mph").alias("max_velocity"),
        _mean("avg_spin_rate_rpm", "total_pitches").alias("avg_spin_rate"),
        _mean("avg_extension_ft", "total_pitches").alias("avg_extension"),
    )
    # Counted apart: two distinct counts in one aggregate would copy every row.
    clubs = games.groupBy(F.col("pitcher_id").alias("of_pitcher")).agg(
        F.count_distinct("pitching_team").alias("stints")
    )
    joined = line.join(clubs, F.col("pitcher_id").eqNullSafe(F.col("of_pitcher")))
    figures = [name for name in line.columns if name != "pitcher_id"]
    return joined.select("pitcher_id", "stints", *figures)


def league_batting_measured(games: DataFrame) -> DataFrame:
    """League means over measured games only: the opt-in that leaves unmeasured weight out."""

    def measured(value: str, weight: str) -> Column:
        return weighted_mean(F.col(value), F.col(weight), null_weight="drop")

    return games.agg(
        measured("avg_exit_velocity_mph", "batted_balls").alias("measured_avg_exit_velocity"),
        measured("avg_xwoba", "plate_appearances").alias("measured_avg_xwoba"),
    )
