"""Reporting tables: facts rolled up first, then dimensions attached."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fungo.functions import labels
from fungo.functions.numeric import safe_divide
from fungo.operators import attach, rollups

_ATTACHED = (*attach.TEAM_ATTRIBUTES, *attach.STATUS_ATTRIBUTES)

# Column order of the batter game report after its attached columns.
_GAME_LOG = (
    "game_date",
    "home_team",
    "away_team",
    "batter_side",
    "plate_appearances",
    "at_bats",
    "hits",
    "singles",
    "doubles",
    "triples",
    "home_runs",
    "strikeouts",
    "walks",
    "batted_balls",
    "avg_exit_velocity_mph",
    "max_exit_velocity_mph",
    "avg_launch_angle_deg",
    "barrel_count",
    "hard_hit_rate",
    "barrel_rate",
    "avg_xba",
    "avg_xwoba",
    "avg_xslg",
)


def batter_game(
    games: DataFrame, players: DataFrame, teams: DataFrame, status: DataFrame
) -> DataFrame:
    """Game log per batter. The game id is not shown, so a doubleheader gives two rows a day."""
    log = attach.attach_name(games, players, "batter_id", "batter_name")
    log = attach.attach_team(log, teams, "batter_team")
    log = attach.attach_status(log, status, "batter_id")
    rates = {
        "hard_hit_rate": safe_divide(F.col("hard_hit_count"), F.col("batted_balls")),
        "barrel_rate": safe_divide(F.col("barrel_count"), F.col("batted_balls")),
    }
    return log.withColumns(rates).select(
        "batter_id", "batter_name", "batter_team", *_ATTACHED, *_GAME_LOG
    )


def batter_season(
    games: DataFrame, players: DataFrame, teams: DataFrame, status: DataFrame
) -> DataFrame:
    """Season line per batter and club."""
    return batter_season_of(rollups.batter_stints(games), players, teams, status)


def batter_season_of(
    stints: DataFrame, players: DataFrame, teams: DataFrame, status: DataFrame
) -> DataFrame:
    """The season report from its stint lines."""
    figures = [name for name in stints.columns if name not in ("batter_id", "batter_team")]
    named = attach.attach_name(stints, players, "batter_id", "batter_name")
    full = attach.attach_status(
        attach.attach_team(named, teams, "batter_team"), status, "batter_id"
    )
    return full.select("batter_id", "batter_name", "batter_team", *_ATTACHED, *figures)


def pitcher_season(games: DataFrame, teams: DataFrame, status: DataFrame) -> DataFrame:
    """Season line per pitcher and club."""
    return pitcher_season_of(rollups.pitcher_stints(games), teams, status)


def pitcher_season_of(stints: DataFrame, teams: DataFrame, status: DataFrame) -> DataFrame:
    """The season report from its stint lines."""
    keys = ("pitcher_id", "pitcher_name", "pitcher_throws", "pitching_team")
    figures = [name for name in stints.columns if name not in keys]
    full = attach.attach_status(
        attach.attach_team(stints, teams, "pitching_team"), status, "pitcher_id"
    )
    return full.select(*keys, *_ATTACHED, *figures)


def pitch_mix(games: DataFrame, teams: DataFrame, status: DataFrame) -> DataFrame:
    """Pitch share per pitcher, club and pitch label."""
    return pitch_mix_of(rollups.mix_by_stint(games), teams, status)


def pitch_mix_of(mix: DataFrame, teams: DataFrame, status: DataFrame) -> DataFrame:
    """The pitch mix report from the shares of each stint."""
    full = attach.attach_status(
        attach.attach_team(mix, teams, "pitching_team"), status, "pitcher_id"
    )
    return full.select(
        "pitcher_id", "pitcher_name", "pitching_team", *_ATTACHED, "pitch_type", "pitch_pct"
    )


def qualified_hitters(
    season: DataFrame, min_batted_balls: int = 50, top: int | None = None
) -> DataFrame:
    """Stints with enough batted balls, best expected average first; all of them unless ``top``."""
    ranked = (
        season.where(F.col("batted_balls") >= min_batted_balls)
        .orderBy(F.desc_nulls_last("xwoba"), "batter_id", "batter_team")
        .select(
            "batter_id", "batter_name", "batter_team", "plate_appearances", "batted_balls",
            "avg_exit_velocity", "hard_hit_rate", "barrel_rate", "xwoba",
        )
    )
    return ranked if top is None else ranked.limit(top)


def whiff_leaders(
    season: DataFrame, min_pitches: int = 250, top: int | None = None
) -> DataFrame:
    """Stints with enough pitches, highest whiff rate first; all of them unless ``top``."""
    ranked = (
        season.where(F.col("total_pitches") >= min_pitches)
        .orderBy(F.desc_nulls_last("whiff_rate"), "pitcher_id", "pitching_team")
        .select(
            "pitcher_id", "pitcher_name", "pitching_team", "total_pitches",
            "whiff_rate", "strike_pct", "avg_velocity",
        )
    )
    return ranked if top is None else ranked.limit(top)


def contact_quality(season: DataFrame) -> DataFrame:
    """Exit velocity against launch angle per stint, sized by batted balls, tiered by xwOBA."""
    return season.where(F.col("batted_balls") > 0).select(
        "batter_id",
        "batter_name",
        "batter_team",
        "avg_exit_velocity",
        "avg_launch_angle",
        "batted_balls",
        "xwoba",
        labels.tier(F.col("xwoba"), labels.XWOBA_BOUNDS).alias("xwoba_tier"),
    )
