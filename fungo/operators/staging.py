"""Typed staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fungo.functions import labels
from fungo.functions.dates import ns_to_date
from fungo.functions.numeric import to_number
from fungo.functions.pitch import club_batting, club_pitching
from fungo.schemas import PITCH_COLUMNS, ROSTERS, TEAMS

_HALF = ("inning_topbot", "home_team", "away_team")


def stage_pitches(raw: DataFrame) -> DataFrame:
    """One row per pitch of known type: renamed, typed, with both clubs of record."""
    derived = {
        "game_date": ns_to_date(F.col("game_date")),
        "launch_angle": to_number(F.col("launch_angle")),
        "batter_team": club_batting(*_HALF),
        "pitching_team": club_pitching(*_HALF),
    }
    projection: list[str] = []
    for name, staged, _ in PITCH_COLUMNS:
        projection.append(f"{name} as {staged}")
        if name == "away_team":
            projection += ["batter_team", "pitching_team"]
    return raw.where("pitch_type is not null").withColumns(derived).selectExpr(*projection)


def stage_teams(raw: DataFrame) -> DataFrame:
    whole = {name: F.col(name).cast("bigint") for name in ("team_id", "league_id", "division_id")}
    return raw.withColumns(whole).select(*TEAMS.names)


def _first_per_player(df: DataFrame, *order: Column | str) -> DataFrame:
    """First row per player. The row-number filter is applied before the shuffle as well, so a
    player with very many rows sends one row per task."""
    ranked = df.withColumn(
        "choice", F.row_number().over(Window.partitionBy("mlbam_id").orderBy(*order))
    )
    return ranked.where(F.col("choice") == 1).drop("choice")


def _typed_roster(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {name: F.col(name).cast("bigint") for name in ("mlbam_id", "team_id")}
    )


def stage_rosters(raw: DataFrame) -> DataFrame:
    """One club per player: the lowest club id; equal ids are settled by the remaining columns."""
    rest = [name for name in ROSTERS.names if name not in ("mlbam_id", "team_id")]
    typed = _typed_roster(raw).select(*ROSTERS.names)
    return _first_per_player(typed, "team_id", *rest)


def label_status(raw: DataFrame) -> DataFrame:
    """Roster status rows with availability label and flags, before any dedup."""
    code, text = F.col("status_code"), F.col("status_description")
    return _typed_roster(raw).select(
        "mlbam_id",
        "player_full_name",
        "team_id",
        "status_code",
        "status_description",
        labels.availability(code, text).alias("availability"),
        labels.is_active(code).alias("is_active"),
        labels.is_injured(code).alias("is_injured"),
    )


def stage_roster_status(raw: DataFrame) -> DataFrame:
    """One status per player: active before injured before the rest, then the lowest club id."""
    return _first_per_player(
        label_status(raw),
        labels.status_rank(F.col("status_code")),
        "team_id",
        "status_code",
        "status_description",
        "player_full_name",
    )
