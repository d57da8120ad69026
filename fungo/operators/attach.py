"""Left joins that keep the grain of the fact side.

No join carries a broadcast hint. Adaptive execution broadcasts a dimension when its measured
size is below the session's threshold and otherwise sorts and merges, splitting hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fungo.functions.labels import full_name

TEAM_ATTRIBUTES = ("team_id", "team_abbrev", "team_name", "league_name", "division_name")
STATUS_ATTRIBUTES = ("availability", "status_description")


def one_row_per_key(dim: DataFrame, key: str, name: str) -> DataFrame:
    """``dim`` for a join that must not multiply rows: a key that two rows have fails, and is named.

    Dimension and check are one aggregate, so nothing is read twice. Rows without a key meet nothing and
    become one.
    """
    others = [column for column in dim.columns if column != key]
    grouped = dim.groupBy(key).agg(
        F.count(F.lit(1)).alias("guarded_rows"), *(F.first(column).alias(column) for column in others)
    )
    told = F.concat(F.lit(f"repeated key: {name}.{key} = "), F.col(key).cast("string"))
    failing = F.raise_error(told).cast(dim.schema[key].dataType)
    checked = F.when((F.col("guarded_rows") > 1) & F.col(key).isNotNull(), failing).otherwise(F.col(key))
    return grouped.withColumn(key, checked).select(*dim.columns)


def attach_team(facts: DataFrame, teams: DataFrame, club: str) -> DataFrame:
    """Add team attributes by the abbreviation of the club of record."""
    dim = teams.select(*TEAM_ATTRIBUTES)
    return facts.join(dim, facts[club] == dim["team_abbrev"], "left")


def attach_status(facts: DataFrame, status: DataFrame, player: str) -> DataFrame:
    """Add today's availability. It is per player, so it repeats on each row of a player."""
    dim = status.select(F.col("mlbam_id").alias("status_player"), *STATUS_ATTRIBUTES)
    return facts.join(dim, facts[player] == dim["status_player"], "left").drop("status_player")


def attach_name(facts: DataFrame, players: DataFrame, player: str, name: str) -> DataFrame:
    """Add a display name from the player registry."""
    dim = players.select(
        F.col("mlbam_id").alias("named_player"),
        full_name(F.col("first_name"), F.col("last_name")).alias(name),
    )
    return facts.join(dim, facts[player] == dim["named_player"], "left").drop("named_player")


def attach_name_parts(facts: DataFrame, players: DataFrame, player: str) -> DataFrame:
    """Add first and last name under the registry's own column names."""
    dim = players.select(
        F.col("mlbam_id").alias("named_player"),
        F.col("first_name").alias("name_first"),
        F.col("last_name").alias("name_last"),
    )
    return facts.join(dim, facts[player] == dim["named_player"], "left").drop("named_player")


def team_dimension(teams: DataFrame) -> DataFrame:
    """One row per club."""
    return teams.select(
        "team_id",
        "team_name",
        "team_abbrev",
        "team_short_name",
        "location_name",
        "league_id",
        "league_name",
        "division_id",
        "division_name",
        "venue_name",
    )


def status_dimension(status: DataFrame, teams: DataFrame) -> DataFrame:
    """Every rostered player, with or without statistics, and the current club."""
    dim = teams.select(*TEAM_ATTRIBUTES)
    return status.join(dim, "team_id", "left").select(
        "mlbam_id",
        "player_full_name",
        "team_id",
        "team_abbrev",
        "team_name",
        "league_name",
        "division_name",
        "status_code",
        "status_description",
        "availability",
        "is_active",
        "is_injured",
    )
