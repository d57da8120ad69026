"""Reference feeds as delivered: registry shards in CSV, clubs and rosters in nested JSON."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fungo.functions.numeric import to_number
from fungo.schemas import (
    PLAYER_LOOKUP,
    REGISTRY_SHARD,
    ROSTER_FEED,
    ROSTERS,
    TEAMS,
    TEAMS_FEED,
    SchemaDrift,
)

# Registry columns and the names they are stored under.
REGISTRY_NAMES = {
    "key_mlbam": "mlbam_id",
    "key_fangraphs": "fangraphs_id",
    "key_bbref": "bbref_id",
    "name_last": "last_name",
    "name_first": "first_name",
    "name_given": "given_name",
    "pro_played_first": "mlb_debut_year",
    "pro_played_last": "mlb_last_year",
    "birth_year": "birth_year",
}
SHARDS = tuple("0123456789abcdef")

# Path of each stored column inside the feed documents.
TEAM_PATHS = {
    "team_id": "team.id",
    "team_name": "team.name",
    "team_abbrev": "team.abbreviation",
    "team_short_name": "team.teamName",
    "location_name": "team.locationName",
    "league_id": "team.league.id",
    "league_name": "team.league.name",
    "division_id": "team.division.id",
    "division_name": "team.division.name",
    "venue_name": "team.venue.name",
}
ROSTER_PATHS = {
    "mlbam_id": "spot.person.id",
    "player_full_name": "spot.person.fullName",
    "team_id": "team_id",
    "jersey_number": "spot.jerseyNumber",
    "position_code": "spot.position.code",
    "position_name": "spot.position.name",
    "position_type": "spot.position.type",
    "status_code": "spot.status.code",
    "status_description": "spot.status.description",
}


def registry_paths(folder: str) -> list[str]:
    """The sixteen published shard files below ``folder``."""
    return [f"{folder}/people-{shard}.csv" for shard in SHARDS]


def read_registry(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The registered columns of all shards, as text.

    Shards carry more columns than are kept. Each is read by its own header, so columns are found by
    name in any order; a shard without one of them fails.
    """
    shards = [_registry_shard(spark, path) for path in paths]
    return reduce(DataFrame.unionAll, shards)


def _registry_shard(spark: SparkSession, path: str) -> DataFrame:
    shard = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [name for name in REGISTRY_SHARD.names if name not in shard.columns]
    if missing:
        raise SchemaDrift(f"{path} lacks {', '.join(missing)}")
    return shard.select(*REGISTRY_SHARD.names)


def shape_registry(registry: DataFrame) -> DataFrame:
    """Keep people with an id, project and rename."""
    return registry.where(F.col("key_mlbam").isNotNull()).select(
        *(F.col(name).alias(stored) for name, stored in REGISTRY_NAMES.items())
    )


def coerce_registry(shaped: DataFrame) -> DataFrame:
    """Type the shaped registry; a person whose id is no number is dropped."""
    whole_id = to_number(F.col("mlbam_id")).try_cast("bigint")
    numbers = ("fangraphs_id", "mlb_debut_year", "mlb_last_year", "birth_year")
    return (
        shaped.withColumns(
            {"mlbam_id": whole_id, **{name: to_number(F.col(name)) for name in numbers}}
        )
        .dropna(subset=["mlbam_id"])
        .to(PLAYER_LOOKUP)
    )


def read_teams_feed(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Club documents; one document may hold any number of clubs.

    A file is one document, or with ``lines`` one document per line, which can be split.
    """
    return spark.read.schema(TEAMS_FEED).option("multiLine", not lines).json(path)


def flatten_teams(feed: DataFrame) -> DataFrame:
    """One row per club. A missing league, division or venue gives nulls."""
    clubs = feed.select(F.explode("teams").alias("team"))
    return clubs.select(
        *(F.col(path).alias(name) for name, path in TEAM_PATHS.items())
    ).to(TEAMS)


def read_roster_feed(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Roster documents landed as ``roster_type=T/team_id=N``; the folder names the request."""
    return spark.read.schema(ROSTER_FEED).option("multiLine", not lines).json(path)


def flatten_rosters(feed: DataFrame, roster_type: str = "40Man") -> DataFrame:
    """One row per roster spot, with the requested club. Spots without a player id are dropped."""
    spots = feed.where(F.col("roster_type") == roster_type).select(
        "team_id", F.explode("roster").alias("spot")
    )
    return (
        spots.select(*(F.col(path).alias(name) for name, path in ROSTER_PATHS.items()))
        .dropna(subset=["mlbam_id"])
        .to(ROSTERS)
    )


# Feeds with everything that was delivered


def read_feed(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Documents of any shape as one ``document`` each, beside the columns of their folders."""
    reader = spark.read.option("singleVariantColumn", "document").option("multiLine", not lines)
    return reader.json(path)


def _elements(feed: DataFrame, field: str) -> DataFrame:
    """A row for each element of an array in the documents: ``element`` and the folders' columns."""
    folders = [name for name in feed.columns if name != "document"]
    arrays = feed.select(*folders, F.try_variant_get("document", f"$.{field}", "variant").alias("elements"))
    exploded = arrays.lateralJoin(feed.sparkSession.tvf.variant_explode(F.col("elements").outer()))
    return exploded.select(*folders, F.col("value").alias("element"))


def _with_delivered(elements: DataFrame, paths: dict[str, str], declared: StructType) -> DataFrame:
    """The declared columns, null where a value is missing or of another kind, and ``delivered``: the whole
    element as JSON, with every field that is not declared."""
    columns = []
    for name, path in paths.items():
        if "." not in path:
            columns.append(F.col(path).alias(name))
            continue
        kind = declared[name].dataType.simpleString()
        columns.append(F.try_variant_get("element", f"$.{path.split('.', 1)[1]}", kind).alias(name))
    return elements.select(*columns, F.to_json("element").alias("delivered"))


def flatten_teams_delivered(feed: DataFrame) -> DataFrame:
    """``flatten_teams`` of ``read_feed`` documents, with each club as it was delivered."""
    return _with_delivered(_elements(feed, "teams"), TEAM_PATHS, TEAMS)


def flatten_rosters_delivered(feed: DataFrame, roster_type: str = "40Man") -> DataFrame:
    """``flatten_rosters`` of ``read_feed`` documents, with each spot as it was delivered."""
    spots = _elements(feed.where(F.col("roster_type") == roster_type), "roster")
    folder = spots.withColumn("team_id", F.col("team_id").cast("bigint"))
    return _with_delivered(folder, ROSTER_PATHS, ROSTERS).dropna(subset=["mlbam_id"])
