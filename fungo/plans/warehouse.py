"""The layered tables as lazy DataFrames, and their registration in the catalog."""

from __future__ import annotations

import time
from collections import ChainMap
from collections.abc import Callable, Collection, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fungo.config import Config
from fungo.operators import attach, game_facts, rollups, staging
from fungo.plans import reports
from fungo.session import materialize, open_folders
from fungo.schemas import RAW_SCHEMAS, conform

STAGING = ("stg_statcast_pitches", "stg_mlb_teams", "stg_mlb_rosters", "stg_mlb_roster_status")
FACTS = ("mart_batter_game_stats", "mart_pitcher_game_stats")
MARTS = (*FACTS, "dim_team", "dim_roster_status")
REPORTING = (
    "rpt_league_batting_kpis",
    "rpt_batter_season",
    "rpt_batter_game",
    "rpt_league_pitching_kpis",
    "rpt_pitcher_season",
    "rpt_pitcher_pitch_mix",
)


class Warehouse:
    """Staging, marts and reporting over five raw tables.

    Every table is a lazy plan. ``stored`` supplies tables that are already written, those of any layer but
    the pitches; what is built on them reads those instead of building them again. A ``guarded``
    warehouse fails where a club, player or status that a report joins has two rows, instead of giving
    the report's rows twice.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        stored: Mapping[str, DataFrame] | None = None,
        guarded: bool = False,
    ) -> None:
        missing = set(RAW_SCHEMAS) - set(raw)
        if missing:
            raise KeyError(f"raw tables missing: {sorted(missing)}")
        self._raw = raw
        self._stored = {} if stored is None else stored
        self._guarded = guarded

    def raw(self, name: str) -> DataFrame:
        """A raw table, checked against its declared columns and types."""
        return conform(self._raw[name], RAW_SCHEMAS[name])

    def table(self, name: str) -> DataFrame:
        """A table of any layer by its full name."""
        if name not in (*STAGING, *MARTS, *REPORTING, "player_lookup"):
            raise KeyError(name)
        return getattr(self, name)

    def with_stored_marts(self, *names: str) -> Warehouse:
        """Write the named marts once and return a warehouse that reads them."""
        written = {name: materialize(self.table(name), name) for name in names or MARTS}
        return self.with_stored(written)

    def with_stored(self, written: Mapping[str, DataFrame]) -> Warehouse:
        """A warehouse that reads the given marts instead of building them."""
        return Warehouse(self._raw, ChainMap(written, self._stored), self._guarded)

    @cached_property
    def player_lookup(self) -> DataFrame:
        return self.raw("player_lookup")

    def _stored_or(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self._stored[name] if name in self._stored else build()

    # staging

    @cached_property
    def stg_statcast_pitches(self) -> DataFrame:
        return staging.stage_pitches(self.raw("statcast_pitches"))

    @cached_property
    def stg_mlb_teams(self) -> DataFrame:
        return self._stored_or(
            "stg_mlb_teams", lambda: staging.stage_teams(self.raw("mlb_teams"))
        )

    @cached_property
    def stg_mlb_rosters(self) -> DataFrame:
        return self._stored_or(
            "stg_mlb_rosters", lambda: staging.stage_rosters(self.raw("mlb_rosters"))
        )

    @cached_property
    def stg_mlb_roster_status(self) -> DataFrame:
        return self._stored_or(
            "stg_mlb_roster_status", lambda: staging.stage_roster_status(self.raw("mlb_roster_status"))
        )

    # marts

    @cached_property
    def mart_batter_game_stats(self) -> DataFrame:
        return self._stored_or(
            "mart_batter_game_stats", lambda: game_facts.batter_games(self.stg_statcast_pitches)
        )

    @cached_property
    def mart_pitcher_game_stats(self) -> DataFrame:
        return self._stored_or(
            "mart_pitcher_game_stats", lambda: game_facts.pitcher_games(self.stg_statcast_pitches)
        )

    @cached_property
    def dim_team(self) -> DataFrame:
        return self._stored_or("dim_team", lambda: attach.team_dimension(self.stg_mlb_teams))

    @cached_property
    def dim_roster_status(self) -> DataFrame:
        return self._stored_or(
            "dim_roster_status",
            lambda: attach.status_dimension(self.stg_mlb_roster_status, self.dim_team),
        )

    # reporting

    def _joined(self, name: str, key: str) -> DataFrame:
        """A table as the reports join it."""
        dim = self.table(name)
        return attach.one_row_per_key(dim, key, name) if self._guarded else dim

    @cached_property
    def _clubs(self) -> DataFrame:
        return self._joined("dim_team", "team_abbrev")

    @cached_property
    def _players(self) -> DataFrame:
        return self._joined("player_lookup", "mlbam_id")

    @cached_property
    def _status(self) -> DataFrame:
        return self._joined("dim_roster_status", "mlbam_id")

    @cached_property
    def rpt_league_batting_kpis(self) -> DataFrame:
        return self._stored_or(
            "rpt_league_batting_kpis", lambda: rollups.league_batting(self.mart_batter_game_stats)
        )

    @cached_property
    def rpt_batter_season(self) -> DataFrame:
        return self._stored_or(
            "rpt_batter_season",
            lambda: reports.batter_season(
                self.mart_batter_game_stats, self._players, self._clubs, self._status
            ),
        )

    @cached_property
    def rpt_batter_game(self) -> DataFrame:
        return self._stored_or(
            "rpt_batter_game",
            lambda: reports.batter_game(
                self.mart_batter_game_stats, self._players, self._clubs, self._status
            ),
        )

    @cached_property
    def rpt_league_pitching_kpis(self) -> DataFrame:
        return self._stored_or(
            "rpt_league_pitching_kpis", lambda: rollups.league_pitching(self.mart_pitcher_game_stats)
        )

    @cached_property
    def rpt_pitcher_season(self) -> DataFrame:
        return self._stored_or(
            "rpt_pitcher_season",
            lambda: reports.pitcher_season(
                self.mart_pitcher_game_stats, self._clubs, self._status
            ),
        )

    @cached_property
    def rpt_pitcher_pitch_mix(self) -> DataFrame:
        return self._stored_or(
            "rpt_pitcher_pitch_mix",
            lambda: reports.pitch_mix(
                self.mart_pitcher_game_stats, self._clubs, self._status
            ),
        )


def _save(df: DataFrame, database: str, name: str, location: str) -> DataFrame:
    """Write a new version of a table and point its name there in one step.

    The name is a view of the newest version, so a reader keeps the version it began with and a write
    that dies leaves the former one in place.
    """
    spark = df.sparkSession
    version = f"{name}__{time.time_ns()}"
    writer = df.write
    if name in FACTS:
        day = F.col("game_date")
        writer = df.withColumns({"year": F.year(day), "month": F.month(day)}).write.partitionBy("year", "month")
    with open_folders(spark):
        writer.option("path", f"{location}/{database}/{version}").saveAsTable(f"{database}.{version}")
    chosen = ", ".join(f"`{column}`" for column in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {chosen} FROM {database}.{version}")
    return spark.table(f"{database}.{name}")


def former_versions(spark: SparkSession, database: str, older_than_days: float) -> list[str]:
    """Tables that are no longer the newest version of their name since so many days; they can be dropped."""
    names = [row.name for row in spark.catalog.listTables(database) if "__" in row.name]
    by_name: dict[str, list[tuple[int, str]]] = {}
    for version in names:
        name, _, at = version.rpartition("__")
        by_name.setdefault(name, []).append((int(at), version))
    limit = time.time_ns() - int(older_than_days * 86_400 * 10**9)
    found = []
    for versions in by_name.values():
        versions.sort()
        # A version is former since the next one was begun.
        found += [version for (_, version), (next_at, _) in zip(versions, versions[1:]) if next_at < limit]
    return sorted(found)


def register(
    spark: SparkSession,
    warehouse: Warehouse,
    location: str,
    config: Config = Config(),
    saved: Collection[str] = (),
) -> Warehouse:
    """Store the marts as tables and expose every layer to ``spark.sql``.

    Raw, staging and reporting tables become temporary views: ``raw_<source>`` and their own
    names. The marts are stored below ``location``, the facts partitioned by year and month of the game, and
    ``marts.<name>`` stands for the newest version of each. A temporary view ends with its session and can not be qualified
    by a database; the layers in ``saved`` (``staging``, ``reporting``) are also stored, as
    ``<layer>.<name>``. The returned warehouse reads the stored marts.
    """
    for name in config.source_names:
        warehouse.raw(name).createOrReplaceTempView(f"{config.raw_database}_{name}")
    layers = {"staging": (config.staging_database, STAGING), "reporting": (config.reporting_database, REPORTING)}
    unknown = set(saved) - set(layers)
    if unknown:
        raise KeyError(f"no such layers: {sorted(unknown)}")
    for database in (config.marts_database, *(layers[layer][0] for layer in saved)):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}/{database}'")
    built = warehouse.with_stored(
        {
            name: _save(warehouse.table(name), config.marts_database, name, location)
            for name in MARTS
        }
    )
    for name in (*STAGING, *REPORTING):
        built.table(name).createOrReplaceTempView(name)
    for layer in saved:
        database, names = layers[layer]
        for name in names:
            _save(built.table(name), database, name, location)
    return built
