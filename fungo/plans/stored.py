"""Facts, dimensions and reports written once per application and folder, for everything that reads them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fungo.operators.id_sets import day_sets
from fungo.plans.warehouse import FACTS, REPORTING, STAGING, Warehouse
from fungo.session import write_by_month
from fungo.sources.landing import month_number
from fungo.sources.raw_zone import RawZone, zone_of

_WRITTEN: set[str] = set()


def with_months(fact: DataFrame) -> DataFrame:
    """Add the calendar month of the game, by which stored facts are partitioned."""
    day = F.col("game_date")
    return fact.withColumns({"year": F.year(day), "month": F.month(day)})


class StoredFacts(Mapping):
    """Facts by name. The first request writes the table beside the raw zone; later ones read it.

    Readers get the fact's own columns. ``dates``, first and last day included, bounds the games: it
    becomes a condition on the month folders, so that only these are listed and read.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str, dates: tuple[date, date] | None = None
    ) -> None:
        self._spark = spark
        self._sf_dir = sf_dir
        self._dates = dates

    def path(self, name: str) -> str:
        """Where the fact lies, written if it was not yet."""
        if name not in FACTS:
            raise KeyError(name)
        path = f"{zone_of(self._spark, self._sf_dir)}/facts/{name}"
        if path not in _WRITTEN:
            fact = Warehouse(RawZone(self._spark, self._sf_dir)).table(name)
            write_by_month(with_months(fact), path, "overwrite")
            _WRITTEN.add(path)
        return path

    def with_partitions(self, name: str) -> DataFrame:
        """The fact with ``year`` and ``month``, on which a condition prunes folders."""
        return self._spark.read.parquet(self.path(name))

    def __getitem__(self, name: str) -> DataFrame:
        games = self.with_partitions(name)
        if self._dates is not None:
            first, last = self._dates
            months = month_number().between(first.year * 12 + first.month, last.year * 12 + last.month)
            games = games.where(months & F.col("game_date").between(F.lit(first), F.lit(last)))
        return games.drop("year", "month")

    def __iter__(self) -> Iterator[str]:
        return iter(FACTS)

    def __len__(self) -> int:
        return len(FACTS)

    def __contains__(self, name: object) -> bool:
        return name in FACTS


# The layers that rules and profiles read; the pitches are read where they are landed.
LAYERS = (*(name for name in STAGING if name != "stg_statcast_pitches"), "dim_team", "dim_roster_status", *REPORTING)


class StoredLayers(Mapping):
    """Dimensions, reports and reference staging by name, each written on its first request."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark = spark
        self._sf_dir = sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        if name not in LAYERS:
            raise KeyError(name)
        path = f"{zone_of(self._spark, self._sf_dir)}/layers/{name}"
        if path not in _WRITTEN:
            built = Warehouse(RawZone(self._spark, self._sf_dir), StoredFacts(self._spark, self._sf_dir))
            built.table(name).write.mode("overwrite").parquet(path)
            _WRITTEN.add(path)
        return self._spark.read.parquet(path)

    def __iter__(self) -> Iterator[str]:
        return iter(LAYERS)

    def __len__(self) -> int:
        return len(LAYERS)

    def __contains__(self, name: object) -> bool:
        return name in LAYERS


# The sets of ids that are stored, and what is counted of them.
SET_SUBJECTS = {
    "batter": ("mart_batter_game_stats", "batter_id"),
    "pitcher": ("mart_pitcher_game_stats", "pitcher_id"),
    "game": ("mart_batter_game_stats", "game_id"),
    "pitched_game": ("mart_pitcher_game_stats", "game_id"),
}
COUNTED = {
    "batters": ("batter",),
    "pitchers": ("pitcher",),
    "players": ("batter", "pitcher"),
    "games": ("game", "pitched_game"),
}


def sets_of(batter_games: DataFrame, pitcher_games: DataFrame) -> DataFrame:
    """The sets of ids by day of both facts."""
    facts = dict(zip(FACTS, (batter_games, pitcher_games)))
    return day_sets({subject: (facts[name], column) for subject, (name, column) in SET_SUBJECTS.items()})


def stored_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sets of ids of the stored facts, in month folders, written on the first request."""
    path = f"{zone_of(spark, sf_dir)}/sets"
    if path not in _WRITTEN:
        facts = StoredFacts(spark, sf_dir)
        parted = with_months(sets_of(*(facts[name] for name in FACTS))).hint("rebalance", "year", "month")
        parted.write.mode("overwrite").partitionBy("year", "month").parquet(path)
        _WRITTEN.add(path)
    return spark.read.parquet(path)
