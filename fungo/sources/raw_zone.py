"""The landed raw tables of one driver data folder."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from fungo.schemas import RAW_SCHEMAS
from fungo.session import fresh_folder
from fungo.sources import derived, landing

_LANDED: dict[tuple[str, str], str] = {}


def land(spark: SparkSession, sf_dir: str) -> str:
    """Derive the raw tables from ``sf_dir`` and write them to a new folder; returns it."""
    zone = fresh_folder(spark, "raw")
    pitches = derived.pitches(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    landing.land_pitches(pitches, f"{zone}/statcast_pitches")
    landed = landing.read_landed(spark, f"{zone}/statcast_pitches")
    for name, table in derived.reference_tables(spark, sf_dir, landed).items():
        landing.land_table(table, f"{zone}/{name}")
    return zone


def zone_of(spark: SparkSession, sf_dir: str) -> str:
    """The folder with the raw tables of ``sf_dir``, landed once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LANDED:
        _LANDED[key] = land(spark, key[1])
    return _LANDED[key]


def landed_pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pitches with the ``year`` and ``month`` partition columns."""
    return landing.read_landed(spark, f"{zone_of(spark, sf_dir)}/statcast_pitches")


class RawZone(Mapping):
    """The landed raw tables by source name, each opened when it is asked for.

    ``dates`` bounds the pitches, first and last day included. The bound prunes month folders, so
    every table, fact and report built on a bounded zone reads those folders only.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str, dates: tuple[date, date] | None = None
    ) -> None:
        self._spark = spark
        self._sf_dir = sf_dir
        self._dates = dates

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RAW_SCHEMAS:
            raise KeyError(name)
        if name == "statcast_pitches":
            pitches = landed_pitches(self._spark, self._sf_dir)
            if self._dates is not None:
                pitches = landing.in_date_range(pitches, *self._dates)
            return pitches.drop("year", "month")
        path = f"{zone_of(self._spark, self._sf_dir)}/{name}"
        return landing.read_reference(self._spark, path, name)

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_SCHEMAS)

    def __len__(self) -> int:
        return len(RAW_SCHEMAS)
