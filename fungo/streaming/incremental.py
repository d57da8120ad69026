"""Pick up each published load once and bring the facts of the dates it changes up to date."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fungo.functions.dates import ns_to_date
from fungo.operators.staging import stage_pitches
from fungo.sources import loads
from fungo.sources.landing import in_months, read_landed
from fungo.sources.loads import NO_PARTITION, RECORD, Load

Build = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class ChangeSet:
    """Dates whose facts have to be built again, and dates that are in the mart but no longer landed.

    None stands for the missing date. Both are bounded by the calendar, some hundred a season.
    """

    changed: tuple[date | None, ...]
    gone: tuple[date | None, ...]

    @property
    def dates(self) -> tuple[date | None, ...]:
        return (*self.changed, *self.gone)


def on_dates(column: str, dates: Sequence[date | None]) -> Column:
    """Whether a date is one of ``dates``; plain ranges and a plain list, so that partitions are pruned by it.

    Days in a row, as loads bring them, are one range: a list of a season's days is so much code that the
    compiler of the JVM leaves everything in the same step alone.
    """
    dated, single = F.lit(False), []
    for first, last in _runs(sorted({day for day in dates if day is not None})):
        if first == last:
            single.append(first)
        else:
            dated = dated | F.col(column).between(F.lit(first), F.lit(last))
    dated = dated | F.col(column).isin(single)
    missing = F.col(column).isNull() if None in dates else F.lit(False)
    return F.coalesce(dated, F.lit(False)) | missing


def _runs(days: Sequence[date]) -> list[tuple[date, date]]:
    """First and last of each run of consecutive days."""
    runs: list[tuple[date, date]] = []
    for day in days:
        if runs and day - runs[-1][1] == timedelta(days=1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs


def _dates(landed: DataFrame) -> set[date | None]:
    """Distinct dates of the pitches that staging keeps; two columns are read."""
    staged = stage_pitches(landed.drop("year", "month"))
    return {row.game_date for row in staged.select("game_date").distinct().collect()}


def _month_of(day: date | None) -> int | None:
    return None if day is None else day.year * 12 + day.month


def change_set(
    spark: SparkSession, landing: str, tables: Sequence[str], new: Sequence[Load]
) -> ChangeSet:
    """What ``new`` loads change in ``tables``, each of them partitioned by date.

    A date changes if a load that still counts brought pitches of it. A date is gone if a table holds it
    and the landing zone has no pitch of it; only a refresh can cause that in any month, and a merge in the
    months it wrote again, so an append looks at its own dates and nothing else.
    """
    ids = {load.load_id for load in new}
    changed = _dates(read_landed(spark, landing, only=ids))
    modes = {load.mode for load in new}
    held: set[date | None] = set()
    if modes != {loads.APPEND}:
        opened = [stored for stored in (loads.opened(spark, table) for table in tables) if stored is not None]
        held = {row.game_date for df in opened for row in df.select("game_date").distinct().collect()}
    if loads.REFRESH not in modes:
        merged = {month for load in new if load.mode == loads.MERGE for month in load.months}
        held = {day for day in held if ((day.year, day.month) if day else (None, None)) in merged}
    there = read_landed(spark, landing).where(in_months(list({_month_of(day) for day in held})))
    return ChangeSet(_ordered(changed), _ordered(held - _dates(there) - changed))


def _ordered(dates: set[date | None]) -> tuple[date | None, ...]:
    return tuple(sorted(dates, key=lambda day: (day is None, day or date.min)))


def pitches_of(spark: SparkSession, landing: str, dates: Sequence[date | None]) -> DataFrame:
    """Staged pitches of whole dates; only the folders of their months are read."""
    day = ns_to_date(F.col("game_date"))
    months = list({_month_of(one) for one in dates})
    landed = read_landed(spark, landing).where(in_months(months))
    chosen = landed.withColumn("landed_day", day).where(on_dates("landed_day", dates))
    return stage_pitches(chosen.drop("landed_day", "year", "month"))


def write_dates(rows: DataFrame, table: str, changes: ChangeSet) -> None:
    """Replace the changed dates of ``table`` by ``rows`` and empty its dates that are gone.

    A dynamic overwrite replaces the partitions that ``rows`` has; a partition without rows is beyond
    its reach and is overwritten by itself with none. Doing it again gives the same table.
    """
    spark = rows.sparkSession
    if changes.changed:
        (
            rows.hint("rebalance", "game_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("game_date")
            .parquet(table)
        )
    empty = spark.createDataFrame([], rows.drop("game_date").schema).coalesce(1)
    for day in changes.gone:
        name = NO_PARTITION if day is None else day.isoformat()
        empty.write.mode("overwrite").parquet(f"{table}/game_date={name}")


def refresh_mart(spark: SparkSession, landing: str, mart: str, build: Build, changes: ChangeSet) -> None:
    """Rebuild the facts of the changed dates and drop those of the dates that are gone.

    A late pitch reopens its game, so whole dates are read again from the landing zone and replace their
    partitions: dates, not the times of day that pitches carry, and the missing date is one of them.
    """
    write_dates(build(pitches_of(spark, landing, changes.changed)), mart, changes)


def ingest_new_loads(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    refresh: Callable[[Sequence[Load], int], None],
) -> None:
    """Hand every load published since the last run to ``refresh``, then stop.

    The stream reads the record of loads, a row each; the checkpoint remembers which it has seen, so each
    is picked up exactly once over any number of runs, also after a failure in between. ``refresh`` gets
    the loads and the number of the batch, and has to bear being called again with the same.
    """

    def take(batch: DataFrame, number: int) -> None:
        found = [loads.as_load(row) for row in batch.collect()]
        if found:
            refresh(sorted(found, key=lambda load: load.load_id), number)

    query = (
        spark.readStream.schema(RECORD)
        .option(*loads.EACH_FOLDER)
        .parquet(loads.record_folder(landing))
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_new_files(spark: SparkSession, landing: str, mart: str, checkpoint: str, build: Build) -> None:
    """Bring ``mart`` up to date with every load published since the last run."""

    def refresh(new: Sequence[Load], _: int) -> None:
        refresh_mart(spark, landing, mart, build, change_set(spark, landing, [mart], new))

    ingest_new_loads(spark, landing, checkpoint, refresh)
