"""Season lines kept up to date from the dates that change, instead of built from all games.

What a line is made of adds up: counts, weighted sums, weights. These parts are stored once per date and
stint, and once in total per stint. When dates change, the stored parts of just these dates are
taken off the totals and the new ones put on. A greatest value and a number of different games can not be taken
off; they are read again, for the stints that the dates touch. All other totals are copied as they are.

The totals are a numbered version: a batch that is run again finds its number published and only writes
its dates once more, so nothing is taken off twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fungo.operators.rollups import StintRollup
from fungo.session import materialize
from fungo.sources import versions
from fungo.sources.loads import opened
from fungo.streaming.incremental import ChangeSet, on_dates, write_dates


class SeasonTotals:
    """The parts by date and their totals of one roll-up, below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, rollup: StintRollup) -> None:
        self._spark = spark
        self._rollup = rollup
        self.by_date = f"{folder}/by-date"
        self.totals = f"{folder}/totals"

    def refresh(self, games: DataFrame, changes: ChangeSet, number: int) -> None:
        """Take in the facts of ``changes.changed`` as batch ``number``; numbers rise from batch to batch."""
        fresh = materialize(self._rollup.per_date(games), "season-parts")
        newest = versions.published(self._spark, self.totals)
        if newest is None or newest.number < number:
            versions.publish(self.after(fresh, changes), self.totals, number)
        write_dates(fresh, self.by_date, changes)

    def after(self, fresh: DataFrame, changes: ChangeSet) -> DataFrame:
        """The totals once ``fresh`` has replaced the stored parts of the dates in ``changes``."""
        keys, adding = list(self._rollup.keys), self._rollup.adding
        stored = opened(self._spark, self.by_date)
        parts = fresh.select(*keys, *adding)
        if stored is not None:
            former = stored.where(on_dates("game_date", changes.dates))
            parts = parts.unionAll(former.select(*keys, *((-F.col(name)).alias(name) for name in adding)))
        changed = materialize(_added_up(parts, keys, adding), "season-changes")
        again = self._read_again(fresh, stored, changed, changes)
        before = versions.read(self._spark, self.totals)
        sums = changed
        if before is not None:
            of_changed = _alike(before.select(*keys, *adding), changed, keys, "left_semi")
            sums = _added_up(changed.unionAll(of_changed), keys, adding)
        # Every part has at least one game; a stint without any is over.
        left = sums.where(F.col("n_games") > 0)
        touched = _joined(left, again, keys)
        if before is None:
            return touched
        untouched = _alike(before, changed, keys, "left_anti")
        return untouched.select(*touched.columns).unionAll(touched)

    def _read_again(
        self, fresh: DataFrame, stored: DataFrame | None, changed: DataFrame, changes: ChangeSet
    ) -> DataFrame:
        """Peaks and numbers of different games of the stints in ``changed``, from their parts."""
        keys, peaks = list(self._rollup.keys), self._rollup.peaks
        parts = fresh.select(*keys, "game_ids", *peaks)
        if stored is not None:
            kept = stored.where(~on_dates("game_date", changes.dates)).select(*keys, "game_ids", *peaks)
            parts = parts.unionAll(_alike(kept, changed, keys, "left_semi"))
        # A stint has some hundred games a season.
        games = F.array_distinct(F.flatten(F.collect_list("game_ids")))
        return parts.groupBy(*keys).agg(
            F.size(games).cast("bigint").alias("games"), *(F.max(name).alias(name) for name in peaks)
        )

    def sums(self) -> DataFrame:
        """The stored totals: a row for each stint."""
        found = versions.read(self._spark, self.totals)
        if found is None:
            raise ValueError(f"no totals below {self.totals}")
        return found

    def lines(self) -> DataFrame:
        """The season lines, as the roll-up gives them from all games."""
        return self._rollup.lines_of(self.sums())


def _added_up(parts: DataFrame, keys: list[str], adding: tuple[str, ...]) -> DataFrame:
    return parts.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in adding))


def _same(keys: list[str]) -> Column:
    """Equal keys; a missing club or name is a key like others."""
    pairs = (F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")) for key in keys)
    return reduce(Column.__and__, pairs)


def _alike(rows: DataFrame, others: DataFrame, keys: list[str], how: str) -> DataFrame:
    """The rows whose keys are (``left_semi``) or are not (``left_anti``) among the others."""
    return rows.alias("a").join(others.select(*keys).alias("b"), _same(keys), how)


def _joined(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    figures = [name for name in others.columns if name not in keys]
    joined = rows.alias("a").join(others.alias("b"), _same(keys))
    return joined.select("a.*", *(f"b.{name}" for name in figures))
