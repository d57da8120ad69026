"""Named dimensions and measures over a fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fungo.functions.numeric import safe_divide


@dataclass(frozen=True)
class Measure:
    """An aggregate and the number of places it is shown with.

    ``parts`` are totals per player, and ``merged`` is the aggregate over such totals.
    """

    value: Column
    places: int | None = None
    parts: Mapping[str, Column] = field(default_factory=dict)
    merged: Column | None = None

    @property
    def shown(self) -> Column:
        return self.aggregate(rounded=True)

    def aggregate(self, rounded: bool, merged: bool = False) -> Column:
        value = self.merged if merged else self.value
        return F.round(value, self.places) if rounded and self.places is not None else value


def rows_counted() -> Measure:
    return Measure(F.count(F.lit(1)), parts={"rows": F.count(F.lit(1))}, merged=F.sum("rows"))


def total(column: str) -> Measure:
    name = f"sum_{column}"
    return Measure(F.sum(column), parts={name: F.sum(column)}, merged=F.sum(name))


def ratio(part: str, whole: str, places: int) -> Measure:
    """Quotient of two totals, right at any grouping."""
    names = f"sum_{part}", f"sum_{whole}"
    return Measure(
        safe_divide(F.sum(part), F.sum(whole)),
        places,
        {names[0]: F.sum(part), names[1]: F.sum(whole)},
        safe_divide(F.sum(names[0]), F.sum(names[1])),
    )


def mean_of_games(column: str, places: int) -> Measure:
    """Average of the per-game values, each game alike."""
    names = f"sum_{column}", f"n_{column}"
    return Measure(
        F.avg(column),
        places,
        {names[0]: F.sum(column), names[1]: F.count(column)},
        safe_divide(F.sum(names[0]), F.sum(names[1])),
    )


@dataclass(frozen=True)
class Explore:
    """A fact with a unique key, its dimensions, row values and measures, and an optional lookup.

    Measures are aggregated on the fact before the lookup is joined, so a lookup that repeats
    a player can not multiply a total: for a lookup attribute the fact is first reduced to totals
    per player, then the lookup, one row per player, is joined, and the totals are merged.
    """

    fact: DataFrame
    player: str
    dimensions: Mapping[str, Column]
    details: Mapping[str, Measure]
    measures: Mapping[str, Measure]
    lookup: DataFrame | None = None
    lookup_key: str = "mlbam_id"
    lookup_attributes: Sequence[str] = field(default=())

    def summarize(
        self, by: Sequence[str], measures: Sequence[str] | None = None, rounded: bool = True
    ) -> DataFrame:
        """Chosen measures grouped by chosen dimensions, as shown or with all their places."""
        names = list(measures or self.measures)
        attributes = [name for name in by if name in self.lookup_attributes]
        own = [name for name in by if name not in self.lookup_attributes]
        groups = [self.dimensions[name].alias(name) for name in own]
        if not attributes:
            return self.fact.groupBy(*groups).agg(
                *(self.measures[name].aggregate(rounded).alias(name) for name in names)
            )
        parts = {part: value for name in names for part, value in self.measures[name].parts.items()}
        per_player = self.fact.groupBy(*groups, F.col(self.player).alias("fact_player")).agg(
            *(value.alias(part) for part, value in parts.items())
        )
        return self._with_lookup(per_player, "fact_player", attributes).groupBy(*own, *attributes).agg(
            *(self.measures[name].aggregate(rounded, merged=True).alias(name) for name in names)
        )

    def rows(self, columns: Sequence[str], attributes: Sequence[str] = ()) -> DataFrame:
        """Fact rows for a drill-down: dimensions, per-game values and lookup attributes."""
        values = {**self.dimensions, **{k: v.shown for k, v in self.details.items()}}
        rows = self.fact
        if attributes:
            rows = self._with_lookup(rows, self.player, attributes)
        return rows.select(*(values[name].alias(name) for name in columns), *attributes)

    def _with_lookup(self, rows: DataFrame, player: str, attributes: Sequence[str]) -> DataFrame:
        """Attach attributes; of a player listed several times one whole row, the greatest."""
        one_per_player = self.lookup.groupBy(F.col(self.lookup_key).alias("lookup_player")).agg(
            F.max(F.struct(*attributes)).alias("chosen")
        )
        found = one_per_player.select("lookup_player", *(F.col(f"chosen.{n}") for n in attributes))
        return rows.join(found, F.col(player) == F.col("lookup_player"), "left").drop("lookup_player")
