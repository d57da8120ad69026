"""Data-quality checks. Each returns ``rule`` and ``failing_rows``; zero passes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fungo.operators.profile import by_column


@dataclass(frozen=True)
class RowRule:
    """Rows whose column is null or, if values are given, is none of them break the rule."""

    rule: str
    table: str
    column: str
    accepted: tuple[str, ...] | None = None

    def failing(self) -> Column:
        return not_null(self.column) if self.accepted is None else accepted(self.column, self.accepted)


@dataclass(frozen=True)
class KeyRule:
    """A key that more than one row of a table has breaks the rule; ``known`` leaves incomplete keys out."""

    rule: str
    table: str
    columns: tuple[str, ...]
    known: bool = False


@dataclass(frozen=True)
class ReferenceRule:
    """A row whose value the parent does not have breaks the rule; nulls pass."""

    rule: str
    table: str
    column: str


Tables = Callable[[str], DataFrame]


def row_rules(tables: Tables, rules: Sequence[RowRule]) -> DataFrame:
    """All rules of a table from one aggregate over one scan of it."""
    by_table: dict[str, dict[str, Column]] = {}
    for rule in rules:
        by_table.setdefault(rule.table, {})[rule.rule] = rule.failing()
    return stack([failing_rows(tables(name), own) for name, own in by_table.items()])


def _with_all(counts: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Counts added up by rule, zero for a rule that has none."""
    none = counts.sparkSession.createDataFrame([(rule, 0) for rule in rules], "rule string, n bigint")
    together = counts.select("rule", "n").unionAll(none)
    return together.groupBy("rule").agg(F.sum("n").alias("failing_rows"))


def key_rules(tables: Tables, rules: Sequence[KeyRule]) -> DataFrame:
    """Repeated keys of all rules from one scan of each table and one keyed aggregate over all.

    Every row gives its key for each rule of its table, and equal keys are counted on the map side first.
    """
    by_table: dict[str, list[KeyRule]] = {}
    for rule in rules:
        by_table.setdefault(rule.table, []).append(rule)

    def keys(name: str, own: list[KeyRule]) -> DataFrame:
        one = [
            F.when(
                reduce(Column.__and__, [F.col(c).isNotNull() for c in rule.columns]) if rule.known else F.lit(True),
                F.struct(F.lit(rule.rule).alias("rule"), F.to_json(F.struct(*rule.columns)).alias("key")),
            )
            for rule in own
        ]
        found = tables(name).select(F.explode(F.array(*one)).alias("one"))
        return found.where(F.col("one").isNotNull()).select("one.*")

    counted = stack([keys(name, own) for name, own in by_table.items()]).groupBy("rule", "key").count()
    repeated = counted.where(F.col("count") > 1).select("rule", F.lit(1).cast("bigint").alias("n"))
    return _with_all(repeated, [rule.rule for rule in rules])


def reference_rules(
    tables: Tables, rules: Sequence[ReferenceRule], parent: DataFrame, field: str
) -> DataFrame:
    """Missing parents of all rules from one scan of each child and one of the parent.

    Child rows are counted per value before the join, so a value carried by a large part of the rows is
    one row in the shuffle.
    """
    values = [
        tables(rule.table)
        .where(F.col(rule.column).isNotNull())
        .groupBy(F.col(rule.column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(rule.rule).alias("rule"), "value", "n")
        for rule in rules
    ]
    # An anti-join would be moved below the union and read the parent once for each child.
    known = parent.select(F.col(field).alias("value")).distinct().withColumn("known", F.lit(True))
    joined = stack(values).join(known, "value", "left")
    return _with_all(joined.where(F.col("known").isNull()), [rule.rule for rule in rules])


def stack(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, results)


def failing_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Count the rows that meet each failing predicate; all rules of a table share one scan."""
    return by_column(
        df,
        {rule: {"failing_rows": F.count_if(bad)} for rule, bad in rules.items()},
        "rule",
    )


def not_null(column: str) -> Column:
    """Failing predicate of a required column."""
    return F.col(column).isNull()


def accepted(column: str, values: Sequence[str]) -> Column:
    """Failing predicate of a closed value list. Null passes."""
    return ~F.col(column).isin(*values)


def _count_of(rule: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(rule).alias("rule"), "failing_rows"
    )


def unique(rule: str, df: DataFrame, column: str) -> DataFrame:
    """Number of values that occur more than once; nulls are not compared."""
    return unique_key(rule, df.where(F.col(column).isNotNull()), [column])


def unique_key(rule: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of key combinations that occur more than once."""
    repeated = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _count_of(rule, repeated)


def relationship(
    rule: str, child: DataFrame, column: str, parent: DataFrame, field: str
) -> DataFrame:
    """Number of child rows whose value is missing in the parent.

    Child rows are counted per value before the anti-join, so a value carried by a large part
    of the rows is one row in the shuffle.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = parent.select(F.col(field).alias("value"))
    orphans = values.join(known, "value", "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failing_rows")).select(
        F.lit(rule).alias("rule"), "failing_rows"
    )


def several_values(rule: str, df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Number of keys with two or more distinct values of ``column``."""
    varied = (
        df.groupBy(*keys).agg(F.count_distinct(column).alias("n_values")).where("n_values > 1")
    )
    return _count_of(rule, varied)


def totals_differ(
    left: DataFrame, right: DataFrame, key: str, names: Sequence[str]
) -> DataFrame:
    """Keys whose totals are not equal on both sides.

    ``both_sides`` tells a key with two unequal totals from one that a side lacks altogether,
    which an inner join would not see.
    """
    ours = left.select(key, *names, F.lit(True).alias("in_left"))
    theirs = right.select(
        key, *(F.col(name).alias(f"{name}_right") for name in names), F.lit(True).alias("in_right")
    )
    joined = ours.join(theirs, key, "full")
    both = F.col("in_left").isNotNull() & F.col("in_right").isNotNull()
    unequal = [~F.col(name).eqNullSafe(F.col(f"{name}_right")) for name in names]
    return joined.where(~both | reduce(Column.__or__, unequal)).select(
        key, both.alias("both_sides")
    )


def none_found(df: DataFrame, label: str, name: str, count: str) -> DataFrame:
    """A row only when ``df`` is empty: the guard against a check that has nothing to check."""
    return (
        df.agg(F.count(F.lit(1)).alias(count))
        .where(F.col(count) == 0)
        .select(F.lit(name).alias(label), count)
    )
