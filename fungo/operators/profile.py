"""Column profiles and shares, each from one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fungo.functions.numeric import safe_divide

_PROFILE = {
    "non_null_count": F.count,
    "avg_value": F.avg,
    "min_value": F.min,
    "max_value": F.max,
    "stddev_value": F.stddev_samp,
}


def by_column(df: DataFrame, measures: dict[str, dict[str, Column]], label: str) -> DataFrame:
    """Aggregate every (row, measure) pair in one pass and return one row per key of ``measures``.

    A union of one query per row would scan the input once for each.
    """
    one_row = df.agg(
        F.array(
            *(
                F.struct(
                    F.lit(row).alias(label),
                    *(value.alias(name) for name, value in values.items()),
                )
                for row, values in measures.items()
            )
        ).alias("rows")
    )
    return one_row.select(F.inline("rows"))


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null count, mean, extremes and sample deviation per column."""
    return by_column(
        df,
        {
            column: {name: measure(column) for name, measure in _PROFILE.items()}
            for column in columns
        },
        "column_name",
    )


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count, row count and null share per column."""
    total = F.count(F.lit(1))
    return by_column(
        df,
        {
            column: {
                "null_count": F.count_if(F.col(column).isNull()),
                "total_rows": total,
                "null_pct": safe_divide(F.count_if(F.col(column).isNull()), total),
            }
            for column in columns
        },
        "column_name",
    )


def shares(df: DataFrame, key: str, count: str, share: str) -> DataFrame:
    """Rows per key and their share of all rows. The total is a one-row scalar subquery."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias(count))
    total = counted.agg(F.sum(count)).scalar()
    return counted.withColumn(share, safe_divide(F.col(count), total))


def coverage(df: DataFrame, label: str, name: str, measures: dict[str, Column]) -> DataFrame:
    """One row of aggregates, named ``name`` in column ``label``."""
    one_row = df.agg(*(value.alias(alias) for alias, value in measures.items()))
    return one_row.select(F.lit(name).alias(label), *measures)
