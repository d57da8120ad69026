"""Null-safe arithmetic and casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null where the denominator is zero or either side is null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def weighted_mean(value: Column, weight: Column, null_weight: str = "keep") -> Column:
    """Aggregate: weighted mean of ``value``.

    With ``keep`` a row without a value still adds its weight to the denominator; this is the
    rule every report follows. ``drop`` leaves such rows out of both sums.
    """
    if null_weight == "keep":
        counted = weight
    elif null_weight == "drop":
        counted = F.when(value.isNotNull(), weight)
    else:
        raise ValueError(f"null_weight must be keep or drop, not {null_weight!r}")
    return safe_divide(F.sum(value * weight), F.sum(counted))


def to_whole(value: Column) -> Column:
    """Nearest integer, halves away from zero; null where the value is not a number."""
    return F.round(value.try_cast("double")).try_cast("bigint")


def to_number(text: Column) -> Column:
    """Text to double, null where it does not parse."""
    return text.try_cast("double")


def _doubles(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, DoubleType)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every double column."""
    nothing = F.lit(None).cast("double")
    return df.withColumns({name: F.nanvl(F.col(name), nothing) for name in _doubles(df)})


def settled(value: Column, places: int) -> Column:
    """Round to ``places``, by way of ten places.

    A sum of doubles depends on the order of its rows in the last bits. The first rounding
    removes those, so they do not decide a value that lies halfway between two results.
    """
    return F.round(F.round(value, 10), places)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column for display or comparison."""
    return df.withColumns({name: settled(F.col(name), places) for name in _doubles(df)})
