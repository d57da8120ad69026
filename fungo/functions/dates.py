"""Calendar expressions. All of them work on dates, free of any session time zone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_NS = 1_000_000_000
DAY_S = 86_400
# No count of nanoseconds in 64 bits has so many seconds; below it a half is added without loss.
LARGEST_S = 1 << 40

TIME_GRAINS = ("date", "week", "month", "quarter", "year")


def ns_to_date(nanoseconds: Column) -> Column:
    """Date of an epoch count in nanoseconds, rounded to the nearest second first."""
    exact = nanoseconds / F.lit(SECOND_NS)
    size = F.abs(exact)
    # Halves go away from zero, as in F.round, which makes a decimal number of every value. What is no number is its.
    whole = F.floor(size + F.lit(0.5))
    nearest = F.when(exact < 0, -whole).otherwise(whole)
    seconds = F.when(size < F.lit(float(LARGEST_S)), nearest).otherwise(F.round(exact).try_cast("bigint"))
    return F.date_from_unix_date(F.floor(seconds / F.lit(DAY_S)).cast("int"))


def ns_between(nanoseconds: Column, first: date, last: date) -> Column:
    """Integer bounds enclosing ``first``..``last``, one second wider on each side.

    A plain comparison, so it is pushed to the parquet scan; the exact test on the date follows.
    """
    epoch = date(1970, 1, 1)
    low = (first - epoch).days * DAY_S - 1
    high = ((last - epoch).days + 1) * DAY_S + 1
    return nanoseconds.between(low * SECOND_NS, high * SECOND_NS)


def time_grain(day: Column, grain: str) -> Column:
    """First day of the period that holds ``day``; weeks start on Monday."""
    if grain not in TIME_GRAINS:
        raise ValueError(f"unknown time grain {grain!r}")
    if grain == "date":
        return day
    return F.trunc(day, grain)


def chunk_starts(first: Column, last: Column, days: int) -> Column:
    """Array of the first days of consecutive ``days``-long chunks; empty when first > last."""
    if days < 1:
        raise ValueError("a chunk holds at least one day")
    steps = F.sequence(
        F.lit(0), F.floor(F.datediff(last, first) / F.lit(days)).cast("int")
    )
    starts = F.transform(steps, lambda step: F.date_add(first, step * days))
    return F.when(first <= last, starts).otherwise(F.array().cast("array<date>"))


def chunk_end(start: Column, last: Column, days: int) -> Column:
    """Last day of the chunk that begins on ``start``, cut at ``last``."""
    return F.least(F.date_add(start, days - 1), last)
