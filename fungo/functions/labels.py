"""Display labels, flags and tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Roster status codes and their display labels.
AVAILABILITY = {
    "A": "Active",
    "D7": "IL — 7-Day",
    "D10": "IL — 10-Day",
    "D15": "IL — 15-Day",
    "D60": "IL — 60-Day",
    "ILF": "IL — Full Season",
    "RA": "Rehab Assignment",
    "RM": "Minors",
    "RES": "Minors",
    "DEV": "Minors",
    "DES": "Designated for Assignment",
    "RST": "Restricted List",
    "NYR": "Not Yet Reported",
    "TI": "Temporary Inactive",
    "ADM": "Administrative Leave",
    "IN": "Ineligible",
    "MIL": "Military Leave",
    "SU": "Suspended",
}
UNKNOWN_STATUS = "Unknown"
ACTIVE_CODE = "A"
INJURED_CODES = ("D7", "D10", "D15", "D60", "ILF", "RA")

# Hard-hit rate bounds, best tier first.
BATTER_HARD_HIT_BOUNDS = (0.45, 0.38)
PITCHER_HARD_HIT_BOUNDS = (0.35, 0.42)

# xwOBA tier bounds of the contact-quality report; our own choice.
XWOBA_BOUNDS = (0.37, 0.31)


def availability(code: Column, description: Column) -> Column:
    """Label of a status code; an unlisted code shows its description."""
    (first, text), *others = AVAILABILITY.items()
    label = F.when(code == first, text)
    for known, text in others:
        label = label.when(code == known, text)
    return label.otherwise(F.coalesce(description, F.lit(UNKNOWN_STATUS)))


def is_active(code: Column) -> Column:
    return code == ACTIVE_CODE


def is_injured(code: Column) -> Column:
    return code.isin(*INJURED_CODES)


def status_rank(code: Column) -> Column:
    """0 active, 1 injured, 2 anything else, a missing code included."""
    return F.when(is_active(code), 0).when(is_injured(code), 1).otherwise(2)


def full_name(first: Column, last: Column) -> Column:
    """Both names with a space between; null when either is missing."""
    return F.concat(first, F.lit(" "), last)


def composite_key(*parts: Column) -> Column:
    """Key parts as text, joined by a dash."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("-"), part.cast("string")]
    return F.concat(*pieces[1:])


def tier(value: Column, bounds: tuple[float, float], lower_is_better: bool = False) -> Column:
    """high, mid or low by two bounds; a missing value is low, like any value past both."""
    best, fair = bounds
    if lower_is_better:
        return F.when(value <= best, "high").when(value <= fair, "mid").otherwise("low")
    return F.when(value >= best, "high").when(value >= fair, "mid").otherwise("low")
