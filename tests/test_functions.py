"""Column expressions on single values."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from fungo.functions import dates, labels, numeric, short_text
from fungo.sources import derived
from tests import small


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_safe_divide(spark):
    assert value(spark, numeric.safe_divide(F.lit(1), F.lit(4))) == 0.25
    assert value(spark, numeric.safe_divide(F.lit(1), F.lit(0))) is None
    assert value(spark, numeric.safe_divide(F.lit(None), F.lit(2))) is None


def test_whole_numbers_round_half_away_from_zero(spark):
    for given, expected in ((2.5, 3), (-2.5, -3), (2.4, 2), ("x", None), (None, None)):
        literal = F.lit(given) if given is not None else F.lit(None).cast("double")
        assert value(spark, numeric.to_whole(literal)) == expected


def test_nan_becomes_null(spark):
    frame = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, k int")
    assert [r.x for r in numeric.nan_to_null(frame).orderBy("k").collect()] == [None, 2.0]


def test_nanoseconds_to_date_ignores_the_session_zone(spark):
    kept = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert value(spark, dates.ns_to_date(F.lit(small.FIRST_DAY_NS))) == date(2026, 3, 27)
            before = F.lit(small.FIRST_DAY_NS - 1_000_000_000)
            assert value(spark, dates.ns_to_date(before)) == date(2026, 3, 26)
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)
    assert value(spark, dates.ns_to_date(F.lit(None).cast("bigint"))) is None


@pytest.mark.parametrize(
    ("first", "last", "days", "expected"),
    [
        ("2024-04-01", "2024-04-01", 7, [("2024-04-01", "2024-04-01")]),
        (
            "2024-04-01",
            "2024-04-14",
            7,
            [("2024-04-01", "2024-04-07"), ("2024-04-08", "2024-04-14")],
        ),
        (
            "2024-04-01",
            "2024-04-10",
            4,
            [("2024-04-01", "2024-04-04"), ("2024-04-05", "2024-04-08"), ("2024-04-09", "2024-04-10")],
        ),
        ("2024-04-02", "2024-04-01", 7, []),
        ("2024-02-28", "2024-03-01", 1, [("2024-02-28",) * 2, ("2024-02-29",) * 2, ("2024-03-01",) * 2]),
    ],
)
def test_date_chunks(spark, first, last, days, expected):
    a, b = F.lit(date.fromisoformat(first)), F.lit(date.fromisoformat(last))
    starts = spark.range(1).select(F.explode(dates.chunk_starts(a, b, days)).alias("s"))
    rows = starts.select("s", dates.chunk_end(F.col("s"), b, days).alias("e")).collect()
    assert [(str(r.s), str(r.e)) for r in rows] == expected


def test_time_grains_start_weeks_on_monday(spark):
    day = F.lit(date(2026, 3, 29))  # a Sunday
    found = {grain: str(value(spark, dates.time_grain(day, grain))) for grain in dates.TIME_GRAINS}
    assert found == {
        "date": "2026-03-29",
        "week": "2026-03-23",
        "month": "2026-03-01",
        "quarter": "2026-01-01",
        "year": "2026-01-01",
    }


@pytest.mark.parametrize(
    ("code", "text", "expected"),
    [
        ("A", "x", ("Active", True, False, 0)),
        ("RA", "x", ("Rehab Assignment", False, True, 1)),
        ("DEV", "x", ("Minors", False, False, 2)),
        ("ZZ", "Other list", ("Other list", False, False, 2)),
        ("ZZ", None, ("Unknown", False, False, 2)),
        (None, None, ("Unknown", None, None, 2)),
    ],
)
def test_status_labels(spark, code, text, expected):
    c, t = F.lit(code).cast("string"), F.lit(text).cast("string")
    found = (
        value(spark, labels.availability(c, t)),
        value(spark, labels.is_active(c)),
        value(spark, labels.is_injured(c)),
        value(spark, labels.status_rank(c)),
    )
    assert found == expected


def test_names_and_keys(spark):
    assert value(spark, labels.full_name(F.lit("Bo"), F.lit("Batts"))) == "Bo Batts"
    assert value(spark, labels.full_name(F.lit("Bo"), F.lit(None).cast("string"))) is None
    assert value(spark, labels.composite_key(F.lit(7), F.lit(12))) == "7-12"


def test_tiers(spark):
    def tier(v, bounds, low):
        return value(spark, labels.tier(F.lit(v), bounds, lower_is_better=low))

    bounds = labels.BATTER_HARD_HIT_BOUNDS
    assert [tier(v, bounds, False) for v in (0.45, 0.38, 0.37)] == ["high", "mid", "low"]
    bounds = labels.PITCHER_HARD_HIT_BOUNDS
    assert [tier(v, bounds, True) for v in (0.35, 0.42, 0.43)] == ["high", "mid", "low"]


def test_settled_rounding_does_not_follow_the_last_bit(spark):
    for noisy in (0.5859375, 0.5859375 - 1e-15, 0.5859375 + 1e-15):
        assert value(spark, numeric.settled(F.lit(noisy), 6)) == 0.585938


def test_pitch_numbering_of_one_very_large_plate_appearance(spark):
    """A third of all rows in one plate appearance: numbered without gaps, in order."""
    hot = [(20, p % 97, p % 7, p % 5, 1.0, float(p), 0.0, "O") for p in range(1000)]
    rest = [(o, o % 13, o % 3, 1 + o % 4, 1.0, 2.0, 0.0, "F") for o in range(2000)]
    lines = spark.createDataFrame(
        hot + rest,
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_linestatus string",
    )
    raw = derived.pitches(lines)
    largest = raw.groupBy("game_pk", "at_bat_number").agg(
        F.count("*").alias("n"),
        F.min("pitch_number").alias("lo"),
        F.max("pitch_number").alias("hi"),
        F.count_distinct("pitch_number").alias("d"),
        F.count("events").alias("e"),
    )
    rows = largest.collect()
    assert sum(r.n for r in rows) == 3000
    assert all((r.lo, r.hi, r.d, r.e) == (1, r.n, r.n, 1) for r in rows)
    assert max(r.n for r in rows) >= 1000


def test_range_bounds_enclose_the_days(spark):
    day = date(2026, 3, 27)
    test = dates.ns_between(F.col("ns"), day, day)
    rows = [(small.FIRST_DAY_NS,), (small.FIRST_DAY_NS + small.DAY_NS - 1,)]
    assert spark.createDataFrame(rows, "ns bigint").where(test).count() == 2
    far = [(small.FIRST_DAY_NS + 2 * small.DAY_NS,), (small.FIRST_DAY_NS - small.DAY_NS,)]
    assert spark.createDataFrame(far, "ns bigint").where(test).count() == 0
    assert day + timedelta(days=1) == date(2026, 3, 28)


def test_short_texts_keep_order_and_come_back_whole(spark):
    texts = ["", "L", "R", "Left", "Right", "Ł", "LL", "L\0", "é", "1234567", "zzzzzzz", "\x7f"]
    frame = spark.createDataFrame([(text,) for text in [*texts, None]], "text string")
    coded = frame.select("text", short_text.to_code(F.col("text")).alias("code"))
    rows = coded.select("text", "code", short_text.to_text(F.col("code")).alias("back")).collect()
    assert all(row.text == row.back for row in rows)
    known = [row for row in rows if row.text is not None]
    by_code = [row.text for row in sorted(known, key=lambda row: row.code)]
    assert by_code == sorted(texts, key=lambda text: text.encode())
    with pytest.raises(Exception, match="longer than 7 bytes: Left-handed"):
        spark.createDataFrame([("Left-handed",)], "text string").select(short_text.to_code(F.col("text"))).collect()


def test_dates_of_nanoseconds_are_those_of_the_nearest_second(spark):
    """Halves go away from zero, as the rounding of a number does, for every count that 64 bits hold."""
    day, half = 86_400 * 10**9, 5 * 10**8
    edges = [k * day + shift for k in (0, 1, -1, 20_539, -20_539) for shift in (-half - 1, -half, -half + 1, -1, 0, 1, half)]
    counts = [*edges, 2**63 - 1, -(2**63), 10**9 // 2 - 1, -(10**9) // 2, None]
    rows = spark.createDataFrame([(n,) for n in counts], "n long")
    by_number = F.floor(F.round(F.col("n") / F.lit(10**9)).try_cast("bigint") / F.lit(86_400)).cast("int")
    wrong = rows.where(~dates.ns_to_date(F.col("n")).eqNullSafe(F.date_from_unix_date(by_number)))
    assert wrong.collect() == []
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (1.5e9,)], "n double")
    assert [str(r[0]) for r in odd.select(dates.ns_to_date(F.col("n"))).collect()] == ["None", "None", "None", "1970-01-01"]
