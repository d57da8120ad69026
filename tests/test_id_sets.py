"""Distinct counts from stored bitmaps."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest

from fungo.operators.id_sets import GRAINS, day_sets, distinct_counts

COUNTED = {"batters": ("batter",), "players": ("batter", "pitcher")}


def drawn(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    ids = [None, 0, 1, 32_767, 32_768, 32_769, 10**6, 2**40, *range(50, 90)]
    days = [None, *(date(2026, 4, 20) + timedelta(days=k) for k in range(25))]
    return [(rng.choice(days), rng.choice(ids)) for _ in range(n)]


def period(day, grain):
    if grain == "season" or day is None:
        return None
    return day if grain == "day" else day.replace(day=1)


def plain(batters, pitchers):
    counts = {}
    for grain in GRAINS:
        for name, rows in (("batters", batters), ("players", batters + pitchers)):
            for day, one in rows:
                if one is not None:
                    counts.setdefault((grain, period(day, grain), name), set()).add(one)
    return {key: len(ids) for key, ids in counts.items()}


@pytest.mark.parametrize("n", [0, 1, 400])
def test_counts_equal_sets(spark, n):
    batters, pitchers = drawn(1, n), drawn(2, n)
    frames = [spark.createDataFrame(rows, "game_date date, id long") for rows in (batters, pitchers)]
    sets = day_sets({"batter": (frames[0], "id"), "pitcher": (frames[1], "id")})
    found = distinct_counts(sets, COUNTED).collect()
    assert {(r.grain, r.starts_on, r.counted): r.n for r in found} == plain(batters, pitchers)
    assert len(found) == len(plain(batters, pitchers))


def test_one_scan_for_the_subjects_of_a_table(spark):
    frame = spark.range(5).selectExpr("date'2026-04-01' as game_date", "id", "id + 1 as other")
    sets = day_sets({"batter": (frame, "id"), "pitcher": (frame, "other")})
    assert sets._jdf.queryExecution().executedPlan().toString().count(" Range (") == 1
    assert {(r.counted, r.n) for r in distinct_counts(sets, COUNTED).collect()} == {("batters", 5), ("players", 6)}


def test_a_set_of_ids_far_apart_is_a_short_row_for_each(spark):
    """Games of a day lie far apart; their set may not cost a bitmap of thousands of bytes for each."""
    frame = spark.range(300).selectExpr("date'2026-04-01' as game_date", "id * 40000 - 2000000 as id")
    sets = day_sets({"game": (frame, "id")})
    assert all(field.dataType.simpleString() in ("string", "date", "bigint") for field in sets.schema)
    assert sets.count() == 300
    assert "SortAggregate" not in sets._jdf.queryExecution().executedPlan().toString()
    counts = distinct_counts(sets, {"games": ("game",)})
    assert {(r.grain, r.n) for r in counts.collect()} == {(grain, 300) for grain in GRAINS}


def test_words_join_ids_that_lie_together(spark):
    frame = spark.range(-64, 128).selectExpr("date'2026-04-01' as game_date", "id").unionAll(
        spark.range(-64, 128, 3).selectExpr("date'2026-04-02' as game_date", "id")
    )
    sets = day_sets({"game": (frame, "id")})
    assert sets.count() == 6
    found = {(r.grain, str(r.starts_on)): r.n for r in distinct_counts(sets, {"games": ("game",)}).collect()}
    assert found == {
        ("day", "2026-04-01"): 192, ("day", "2026-04-02"): 64, ("month", "2026-04-01"): 192, ("season", "None"): 192
    }
