"""Facts and season totals that follow what is landed, deletions included."""

from __future__ import annotations

import datetime
import random
import threading

import pytest
from pyspark.sql import functions as F

from fungo.operators import rollups
from fungo.operators.game_facts import batter_games, pitcher_games
from fungo.operators.staging import stage_pitches
from fungo.plans import ingestion
from fungo.sources import landing, versions
from fungo.streaming.incremental import ChangeSet, ingest_new_files, on_dates
from fungo.functions.numeric import rounded
from fungo.session import fresh_folder
from fungo.streaming.season_totals import SeasonTotals
from tests import small


def on_day(day, at_bats, **values):
    date = None if day is None else small.FIRST_DAY_NS + day * small.DAY_NS
    game = 999 if day is None else day
    return [small.pitch(n, 1, **{"game_date": date, "game_pk": game, "events": "single", **values}) for n in at_bats]


def season(seed: int, days) -> list[dict]:
    """Pitches of several batters, pitchers and clubs with measured values, some of them missing."""
    rng = random.Random(seed)
    rows = []
    for day in days:
        for at_bat in range(rng.randint(4, 9)):
            speed = rng.choice([None, 60 + 50 * rng.random()])
            rows += [
                small.ball_in_play(
                    at_bat, 1, rng.choice(["single", "field_out", "home_run"]), speed, str(rng.randint(-20, 50)), 4,
                    game_pk=day, game_date=small.FIRST_DAY_NS + day * small.DAY_NS, batter=rng.randint(1, 4),
                    pitcher=rng.randint(90, 92), player_name=rng.choice(["Ace, Al", None]),
                    inning_topbot=rng.choice(["Top", "Bot"]), release_speed=rng.choice([None, 90 * rng.random()]),
                    estimated_woba_using_speedangle=rng.choice([None, rng.random()]),
                    pitch_type=rng.choice(["FF", "SL", None]),
                )
            ]
    return rows


def full(spark, zone, build):
    return build(stage_pitches(landing.read_landed(spark, zone).drop("year", "month")))


def same(left, right) -> bool:
    right = right.select(*left.columns)
    return left.exceptAll(right).count() == right.exceptAll(left).count() == 0


class Zone:
    def __init__(self, spark):
        self.spark = spark
        self.zone, self.mart, self.progress = (fresh_folder(spark, n) for n in ("drops", "mart", "progress"))

    def take(self, rows, mode="append"):
        landing.land_pitches(small.pitches(self.spark, rows), self.zone, mode)
        ingest_new_files(self.spark, self.zone, self.mart, self.progress, batter_games)
        stored = self.spark.read.parquet(self.mart)
        assert same(full(self.spark, self.zone, batter_games), stored)
        return sorted(str(row.game_date) for row in stored.select("game_date").distinct().collect())


def test_dates_that_a_refresh_takes_away_leave_the_mart(spark):
    zone = Zone(spark)
    days = {day: on_day(day, (1, 2)) for day in (1, 2, 3, 40, None)}
    assert len(zone.take(sum(days.values(), []))) == 5
    assert zone.take(days[1] + days[3], "full-refresh") == ["2026-03-28", "2026-03-30"]
    assert zone.take(days[40], "full-refresh") == ["2026-05-06"]
    assert zone.take(days[1] + days[None]) == ["2026-03-28", "2026-05-06", "None"]


def test_a_date_that_loses_all_its_kept_pitches_leaves_the_mart(spark):
    zone = Zone(spark)
    zone.take(on_day(1, (1, 2)) + on_day(2, (1,)) + on_day(3, (1,)))
    untyped = on_day(2, (1,), pitch_type=None)
    assert zone.take(on_day(1, (1,)) + untyped, "full-refresh") == ["2026-03-28"]


def test_a_merge_that_moves_a_pitch_to_another_day(spark):
    zone = Zone(spark)
    zone.take(on_day(1, (1,)) + on_day(2, (1, 2)) + on_day(40, (1,)))
    moved = on_day(1, (1,))
    moved[0]["game_date"] += 3 * small.DAY_NS
    assert zone.take(moved, "merge") == ["2026-03-29", "2026-03-31", "2026-05-06"]


def test_several_loads_between_two_runs(spark):
    zone = Zone(spark)
    zone.take(on_day(1, (1,)) + on_day(2, (1,)))
    for rows, mode in ((on_day(5, (1,)), "append"), (on_day(2, (1,)), "full-refresh"), (on_day(6, (1,)), "append")):
        landing.land_pitches(small.pitches(spark, rows), zone.zone, mode)
    assert zone.take(on_day(2, (2,))) == ["2026-03-29", "2026-04-02"]


def test_an_unpublished_load_is_not_taken_in(spark, monkeypatch):
    zone = Zone(spark)
    zone.take(on_day(1, (1,)))
    with monkeypatch.context() as patch:
        patch.setattr(landing.loads, "commit", lambda *_: None)
        landing.land_pitches(small.pitches(spark, on_day(2, (1,))), zone.zone)
    assert zone.take(on_day(3, (1,))) == ["2026-03-28", "2026-03-30"]


SIDES = [
    (batter_games, rollups.BATTER_STINTS, "batter_totals"),
    (pitcher_games, rollups.PITCHER_STINTS, "pitcher_totals"),
]


def test_season_totals_equal_the_full_build_after_every_load(spark):
    state = ingestion.new_ingestion(spark)
    steps = [
        (season(1, range(0, 6)), "append"),
        (season(3, range(2, 7)), "full-refresh"),
        (season(4, (3, 40)), "append"),
        (season(5, (5, 6)), "merge"),
    ]
    for rows, mode in steps:
        landing.land_pitches(small.pitches(spark, rows), state.zone, mode)
        ingestion.bring_up_to_date(spark, state)
        for build, rollup, name in SIDES:
            games = full(spark, state.zone, build)
            totals = getattr(state, name)
            assert same(rounded(rollup.lines(games)), rounded(totals.lines()))
            if rollup is rollups.PITCHER_STINTS:
                mix = rollups.mix_of_totals(totals.sums())
                assert same(rounded(rollups.mix_by_stint(games)), rounded(mix))
                league = rollups.league_of_totals(totals.sums(), rollup, rollups.LEAGUE_PITCHING)
                assert same(rounded(rollups.league_pitching(games)), rounded(league))


def games_of(spark, seed, days):
    return batter_games(stage_pitches(small.pitches(spark, season(seed, days))))


def dates_of(games):
    return tuple(row.game_date for row in games.select("game_date").distinct().collect())


def test_a_batch_that_runs_again_changes_nothing(spark, monkeypatch):
    totals = SeasonTotals(spark, fresh_folder(spark, "totals"), rollups.BATTER_STINTS)
    first, late = games_of(spark, 1, range(5)), games_of(spark, 2, (3, 4))
    totals.refresh(first, ChangeSet(dates_of(first), ()), 0)
    changes = ChangeSet(dates_of(late), dates_of(first.where("game_id = 2")))
    everything = rounded(rollups.BATTER_STINTS.lines(first.where("game_id < 2").unionAll(late)))
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr("fungo.streaming.season_totals.write_dates", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        totals.refresh(late, changes, 1)
    for _ in range(2):
        totals.refresh(late, changes, 1)
        assert same(everything, rounded(totals.lines()))
    assert versions.published(spark, totals.totals).number == 1
    later = games_of(spark, 7, (9,))
    totals.refresh(later, ChangeSet(dates_of(later), ()), 2)
    everything = rollups.BATTER_STINTS.lines(first.where("game_id < 2").unionAll(late).unionAll(later))
    assert same(rounded(everything), rounded(totals.lines()))


def test_only_touched_dates_are_taken_off_and_touched_stints_read_again(spark):
    totals = SeasonTotals(spark, fresh_folder(spark, "totals"), rollups.BATTER_STINTS)
    first = games_of(spark, 1, range(8))
    totals.refresh(first, ChangeSet(dates_of(first), ()), 0)
    late = games_of(spark, 2, (3,))
    fresh = totals._rollup.per_date(late)
    after = totals.after(fresh, ChangeSet(dates_of(late), ()))
    text = after._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "LeftSemi" in text and "LeftAnti" in text
    assert "PartitionFilters" in text and "game_date" in text
    assert after.where(F.col("n_games") <= 0).count() == 0


def test_days_in_a_row_are_ranges(spark):
    """A list of all days of a season is more code than the JVM compiles together with the facts."""
    first = datetime.date(2026, 3, 27)
    days = [first + datetime.timedelta(days=n) for n in (*range(150), 152, 154, 155)]
    held = [first + datetime.timedelta(days=n) for n in range(-3, 160)]
    rows = spark.createDataFrame([(day,) for day in (*held, None)], "day date")
    for chosen in (days, [*days, None], [], [None], days[-3:]):
        found = {row.day for row in rows.where(on_dates("day", chosen)).collect()}
        assert found == set(chosen)
    plan = rows.where(on_dates("day", days))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 1000


def test_both_facts_are_brought_up_to_date_at_once(spark, monkeypatch):
    """Each side waits for the other to begin; one after the other, the first would wait in vain."""
    both, refresh_mart = threading.Barrier(2), ingestion.refresh_mart

    def refresh(*arguments):
        both.wait(timeout=60)
        refresh_mart(*arguments)

    monkeypatch.setattr(ingestion, "refresh_mart", refresh)
    state = ingestion.new_ingestion(spark)
    landing.land_pitches(small.pitches(spark, season(1, range(0, 3))), state.zone)
    ingestion.bring_up_to_date(spark, state)
    for mart, (build, _, _) in zip((state.batter_mart, state.pitcher_mart), SIDES):
        assert same(full(spark, state.zone, build), spark.read.parquet(mart))


def test_a_side_that_fails_fails_the_load_and_is_made_up_for(spark, monkeypatch):
    state = ingestion.new_ingestion(spark)
    landing.land_pitches(small.pitches(spark, season(1, range(0, 3))), state.zone)
    with monkeypatch.context() as patch, pytest.raises(Exception, match="lost"):
        patch.setattr(SeasonTotals, "refresh", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        ingestion.bring_up_to_date(spark, state)
    ingestion.bring_up_to_date(spark, state)
    for build, rollup, name in SIDES:
        games = full(spark, state.zone, build)
        assert same(rounded(rollup.lines(games)), rounded(getattr(state, name).lines()))
