"""A hand-computed game."""

from __future__ import annotations

import datetime

import pytest

from fungo.functions.numeric import weighted_mean
from fungo.operators import game_facts, rollups, staging
from fungo.plans.warehouse import Warehouse
from pyspark.sql import functions as F
from tests import small


@pytest.fixture(scope="module")
def staged(spark):
    return staging.stage_pitches(small.pitches(spark, small.game())).cache()


def _one(frame, **keys):
    for name, value in keys.items():
        frame = frame.where(F.col(name) == value)
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_staging_drops_untyped_pitches_and_types_the_rest(staged):
    assert len(staged.columns) == 110
    assert staged.count() == 10
    row = _one(staged, at_bat_number=4)
    assert row["launch_angle_deg"] is None
    assert row["game_date"] == datetime.date(2026, 3, 27)
    assert (row["batter_team"], row["pitching_team"]) == (small.AWAY, small.HOME)


def test_batter_game(staged):
    row = _one(game_facts.batter_games(staged), batter_id=small.BATTER)
    expected = {
        "game_id": 1,
        "batter_team": small.AWAY,
        "batter_side": "R",  # seen on both sides: the greater wins
        "total_pitches": 9,
        "plate_appearances": 4,
        "at_bats": 2,  # walk and sac_fly are none; the home run had no pitch type
        "hits": 1,
        "singles": 1,
        "doubles": 0,
        "home_runs": 0,
        "strikeouts": 1,
        "walks": 1,
        "swings": 6,
        "whiffs": 2,  # a foul tip is no whiff
        "batted_balls": 2,
        "hard_hit_count": 1,
        "barrel_count": 1,
        "avg_exit_velocity_mph": 100.0,  # the foul's 70 stays out
        "max_exit_velocity_mph": 100.0,
        "avg_launch_angle_deg": 10.0,
        "hard_hit_rate": 0.5,
        "avg_xba": 0.5,
        "avg_xwoba": 0.6,
        "avg_xslg": None,
        "avg_bat_speed": None,
    }
    assert {name: row[name] for name in expected} == expected
    assert row["whiff_rate"] == pytest.approx(2 / 6)


def test_pitcher_game(staged):
    row = _one(game_facts.pitcher_games(staged), pitcher_id=small.PITCHER)
    expected = {
        "pitcher_name": "Ace, Al",
        "pitcher_throws": "R",
        "pitching_team": small.HOME,
        "total_pitches": 10,
        "batters_faced": 5,
        "strikeouts": 1,
        "walks": 1,
        "hits_allowed": 2,
        "home_runs_allowed": 1,
        "avg_pitch_velocity_mph": 90.0,
        "strikes": 5,
        "balls": 2,
        "called_strikes": 1,
        "swings": 7,
        "whiffs": 2,
        "pct_four_seam": 0.7,
        "pct_slider": 0.2,
        "pct_sinker": 0.0,
        "pct_other": 0.1,
        "hard_hit_allowed_count": 2,
        "batted_balls_allowed": 3,
        "avg_exit_velocity_allowed": 97.5,
    }
    assert {name: row[name] for name in expected} == expected
    assert sum(row[f"pct_{label}"] for label in game_facts.pitch.MIX_LABELS) == pytest.approx(1)


def test_pitches_without_plate_appearance_number_do_not_count_as_one(spark):
    rows = [small.pitch(None, 1, events="single"), small.pitch(1, 1, events="single")]
    staged = staging.stage_pitches(small.pitches(spark, rows))
    batter = game_facts.batter_games(staged).first()
    assert (batter.total_pitches, batter.plate_appearances, batter.hits) == (2, 1, 1)
    assert game_facts.pitcher_games(staged).first().batters_faced == 1


def test_repeated_load_leaves_distinct_counts_alone(spark):
    staged = staging.stage_pitches(small.pitches(spark, small.game() * 2))
    row = _one(game_facts.batter_games(staged), batter_id=small.BATTER)
    assert (row["total_pitches"], row["plate_appearances"], row["hits"]) == (18, 4, 1)


def test_unlisted_events_are_at_bats(spark):
    rows = [
        small.pitch(1, 1, events="truncated_pa"),
        small.pitch(2, 1, events="sac_bunt_double_play"),
        small.pitch(3, 1, events="catcher_interf"),
    ]
    row = game_facts.batter_games(staging.stage_pitches(small.pitches(spark, rows))).first()
    assert (row.plate_appearances, row.at_bats) == (3, 2)


def test_null_keys_keep_their_group(spark):
    rows = [small.pitch(1, 1, batter=None, home_team=None, events="single")]
    facts = game_facts.batter_games(staging.stage_pitches(small.pitches(spark, rows)))
    assert [(r.batter_id, r.home_team, r.hits) for r in facts.collect()] == [(None, None, 1)]


def test_unknown_half_counts_as_bottom(spark):
    rows = [small.pitch(1, 1, inning_topbot=half) for half in ("Top", "Bot", None, "top")]
    staged = staging.stage_pitches(small.pitches(spark, rows))
    found = {(r.inning_half, r.batter_team, r.pitching_team) for r in staged.collect()}
    assert found == {
        ("Top", "AWY", "HOM"), ("Bot", "HOM", "AWY"), (None, "HOM", "AWY"), ("top", "HOM", "AWY")
    }


def test_season_mean_keeps_the_weight_of_unmeasured_games(spark):
    rows = [
        small.ball_in_play(1, 1, "single", 100.0, "10", 1),
        small.ball_in_play(1, 1, "single", None, "10", 1, game_pk=2),
    ]
    games = game_facts.batter_games(staging.stage_pitches(small.pitches(spark, rows)))
    assert rollups.batter_stints(games).first().avg_exit_velocity == 50.0
    assert rollups.league_batting_measured(games).first().measured_avg_exit_velocity == 100.0


def test_weighted_mean_rejects_other_rules():
    with pytest.raises(ValueError):
        weighted_mean(F.lit(1.0), F.lit(1), null_weight="zero")


def test_traded_batter_has_one_line_per_club_that_adds_up(spark):
    rows = [
        small.pitch(1, 1, events="single"),
        small.pitch(1, 1, events="single", game_pk=2, home_team="THD", inning_topbot="Bot"),
        small.pitch(1, 1, events="walk", game_pk=3),
    ]
    warehouse = Warehouse(small.raw_tables(spark, rows=rows))
    lines = {r.batter_team: r for r in warehouse.rpt_batter_season.collect()}
    assert {club: (r.games, r.hits) for club, r in lines.items()} == {"AWY": (2, 1), "THD": (1, 1)}
    assert lines["AWY"].batter_name == "Bo Batts"
    assert lines["THD"].team_id is None
    assert lines["THD"].availability == "Active"
    combined = rollups.combined_batting(rollups.batter_stints(warehouse.mart_batter_game_stats))
    row = combined.first()
    assert (row.stints, row.games, row.hits, row.walks) == (2, 3, 2, 1)


def test_mix_by_stint_weights_games_by_their_pitches(spark):
    rows = [small.pitch(1, n, pitch_type="FF") for n in range(3)] + [
        small.pitch(1, 1, game_pk=2, pitch_type="CU")
    ]
    games = game_facts.pitcher_games(staging.stage_pitches(small.pitches(spark, rows)))
    mix = {r.pitch_type: r.pitch_pct for r in rollups.mix_by_stint(games).collect()}
    assert len(mix) == 9
    assert (mix["four_seam"], mix["curveball"], mix["other"]) == (0.75, 0.25, 0.0)
    assert rollups.mix_long(games, "pitcher_id", "game_id").count() == 18


@pytest.mark.parametrize("sides, expected", [(("Left", "L"), "Left"), (("", None), ""), (("Ł", "R"), "Ł")])
def test_labels_come_back_whole(spark, sides, expected):
    rows = [small.pitch(n, 1, stand=side, p_throws=side) for n, side in enumerate(sides)]
    staged = staging.stage_pitches(small.pitches(spark, rows))
    assert game_facts.batter_games(staged).first().batter_side == expected
    assert game_facts.pitcher_games(staged).first().pitcher_throws == expected


def test_plate_appearances_of_any_number_count_once(spark):
    numbers = (-1, -1, 0, 1, 63, 64, 64, 127, 128, 128, 191, 192, 1_000_000, None)
    rows = [
        small.pitch(number, n, events="single" if n % 2 else "walk", description="foul")
        for number in numbers
        for n in (1, 2, 3)
    ]
    staged = staging.stage_pitches(small.pitches(spark, rows)).repartition(5)
    different = len(set(numbers) - {None})
    batter = _one(game_facts.batter_games(staged), batter_id=small.BATTER)
    assert (batter["plate_appearances"], batter["singles"], batter["walks"]) == (different,) * 3
    assert (batter["total_pitches"], batter["swings"], batter["home_runs"]) == (len(rows), len(rows), 0)
    pitcher = _one(game_facts.pitcher_games(staged), pitcher_id=small.PITCHER)
    assert (pitcher["batters_faced"], pitcher["hits_allowed"]) == (different, different)
    assert (pitcher["total_pitches"], pitcher["avg_pitch_velocity_mph"]) == (len(rows), 90.0)


def test_no_row_is_shuffled_for_a_plate_appearance(spark):
    staged = staging.stage_pitches(small.pitches(spark, small.game()))
    for build in (game_facts.batter_games, game_facts.pitcher_games):
        plan = build(staged)._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert len(shuffles) == 2
        assert not any("at_bat_number#" in line for line in shuffles)
