"""Each rule passes on sound input and fails on a broken one."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fungo.operators.measures import Explore, mean_of_games, total
from fungo.plans import profiles, quality
from fungo.plans.warehouse import Warehouse
from tests import small


def traded_game() -> list[dict]:
    """The sound game plus a second one in which batter and pitcher wear other clubs' shirts."""
    return [
        *small.game(),
        small.pitch(1, 1, game_pk=2, home_team="HOM", away_team="AWY", inning_topbot="Bot"),
    ]


@pytest.fixture(scope="module")
def sound(spark):
    return Warehouse(small.raw_tables(spark, rows=traded_game())).with_stored_marts()


def failing(frame) -> dict[str, int]:
    return {r.rule: r.failing_rows for r in frame.collect() if r.failing_rows}


def test_sound_input_passes_every_rule(sound):
    found = quality.full_suite(sound)
    assert failing(found) == {}
    assert found.count() == 39 + 4 + 5 + 2 + 4 + 2 + 3 + 4


def test_missing_values(spark):
    rows = [*traded_game(), small.pitch(9, 9, batter=None, game_pk=None)]
    found = failing(quality.required_columns(Warehouse(small.raw_tables(spark, rows=rows))))
    assert found["not_null stg_statcast_pitches.batter_id"] == 1
    assert found["not_null stg_statcast_pitches.game_id"] == 1
    assert found["not_null mart_batter_game_stats.batter_id"] == 1
    assert found["not_null rpt_batter_game.batter_id"] == 1
    assert "not_null stg_statcast_pitches.pitch_type" not in found


def test_repeated_keys(spark):
    raw = small.raw_tables(
        spark,
        teams=[small.team(1, "HOM"), small.team(1, "AWY"), small.team(None, "X"), small.team(None, "Y")],
    )
    found = failing(quality.unique_columns(Warehouse(raw)))
    assert found == {
        "unique stg_mlb_teams.team_id": 1,
        "unique dim_team.team_id": 1,
        "unique dim_roster_status.mlbam_id": 1,  # the player of that club comes out twice
    }


def test_repeated_join_keys_and_the_fanout_they_cause(spark):
    raw = small.raw_tables(
        spark, rows=traded_game(), teams=[small.team(1, "HOM"), small.team(2, "AWY"), small.team(3, "AWY")]
    )
    warehouse = Warehouse(raw)
    assert failing(quality.join_keys(warehouse)) == {"join_key dim_team.team_abbrev": 1}
    assert "grain rpt_batter_season" in failing(quality.composite_grains(warehouse))
    assert failing(quality.batter_recoverable(warehouse)) != {}


@pytest.mark.parametrize(
    "teams, players, status, key",
    [
        ([small.team(1, "HOM"), small.team(2, "AWY"), small.team(3, "AWY")], None, None, "dim_team.team_abbrev = AWY"),
        (None, [{"mlbam_id": small.BATTER, "first_name": name} for name in "ab"], None, "player_lookup.mlbam_id = 10"),
    ],
)
def test_guarded_reports_fail_on_a_repeated_key(spark, teams, players, status, key):
    raw = small.raw_tables(spark, rows=traded_game(), teams=teams, players=players, status=status)
    assert Warehouse(raw).rpt_batter_season.count() > Warehouse(small.raw_tables(spark, rows=traded_game())).rpt_batter_season.count()
    guarded = Warehouse(raw, guarded=True)
    for report in (guarded.rpt_batter_season, guarded.with_stored_marts().rpt_batter_game):
        with pytest.raises(Exception, match=f"repeated key: {key}"):
            report.collect()


def test_guarded_reports_equal_others_and_bear_missing_keys(spark):
    teams = [small.team(1, "HOM"), small.team(2, "AWY"), small.team(3, None), small.team(4, None)]
    raw = small.raw_tables(spark, rows=traded_game(), teams=teams)
    for name in ("rpt_batter_season", "rpt_batter_game", "rpt_pitcher_season", "rpt_pitcher_pitch_mix"):
        plain, guarded = (Warehouse(raw, guarded=g).table(name) for g in (False, True))
        assert plain.columns == guarded.columns
        assert plain.exceptAll(guarded).count() == guarded.exceptAll(plain).count() == 0


def test_values_outside_the_list(spark):
    rows = [*small.game(), small.pitch(8, 1, stand="S", type=None), small.pitch(8, 2, type="Q")]
    found = failing(quality.closed_lists(Warehouse(small.raw_tables(spark, rows=rows))))
    assert found == {
        "accepted_values stg_statcast_pitches.batter_side": 1,
        "accepted_values stg_statcast_pitches.pitch_outcome_category": 1,
    }


def test_unknown_clubs(spark):
    raw = small.raw_tables(spark, rows=small.game(), teams=[small.team(1, "HOM")])
    found = failing(quality.references(Warehouse(raw)))
    assert found == {
        "relationships rpt_batter_season.batter_team": 2,
        "relationships rpt_batter_game.batter_team": 2,
    }


def test_two_clubs_in_one_game(spark):
    rows = [small.pitch(1, 1), small.pitch(2, 1, inning_topbot="Bot")]
    warehouse = Warehouse(small.raw_tables(spark, rows=rows))
    assert failing(quality.one_team_per_batter_game(warehouse.mart_batter_game_stats)) == {
        "one_team_per_batter_game": 1
    }
    assert failing(quality.one_team_per_pitcher_game(warehouse.mart_pitcher_game_stats)) == {
        "one_team_per_pitcher_game": 1
    }


def test_lost_stint_and_lost_player(sound):
    def found(season, games, key, names):
        return [r.both_sides for r in quality.recoverable(season, games, key, names).collect()]

    season, games = sound.rpt_batter_season, sound.mart_batter_game_stats
    batting = ("batter_id", quality.BATTER_TOTALS)
    assert found(season.where("batter_team <> 'HOM'"), games, *batting) == [True]
    lost_player = season.where(F.col("batter_id") != small.OTHER_BATTER)
    assert found(lost_player, games, *batting) == [False]
    lost = sound.rpt_pitcher_season.where("pitching_team <> 'HOM'")
    pitching = ("pitcher_id", quality.PITCHER_TOTALS)
    assert found(lost, sound.mart_pitcher_game_stats, *pitching) == [True]


def test_nobody_traded(spark):
    found = quality.traded_nonvacuous(Warehouse(small.raw_tables(spark)))
    assert sorted((r.side, r.multi_team_players) for r in found.collect()) == [
        ("batter", 0), ("pitcher", 0)
    ]


def test_profiles_of_the_small_game(sound):
    rates = {r.column_name: r for r in profiles.null_rate_columns(sound.stg_statcast_pitches).collect()}
    assert (rates["xba"].null_count, rates["xba"].total_rows) == (10, 11)
    outcome = {
        r.pitch_outcome_category: (r.outcome_count, round(r.outcome_pct, 4))
        for r in profiles.outcome_distribution(sound.stg_statcast_pitches).collect()
    }
    assert outcome == {"S": (6, 0.5455), "X": (3, 0.2727), "B": (2, 0.1818)}
    named = profiles.name_like(sound.rpt_pitcher_season, "%ace%").collect()
    assert {(r.pitcher_name, r.availability) for r in named} == {("Ace, Al", "IL — 60-Day")}
    listed = profiles.long_injured_without_stats(sound.dim_roster_status, sound.mart_batter_game_stats)
    assert [r.player_full_name for r in listed.collect()] == [f"Player {small.PITCHER}"]


def test_lookup_that_repeats_a_player_does_not_multiply_totals(spark):
    fact = spark.createDataFrame([(1, 10, 2.0), (1, 11, 4.0), (2, 10, 6.0)], "p int, g int, x double")
    lookup = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "mlbam_id int, name string")
    explore = Explore(
        fact, "p", {"p": F.col("p")}, {}, {"x": total("x"), "mean": mean_of_games("x", 1)},
        lookup=lookup, lookup_attributes=("name",),
    )
    rows = {r.name: (r.x, r.mean) for r in explore.summarize(["name"]).collect()}
    assert rows == {"a": (6.0, 3.0), "b": (6.0, 6.0)}


def test_date_gaps(spark):
    days = [("A", "2026-04-01"), ("A", "2026-04-01"), ("A", "2026-04-02"), ("A", "2026-04-05"), ("B", "2026-04-03"), (None, None)]
    games = spark.createDataFrame(days, "club string, day string").selectExpr("club", "date(day) as game_date")
    (gap,) = profiles.date_gaps(games, "club").collect()
    assert (gap.club, str(gap.last_date), str(gap.next_date), gap.days_between) == ("A", "2026-04-02", "2026-04-05", 2)
    whole = [(str(g.last_date), g.days_between) for g in profiles.date_gaps(games).collect()]
    assert whole == [("2026-04-03", 1)]
