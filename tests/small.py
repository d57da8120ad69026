"""Hand-made raw tables: one game of eleven pitches, clubs, players and rosters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fungo.schemas import PITCHES, PLAYER_LOOKUP, ROSTERS, TEAMS

DAY_NS = 86_400 * 1_000_000_000
FIRST_DAY_NS = 1_774_569_600 * 1_000_000_000  # 2026-03-27

HOME, AWAY = "HOM", "AWY"
BATTER, OTHER_BATTER, PITCHER = 10, 11, 90

_PITCH = {
    "game_pk": 1,
    "game_date": FIRST_DAY_NS,
    "game_year": 2026,
    "game_type": "R",
    "batter": BATTER,
    "pitcher": PITCHER,
    "player_name": "Ace, Al",
    "stand": "L",
    "p_throws": "R",
    "home_team": HOME,
    "away_team": AWAY,
    "inning_topbot": "Top",
    "pitch_type": "FF",
    "pitch_name": "4-Seam Fastball",
    "release_speed": 90.0,
    "type": "S",
    "description": "called_strike",
}


def pitch(at_bat_number, pitch_number, **values) -> dict:
    return {**_PITCH, "at_bat_number": at_bat_number, "pitch_number": pitch_number, **values}


def ball_in_play(at_bat_number, pitch_number, event, speed, angle, code, **values) -> dict:
    return pitch(
        at_bat_number, pitch_number, type="X", description="hit_into_play", events=event,
        launch_speed=speed, launch_angle=angle, launch_speed_angle=code, **values,
    )


def game() -> list[dict]:
    """Eleven pitches; one has no type and is dropped by staging."""
    return [
        pitch(1, 1),
        pitch(1, 2, description="foul", launch_speed=70.0),
        ball_in_play(
            1, 3, "single", 100.0, "10", 6, stand="R",
            estimated_ba_using_speedangle=0.5, estimated_woba_using_speedangle=0.6,
        ),
        pitch(2, 1, type="B", description="ball", pitch_type="SL", release_speed=None),
        pitch(2, 2, type="B", description="ball", events="walk", pitch_type="SL"),
        pitch(3, 1, description="swinging_strike", pitch_type="KN"),
        pitch(3, 2, description="foul_tip"),
        pitch(3, 3, description="swinging_strike", events="strikeout"),
        ball_in_play(4, 1, "sac_fly", None, "n/a", 2),
        pitch(5, 1, pitch_type=None, events="home_run", type="X"),
        ball_in_play(6, 1, "home_run", 95.0, "30", 6, batter=OTHER_BATTER),
    ]


def pitches(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(n) for n in PITCHES.names) for r in rows], PITCHES)


def _frame(spark: SparkSession, rows: list[dict], schema) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def team(team_id, abbrev, **values) -> dict:
    return {"team_id": team_id, "team_abbrev": abbrev, "team_name": f"Club {abbrev}", **values}


def spot(mlbam_id, team_id, code="A", **values) -> dict:
    return {
        "mlbam_id": mlbam_id, "team_id": team_id, "status_code": code,
        "player_full_name": f"Player {mlbam_id}", "status_description": f"desc {code}", **values,
    }


def raw_tables(spark: SparkSession, rows=None, teams=None, players=None, rosters=None, status=None):
    """All five raw tables; any of them can be replaced by other rows."""
    if teams is None:
        teams = [team(1, HOME), team(2, AWAY)]
    if players is None:
        players = [
            {"mlbam_id": BATTER, "first_name": "Bo", "last_name": "Batts"},
            {"mlbam_id": OTHER_BATTER, "first_name": "Only", "last_name": None},
        ]
    if rosters is None:
        rosters = [spot(BATTER, 2), spot(PITCHER, 1)]
    if status is None:
        status = [spot(BATTER, 2), spot(PITCHER, 1, "D60")]
    return {
        "statcast_pitches": pitches(spark, game() if rows is None else rows),
        "player_lookup": _frame(spark, players, PLAYER_LOOKUP),
        "mlb_teams": _frame(spark, teams, TEAMS),
        "mlb_rosters": _frame(spark, rosters, ROSTERS),
        "mlb_roster_status": _frame(spark, status, ROSTERS),
    }
