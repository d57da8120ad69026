"""The semantic layer: two fact explores and the player dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fungo.functions import labels
from fungo.functions.dates import TIME_GRAINS, time_grain
from fungo.functions.numeric import to_whole
from fungo.operators.measures import Explore, Measure, mean_of_games, ratio, rows_counted, total

PLAYER_NAMES = ("first_name", "last_name", "full_name", "given_name")


def player_dimension(players: DataFrame) -> DataFrame:
    """Player names, outside ids and career years, the float-coded numbers made whole."""
    return players.select(
        "mlbam_id",
        "first_name",
        "last_name",
        labels.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "given_name",
        "bbref_id",
        *(
            to_whole(F.col(name)).alias(name)
            for name in ("fangraphs_id", "mlb_debut_year", "mlb_last_year", "birth_year")
        ),
    )


def player_count(players: DataFrame) -> DataFrame:
    return players.agg(F.count_distinct("mlbam_id").alias("player_count"))


def _game_dimensions(player: str, *context: str) -> dict[str, Column]:
    key = labels.composite_key(F.col(player), F.col("game_id"))
    return {
        "pk": key,
        player: F.col(player),
        "game_id": F.col("game_id"),
        **{f"game_{grain}": time_grain(F.col("game_date"), grain) for grain in TIME_GRAINS},
        "season": F.col("game_year"),
        "home_team": F.col("home_team"),
        "away_team": F.col("away_team"),
        **{name: F.col(name) for name in context},
    }


def batting(games: DataFrame, players: DataFrame) -> Explore:
    """Batting per game."""
    return Explore(
        fact=games,
        player="batter_id",
        dimensions=_game_dimensions("batter_id", "batter_team", "batter_side"),
        details={
            "avg_exit_velocity_mph": Measure(F.col("avg_exit_velocity_mph"), 1),
            "max_exit_velocity_mph": Measure(F.col("max_exit_velocity_mph"), 1),
            "hard_hit_rate_row": Measure(F.col("hard_hit_rate"), 3),
        },
        measures={
            "game_count": rows_counted(),
            "total_plate_appearances": total("plate_appearances"),
            "total_at_bats": total("at_bats"),
            "total_hits": total("hits"),
            "total_home_runs": total("home_runs"),
            "total_strikeouts": total("strikeouts"),
            "total_walks": total("walks"),
            "total_batted_balls": total("batted_balls"),
            "total_hard_hit": total("hard_hit_count"),
            "total_barrels": total("barrel_count"),
            "avg_exit_velocity": mean_of_games("avg_exit_velocity_mph", 1),
            "avg_xwoba": mean_of_games("avg_xwoba", 3),
            "batting_average": ratio("hits", "at_bats", 3),
            "hard_hit_rate": ratio("hard_hit_count", "batted_balls", 3),
        },
        lookup=player_dimension(players),
        lookup_attributes=PLAYER_NAMES,
    )


def pitching(games: DataFrame, players: DataFrame) -> Explore:
    """Pitching per game."""
    return Explore(
        fact=games,
        player="pitcher_id",
        dimensions=_game_dimensions(
            "pitcher_id", "pitcher_name", "pitching_team", "pitcher_throws"
        ),
        details={
            "avg_pitch_velocity_mph": Measure(F.col("avg_pitch_velocity_mph"), 1),
            "hard_hit_allowed_rate_row": Measure(F.col("hard_hit_allowed_rate"), 3),
        },
        measures={
            "game_count": rows_counted(),
            "total_pitches": total("total_pitches"),
            "total_batters_faced": total("batters_faced"),
            "total_strikeouts": total("strikeouts"),
            "total_walks": total("walks"),
            "total_hits_allowed": total("hits_allowed"),
            "total_home_runs_allowed": total("home_runs_allowed"),
            "total_hard_hit_allowed": total("hard_hit_allowed_count"),
            "total_batted_balls_allowed": total("batted_balls_allowed"),
            "avg_pitch_velocity": mean_of_games("avg_pitch_velocity_mph", 1),
            "avg_spin_rate": mean_of_games("avg_spin_rate_rpm", 0),
            "k_per_bb": ratio("strikeouts", "walks", 2),
            "strikeout_rate": ratio("strikeouts", "batters_faced", 3),
            "hard_hit_allowed_rate": ratio("hard_hit_allowed_count", "batted_balls_allowed", 3),
        },
        lookup=player_dimension(players),
        lookup_attributes=PLAYER_NAMES,
    )


def hard_hit_tiers(batter_games: DataFrame, pitcher_games: DataFrame) -> DataFrame:
    """Tier of each player's hard-hit rate; for a pitcher a low rate is good."""

    def tiered(games: DataFrame, role: str, player: str, part: str, whole: str, bounds, low) -> DataFrame:
        rate = games.groupBy(F.col(player).alias("player_id")).agg(
            ratio(part, whole, 3).value.alias("rate")
        )
        return rate.select(
            F.lit(role).alias("role"),
            "player_id",
            "rate",
            labels.tier(F.col("rate"), bounds, lower_is_better=low).alias("tier"),
        )

    return tiered(
        batter_games, "batter", "batter_id", "hard_hit_count", "batted_balls",
        labels.BATTER_HARD_HIT_BOUNDS, False,
    ).unionAll(
        tiered(
            pitcher_games, "pitcher", "pitcher_id", "hard_hit_allowed_count",
            "batted_balls_allowed", labels.PITCHER_HARD_HIT_BOUNDS, True,
        )
    )
