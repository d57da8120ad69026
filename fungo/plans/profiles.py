"""Profiling queries over the layered tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fungo.functions import labels
from fungo.functions.dates import chunk_end, chunk_starts, ns_to_date
from fungo.functions.numeric import safe_divide
from fungo.functions.pitch import MIX_LABELS
from fungo.operators import attach
from fungo.operators.checks import stack
from fungo.operators.profile import coverage, null_rates, numeric_profile, shares
from fungo.plans.warehouse import Warehouse
from fungo.session import materialize

# Profiled pitch columns.
NUMERIC_COLUMNS = (
    "pitch_velocity_mph",
    "spin_rate_rpm",
    "exit_velocity_mph",
    "launch_angle_deg",
    "xba",
    "xwoba",
    "bat_speed",
    "swing_length",
)
NULL_RATE_COLUMNS = (
    "exit_velocity_mph",
    "launch_angle_deg",
    "xba",
    "xwoba",
    "xslg",
    "bat_speed",
    "swing_length",
    "spin_rate_rpm",
)


def _rows() -> Column:
    return F.count(F.lit(1))


def preview(table: DataFrame, n: int, columns: Sequence[str] = ("*",)) -> DataFrame:
    """``n`` rows, whichever come first."""
    return table.select(*columns).limit(n)


def _distinct(df: DataFrame, column: str) -> Column:
    """How many values a column has, as a scalar: one count apart from the others copies no rows."""
    return df.select(column).distinct().agg(F.count(column)).scalar()


def raw_summary(raw_pitches: DataFrame) -> DataFrame:
    """One scan of the pitches; the counts come from its written match-ups by day."""
    day = ns_to_date(F.col("game_date")).alias("day")
    matchups = materialize(
        raw_pitches.groupBy(day, "pitcher", "batter").agg(_rows().alias("n")), "match-ups"
    )
    return matchups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count_distinct("day").alias("distinct_game_dates"),
        F.min("day").alias("min_game_date"),
        F.max("day").alias("max_game_date"),
    ).select(
        "*",
        _distinct(matchups, "pitcher").alias("distinct_pitchers"),
        _distinct(matchups, "batter").alias("distinct_batters"),
    )


def raw_pitch_types(raw_pitches: DataFrame) -> DataFrame:
    return (
        raw_pitches.groupBy("pitch_type")
        .agg(_rows().alias("pitch_count"))
        .orderBy(F.desc("pitch_count"), F.asc_nulls_first("pitch_type"))
    )


def staging_summary(pitches: DataFrame) -> DataFrame:
    return pitches.agg(
        _rows().alias("total_rows"),
        F.count_if(F.col("pitch_type").isNull()).alias("null_pitch_type_rows"),
        F.count_if(F.col("game_date").isNull()).alias("null_game_date_rows"),
        F.min("game_date").alias("min_game_date"),
        F.max("game_date").alias("max_game_date"),
    )


def outcome_distribution(pitches: DataFrame) -> DataFrame:
    return shares(pitches, "pitch_outcome_category", "outcome_count", "outcome_pct").orderBy(
        F.desc("outcome_count"), "pitch_outcome_category"
    )


def numeric_columns(pitches: DataFrame) -> DataFrame:
    return numeric_profile(pitches, NUMERIC_COLUMNS).orderBy("column_name")


def pitch_types(pitches: DataFrame) -> DataFrame:
    return (
        pitches.groupBy("pitch_type", "pitch_name")
        .agg(
            _rows().alias("pitch_count"),
            F.avg("pitch_velocity_mph").alias("avg_pitch_velocity_mph"),
            F.avg("spin_rate_rpm").alias("avg_spin_rate_rpm"),
            F.avg("xba").alias("avg_xba"),
        )
        .orderBy(F.desc("pitch_count"), "pitch_type", "pitch_name")
    )


def batter_overview(games: DataFrame) -> DataFrame:
    return games.agg(
        _rows().alias("total_rows"),
        F.count_distinct("batter_id").alias("distinct_batters"),
        F.avg("hard_hit_rate").alias("avg_hard_hit_rate"),
        F.avg("barrel_rate").alias("avg_barrel_rate"),
        F.avg("avg_xwoba").alias("avg_avg_xwoba"),
        F.avg("avg_bat_speed").alias("avg_avg_bat_speed"),
    ).select("*", _distinct(games, "game_id").alias("distinct_games"))


def pitcher_overview(games: DataFrame) -> DataFrame:
    return games.agg(
        _rows().alias("total_rows"),
        F.count_distinct("pitcher_id").alias("distinct_pitchers"),
        F.avg("whiff_rate").alias("avg_whiff_rate"),
        F.avg("strike_pct").alias("avg_strike_pct"),
        F.avg("avg_pitch_velocity_mph").alias("avg_avg_pitch_velocity_mph"),
    ).select("*", _distinct(games, "game_id").alias("distinct_games"))


def top_batters(games: DataFrame, min_batted_balls: int = 5, top: int = 20) -> DataFrame:
    """Batters by mean of their per-game exit velocities."""
    return (
        games.groupBy("batter_id")
        .agg(
            _rows().alias("games"),
            F.sum("batted_balls").alias("total_batted_balls"),
            F.avg("avg_exit_velocity_mph").alias("avg_exit_velocity_mph"),
            F.avg("avg_xwoba").alias("avg_xwoba"),
            safe_divide(F.sum("hard_hit_count"), F.sum("batted_balls")).alias("avg_hard_hit_rate"),
            F.sum("home_runs").alias("total_home_runs"),
        )
        .where(F.col("total_batted_balls") >= min_batted_balls)
        .orderBy(F.desc("avg_exit_velocity_mph"), "batter_id")
        .limit(top)
    )


def top_pitchers(games: DataFrame, min_pitches: int = 50, top: int = 20) -> DataFrame:
    """Pitchers by whiff rate over all their games."""
    return (
        games.groupBy("pitcher_id", "pitcher_name")
        .agg(
            _rows().alias("games"),
            F.sum("total_pitches").alias("total_pitches"),
            F.avg("avg_pitch_velocity_mph").alias("avg_velocity"),
            safe_divide(F.sum("whiffs"), F.sum("swings")).alias("avg_whiff_rate"),
            safe_divide(F.sum("strikes"), F.sum("total_pitches")).alias("avg_strike_pct"),
            safe_divide(
                F.sum("hard_hit_allowed_count"), F.sum("batted_balls_allowed")
            ).alias("avg_hard_hit_allowed_rate"),
        )
        .where(F.col("total_pitches") >= min_pitches)
        .orderBy(F.desc("avg_whiff_rate"), "pitcher_id")
        .limit(top)
    )


def top_batters_named(games: DataFrame, players: DataFrame) -> DataFrame:
    named = attach.attach_name_parts(top_batters(games), players, "batter_id")
    return named.select(
        "name_first",
        "name_last",
        "batter_id",
        "games",
        "avg_exit_velocity_mph",
        "avg_xwoba",
        "avg_hard_hit_rate",
        "total_home_runs",
    ).orderBy(F.desc("avg_exit_velocity_mph"), "batter_id")


def top_pitchers_named(games: DataFrame, players: DataFrame) -> DataFrame:
    named = attach.attach_name_parts(top_pitchers(games), players, "pitcher_id")
    return named.select(
        "name_first",
        "name_last",
        "pitcher_id",
        "games",
        "total_pitches",
        "avg_velocity",
        "avg_whiff_rate",
        "avg_hard_hit_allowed_rate",
    ).orderBy(F.desc("avg_whiff_rate"), "pitcher_id")


def pitch_mix_top(games: DataFrame, min_pitches: int = 50, top: int = 20) -> DataFrame:
    """Mean of per-game shares for the busiest pitchers; not weighted, unlike the report."""
    shares_by_label = [f"pct_{label}" for label in MIX_LABELS]
    # By name first: the maximum of a text would have every game sorted.
    by_name = games.groupBy("pitcher_id", "pitcher_name").agg(
        F.sum("total_pitches").alias("pitches"),
        *(F.sum(name).alias(f"sum_{name}") for name in shares_by_label),
        *(F.count(name).alias(f"n_{name}") for name in shares_by_label),
    )
    return (
        by_name.groupBy("pitcher_id")
        .agg(
            F.max("pitcher_name").alias("pitcher_name"),
            F.sum("pitches").alias("total_pitches"),
            *(
                safe_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}")).alias(name)
                for name in shares_by_label
            ),
        )
        .where(F.col("total_pitches") >= min_pitches)
        .orderBy(F.desc("total_pitches"), "pitcher_id")
        .select("pitcher_name", "total_pitches", *shares_by_label)
        .limit(top)
    )


def all_player_ids(batter_games: DataFrame, pitcher_games: DataFrame, players: DataFrame) -> DataFrame:
    """Every player of either fact once, with the registry's names where it has the player."""
    ids = (
        batter_games.select(F.col("batter_id").alias("player_id"))
        .unionAll(pitcher_games.select(F.col("pitcher_id").alias("player_id")))
        .where(F.col("player_id").isNotNull())
        .distinct()
    )
    return attach.attach_name_parts(ids, players, "player_id")


def null_rate_columns(pitches: DataFrame) -> DataFrame:
    return null_rates(pitches, NULL_RATE_COLUMNS).orderBy(F.desc("null_pct"), "column_name")


def pitches_by_date(pitches: DataFrame) -> DataFrame:
    return pitches.groupBy("game_date").agg(_rows().alias("pitch_count")).orderBy("game_date")


def date_gaps(games: DataFrame, *keys: str) -> DataFrame:
    """Stretches of days without a game between two days with one, for each of ``keys``.

    Days are made distinct before they are ordered, so a window holds the days of a calendar.
    """
    days = games.where(F.col("game_date").isNotNull()).select(*keys, "game_date").distinct()
    following = F.lead("game_date").over(Window.partitionBy(*keys).orderBy("game_date"))
    gaps = days.withColumn("next_date", following).withColumn(
        "days_between", F.datediff("next_date", "game_date").cast("bigint") - 1
    )
    return gaps.where(F.col("days_between") > 0).select(
        *keys, F.col("game_date").alias("last_date"), "next_date", "days_between"
    )


def team_coverage(warehouse: Warehouse) -> DataFrame:
    matched = F.count_if(F.col("team_id").isNotNull())
    measures = {
        "total_players": _rows(),
        "with_team": matched,
        "match_rate": safe_divide(matched, _rows()),
    }
    return stack(
        [
            coverage(warehouse.rpt_batter_season, "role", "batter", measures),
            coverage(warehouse.rpt_pitcher_season, "role", "pitcher", measures),
        ]
    )


def team_join_integrity(batter_season: DataFrame, rosters: DataFrame) -> DataFrame:
    """Batters without a club who nevertheless stand on a roster: must be none."""
    listed = rosters.select(F.col("mlbam_id").alias("rostered_player"))
    joined = batter_season.join(
        listed, batter_season["batter_id"] == listed["rostered_player"], "left"
    )
    clubless = F.col("team_id").isNull()
    return joined.agg(
        F.count_if(clubless & F.col("rostered_player").isNotNull()).alias("null_team_but_on_40man"),
        F.count_if(clubless).alias("null_team_total"),
    )


def unmatched_batters(batter_season: DataFrame, top: int = 10) -> DataFrame:
    return (
        batter_season.where(F.col("team_id").isNull())
        .orderBy(F.desc("games"), "batter_id", "batter_team")
        .select("batter_id", "batter_name", "games", "plate_appearances")
        .limit(top)
    )


def team_distribution(warehouse: Warehouse) -> DataFrame:
    """Players with statistics per club."""

    def per_team(season: DataFrame, name: str) -> DataFrame:
        known = season.where(F.col("team_id").isNotNull())
        return known.groupBy("team_id").agg(_rows().alias(name))

    joined = (
        warehouse.dim_team.select("team_id", "team_abbrev", "division_name")
        .join(per_team(warehouse.rpt_batter_season, "n_batters"), "team_id", "left")
        .join(per_team(warehouse.rpt_pitcher_season, "n_pitchers"), "team_id", "left")
    )
    batters = F.coalesce("n_batters", F.lit(0))
    pitchers = F.coalesce("n_pitchers", F.lit(0))
    return joined.select(
        "team_abbrev",
        "division_name",
        batters.alias("batters"),
        pitchers.alias("pitchers"),
        (batters + pitchers).alias("players"),
    ).orderBy(F.desc("players"), "team_abbrev")


def team_distribution_range(warehouse: Warehouse) -> DataFrame:
    """Fewest, median and most players per club; the median is cut to a whole number."""
    return team_distribution(warehouse).agg(
        F.min("players").alias("min_players"),
        F.floor(F.median("players")).alias("median_players"),
        F.max("players").alias("max_players"),
    )


def status_distribution(status: DataFrame) -> DataFrame:
    return shares(status, "availability", "players", "pct").orderBy(
        F.desc("players"), "availability"
    )


def status_attach(warehouse: Warehouse) -> DataFrame:
    measures = {
        "n_rows": _rows(),
        "with_availability": F.count("availability"),
        "with_status_desc": F.count("status_description"),
    }
    names = ("rpt_batter_season", "rpt_pitcher_season", "rpt_batter_game", "rpt_pitcher_pitch_mix")
    return stack(
        [coverage(warehouse.table(name), "model", name, measures) for name in names]
    )


def name_like(pitcher_season: DataFrame, pattern: str) -> DataFrame:
    return (
        pitcher_season.where(F.lower("pitcher_name").like(pattern))
        .orderBy(F.desc("games"), "pitcher_name", "team_abbrev")
        .select("pitcher_name", "team_abbrev", "games", "availability", "status_description")
    )


def long_injured_without_stats(status: DataFrame, batter_games: DataFrame, top: int = 10) -> DataFrame:
    """Players on the 60-day list who have no batting line.

    The line exists exactly when the batter has a game, so the anti-join reads the fact table
    and skips the season roll-up.
    """
    listed = status.where(F.col("availability") == labels.AVAILABILITY["D60"])
    played = batter_games.select(F.col("batter_id").alias("mlbam_id")).distinct()
    return (
        listed.join(played, "mlbam_id", "left_anti")
        .orderBy("player_full_name", "mlbam_id")
        .select("player_full_name", "team_abbrev", "availability")
        .limit(top)
    )


def date_chunks(pitches: DataFrame, days: int) -> DataFrame:
    """The stored date range cut into ``days``-long chunks, with the pitches of each.

    Pitches are counted per date in one scan and the few counts written down. The range and
    the chunk of a date, found by arithmetic, both come from them.
    """
    per_date = materialize(
        pitches.groupBy("game_date").agg(_rows().alias("n")), "pitches-per-date"
    )
    span = per_date.agg(F.min("game_date").alias("first"), F.max("game_date").alias("last"))
    chunks = span.select(
        "last", F.explode(chunk_starts(F.col("first"), F.col("last"), days)).alias("chunk_start")
    ).select("chunk_start", chunk_end(F.col("chunk_start"), F.col("last"), days).alias("chunk_end"))
    first = span.select("first").scalar()
    offset = F.floor(F.datediff("game_date", first) / F.lit(days)).cast("int") * days
    filled = per_date.groupBy(F.date_add(first, offset).alias("chunk_start")).agg(
        F.sum("n").alias("n")
    )
    return chunks.join(filled, "chunk_start", "left").select(
        "chunk_start", "chunk_end", F.coalesce("n", F.lit(0)).alias("pitches")
    )
