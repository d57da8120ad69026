"""Every query by name: ``(spark, sf_dir) -> DataFrame``.

The raw tables and the two facts are written once per application and folder, on the first request;
every report, profile, explore and rule reads those. Only the queries of the facts themselves build them
from the pitches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fungo.config import Config
from fungo.functions import labels
from fungo.functions.numeric import rounded
from fungo.functions.pitch import club_batting, club_pitching
from fungo.operators import rollups, staging
from fungo.operators.checks import stack
from fungo.operators.id_sets import distinct_counts
from fungo.operators.profile import coverage
from fungo.plans import explores, ingestion, profiles, quality, reports
from fungo.plans.stored import COUNTED, StoredFacts, StoredLayers, stored_sets
from fungo.plans.warehouse import FACTS, MARTS, Warehouse, register
from fungo.session import fresh_folder
from fungo.sources import landing, raw_zone

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register ``build`` under its own name; doubles are rounded to six places."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def _from_pitches(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(raw_zone.RawZone(spark, sf_dir))


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(raw_zone.RawZone(spark, sf_dir), StoredFacts(spark, sf_dir), guarded=True)


def _layers(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Everything stored: for rules and profiles, which look at tables that others have built."""
    return _warehouse(spark, sf_dir).with_stored(StoredLayers(spark, sf_dir))


def _table(name: str) -> None:
    source = _from_pitches if name in FACTS else _warehouse

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return source(spark, sf_dir).table(name)

    run.__name__ = _QUERY_NAMES.get(name, name)
    query(run)


_QUERY_NAMES = {
    "stg_statcast_pitches": "stg_pitches",
    "stg_mlb_teams": "stg_teams",
    "stg_mlb_rosters": "stg_rosters",
    "stg_mlb_roster_status": "stg_roster_status",
    "mart_batter_game_stats": "mart_batter_game",
    "mart_pitcher_game_stats": "mart_pitcher_game",
    "rpt_league_batting_kpis": "rpt_league_batting",
    "rpt_league_pitching_kpis": "rpt_league_pitching",
}
for _name in (
    *_QUERY_NAMES,
    "dim_team",
    "dim_roster_status",
    "rpt_batter_game",
    "rpt_batter_season",
    "rpt_pitcher_season",
    "rpt_pitcher_pitch_mix",
):
    _table(_name)


# scans, sources, sinks


@query
def src_parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_zone.RawZone(spark, sf_dir)["statcast_pitches"]


@query
def preview_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A preview takes any rows; ordered within one month so that it can be compared."""
    key = ("game_pk", "at_bat_number", "pitch_number")
    month = landing.in_date_range(
        raw_zone.landed_pitches(spark, sf_dir), *ingestion.PREVIEWED_DATES
    )
    columns = (*key, "batter", "pitcher", "pitch_type", "events")
    return profiles.preview(month.orderBy(*key), 5, columns)


@query
def date_range_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = landing.in_date_range(
        raw_zone.landed_pitches(spark, sf_dir), *ingestion.SELECTED_DATES
    )
    return staging.stage_pitches(chosen).select(
        "game_id", "at_bat_number", "pitch_number", "game_date", "batter_id", "pitcher_id"
    )


@query
def date_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pitches = _warehouse(spark, sf_dir).stg_statcast_pitches
    return profiles.date_chunks(pitches, Config().chunk_size_days)


for _build in (
    ingestion.chunk_union,
    ingestion.ingest_append_vs_refresh,
    ingestion.ingest_reference_refresh,
    ingestion.ingest_partitioned_landing,
    ingestion.ingest_row_audit,
    ingestion.ingest_merge,
    ingestion.ingest_merge_audit,
    ingestion.ingest_schema_drift,
    ingestion.ingest_incremental_files,
    ingestion.ingest_refresh_deletions,
    ingestion.ingest_refresh_season,
    ingestion.registry_shard_scan,
    ingestion.registry_shape,
    ingestion.registry_id_coerce,
    ingestion.teams_json_flatten,
    ingestion.teams_json_delivered,
    ingestion.rosters_json_flatten,
):
    query(_build)


@query
def batter_stints_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season lines of a range of dates; the stored fact is read in the folders of its months only."""
    games = StoredFacts(spark, sf_dir, ingestion.SELECTED_DATES)["mart_batter_game_stats"]
    return rollups.batter_stints(games)


# reports from season totals that were kept up date by date


@query
def incremental_batter_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _warehouse(spark, sf_dir)
    lines = ingestion.late_files(spark, sf_dir).batter_totals.lines()
    return reports.batter_season_of(
        lines, warehouse.player_lookup, warehouse.dim_team, warehouse.dim_roster_status
    )


@query
def incremental_pitcher_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _warehouse(spark, sf_dir)
    lines = ingestion.late_files(spark, sf_dir).pitcher_totals.lines()
    return reports.pitcher_season_of(lines, warehouse.dim_team, warehouse.dim_roster_status)


@query
def incremental_pitch_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _warehouse(spark, sf_dir)
    mix = rollups.mix_of_totals(ingestion.late_files(spark, sf_dir).pitcher_totals.sums())
    return reports.pitch_mix_of(mix, warehouse.dim_team, warehouse.dim_roster_status)


@query
def incremental_season_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.combined_batting(ingestion.late_files(spark, sf_dir).batter_totals.lines())


@query
def incremental_league_batting(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = ingestion.late_files(spark, sf_dir).batter_totals.sums()
    return rollups.league_of_totals(sums, rollups.BATTER_STINTS, rollups.LEAGUE_BATTING)


@query
def incremental_league_pitching(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = ingestion.late_files(spark, sf_dir).pitcher_totals.sums()
    return rollups.league_of_totals(sums, rollups.PITCHER_STINTS, rollups.LEAGUE_PITCHING)


@query
def incremental_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_counts(spark.read.parquet(ingestion.late_files(spark, sf_dir).sets), COUNTED)


@query
def distinct_counts_by_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different players and games by day, month and season, from the stored sets."""
    return distinct_counts(stored_sets(spark, sf_dir), COUNTED)


@query
def mart_materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = register(spark, _warehouse(spark, sf_dir), fresh_folder(spark, "layers"))
    checked = {
        "mart_batter_game_stats": ("batter_id * game_id + total_pitches", "batter_team", "batter_side"),
        "mart_pitcher_game_stats": (
            "pitcher_id * game_id + total_pitches", "pitching_team", "pitcher_name",
        ),
        "dim_team": ("team_id", "team_abbrev", "team_name"),
        "dim_roster_status": ("mlbam_id", "player_full_name", "availability"),
    }

    def content(name: str) -> DataFrame:
        numbers, *texts = checked[name]
        letters = F.length(texts[0]) + F.length(texts[1])
        measures = {
            "n_rows": F.count(F.lit(1)),
            "numbers": F.sum(F.expr(numbers)),
            "letters": F.sum(letters.cast("bigint")),
        }
        return coverage(built.table(name), "table_name", f"marts.{name}", measures)

    return stack([content(name) for name in MARTS])


@query
def sql_over_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the stored layers, each by its database name, in a session that did not build them."""
    folder = fresh_folder(spark, "layers")
    register(spark, _warehouse(spark, sf_dir), folder, saved=("staging", "reporting"))
    return spark.newSession().sql(
        """select t.division_name, count(distinct b.batter_id) as batters,
            sum(b.home_runs) as home_runs, max(s.games) as most_games
        from marts.mart_batter_game_stats b
        join staging.stg_mlb_teams t on t.team_abbrev = b.batter_team
        join reporting.rpt_batter_season s
            on s.batter_id = b.batter_id and s.batter_team = b.batter_team
        group by t.division_name"""
    )


# staging operators


@query
def team_of_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = ("inning_topbot", "home_team", "away_team")
    return (
        raw_zone.landed_pitches(spark, sf_dir)
        .groupBy(
            *half,
            club_batting(*half).alias("batter_team"),
            club_pitching(*half).alias("pitching_team"),
        )
        .agg(F.count(F.lit(1)).alias("pitches"))
    )


@query
def safe_cast_launch_angle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _warehouse(spark, sf_dir)
        .stg_statcast_pitches.groupBy("launch_angle_deg")
        .agg(F.count(F.lit(1)).alias("pitches"))
    )


@query
def status_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.label_status(raw_zone.RawZone(spark, sf_dir)["mlb_roster_status"])


@query
def batter_display_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    players = raw_zone.RawZone(spark, sf_dir)["player_lookup"]
    name = labels.full_name(F.col("first_name"), F.col("last_name"))
    return players.select("mlbam_id", name.alias("display_name"))


# reports


@query
def pitch_mix_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = _warehouse(spark, sf_dir).mart_pitcher_game_stats
    return rollups.mix_long(games, "pitcher_id", "game_id", "pitching_team", "total_pitches")


@query
def leaderboard_batters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.qualified_hitters(_warehouse(spark, sf_dir).rpt_batter_season)


@query
def leaderboard_pitchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.whiff_leaders(_warehouse(spark, sf_dir).rpt_pitcher_season)


@query
def contact_quality_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.contact_quality(_warehouse(spark, sf_dir).rpt_batter_season)


@query
def season_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = _warehouse(spark, sf_dir).mart_batter_game_stats
    return rollups.combined_batting(rollups.batter_stints(games))


@query
def season_combined_pitching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.combined_pitching(_warehouse(spark, sf_dir).mart_pitcher_game_stats)


@query
def weighted_mean_drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.league_batting_measured(_warehouse(spark, sf_dir).mart_batter_game_stats)


# semantic layer


def _batting(spark: SparkSession, sf_dir: str):
    warehouse = _warehouse(spark, sf_dir)
    return explores.batting(warehouse.mart_batter_game_stats, warehouse.player_lookup)


def _pitching(spark: SparkSession, sf_dir: str):
    warehouse = _warehouse(spark, sf_dir)
    return explores.pitching(warehouse.mart_pitcher_game_stats, warehouse.player_lookup)


@query
def sem_batting_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batting(spark, sf_dir).summarize(["game_month"])


@query
def sem_pitching_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pitching(spark, sf_dir).summarize(["game_month"])


@query
def sem_batting_explore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batting(spark, sf_dir).rows(
        ["pk", "batter_id", "game_date", "avg_exit_velocity_mph", "max_exit_velocity_mph",
         "hard_hit_rate_row"],
        ["first_name", "last_name", "full_name"],
    )


@query
def sem_pitching_explore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pitching(spark, sf_dir).rows(
        ["pk", "pitcher_id", "game_date", "avg_pitch_velocity_mph", "hard_hit_allowed_rate_row"],
        ["first_name", "last_name", "full_name"],
    )


@query
def sem_batting_by_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batting(spark, sf_dir).summarize(
        ["full_name"], ["game_count", "total_hits", "total_at_bats", "batting_average"]
    )


@query
def sem_fact_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batting(spark, sf_dir).rows(["pk", "batter_id", "game_id"])


@query
def sem_time_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    grains = [f"game_{grain}" for grain in ("date", "week", "month", "quarter", "year")]
    return _batting(spark, sf_dir).summarize(grains, ["game_count", "total_plate_appearances"])


@query
def sem_player_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explores.player_dimension(raw_zone.RawZone(spark, sf_dir)["player_lookup"])


@query
def sem_player_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explores.player_count(raw_zone.RawZone(spark, sf_dir)["player_lookup"])


@query
def sem_metric_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _warehouse(spark, sf_dir)
    return explores.hard_hit_tiers(
        warehouse.mart_batter_game_stats, warehouse.mart_pitcher_game_stats
    )


@query
def sem_fanout_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by player name over a registry that lists every player twice."""
    warehouse = _warehouse(spark, sf_dir)
    doubled = warehouse.player_lookup.unionAll(warehouse.player_lookup)
    explore = explores.batting(warehouse.mart_batter_game_stats, doubled)
    measures = ["game_count", "total_hits", "avg_xwoba"]
    return explore.summarize(["batter_id", "full_name"], measures, rounded=False)


# profiles


@query
def profile_raw_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.raw_summary(raw_zone.landed_pitches(spark, sf_dir))


@query
def profile_raw_pitch_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.raw_pitch_types(raw_zone.landed_pitches(spark, sf_dir))


def _pitch_profile(name: str, profile: Callable[[DataFrame], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return profile(_warehouse(spark, sf_dir).stg_statcast_pitches)

    run.__name__ = name
    query(run)


_pitch_profile("profile_staging_summary", profiles.staging_summary)
_pitch_profile("profile_outcome_distribution", profiles.outcome_distribution)
_pitch_profile("profile_numeric", profiles.numeric_columns)
_pitch_profile("profile_pitch_types", profiles.pitch_types)
_pitch_profile("profile_null_rates", profiles.null_rate_columns)
_pitch_profile("profile_pitches_by_date", profiles.pitches_by_date)


@query
def profile_date_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which a club had no game, between two on which it had."""
    return profiles.date_gaps(_warehouse(spark, sf_dir).mart_batter_game_stats, "batter_team")


@query
def profile_batter_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.batter_overview(_warehouse(spark, sf_dir).mart_batter_game_stats)


@query
def profile_pitcher_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.pitcher_overview(_warehouse(spark, sf_dir).mart_pitcher_game_stats)


@query
def top_batters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.top_batters(_warehouse(spark, sf_dir).mart_batter_game_stats)


@query
def top_pitchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.top_pitchers(_warehouse(spark, sf_dir).mart_pitcher_game_stats)


@query
def top_batters_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _warehouse(spark, sf_dir)
    return profiles.top_batters_named(warehouse.mart_batter_game_stats, warehouse.player_lookup)


@query
def top_pitchers_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _warehouse(spark, sf_dir)
    return profiles.top_pitchers_named(warehouse.mart_pitcher_game_stats, warehouse.player_lookup)


@query
def profile_pitch_mix_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.pitch_mix_top(_warehouse(spark, sf_dir).mart_pitcher_game_stats)


@query
def all_player_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _warehouse(spark, sf_dir)
    return profiles.all_player_ids(
        warehouse.mart_batter_game_stats, warehouse.mart_pitcher_game_stats, warehouse.player_lookup
    )


@query
def profile_team_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.team_coverage(_layers(spark, sf_dir))


@query
def profile_team_join_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _layers(spark, sf_dir)
    return profiles.team_join_integrity(warehouse.rpt_batter_season, warehouse.stg_mlb_rosters)


@query
def profile_unmatched_batters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.unmatched_batters(_layers(spark, sf_dir).rpt_batter_season)


@query
def profile_team_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.team_distribution(_layers(spark, sf_dir))


@query
def profile_team_distribution_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.team_distribution_range(_layers(spark, sf_dir))


@query
def profile_status_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.status_distribution(_layers(spark, sf_dir).dim_roster_status)


@query
def profile_status_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.status_attach(_layers(spark, sf_dir))


@query
def spot_name_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.name_like(_layers(spark, sf_dir).rpt_pitcher_season, "%p190%")


@query
def il60_without_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _layers(spark, sf_dir)
    return profiles.long_injured_without_stats(
        warehouse.dim_roster_status, warehouse.mart_batter_game_stats
    )


# data quality


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.required_columns(_layers(spark, sf_dir))


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique_columns(_layers(spark, sf_dir))


@query
def dq_join_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.join_keys(_layers(spark, sf_dir))


@query
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.closed_lists(_layers(spark, sf_dir))


@query
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.references(_layers(spark, sf_dir))


@query
def dq_batter_team_per_game(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.one_team_per_batter_game(_layers(spark, sf_dir).mart_batter_game_stats)


@query
def dq_pitcher_team_per_game(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.one_team_per_pitcher_game(_layers(spark, sf_dir).mart_pitcher_game_stats)


@query
def dq_composite_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.composite_grains(_layers(spark, sf_dir))


@query
def dq_batter_recoverable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.batter_recoverable(_layers(spark, sf_dir))


@query
def dq_pitcher_recoverable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.pitcher_recoverable(_layers(spark, sf_dir))


@query
def dq_traded_nonvacuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.traded_nonvacuous(_layers(spark, sf_dir))


@query
def dq_traded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.traded_counts(_layers(spark, sf_dir))


@query
def dq_grain_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.grain_guard(_layers(spark, sf_dir))


@query
def dq_full_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the suite, fused by table."""
    return quality.full_suite(_layers(spark, sf_dir))
