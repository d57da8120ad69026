"""The comparison query of every registered query."""

from __future__ import annotations

from fungo.oracle import values
from fungo.oracle.tables import BATTER_RATES, BATTER_TOTALS, DAY, PITCHER_RATES, PITCHER_TOTALS
from fungo.oracle.tables import listed, mean, ratio, with_tables
from fungo.oracle.values import (
    BATTER_GAME_COLUMNS,
    MIX_LABELS,
    NULL_RATE_COLUMNS,
    NUMERIC_COLUMNS,
    PITCH_COLUMNS,
    PITCHER_GAME_COLUMNS,
)

_TEAM_STATUS = (
    "team_id, team_abbrev, team_name, league_name, division_name, availability,"
    " status_description"
)
_BATTER_DOUBLES = (
    "whiff_rate avg_exit_velocity_mph max_exit_velocity_mph avg_launch_angle_deg hard_hit_rate"
    " barrel_rate avg_xba avg_xwoba avg_xslg avg_bat_speed avg_swing_length"
)
_PITCHER_DOUBLES = (
    "avg_pitch_velocity_mph max_pitch_velocity_mph avg_spin_rate_rpm avg_extension_ft strike_pct"
    " whiff_rate avg_exit_velocity_allowed avg_launch_angle_allowed hard_hit_allowed_rate"
    " avg_xba_against avg_xwoba_against " + " ".join(f"pct_{label}" for label in MIX_LABELS)
)
_BATTER_SEASON_DOUBLES = (
    "hard_hit_rate barrel_rate avg_exit_velocity max_exit_velocity avg_launch_angle xwoba xba xslg"
)
_PITCHER_SEASON_DOUBLES = (
    "whiff_rate strike_pct avg_velocity max_velocity avg_spin_rate avg_extension"
)
_RAW_PITCH_DOUBLES = " ".join(raw for raw, _, kind in PITCH_COLUMNS if kind == "double")
_PITCH_DOUBLES = " ".join(
    staged
    for _, staged, kind in PITCH_COLUMNS
    if kind == "double" or staged == "launch_angle_deg"
)


def _out(sql: str, doubles: str = "") -> str:
    """Round the named double columns and add the tables the text needs."""
    if doubles:
        changed = ", ".join(f"round(round({name}, 10), 6) as {name}" for name in doubles.split())
        sql = f"select * replace ({changed}) from ({sql})"
    return with_tables(sql)


TEXTS: dict[str, str] = {}

# staging

TEXTS["stg_pitches"] = _out("select * from pitches", _PITCH_DOUBLES)
TEXTS["stg_teams"] = _out("select * from raw_teams")
TEXTS["dim_team"] = TEXTS["stg_teams"]
TEXTS["stg_rosters"] = _out("select * from rosters")
TEXTS["stg_roster_status"] = _out("select * from status")
TEXTS["status_availability"] = _out("select * from status_labelled")
TEXTS["dim_roster_status"] = _out("select * from status_dim")
TEXTS["team_of_record"] = _out(
    """select inning_half as inning_topbot, home_team, away_team, batter_team, pitching_team,
        count(*) as pitches
    from (
        select inning_topbot as inning_half, home_team, away_team,
            if(inning_topbot = 'Top', away_team, home_team) as batter_team,
            if(inning_topbot = 'Top', home_team, away_team) as pitching_team
        from raw_pitches
    ) group by all"""
)
TEXTS["safe_cast_launch_angle"] = _out(
    "select launch_angle_deg, count(*) as pitches from pitches group by 1", "launch_angle_deg"
)
TEXTS["batter_display_name"] = _out("select mlbam_id, display_name from named")

# facts and reports

TEXTS["mart_batter_game"] = _out(
    f"select {', '.join(BATTER_GAME_COLUMNS)} from batter_games", _BATTER_DOUBLES
)
TEXTS["mart_pitcher_game"] = _out(
    f"select {', '.join(PITCHER_GAME_COLUMNS)} from pitcher_games", _PITCHER_DOUBLES
)
TEXTS["rpt_batter_game"] = _out(
    "select * from batter_log",
    "avg_exit_velocity_mph max_exit_velocity_mph avg_launch_angle_deg hard_hit_rate barrel_rate"
    " avg_xba avg_xwoba avg_xslg",
)
TEXTS["rpt_batter_season"] = _out("select * from batter_season", _BATTER_SEASON_DOUBLES)
TEXTS["rpt_pitcher_season"] = _out("select * from pitcher_season", _PITCHER_SEASON_DOUBLES)
TEXTS["rpt_pitcher_pitch_mix"] = _out("select * from mix", "pitch_pct")
TEXTS["pitch_mix_unpivot"] = _out("select * exclude (pitcher_name) from mix_long", "pct")
TEXTS["rpt_league_batting"] = _out(
    f"""select {mean('avg_exit_velocity_mph', 'batted_balls', 'league_avg_exit_velocity')},
        {mean('avg_xwoba', 'plate_appearances', 'league_avg_xwoba')},
        {ratio('hard_hit_count', 'batted_balls', 'league_hard_hit_rate')}
    from batter_games""",
    "league_avg_exit_velocity league_avg_xwoba league_hard_hit_rate",
)
TEXTS["rpt_league_pitching"] = _out(
    f"""select {mean('avg_pitch_velocity_mph', 'total_pitches', 'league_avg_velocity')},
        {ratio('whiffs', 'swings', 'league_avg_whiff_rate')},
        {ratio('strikes', 'total_pitches', 'league_avg_strike_pct')}
    from pitcher_games""",
    "league_avg_velocity league_avg_whiff_rate league_avg_strike_pct",
)
TEXTS["weighted_mean_drop_nulls"] = _out(
    """select
        sum(avg_exit_velocity_mph * batted_balls)
            / nullif(sum(batted_balls) filter (avg_exit_velocity_mph is not null), 0)
            as measured_avg_exit_velocity,
        sum(avg_xwoba * plate_appearances)
            / nullif(sum(plate_appearances) filter (avg_xwoba is not null), 0)
            as measured_avg_xwoba
    from batter_games""",
    "measured_avg_exit_velocity measured_avg_xwoba",
)
TEXTS["leaderboard_batters"] = _out(
    """select batter_id, batter_name, batter_team, plate_appearances, batted_balls,
        avg_exit_velocity, hard_hit_rate, barrel_rate, xwoba
    from batter_season where batted_balls >= 50""",
    "avg_exit_velocity hard_hit_rate barrel_rate xwoba",
)
TEXTS["leaderboard_pitchers"] = _out(
    """select pitcher_id, pitcher_name, pitching_team, total_pitches, whiff_rate, strike_pct,
        avg_velocity
    from pitcher_season where total_pitches >= 250""",
    "whiff_rate strike_pct avg_velocity",
)
_best, _fair = values.XWOBA_BOUNDS
TEXTS["contact_quality_scatter"] = _out(
    f"""select batter_id, batter_name, batter_team, avg_exit_velocity, avg_launch_angle,
        batted_balls, xwoba,
        if(xwoba >= {_best}, 'high', if(xwoba >= {_fair}, 'mid', 'low')) as xwoba_tier
    from batter_season where batted_balls > 0""",
    "avg_exit_velocity avg_launch_angle xwoba",
)
TEXTS["season_combined"] = _out(
    f"""select batter_id, count(*) as stints, cast(sum(games) as bigint) as games,
        {BATTER_TOTALS},
        {mean('hard_hit_rate', 'batted_balls', 'hard_hit_rate')},
        {mean('barrel_rate', 'batted_balls', 'barrel_rate')},
        {mean('avg_exit_velocity', 'batted_balls', 'avg_exit_velocity')},
        max(max_exit_velocity) as max_exit_velocity,
        {mean('avg_launch_angle', 'batted_balls', 'avg_launch_angle')},
        {mean('xwoba', 'plate_appearances', 'xwoba')},
        {mean('xba', 'at_bats', 'xba')},
        {mean('xslg', 'at_bats', 'xslg')}
    from batter_stints group by batter_id""",
    _BATTER_SEASON_DOUBLES,
)
TEXTS["season_combined_pitching"] = _out(
    f"""select pitcher_id, count(distinct pitching_team) as stints,
        count(distinct game_id) as games, {PITCHER_TOTALS}, {PITCHER_RATES}
    from pitcher_games group by pitcher_id""",
    _PITCHER_SEASON_DOUBLES,
)

# ingestion

TEXTS["src_parquet_scan"] = _out(
    "select * from raw_pitches", _RAW_PITCH_DOUBLES
)
TEXTS["preview_table"] = _out(
    f"""select game_pk, at_bat_number, pitch_number, batter, pitcher, pitch_type, events
    from raw_pitches where {DAY} between date '{values.PREVIEWED_DATES[0]}'
        and date '{values.PREVIEWED_DATES[1]}'
    order by game_pk, at_bat_number, pitch_number limit 5"""
)
_first, _last = (f"date '{day}'" for day in values.SELECTED_DATES)
TEXTS["date_range_select"] = _out(
    f"""select game_id, at_bat_number, pitch_number, game_date, batter_id, pitcher_id
    from pitches where game_date between {_first} and {_last}"""
)
_days = values.CHUNK_DAYS
TEXTS["date_chunks"] = _out(
    f"""select chunk_start, least(chunk_start + {_days - 1}, last_day) as chunk_end,
        count(game_date) as pitches
    from (
        select last_day, cast(unnest(generate_series(
            cast(first_day as timestamp), cast(last_day as timestamp),
            interval {_days} day)) as date) as chunk_start
        from (select min(game_date) as first_day, max(game_date) as last_day from pitches)
    ) left join pitches
        on game_date between chunk_start and least(chunk_start + {_days - 1}, last_day)
    group by all"""
)
TEXTS["chunk_union"] = _out(
    "select * from raw_pitches", _RAW_PITCH_DOUBLES
)
_until = f"date '{values.FIRST_BATCH_UNTIL}'"
TEXTS["ingest_append_vs_refresh"] = _out(
    f"""select mode, game_date, sum(copies)::bigint as n_rows,
        sum(copies * (batter * pitch_number + pitcher))::bigint as numbers,
        sum(copies * (length(home_team) + length(pitch_type)))::bigint as letters
    from (select {DAY} as game_date, * exclude (game_date) from raw_pitches),
        (values ('append', 2, 1), ('append-once', 1, 1), ('full-refresh', 1, 0))
            as loads(mode, late_copies, early_copies),
        lateral (select if(game_date > {_until}, late_copies, early_copies) as copies)
    where copies > 0 group by all"""
)
TEXTS["ingest_reference_refresh"] = TEXTS["stg_teams"]
TEXTS["ingest_partitioned_landing"] = _out(
    f"""select year({DAY}) as year, month({DAY}) as month, count(*) as n_rows,
        count(distinct game_pk) as games
    from raw_pitches group by all"""
)
TEXTS["ingest_row_audit"] = _out(
    f"""select cast(load as bigint) as load, 'append' as mode, n as rows_extracted, n as rows_loaded
    from (
        select 1 as load, count(*) as n from raw_pitches where {DAY} <= {_until}
        union all select 2, 0
        union all select 3, count(*) from raw_pitches where {DAY} > {_until}
    )"""
)
TEXTS["ingest_incremental_files"] = TEXTS["mart_batter_game"]
for _incremental, _full in (
    ("batter_season", "rpt_batter_season"),
    ("pitcher_season", "rpt_pitcher_season"),
    ("pitch_mix", "rpt_pitcher_pitch_mix"),
    ("season_combined", "season_combined"),
    ("league_batting", "rpt_league_batting"),
    ("league_pitching", "rpt_league_pitching"),
):
    TEXTS[f"incremental_{_incremental}"] = TEXTS[_full]
_COUNTED = """(
    select game_date, 'batters' as counted, batter_id as id from batter_games
    union all select game_date, 'pitchers', pitcher_id from pitcher_games
    union all select game_date, 'players', batter_id from batter_games
    union all select game_date, 'players', pitcher_id from pitcher_games
    union all select game_date, 'games', game_id from batter_games
    union all select game_date, 'games', game_id from pitcher_games)"""
TEXTS["distinct_counts_by_grain"] = _out(
    " union all ".join(
        f"select '{grain}' as grain, {start} as starts_on, counted, count(distinct id) as n from {_COUNTED} group by all"
        for grain, start in (
            ("day", "game_date"),
            ("month", "cast(date_trunc('month', game_date) as date)"),
            ("season", "cast(null as date)"),
        )
    )
)
TEXTS["incremental_distinct_counts"] = TEXTS["distinct_counts_by_grain"]
TEXTS["ingest_refresh_deletions"] = _out(
    f"""select {', '.join(BATTER_GAME_COLUMNS)} from batter_games
    where game_date <= date '2026-04-30' and game_date <> date '2026-04-15'""",
    _BATTER_DOUBLES,
)
TEXTS["batter_stints_in_range"] = _out(
    f"""select batter_id, batter_team, count(distinct game_id) as games, {BATTER_TOTALS}, {BATTER_RATES}
    from batter_games where game_date between {_first} and {_last} group by batter_id, batter_team""",
    _BATTER_SEASON_DOUBLES,
)
TEXTS["ingest_refresh_season"] = _out(
    f"""select batter_id, batter_team, count(distinct game_id) as games, {BATTER_TOTALS}, {BATTER_RATES}
    from batter_games where game_date between date '2026-04-09' and date '2026-04-30'
    group by batter_id, batter_team""",
    _BATTER_SEASON_DOUBLES,
)
TEXTS["ingest_merge"] = _out(
    f"""select 'merge' as mode, {DAY} as game_date, count(*) as n_rows,
        sum(batter * pitch_number + pitcher)::bigint as numbers,
        sum(length(home_team) + length(pitch_type))::bigint as letters
    from raw_pitches where month({DAY}) between 4 and 6 group by all"""
)
TEXTS["ingest_merge_audit"] = _out(
    f"""select load::bigint as load, mode, sum(taken)::bigint as rows_extracted,
        sum(gained)::bigint as rows_loaded
    from (select month({DAY}) as month from raw_pitches) as landed,
        (values (1, 'append', 4, 1, 1), (1, 'append', 5, 1, 1), (2, 'merge', 5, 1, 0),
            (2, 'merge', 6, 1, 1), (3, 'merge', 5, 1, 0), (3, 'merge', 6, 1, 0))
            as loads(load, mode, of_month, taken, gained)
    where month = of_month group by all"""
)
TEXTS["ingest_schema_drift"] = _out(
    f"""select month({DAY}) as month,
        case month({DAY}) when 4 then cast(pitch_number as varchar)
            when 5 then cast(pitch_number / 2.0::double as varchar) when 6 then home_team end as extra,
        count(*) as n_rows
    from raw_pitches where month({DAY}) between 4 and 7 group by all"""
)
_PERSON = """printf('%.1f', fangraphs_id) as key_fangraphs, bbref_id as key_bbref,
    last_name as name_last, first_name as name_first, given_name as name_given,
    printf('%.1f', mlb_debut_year) as pro_played_first,
    printf('%.1f', mlb_last_year) as pro_played_last, printf('%.1f', birth_year) as birth_year"""
_REGISTRY = f"""
    select printf('%.1f', cast(mlbam_id as double)) as key_mlbam, {_PERSON} from raw_players
    union all
    select null, {_PERSON} from raw_players where mlbam_id % 3 = 0
    union all
    select 'unknown', {_PERSON} from raw_players where mlbam_id % 7 = 0"""
TEXTS["registry_shard_scan"] = _out(_REGISTRY)
TEXTS["registry_shape"] = _out(
    f"""select key_mlbam as mlbam_id, key_fangraphs as fangraphs_id, key_bbref as bbref_id,
        name_last as last_name, name_first as first_name, name_given as given_name,
        pro_played_first as mlb_debut_year, pro_played_last as mlb_last_year, birth_year
    from ({_REGISTRY}) where key_mlbam is not null"""
)
TEXTS["registry_id_coerce"] = _out(f"select {', '.join(values.PLAYER_COLUMNS)} from raw_players")
TEXTS["teams_json_flatten"] = _out(
    "select "
    + ", ".join(
        f"if(team_id % 2 = 0, {name}, null) as {name}" if name.startswith("division") else name
        for name in values.TEAM_COLUMNS
    )
    + " from raw_teams"
)
TEXTS["teams_json_delivered"] = _out(
    """select team_id, team_name, if(team_id % 3 = 0, null, league_id) as league_id, league_name,
        cast(null as varchar) as venue_name, team_id + 1800 as founded, location_name as city,
        if(team_id % 3 = 0, 'n/a', cast(league_id as varchar)) as delivered_league
    from raw_teams"""
)
TEXTS["rosters_json_flatten"] = _out(
    "select '40Man' as roster_type, * from raw_rosters"
    " union all select 'fullRoster', * from raw_status"
)
TEXTS["mart_materialize"] = _out(
    """select 'marts.mart_batter_game_stats' as table_name, count(*) as n_rows,
        cast(sum(batter_id * game_id + total_pitches) as bigint) as numbers,
        cast(sum(length(batter_team) + length(batter_side)) as bigint) as letters
    from batter_games
    union all select 'marts.mart_pitcher_game_stats', count(*),
        cast(sum(pitcher_id * game_id + total_pitches) as bigint),
        cast(sum(length(pitching_team) + length(pitcher_name)) as bigint)
    from pitcher_games
    union all select 'marts.dim_team', count(*), cast(sum(team_id) as bigint),
        cast(sum(length(team_abbrev) + length(team_name)) as bigint) from raw_teams
    union all select 'marts.dim_roster_status', count(*), cast(sum(mlbam_id) as bigint),
        cast(sum(length(player_full_name) + length(availability)) as bigint)
    from status_dim"""
)
TEXTS["sql_over_layers"] = _out(
    """select t.division_name, count(distinct b.batter_id) as batters,
        cast(sum(b.home_runs) as bigint) as home_runs, cast(max(s.games) as bigint) as most_games
    from batter_games b
    join raw_teams t on t.team_abbrev = b.batter_team
    join batter_season s on s.batter_id = b.batter_id and s.batter_team = b.batter_team
    group by 1"""
)

# semantic layer

_BATTING_MEASURES = """count(*) as game_count,
    cast(sum(plate_appearances) as bigint) as total_plate_appearances,
    cast(sum(at_bats) as bigint) as total_at_bats,
    cast(sum(hits) as bigint) as total_hits,
    cast(sum(home_runs) as bigint) as total_home_runs,
    cast(sum(strikeouts) as bigint) as total_strikeouts,
    cast(sum(walks) as bigint) as total_walks,
    cast(sum(batted_balls) as bigint) as total_batted_balls,
    cast(sum(hard_hit_count) as bigint) as total_hard_hit,
    cast(sum(barrel_count) as bigint) as total_barrels,
    round(avg(avg_exit_velocity_mph), 1) as avg_exit_velocity,
    round(avg(avg_xwoba), 3) as avg_xwoba,
    round(sum(hits) / nullif(sum(at_bats), 0), 3) as batting_average,
    round(sum(hard_hit_count) / nullif(sum(batted_balls), 0), 3) as hard_hit_rate"""
_PITCHING_MEASURES = """count(*) as game_count,
    cast(sum(total_pitches) as bigint) as total_pitches,
    cast(sum(batters_faced) as bigint) as total_batters_faced,
    cast(sum(strikeouts) as bigint) as total_strikeouts,
    cast(sum(walks) as bigint) as total_walks,
    cast(sum(hits_allowed) as bigint) as total_hits_allowed,
    cast(sum(home_runs_allowed) as bigint) as total_home_runs_allowed,
    cast(sum(hard_hit_allowed_count) as bigint) as total_hard_hit_allowed,
    cast(sum(batted_balls_allowed) as bigint) as total_batted_balls_allowed,
    round(avg(avg_pitch_velocity_mph), 1) as avg_pitch_velocity,
    round(avg(avg_spin_rate_rpm), 0) as avg_spin_rate,
    round(sum(strikeouts) / nullif(sum(walks), 0), 2) as k_per_bb,
    round(sum(strikeouts) / nullif(sum(batters_faced), 0), 3) as strikeout_rate,
    round(sum(hard_hit_allowed_count) / nullif(sum(batted_balls_allowed), 0), 3)
        as hard_hit_allowed_rate"""
_MONTH = "cast(date_trunc('month', game_date) as date) as game_month"
TEXTS["sem_batting_by_month"] = _out(
    f"select {_MONTH}, {_BATTING_MEASURES} from batter_games group by 1"
)
TEXTS["sem_pitching_by_month"] = _out(
    f"select {_MONTH}, {_PITCHING_MEASURES} from pitcher_games group by 1"
)
TEXTS["sem_batting_explore"] = _out(
    """select batter_id || '-' || game_id as pk, batter_id, game_date,
        round(avg_exit_velocity_mph, 1) as avg_exit_velocity_mph,
        round(max_exit_velocity_mph, 1) as max_exit_velocity_mph,
        round(hard_hit_rate, 3) as hard_hit_rate_row,
        name_first as first_name, name_last as last_name, display_name as full_name
    from batter_games left join named on mlbam_id = batter_id"""
)
TEXTS["sem_pitching_explore"] = _out(
    """select pitcher_id || '-' || game_id as pk, pitcher_id, game_date,
        round(avg_pitch_velocity_mph, 1) as avg_pitch_velocity_mph,
        round(hard_hit_allowed_rate, 3) as hard_hit_allowed_rate_row,
        name_first as first_name, name_last as last_name, display_name as full_name
    from pitcher_games left join named on mlbam_id = pitcher_id"""
)
TEXTS["sem_batting_by_player"] = _out(
    """select display_name as full_name, count(*) as game_count,
        cast(sum(hits) as bigint) as total_hits, cast(sum(at_bats) as bigint) as total_at_bats,
        round(sum(hits) / nullif(sum(at_bats), 0), 3) as batting_average
    from batter_games left join named on mlbam_id = batter_id group by 1"""
)
TEXTS["sem_fact_pk"] = _out(
    "select batter_id || '-' || game_id as pk, batter_id, game_id from batter_games"
)
TEXTS["sem_time_grains"] = _out(
    "select game_date, "
    + ", ".join(
        f"cast(date_trunc('{grain}', game_date) as date) as game_{grain}"
        for grain in ("week", "month", "quarter", "year")
    )
    + ", count(*) as game_count,"
    " cast(sum(plate_appearances) as bigint) as total_plate_appearances"
    " from batter_games group by all"
)
TEXTS["sem_player_dim"] = _out(
    """select mlbam_id, first_name, last_name, first_name || ' ' || last_name as full_name,
        given_name, bbref_id, cast(round(fangraphs_id) as bigint) as fangraphs_id,
        cast(round(mlb_debut_year) as bigint) as mlb_debut_year,
        cast(round(mlb_last_year) as bigint) as mlb_last_year,
        cast(round(birth_year) as bigint) as birth_year
    from raw_players"""
)
TEXTS["sem_player_count"] = _out(
    "select count(distinct mlbam_id) as player_count from raw_players"
)
_good, _ok = values.BATTER_HARD_HIT_BOUNDS
_low, _ok_low = values.PITCHER_HARD_HIT_BOUNDS
TEXTS["sem_metric_tier"] = _out(
    f"""select 'batter' as role, batter_id as player_id, rate,
        if(rate >= {_good}, 'high', if(rate >= {_ok}, 'mid', 'low')) as tier
    from (select batter_id, {ratio('hard_hit_count', 'batted_balls', 'rate')}
        from batter_games group by 1)
    union all
    select 'pitcher', pitcher_id, rate,
        if(rate <= {_low}, 'high', if(rate <= {_ok_low}, 'mid', 'low'))
    from (select pitcher_id, {ratio('hard_hit_allowed_count', 'batted_balls_allowed', 'rate')}
        from pitcher_games group by 1)""",
    "rate",
)
TEXTS["sem_fanout_safe"] = _out(
    """select batter_id, display_name as full_name, count(*) as game_count,
        cast(sum(hits) as bigint) as total_hits, avg(avg_xwoba) as avg_xwoba
    from batter_games left join named on mlbam_id = batter_id group by 1, 2""",
    "avg_xwoba",
)

# profiles

TEXTS["profile_raw_summary"] = _out(
    f"""select count(*) as total_rows, count(distinct {DAY}) as distinct_game_dates,
        min({DAY}) as min_game_date, max({DAY}) as max_game_date,
        count(distinct pitcher) as distinct_pitchers, count(distinct batter) as distinct_batters
    from raw_pitches"""
)
TEXTS["profile_raw_pitch_types"] = _out(
    """select pitch_type, count(*) as pitch_count from raw_pitches group by 1
    order by pitch_count desc, pitch_type nulls first"""
)
TEXTS["profile_staging_summary"] = _out(
    """select count(*) as total_rows,
        count(*) filter (pitch_type is null) as null_pitch_type_rows,
        count(*) filter (game_date is null) as null_game_date_rows,
        min(game_date) as min_game_date, max(game_date) as max_game_date
    from pitches"""
)
TEXTS["profile_outcome_distribution"] = _out(
    """select pitch_outcome_category, count(*) as outcome_count,
        count(*) / (select count(*) from pitches) as outcome_pct
    from pitches group by 1""",
    "outcome_pct",
)
TEXTS["profile_numeric"] = _out(
    " union all ".join(
        f"""select '{name}' as column_name, count({name}) as non_null_count,
            avg({name}) as avg_value, min({name}) as min_value, max({name}) as max_value,
            stddev_samp({name}) as stddev_value from pitches"""
        for name in NUMERIC_COLUMNS
    ),
    "avg_value min_value max_value stddev_value",
)
TEXTS["profile_null_rates"] = _out(
    " union all ".join(
        f"""select '{name}' as column_name, count(*) - count({name}) as null_count,
            count(*) as total_rows, (count(*) - count({name})) / count(*) as null_pct
        from pitches"""
        for name in NULL_RATE_COLUMNS
    ),
    "null_pct",
)
TEXTS["profile_pitch_types"] = _out(
    """select pitch_type, pitch_name, count(*) as pitch_count,
        avg(pitch_velocity_mph) as avg_pitch_velocity_mph,
        avg(spin_rate_rpm) as avg_spin_rate_rpm, avg(xba) as avg_xba
    from pitches group by 1, 2""",
    "avg_pitch_velocity_mph avg_spin_rate_rpm avg_xba",
)
TEXTS["profile_pitches_by_date"] = _out(
    "select game_date, count(*) as pitch_count from pitches group by 1 order by 1"
)
TEXTS["profile_batter_mart"] = _out(
    """select count(*) as total_rows, count(distinct batter_id) as distinct_batters,
        count(distinct game_id) as distinct_games, avg(hard_hit_rate) as avg_hard_hit_rate,
        avg(barrel_rate) as avg_barrel_rate, avg(avg_xwoba) as avg_avg_xwoba,
        avg(avg_bat_speed) as avg_avg_bat_speed
    from batter_games""",
    "avg_hard_hit_rate avg_barrel_rate avg_avg_xwoba avg_avg_bat_speed",
)
TEXTS["profile_pitcher_mart"] = _out(
    """select count(*) as total_rows, count(distinct pitcher_id) as distinct_pitchers,
        count(distinct game_id) as distinct_games, avg(whiff_rate) as avg_whiff_rate,
        avg(strike_pct) as avg_strike_pct,
        avg(avg_pitch_velocity_mph) as avg_avg_pitch_velocity_mph
    from pitcher_games""",
    "avg_whiff_rate avg_strike_pct avg_avg_pitch_velocity_mph",
)
_TOP_BATTERS = f"""
    select batter_id, count(*) as games, cast(sum(batted_balls) as bigint) as total_batted_balls,
        avg(avg_exit_velocity_mph) as avg_exit_velocity_mph, avg(avg_xwoba) as avg_xwoba,
        {ratio('hard_hit_count', 'batted_balls', 'avg_hard_hit_rate')},
        cast(sum(home_runs) as bigint) as total_home_runs
    from batter_games group by 1 having sum(batted_balls) >= 5
    order by avg_exit_velocity_mph desc nulls last, batter_id limit 20"""
_TOP_PITCHERS = f"""
    select pitcher_id, pitcher_name, count(*) as games,
        cast(sum(total_pitches) as bigint) as total_pitches,
        avg(avg_pitch_velocity_mph) as avg_velocity,
        {ratio('whiffs', 'swings', 'avg_whiff_rate')},
        {ratio('strikes', 'total_pitches', 'avg_strike_pct')},
        {ratio('hard_hit_allowed_count', 'batted_balls_allowed', 'avg_hard_hit_allowed_rate')}
    from pitcher_games group by 1, 2 having sum(total_pitches) >= 50
    order by avg_whiff_rate desc nulls last, pitcher_id limit 20"""
TEXTS["top_batters"] = _out(_TOP_BATTERS, "avg_exit_velocity_mph avg_xwoba avg_hard_hit_rate")
TEXTS["top_pitchers"] = _out(
    _TOP_PITCHERS, "avg_velocity avg_whiff_rate avg_strike_pct avg_hard_hit_allowed_rate"
)
TEXTS["top_batters_named"] = _out(
    f"""select name_first, name_last, batter_id, games, avg_exit_velocity_mph, avg_xwoba,
        avg_hard_hit_rate, total_home_runs
    from ({_TOP_BATTERS}) left join named on mlbam_id = batter_id""",
    "avg_exit_velocity_mph avg_xwoba avg_hard_hit_rate",
)
TEXTS["top_pitchers_named"] = _out(
    f"""select name_first, name_last, pitcher_id, games, total_pitches, avg_velocity,
        avg_whiff_rate, avg_hard_hit_allowed_rate
    from ({_TOP_PITCHERS}) left join named on mlbam_id = pitcher_id""",
    "avg_velocity avg_whiff_rate avg_hard_hit_allowed_rate",
)
_shares = " ".join(f"pct_{label}" for label in MIX_LABELS)
TEXTS["profile_pitch_mix_top"] = _out(
    "select * exclude (pitcher_id) from (select pitcher_id, max(pitcher_name) as pitcher_name,"
    " cast(sum(total_pitches) as bigint) as total_pitches, "
    + ", ".join(f"avg({name}) as {name}" for name in _shares.split())
    + " from pitcher_games group by 1 having sum(total_pitches) >= 50)"
    " order by total_pitches desc, pitcher_id limit 20",
    _shares,
)
TEXTS["all_player_ids"] = _out(
    """select player_id, name_first, name_last
    from (
        select batter_id as player_id from batter_games
        union select pitcher_id from pitcher_games
    ) left join named on mlbam_id = player_id where player_id is not null"""
)
TEXTS["profile_date_gaps"] = _out(
    """select batter_team, last_date, next_date, next_date - last_date - 1 as days_between
    from (
        select batter_team, game_date as last_date,
            lead(game_date) over (partition by batter_team order by game_date) as next_date
        from (select distinct batter_team, game_date from batter_games where game_date is not null)
    ) where next_date - last_date > 1"""
)
TEXTS["profile_team_coverage"] = _out(
    " union all ".join(
        f"select '{role}' as role, count(*) as total_players, count(team_id) as with_team,"
        f" count(team_id) / nullif(count(*), 0) as match_rate from {role}_season"
        for role in ("batter", "pitcher")
    ),
    "match_rate",
)
TEXTS["profile_team_join_integrity"] = _out(
    """select count(*) filter (s.team_id is null and r.mlbam_id is not null)
            as null_team_but_on_40man,
        count(*) filter (s.team_id is null) as null_team_total
    from batter_season s left join rosters r on r.mlbam_id = s.batter_id"""
)
TEXTS["profile_unmatched_batters"] = _out(
    """select batter_id, batter_name, games, plate_appearances from batter_season
    where team_id is null order by games desc, batter_id, batter_team limit 10"""
)
_PER_TEAM = """
    select team_abbrev, division_name, coalesce(b.n, 0) as batters, coalesce(p.n, 0) as pitchers,
        coalesce(b.n, 0) + coalesce(p.n, 0) as players
    from raw_teams t
    left join (select team_id, count(*) as n from batter_season group by 1) b using (team_id)
    left join (select team_id, count(*) as n from pitcher_season group by 1) p using (team_id)"""
TEXTS["profile_team_distribution"] = _out(_PER_TEAM)
TEXTS["profile_team_distribution_range"] = _out(
    f"""select min(players) as min_players, cast(floor(median(players)) as bigint)
        as median_players, max(players) as max_players from ({_PER_TEAM})"""
)
TEXTS["profile_status_distribution"] = _out(
    """select availability, count(*) as players,
        count(*) / (select count(*) from status_dim) as pct
    from status_dim group by 1""",
    "pct",
)
TEXTS["profile_status_attach"] = _out(
    " union all ".join(
        f"select '{model}' as model, count(*) as n_rows,"
        " count(availability) as with_availability,"
        f" count(status_description) as with_status_desc from {table}"
        for model, table in (
            ("rpt_batter_season", "batter_season"),
            ("rpt_pitcher_season", "pitcher_season"),
            ("rpt_batter_game", "batter_log"),
            ("rpt_pitcher_pitch_mix", "mix"),
        )
    )
)
TEXTS["spot_name_like"] = _out(
    """select pitcher_name, team_abbrev, games, availability, status_description
    from pitcher_season where lower(pitcher_name) like '%p190%'"""
)
TEXTS["il60_without_stats"] = _out(
    f"""select player_full_name, team_abbrev, availability from status_dim
    where availability = '{values.AVAILABILITY["D60"]}'
        and not exists (select 1 from batter_season where batter_id = mlbam_id)
    order by player_full_name, mlbam_id limit 10"""
)

# data quality

_LAYER_TABLES = {
    "stg_statcast_pitches": "pitches",
    "stg_mlb_teams": "raw_teams",
    "stg_mlb_rosters": "rosters",
    "stg_mlb_roster_status": "status",
    "mart_batter_game_stats": "batter_games",
    "mart_pitcher_game_stats": "pitcher_games",
    "dim_team": "raw_teams",
    "dim_roster_status": "status_dim",
    "rpt_batter_season": "batter_season",
    "rpt_batter_game": "batter_log",
    "rpt_pitcher_season": "pitcher_season",
    "rpt_pitcher_pitch_mix": "mix",
    "player_lookup": "raw_players",
}


def _rule(rule: str, failing: str) -> str:
    return f"select '{rule}' as rule, count(*) as failing_rows from ({failing})"


def _repeated(table: str, keys: str, known: str = "true") -> str:
    return f"select {keys} from {table} where {known} group by all having count(*) > 1"


TEXTS["dq_not_null"] = _out(
    " union all ".join(
        _rule(
            f"not_null {name}.{column}",
            f"select 1 from {_LAYER_TABLES[name]} where {column} is null",
        )
        for name, columns in values.REQUIRED.items()
        for column in columns
    )
)
TEXTS["dq_unique"] = _out(
    " union all ".join(
        _rule(
            f"unique {name}.{column}",
            _repeated(_LAYER_TABLES[name], column, f"{column} is not null"),
        )
        for name, column in values.UNIQUE
    )
)
TEXTS["dq_join_keys"] = _out(
    " union all ".join(
        _rule(
            f"join_key {name}.{column}",
            _repeated(_LAYER_TABLES[name], column, f"{column} is not null"),
        )
        for name, column in values.JOIN_KEYS
    )
)
TEXTS["dq_accepted_values"] = _out(
    " union all ".join(
        _rule(
            f"accepted_values {name}.{column}",
            f"select 1 from {_LAYER_TABLES[name]} where {column} not in {listed(values)}",
        )
        for name, lists in values.ACCEPTED.items()
        for column, values in lists.items()
    )
)
TEXTS["dq_relationships"] = _out(
    " union all ".join(
        _rule(
            f"relationships {name}.{column}",
            f"select 1 from {_LAYER_TABLES[name]} child where child.{column} is not null and"
            f" not exists (select 1 from raw_teams t where t.team_abbrev = child.{column})",
        )
        for name, column in values.REFERENCES
    )
)
TEXTS["dq_batter_team_per_game"] = _out(
    _rule(
        "one_team_per_batter_game",
        "select 1 from batter_games group by batter_id, game_id"
        " having count(distinct batter_team) > 1",
    )
)
TEXTS["dq_pitcher_team_per_game"] = _out(
    _rule(
        "one_team_per_pitcher_game",
        "select 1 from pitcher_games group by pitcher_id, game_id"
        " having count(distinct pitching_team) > 1",
    )
)
TEXTS["dq_composite_grain"] = _out(
    " union all ".join(
        _rule(f"grain {name}", _repeated(_LAYER_TABLES[name], ", ".join(keys)))
        for name, keys in values.GRAINS
    )
)


def _recovered(role: str, player: str, names: tuple[str, ...]) -> str:
    sums = ", ".join(f"sum({name}) as {name}" for name in names)
    columns = (*names, "games")
    either = " or ".join(f"s.{name} <> m.{name}" for name in columns)
    distinct = " or ".join(f"s.{name} is distinct from m.{name}" for name in columns)
    sides = (
        f"(select {player}, {sums}, sum(games) as games from {role}_season group by 1) s"
        " {join} join"
        f" (select {player}, {sums}, count(distinct game_id) as games from {role}_games"
        f" group by 1) m using ({player})"
    )
    return " union all ".join(
        (
            _rule(
                f"{role}_recoverable_inner",
                f"select 1 from {sides.format(join='inner')} where {either}",
            ),
            _rule(
                f"{role}_recoverable_full",
                f"select 1 from {sides.format(join='full')} where {distinct}",
            ),
        )
    )


TEXTS["dq_batter_recoverable"] = _out(_recovered("batter", "batter_id", values.RECOVERED_BATTER_TOTALS))
TEXTS["dq_pitcher_recoverable"] = _out(_recovered("pitcher", "pitcher_id", values.RECOVERED_PITCHER_TOTALS))
_TRADED = " union all ".join(
    f"select '{side}' as side, count(*) as multi_team_players from (select {side}_id"
    f" from {side}_season group by 1 having count(distinct {club}) > 1) players"
    for side, club in (("batter", "batter_team"), ("pitcher", "pitching_team"))
)
TEXTS["dq_traded_counts"] = _out(_TRADED)
TEXTS["dq_traded_nonvacuous"] = _out(f"select * from ({_TRADED}) where multi_team_players = 0")
TEXTS["dq_grain_guard"] = _out(
    " union all ".join(
        f"select '{name}.{key}' as grain_key, count(*) as n_rows,"
        f" count(distinct {key}) as distinct_keys, count(*) - count(distinct {key}) as dup_rows"
        f" from {_LAYER_TABLES[name]}"
        for name, key in (("dim_team", "team_id"), ("dim_roster_status", "mlbam_id"))
    )
)


_SUITE = (
    "dq_not_null", "dq_accepted_values", "dq_unique", "dq_join_keys", "dq_composite_grain", "dq_relationships",
    "dq_batter_team_per_game", "dq_pitcher_team_per_game", "dq_batter_recoverable", "dq_pitcher_recoverable",
)
TEXTS["dq_full_suite"] = " union all ".join(
    [*(f"(select rule, failing_rows from ({TEXTS[name]}))" for name in _SUITE)]
    + [f"(select 'traded_nonvacuous ' || side, 1 from ({TEXTS['dq_traded_nonvacuous']}))"]
)


def oracle_texts() -> dict[str, str]:
    return dict(TEXTS)
