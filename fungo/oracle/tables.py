"""The layered tables as DuckDB common table expressions over the driver's tables."""

from __future__ import annotations

import re

from fungo.oracle.values import (
    AVAILABILITY,
    HIT_EVENTS,
    INJURED_CODES,
    MIX_LABELS,
    NOT_AT_BAT_EVENTS,
    PITCH_COLUMNS,
    PITCH_LABELS,
    STRIKEOUT_EVENTS,
    SWING_DESCRIPTIONS,
    UNKNOWN_STATUS,
    WALK_EVENTS,
    WHIFF_DESCRIPTIONS,
)
from fungo.sources import derived


def listed(values) -> str:
    """Values as a SQL list."""
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


def _columns(step: dict[str, str]) -> str:
    return ", ".join(f"{text} as {name}" for name, text in step.items())


TABLES: dict[str, str] = {}

# raw tables, from the same expressions the landing uses

_previous = "lineitem"
for _name, _step in (
    ("line_game", derived.GAME_STEP),
    ("line_club", derived.CLUB_STEP),
    ("line_side", derived.SIDE_STEP),
):
    TABLES[_name] = f"select *, {_columns(_step)} from {_previous}"
    _previous = _name
_plate = ", ".join(derived.PLATE)
TABLES["line_number"] = (
    f"select *, row_number() over (partition by {_plate} order by "
    f"{', '.join(derived.PITCH_ORDER)}) as pitch_number, "
    f"count(*) over (partition by {_plate}) as n_pitch from line_side"
)
TABLES["line_event"] = f"select *, {_columns(derived.EVENT_STEP)} from line_number"
TABLES["line_type"] = f"select *, {_columns(derived.TYPE_STEP)} from line_event"
TABLES["raw_pitches"] = (
    "select "
    + ", ".join(
        f"cast({derived.PITCH_STEP.get(name, 'null')} as {kind}) as {name}"
        for name, _, kind in PITCH_COLUMNS
    )
    + " from line_type"
)
TABLES["ids"] = "select batter as id from raw_pitches union select pitcher from raw_pitches"
TABLES["raw_players"] = (
    f"select {_columns(derived.PLAYER_STEP)} from ids where {derived.PLAYER_KEPT}"
)
TABLES["raw_teams"] = (
    f"select {_columns(derived.TEAM_STEP)} from nation join region on n_regionkey = r_regionkey"
    f" where {derived.TEAM_KEPT}"
)
TABLES["raw_status"] = (
    f"select {_columns(derived.STATUS_HOME)} from ids where {derived.ON_ROSTER}"
    f" union all select {_columns(derived.STATUS_SECOND)} from ids"
    f" where {derived.ON_ROSTER} and id % 5 = 0"
    f" union all select {_columns(derived.STATUS_NEVER_PLAYED)} from range("
    f"{derived.NEVER_PLAYED_FIRST},"
    f" {derived.NEVER_PLAYED_FIRST + derived.NEVER_PLAYED_COUNT}) as never(id)"
)
TABLES["raw_rosters"] = (
    f"select {_columns(derived.FORTY_HOME)} from ids where {derived.ON_FORTY}"
    f" union all select {_columns(derived.FORTY_SECOND)} from ids"
    f" where {derived.ON_FORTY} and id % 10 = 0"
)

# staging

DAY = "make_date(1970, 1, 1) + cast(floor(round(game_date / 1e9) / 86400) as integer)"


def _staged(raw: str, staged: str) -> str:
    if raw == "game_date":
        return f"{DAY} as game_date"
    if raw == "launch_angle":
        return "try_cast(launch_angle as double) as launch_angle_deg"
    if raw == "away_team":
        return (
            "away_team, if(coalesce(inning_topbot, '') = 'Top', away_team, home_team)"
            " as batter_team, if(coalesce(inning_topbot, '') = 'Top', home_team, away_team)"
            " as pitching_team"
        )
    return f"{raw} as {staged}"


TABLES["pitches"] = (
    "select "
    + ", ".join(_staged(raw, staged) for raw, staged, _ in PITCH_COLUMNS)
    + " from raw_pitches where pitch_type is not null"
)
TABLES["status_labelled"] = (
    "select mlbam_id, player_full_name, team_id, status_code, status_description,"
    " coalesce(map {"
    + ", ".join(f"'{code}': '{label}'" for code, label in AVAILABILITY.items())
    + f"}}[status_code], status_description, '{UNKNOWN_STATUS}') as availability,"
    f" status_code = 'A' as is_active, status_code in {listed(INJURED_CODES)} as is_injured"
    " from raw_status"
)
TABLES["rosters"] = (
    "select distinct on (mlbam_id) * from raw_rosters order by mlbam_id, team_id"
)
TABLES["status"] = (
    "select distinct on (mlbam_id) * from status_labelled order by mlbam_id,"
    " if(is_active, 0, if(is_injured, 1, 2)), team_id"
)

# facts and dimensions


def plate_count(name: str, test: str) -> str:
    return f"count(distinct at_bat_number) filter ({test}) as {name}"


def pitch_count(name: str, test: str) -> str:
    return f"count(*) filter ({test}) as {name}"


GAME = "game_id, game_date, game_year, home_team, away_team"
X = "pitch_outcome_category = 'X'"
_swings = pitch_count("swings", f"pitch_description in {listed(SWING_DESCRIPTIONS)}")
_whiffs = pitch_count("whiffs", f"pitch_description in {listed(WHIFF_DESCRIPTIONS)}")

TABLES["batter_parts"] = f"""
    select batter_id, {GAME}, batter_team,
        max(batter_side) as batter_side,
        count(*) as total_pitches,
        {plate_count('plate_appearances', 'events is not null')},
        {plate_count('at_bats', f'events not in {listed(NOT_AT_BAT_EVENTS)}')},
        {plate_count('hits', f'events in {listed(HIT_EVENTS)}')},
        {plate_count('singles', "events = 'single'")},
        {plate_count('doubles', "events = 'double'")},
        {plate_count('triples', "events = 'triple'")},
        {plate_count('home_runs', "events = 'home_run'")},
        {plate_count('strikeouts', f'events in {listed(STRIKEOUT_EVENTS)}')},
        {plate_count('walks', f'events in {listed(WALK_EVENTS)}')},
        {_swings},
        {_whiffs},
        avg(exit_velocity_mph) filter ({X}) as avg_exit_velocity_mph,
        max(exit_velocity_mph) filter ({X}) as max_exit_velocity_mph,
        avg(launch_angle_deg) filter ({X}) as avg_launch_angle_deg,
        {pitch_count('hard_hit_count', f'{X} and exit_velocity_mph >= 95')},
        {pitch_count('batted_balls', X)},
        {pitch_count('barrel_count', f'{X} and launch_speed_angle = 6')},
        avg(xba) as avg_xba, avg(xwoba) as avg_xwoba, avg(xslg) as avg_xslg,
        avg(bat_speed) as avg_bat_speed, avg(swing_length) as avg_swing_length
    from pitches group by all"""
TABLES["batter_games"] = """
    select *, whiffs / nullif(swings, 0) as whiff_rate,
        hard_hit_count / nullif(batted_balls, 0) as hard_hit_rate,
        barrel_count / nullif(batted_balls, 0) as barrel_rate
    from batter_parts"""

_mix_counts = ", ".join(
    pitch_count(f"cnt_{label}", f"pitch_type = '{code}'") for code, label in PITCH_LABELS.items()
)
TABLES["pitcher_parts"] = f"""
    select pitcher_id, {GAME}, pitching_team,
        max(pitcher_name) as pitcher_name,
        max(pitcher_throws) as pitcher_throws,
        count(*) as total_pitches,
        count(distinct at_bat_number) as batters_faced,
        {plate_count('strikeouts', f'events in {listed(STRIKEOUT_EVENTS)}')},
        {plate_count('walks', f'events in {listed(WALK_EVENTS)}')},
        {plate_count('hits_allowed', f'events in {listed(HIT_EVENTS)}')},
        {plate_count('home_runs_allowed', "events = 'home_run'")},
        avg(pitch_velocity_mph) as avg_pitch_velocity_mph,
        max(pitch_velocity_mph) as max_pitch_velocity_mph,
        avg(spin_rate_rpm) as avg_spin_rate_rpm,
        avg(extension_ft) as avg_extension_ft,
        {pitch_count('strikes', "pitch_outcome_category = 'S'")},
        {pitch_count('balls', "pitch_outcome_category = 'B'")},
        {pitch_count('called_strikes', "pitch_description = 'called_strike'")},
        {_swings},
        {_whiffs},
        {_mix_counts},
        {pitch_count('cnt_other', f'pitch_type not in {listed(PITCH_LABELS)}')},
        avg(exit_velocity_mph) filter ({X}) as avg_exit_velocity_allowed,
        avg(launch_angle_deg) filter ({X}) as avg_launch_angle_allowed,
        {pitch_count('hard_hit_allowed_count', f'{X} and exit_velocity_mph >= 95')},
        {pitch_count('batted_balls_allowed', X)},
        avg(xba) as avg_xba_against, avg(xwoba) as avg_xwoba_against
    from pitches group by all"""
TABLES["pitcher_games"] = (
    "select * exclude ("
    + ", ".join(f"cnt_{label}" for label in MIX_LABELS)
    + "), strikes / nullif(total_pitches, 0) as strike_pct,"
    " whiffs / nullif(swings, 0) as whiff_rate,"
    " hard_hit_allowed_count / nullif(batted_balls_allowed, 0) as hard_hit_allowed_rate, "
    + ", ".join(
        f"cnt_{label} / nullif(total_pitches, 0) as pct_{label}" for label in MIX_LABELS
    )
    + " from pitcher_parts"
)
TABLES["club"] = (
    "select team_id, team_abbrev, team_name, league_name, division_name from raw_teams"
)
TABLES["status_dim"] = """
    select mlbam_id, player_full_name, team_id, team_abbrev, team_name, league_name,
        division_name, status_code, status_description, availability, is_active, is_injured
    from status left join club using (team_id)"""

# reports


def mean(value: str, weight: str, name: str) -> str:
    return f"sum({value} * {weight}) / nullif(sum({weight}), 0) as {name}"


def ratio(part: str, whole: str, name: str) -> str:
    return f"sum({part}) / nullif(sum({whole}), 0) as {name}"


def total(*names: str) -> str:
    return ", ".join(f"cast(sum({name}) as bigint) as {name}" for name in names)


BATTER_TOTALS = total(
    "plate_appearances", "at_bats", "hits", "home_runs", "strikeouts", "walks", "batted_balls"
)
PITCHER_TOTALS = total(
    "total_pitches", "batters_faced", "strikeouts", "walks", "hits_allowed", "home_runs_allowed"
)
PITCHER_RATES = ", ".join(
    (
        ratio("whiffs", "swings", "whiff_rate"),
        ratio("strikes", "total_pitches", "strike_pct"),
        mean("avg_pitch_velocity_mph", "total_pitches", "avg_velocity"),
        "max(max_pitch_velocity_mph) as max_velocity",
        mean("avg_spin_rate_rpm", "total_pitches", "avg_spin_rate"),
        mean("avg_extension_ft", "total_pitches", "avg_extension"),
    )
)
BATTER_RATES = ", ".join(
    (
        ratio("hard_hit_count", "batted_balls", "hard_hit_rate"),
        ratio("barrel_count", "batted_balls", "barrel_rate"),
        mean("avg_exit_velocity_mph", "batted_balls", "avg_exit_velocity"),
        "max(max_exit_velocity_mph) as max_exit_velocity",
        mean("avg_launch_angle_deg", "batted_balls", "avg_launch_angle"),
        mean("avg_xwoba", "plate_appearances", "xwoba"),
        mean("avg_xba", "at_bats", "xba"),
        mean("avg_xslg", "at_bats", "xslg"),
    )
)
TABLES["batter_stints"] = f"""
    select batter_id, batter_team, count(distinct game_id) as games, {BATTER_TOTALS},
        {BATTER_RATES}
    from batter_games group by all"""
TABLES["pitcher_stints"] = f"""
    select pitcher_id, pitcher_name, pitcher_throws, pitching_team,
        count(distinct game_id) as games, {PITCHER_TOTALS}, {PITCHER_RATES}
    from pitcher_games group by all"""
TABLES["named"] = (
    "select mlbam_id, first_name || ' ' || last_name as display_name,"
    " first_name as name_first, last_name as name_last from raw_players"
)
TABLES["batter_season"] = """
    select a.batter_id, display_name as batter_name, a.batter_team, club.*,
        availability, status_description, a.* exclude (batter_id, batter_team)
    from batter_stints a
    left join named on named.mlbam_id = a.batter_id
    left join club on club.team_abbrev = a.batter_team
    left join status on status.mlbam_id = a.batter_id"""
TABLES["pitcher_season"] = """
    select a.* exclude (pitching_team), a.pitching_team, club.*, availability, status_description
    from pitcher_stints a
    left join club on club.team_abbrev = a.pitching_team
    left join status on status.mlbam_id = a.pitcher_id"""
TABLES["batter_log"] = """
    select a.batter_id, display_name as batter_name, a.batter_team, club.*,
        availability, status_description, game_date, home_team, away_team, batter_side,
        plate_appearances, at_bats, hits, singles, doubles, triples, home_runs, strikeouts,
        walks, batted_balls, avg_exit_velocity_mph, max_exit_velocity_mph,
        avg_launch_angle_deg, barrel_count, hard_hit_rate, barrel_rate, avg_xba, avg_xwoba,
        avg_xslg
    from batter_games a
    left join named on named.mlbam_id = a.batter_id
    left join club on club.team_abbrev = a.batter_team
    left join status on status.mlbam_id = a.batter_id"""
TABLES["mix_long"] = " union all ".join(
    "select pitcher_id, pitcher_name, game_id, pitching_team, total_pitches,"
    f" '{label}' as pitch_type, pct_{label} as pct from pitcher_games"
    for label in MIX_LABELS
)
TABLES["mix"] = f"""
    select a.*, club.*, availability, status_description
    from (
        select pitcher_id, pitcher_name, pitching_team, pitch_type,
            {mean('pct', 'total_pitches', 'pitch_pct')}
        from mix_long group by all
    ) a
    left join club on club.team_abbrev = a.pitching_team
    left join status on status.mlbam_id = a.pitcher_id"""

_ORDER = list(TABLES)


def with_tables(final: str) -> str:
    """Prefix ``final`` with the tables it needs, in order."""
    needed: set[str] = set()
    pending = [final]
    while pending:
        text = pending.pop()
        for name in _ORDER:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(TABLES[name])
    parts = ", ".join(f"{name} as ({TABLES[name]})" for name in _ORDER if name in needed)
    return f"with {parts} {final}" if parts else final
