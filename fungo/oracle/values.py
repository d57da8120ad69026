"""Fixed values of the comparison texts, written out here so that a wrong or lost value in the code
under test shows as a difference."""

from __future__ import annotations


# Event, description and pitch codes.
HIT_EVENTS = ('single', 'double', 'triple', 'home_run')
STRIKEOUT_EVENTS = ('strikeout', 'strikeout_double_play')
WALK_EVENTS = ('walk', 'intent_walk')
NOT_AT_BAT_EVENTS = ('walk', 'intent_walk', 'hit_by_pitch', 'sac_fly', 'sac_bunt', 'sac_fly_double_play',
 'catcher_interf')
SWING_DESCRIPTIONS = ('hit_into_play', 'swinging_strike', 'foul', 'foul_tip', 'swinging_strike_blocked',
 'missed_bunt', 'foul_bunt', 'bunt_foul_tip')
WHIFF_DESCRIPTIONS = ('swinging_strike', 'swinging_strike_blocked', 'missed_bunt', 'bunt_foul_tip')
PITCH_LABELS = {'FF': 'four_seam',
 'SI': 'sinker',
 'FC': 'cutter',
 'SL': 'slider',
 'ST': 'sweeper',
 'CU': 'curveball',
 'CH': 'changeup',
 'FS': 'splitter'}
MIX_LABELS = ('four_seam', 'sinker', 'cutter', 'slider', 'sweeper', 'curveball', 'changeup', 'splitter',
 'other')

# Roster status labels, and bounds of the tiers.
AVAILABILITY = {'A': 'Active',
 'D7': 'IL — 7-Day',
 'D10': 'IL — 10-Day',
 'D15': 'IL — 15-Day',
 'D60': 'IL — 60-Day',
 'ILF': 'IL — Full Season',
 'RA': 'Rehab Assignment',
 'RM': 'Minors',
 'RES': 'Minors',
 'DEV': 'Minors',
 'DES': 'Designated for Assignment',
 'RST': 'Restricted List',
 'NYR': 'Not Yet Reported',
 'TI': 'Temporary Inactive',
 'ADM': 'Administrative Leave',
 'IN': 'Ineligible',
 'MIL': 'Military Leave',
 'SU': 'Suspended'}
INJURED_CODES = ('D7', 'D10', 'D15', 'D60', 'ILF', 'RA')
UNKNOWN_STATUS = 'Unknown'
XWOBA_BOUNDS = (0.37, 0.31)
BATTER_HARD_HIT_BOUNDS = (0.45, 0.38)
PITCHER_HARD_HIT_BOUNDS = (0.35, 0.42)

# Columns of the facts, and profiled pitch columns.
BATTER_GAME_COLUMNS = ('batter_id', 'game_id', 'game_date', 'game_year', 'home_team', 'away_team', 'batter_team',
 'batter_side', 'total_pitches', 'plate_appearances', 'at_bats', 'hits', 'singles', 'doubles',
 'triples', 'home_runs', 'strikeouts', 'walks', 'swings', 'whiffs', 'whiff_rate',
 'avg_exit_velocity_mph', 'max_exit_velocity_mph', 'avg_launch_angle_deg', 'hard_hit_count',
 'batted_balls', 'hard_hit_rate', 'barrel_count', 'barrel_rate', 'avg_xba', 'avg_xwoba',
 'avg_xslg', 'avg_bat_speed', 'avg_swing_length')
PITCHER_GAME_COLUMNS = ('pitcher_id', 'pitcher_name', 'game_id', 'game_date', 'game_year', 'home_team', 'away_team',
 'pitching_team', 'pitcher_throws', 'total_pitches', 'batters_faced', 'strikeouts', 'walks',
 'hits_allowed', 'home_runs_allowed', 'avg_pitch_velocity_mph', 'max_pitch_velocity_mph',
 'avg_spin_rate_rpm', 'avg_extension_ft', 'strikes', 'balls', 'strike_pct', 'called_strikes',
 'swings', 'whiffs', 'whiff_rate', 'pct_four_seam', 'pct_sinker', 'pct_cutter', 'pct_slider',
 'pct_sweeper', 'pct_curveball', 'pct_changeup', 'pct_splitter', 'pct_other',
 'avg_exit_velocity_allowed', 'avg_launch_angle_allowed', 'hard_hit_allowed_count',
 'batted_balls_allowed', 'hard_hit_allowed_rate', 'avg_xba_against', 'avg_xwoba_against')
NUMERIC_COLUMNS = ('pitch_velocity_mph', 'spin_rate_rpm', 'exit_velocity_mph', 'launch_angle_deg', 'xba', 'xwoba',
 'bat_speed', 'swing_length')
NULL_RATE_COLUMNS = ('exit_velocity_mph', 'launch_angle_deg', 'xba', 'xwoba', 'xslg', 'bat_speed', 'swing_length',
 'spin_rate_rpm')

# Data-quality rules.
REQUIRED = {'stg_statcast_pitches': ('game_id', 'game_date', 'batter_id', 'pitcher_id', 'pitch_type'),
 'stg_mlb_teams': ('team_id',),
 'stg_mlb_rosters': ('mlbam_id', 'team_id'),
 'stg_mlb_roster_status': ('mlbam_id', 'availability'),
 'mart_batter_game_stats': ('batter_id', 'game_id', 'game_date', 'batter_team'),
 'mart_pitcher_game_stats': ('pitcher_id', 'game_id', 'game_date', 'pitching_team',
                             'total_pitches'),
 'dim_team': ('team_id',),
 'dim_roster_status': ('mlbam_id',),
 'rpt_batter_season': ('batter_id', 'batter_team'),
 'rpt_batter_game': ('batter_id', 'game_date', 'batter_team', 'at_bats', 'hits', 'singles',
                     'doubles', 'triples', 'home_runs', 'strikeouts', 'walks'),
 'rpt_pitcher_season': ('pitcher_id', 'pitching_team'),
 'rpt_pitcher_pitch_mix': ('pitcher_id', 'pitching_team', 'pitch_type')}
UNIQUE = (('stg_mlb_teams', 'team_id'), ('stg_mlb_rosters', 'mlbam_id'),
 ('stg_mlb_roster_status', 'mlbam_id'), ('dim_team', 'team_id'),
 ('dim_roster_status', 'mlbam_id'))
ACCEPTED = {'stg_statcast_pitches': {'pitch_outcome_category': ('S', 'B', 'X'),
                          'batter_side': ('L', 'R'),
                          'pitcher_throws': ('L', 'R')},
 'rpt_pitcher_pitch_mix': {'pitch_type': ('four_seam', 'sinker', 'cutter', 'slider', 'sweeper',
                                          'curveball', 'changeup', 'splitter', 'other')}}
REFERENCES = (('rpt_batter_season', 'batter_team'), ('rpt_batter_game', 'batter_team'),
 ('rpt_pitcher_season', 'pitching_team'), ('rpt_pitcher_pitch_mix', 'pitching_team'))
GRAINS = (('rpt_batter_season', ('batter_id', 'batter_team')),
 ('rpt_pitcher_season', ('pitcher_id', 'pitching_team')),
 ('rpt_pitcher_pitch_mix', ('pitcher_id', 'pitching_team', 'pitch_type')))
JOIN_KEYS = (('dim_team', 'team_abbrev'), ('player_lookup', 'mlbam_id'))
RECOVERED_BATTER_TOTALS = ('plate_appearances', 'at_bats', 'hits', 'home_runs', 'strikeouts', 'walks', 'batted_balls')
RECOVERED_PITCHER_TOTALS = ('total_pitches', 'batters_faced', 'strikeouts', 'walks', 'hits_allowed', 'home_runs_allowed')

# Raw pitch columns, their staged names and raw types.
PITCH_COLUMNS = (
    ("game_pk", "game_id", "bigint"),
    ("game_date", "game_date", "bigint"),
    ("game_year", "game_year", "bigint"),
    ("game_type", "game_type", "string"),
    ("at_bat_number", "at_bat_number", "bigint"),
    ("pitch_number", "pitch_number", "bigint"),
    ("batter", "batter_id", "bigint"),
    ("pitcher", "pitcher_id", "bigint"),
    ("player_name", "pitcher_name", "string"),
    ("stand", "batter_side", "string"),
    ("p_throws", "pitcher_throws", "string"),
    ("age_bat", "age_bat", "bigint"),
    ("age_pit", "age_pit", "bigint"),
    ("home_team", "home_team", "string"),
    ("away_team", "away_team", "string"),
    ("inning", "inning", "bigint"),
    ("inning_topbot", "inning_half", "string"),
    ("outs_when_up", "outs_when_up", "bigint"),
    ("balls", "balls", "bigint"),
    ("strikes", "strikes", "bigint"),
    ("on_1b", "on_1b", "bigint"),
    ("on_2b", "on_2b", "bigint"),
    ("on_3b", "on_3b", "bigint"),
    ("home_score", "home_score", "bigint"),
    ("away_score", "away_score", "bigint"),
    ("bat_score", "bat_score", "bigint"),
    ("fld_score", "fld_score", "bigint"),
    ("post_home_score", "post_home_score", "bigint"),
    ("post_away_score", "post_away_score", "bigint"),
    ("post_bat_score", "post_bat_score", "bigint"),
    ("post_fld_score", "post_fld_score", "bigint"),
    ("home_score_diff", "home_score_diff", "bigint"),
    ("bat_score_diff", "bat_score_diff", "bigint"),
    ("home_win_exp", "home_win_exp", "double"),
    ("bat_win_exp", "bat_win_exp", "double"),
    ("delta_home_win_exp", "delta_home_win_exp", "double"),
    ("delta_run_exp", "delta_run_exp", "double"),
    ("delta_pitcher_run_exp", "delta_pitcher_run_exp", "double"),
    ("pitch_type", "pitch_type", "string"),
    ("pitch_name", "pitch_name", "string"),
    ("release_speed", "pitch_velocity_mph", "double"),
    ("effective_speed", "effective_velocity_mph", "double"),
    ("release_spin_rate", "spin_rate_rpm", "double"),
    ("spin_axis", "spin_axis", "double"),
    ("release_extension", "extension_ft", "double"),
    ("release_pos_x", "release_pos_x_ft", "double"),
    ("release_pos_y", "release_pos_y_ft", "double"),
    ("release_pos_z", "release_pos_z_ft", "double"),
    ("pfx_x", "pfx_x", "double"),
    ("pfx_z", "pfx_z", "double"),
    ("plate_x", "plate_x", "double"),
    ("plate_z", "plate_z", "double"),
    ("zone", "zone", "bigint"),
    ("vx0", "vx0", "double"),
    ("vy0", "vy0", "double"),
    ("vz0", "vz0", "double"),
    ("ax", "ax", "double"),
    ("ay", "ay", "double"),
    ("az", "az", "double"),
    ("api_break_z_with_gravity", "api_break_z_with_gravity", "double"),
    ("api_break_x_arm", "api_break_x_arm", "double"),
    ("api_break_x_batter_in", "api_break_x_batter_in", "double"),
    ("arm_angle", "arm_angle", "double"),
    ("sz_top", "sz_top", "double"),
    ("sz_bot", "sz_bot", "double"),
    ("if_fielding_alignment", "if_fielding_alignment", "string"),
    ("of_fielding_alignment", "of_fielding_alignment", "string"),
    ("type", "pitch_outcome_category", "string"),
    ("description", "pitch_description", "string"),
    ("des", "play_description", "string"),
    ("events", "events", "string"),
    ("bb_type", "batted_ball_type", "string"),
    ("launch_speed", "exit_velocity_mph", "double"),
    ("launch_angle", "launch_angle_deg", "string"),
    ("hit_distance_sc", "hit_distance_ft", "double"),
    ("hc_x", "hc_x", "double"),
    ("hc_y", "hc_y", "double"),
    ("hit_location", "hit_location", "bigint"),
    ("launch_speed_angle", "launch_speed_angle", "bigint"),
    ("bat_speed", "bat_speed", "double"),
    ("swing_length", "swing_length", "double"),
    ("attack_angle", "attack_angle", "double"),
    ("attack_direction", "attack_direction", "double"),
    ("swing_path_tilt", "swing_path_tilt", "double"),
    ("intercept_ball_minus_batter_pos_x_inches", "intercept_ball_minus_batter_pos_x_inches", "double"),
    ("intercept_ball_minus_batter_pos_y_inches", "intercept_ball_minus_batter_pos_y_inches", "double"),
    ("hyper_speed", "hyper_speed", "double"),
    ("estimated_ba_using_speedangle", "xba", "double"),
    ("estimated_woba_using_speedangle", "xwoba", "double"),
    ("estimated_slg_using_speedangle", "xslg", "double"),
    ("woba_value", "woba_value", "double"),
    ("woba_denom", "woba_denom", "double"),
    ("babip_value", "babip_value", "double"),
    ("iso_value", "iso_value", "double"),
    ("fielder_2", "fielder_2", "bigint"),
    ("fielder_3", "fielder_3", "bigint"),
    ("fielder_4", "fielder_4", "bigint"),
    ("fielder_5", "fielder_5", "bigint"),
    ("fielder_6", "fielder_6", "bigint"),
    ("fielder_7", "fielder_7", "bigint"),
    ("fielder_8", "fielder_8", "bigint"),
    ("fielder_9", "fielder_9", "bigint"),
    ("n_thruorder_pitcher", "n_thruorder_pitcher", "bigint"),
    ("n_priorpa_thisgame_player_at_bat", "n_priorpa_thisgame_player_at_bat", "bigint"),
    ("pitcher_days_since_prev_game", "pitcher_days_since_prev_game", "bigint"),
    ("batter_days_since_prev_game", "batter_days_since_prev_game", "bigint"),
    ("pitcher_days_until_next_game", "pitcher_days_until_next_game", "bigint"),
    ("batter_days_until_next_game", "batter_days_until_next_game", "bigint"),
)

# Columns of the registry and of the clubs.
PLAYER_COLUMNS = (
    "mlbam_id", "fangraphs_id", "bbref_id", "last_name", "first_name", "given_name", "mlb_debut_year",
    "mlb_last_year", "birth_year",
)
TEAM_COLUMNS = (
    "team_id", "team_name", "team_abbrev", "team_short_name", "location_name", "league_id", "league_name",
    "division_id", "division_name", "venue_name",
)

# Dates and days of the ingestion queries.
PREVIEWED_DATES = ("2026-04-01", "2026-04-30")
SELECTED_DATES = ("2026-04-15", "2026-06-10")
FIRST_BATCH_UNTIL = "2026-06-30"
CHUNK_DAYS = 7
