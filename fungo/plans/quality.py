"""The data-quality suite over the layered tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fungo.functions.pitch import MIX_LABELS
from fungo.operators import checks
from fungo.operators.profile import by_column, coverage
from fungo.plans.warehouse import Warehouse

# Required, unique and closed-list columns, and references to a parent.
REQUIRED: dict[str, tuple[str, ...]] = {
    "stg_statcast_pitches": ("game_id", "game_date", "batter_id", "pitcher_id", "pitch_type"),
    "stg_mlb_teams": ("team_id",),
    "stg_mlb_rosters": ("mlbam_id", "team_id"),
    "stg_mlb_roster_status": ("mlbam_id", "availability"),
    "mart_batter_game_stats": ("batter_id", "game_id", "game_date", "batter_team"),
    "mart_pitcher_game_stats": (
        "pitcher_id",
        "game_id",
        "game_date",
        "pitching_team",
        "total_pitches",
    ),
    "dim_team": ("team_id",),
    "dim_roster_status": ("mlbam_id",),
    "rpt_batter_season": ("batter_id", "batter_team"),
    "rpt_batter_game": (
        "batter_id",
        "game_date",
        "batter_team",
        "at_bats",
        "hits",
        "singles",
        "doubles",
        "triples",
        "home_runs",
        "strikeouts",
        "walks",
    ),
    "rpt_pitcher_season": ("pitcher_id", "pitching_team"),
    "rpt_pitcher_pitch_mix": ("pitcher_id", "pitching_team", "pitch_type"),
}
UNIQUE = (
    ("stg_mlb_teams", "team_id"),
    ("stg_mlb_rosters", "mlbam_id"),
    ("stg_mlb_roster_status", "mlbam_id"),
    ("dim_team", "team_id"),
    ("dim_roster_status", "mlbam_id"),
)
ACCEPTED: dict[str, dict[str, tuple[str, ...]]] = {
    "stg_statcast_pitches": {
        "pitch_outcome_category": ("S", "B", "X"),
        "batter_side": ("L", "R"),
        "pitcher_throws": ("L", "R"),
    },
    "rpt_pitcher_pitch_mix": {"pitch_type": MIX_LABELS},
}
REFERENCES = (
    ("rpt_batter_season", "batter_team"),
    ("rpt_batter_game", "batter_team"),
    ("rpt_pitcher_season", "pitching_team"),
    ("rpt_pitcher_pitch_mix", "pitching_team"),
)
GRAINS = (
    ("rpt_batter_season", ("batter_id", "batter_team")),
    ("rpt_pitcher_season", ("pitcher_id", "pitching_team")),
    ("rpt_pitcher_pitch_mix", ("pitcher_id", "pitching_team", "pitch_type")),
)
# Keys the attaching joins rely on.
JOIN_KEYS = (("dim_team", "team_abbrev"), ("player_lookup", "mlbam_id"))

BATTER_TOTALS = (
    "plate_appearances",
    "at_bats",
    "hits",
    "home_runs",
    "strikeouts",
    "walks",
    "batted_balls",
)
PITCHER_TOTALS = (
    "total_pitches",
    "batters_faced",
    "strikeouts",
    "walks",
    "hits_allowed",
    "home_runs_allowed",
)


# The rules as data; ``operators.checks`` makes one aggregate of all that concern a table.
REQUIRED_RULES = [
    checks.RowRule(f"not_null {name}.{column}", name, column)
    for name, columns in REQUIRED.items()
    for column in columns
]
ACCEPTED_RULES = [
    checks.RowRule(f"accepted_values {name}.{column}", name, column, values)
    for name, lists in ACCEPTED.items()
    for column, values in lists.items()
]
UNIQUE_RULES = [
    checks.KeyRule(f"unique {name}.{column}", name, (column,), known=True) for name, column in UNIQUE
]
JOIN_KEY_RULES = [
    checks.KeyRule(f"join_key {name}.{column}", name, (column,), known=True) for name, column in JOIN_KEYS
]
GRAIN_RULES = [checks.KeyRule(f"grain {name}", name, columns) for name, columns in GRAINS]
REFERENCE_RULES = [
    checks.ReferenceRule(f"relationships {name}.{column}", name, column) for name, column in REFERENCES
]


def required_columns(warehouse: Warehouse) -> DataFrame:
    return checks.row_rules(warehouse.table, REQUIRED_RULES)


def closed_lists(warehouse: Warehouse) -> DataFrame:
    return checks.row_rules(warehouse.table, ACCEPTED_RULES)


def unique_columns(warehouse: Warehouse) -> DataFrame:
    return checks.key_rules(warehouse.table, UNIQUE_RULES)


def join_keys(warehouse: Warehouse) -> DataFrame:
    return checks.key_rules(warehouse.table, JOIN_KEY_RULES)


def references(warehouse: Warehouse) -> DataFrame:
    return checks.reference_rules(warehouse.table, REFERENCE_RULES, warehouse.dim_team, "team_abbrev")


def one_team_per_batter_game(games: DataFrame) -> DataFrame:
    return checks.several_values(
        "one_team_per_batter_game", games, ("batter_id", "game_id"), "batter_team"
    )


def one_team_per_pitcher_game(games: DataFrame) -> DataFrame:
    return checks.several_values(
        "one_team_per_pitcher_game", games, ("pitcher_id", "game_id"), "pitching_team"
    )


def composite_grains(warehouse: Warehouse) -> DataFrame:
    return checks.key_rules(warehouse.table, GRAIN_RULES)


def _totals(df: DataFrame, key: str, names: tuple[str, ...], games: Column) -> DataFrame:
    return df.groupBy(key).agg(*(F.sum(n).alias(n) for n in names), games.alias("games"))


def recoverable(
    stints: DataFrame, games: DataFrame, key: str, names: tuple[str, ...]
) -> DataFrame:
    """Players whose stint rows do not add up to the season total of the game facts."""
    from_stints = _totals(stints, key, names, F.sum("games"))
    from_games = _totals(games, key, names, F.count_distinct("game_id"))
    return checks.totals_differ(from_stints, from_games, key, (*names, "games"))


def _recoverable_rules(
    role: str, stints: DataFrame, games: DataFrame, key: str, names: tuple[str, ...]
) -> DataFrame:
    """Unequal totals of players on both sides, and of all players, from one comparison."""
    return by_column(
        recoverable(stints, games, key, names),
        {
            f"{role}_inner": {"failing_rows": F.count_if("both_sides")},
            f"{role}_full": {"failing_rows": F.count(F.lit(1))},
        },
        "rule",
    )


def batter_recoverable(warehouse: Warehouse) -> DataFrame:
    return _recoverable_rules(
        "batter_recoverable",
        warehouse.rpt_batter_season,
        warehouse.mart_batter_game_stats,
        "batter_id",
        BATTER_TOTALS,
    )


def pitcher_recoverable(warehouse: Warehouse) -> DataFrame:
    return _recoverable_rules(
        "pitcher_recoverable",
        warehouse.rpt_pitcher_season,
        warehouse.mart_pitcher_game_stats,
        "pitcher_id",
        PITCHER_TOTALS,
    )


def traded_players(season: DataFrame, player: str, club: str) -> DataFrame:
    """Players with two or more clubs."""
    return (
        season.groupBy(player).agg(F.count_distinct(club).alias("clubs")).where("clubs > 1")
    )


def traded_nonvacuous(warehouse: Warehouse) -> DataFrame:
    """A row per side on which nobody changed clubs; no row passes."""
    batters = traded_players(warehouse.rpt_batter_season, "batter_id", "batter_team")
    pitchers = traded_players(warehouse.rpt_pitcher_season, "pitcher_id", "pitching_team")
    return checks.stack(
        [
            checks.none_found(batters, "side", "batter", "multi_team_players"),
            checks.none_found(pitchers, "side", "pitcher", "multi_team_players"),
        ]
    )


def traded_counts(warehouse: Warehouse) -> DataFrame:
    """Number of players with two or more clubs, per side."""
    count = {"multi_team_players": F.count(F.lit(1))}
    batters = traded_players(warehouse.rpt_batter_season, "batter_id", "batter_team")
    pitchers = traded_players(warehouse.rpt_pitcher_season, "pitcher_id", "pitching_team")
    return checks.stack(
        [
            coverage(batters, "side", "batter", count),
            coverage(pitchers, "side", "pitcher", count),
        ]
    )


def grain_guard(warehouse: Warehouse) -> DataFrame:
    """Rows, distinct keys and surplus rows of both dimensions."""

    def guard(name: str, key: str) -> DataFrame:
        rows, keys = F.count(F.lit(1)), F.count_distinct(key)
        return coverage(
            warehouse.table(name),
            "grain_key",
            f"{name}.{key}",
            {"n_rows": rows, "distinct_keys": keys, "dup_rows": rows - keys},
        )

    return checks.stack([guard("dim_team", "team_id"), guard("dim_roster_status", "mlbam_id")])


def full_suite(warehouse: Warehouse) -> DataFrame:
    """All rules as ``rule, failing_rows``."""
    traded = traded_nonvacuous(warehouse).select(
        F.concat(F.lit("traded_nonvacuous "), "side").alias("rule"),
        F.lit(1).cast("bigint").alias("failing_rows"),
    )
    return checks.stack(
        [
            checks.row_rules(warehouse.table, [*REQUIRED_RULES, *ACCEPTED_RULES]),
            checks.key_rules(warehouse.table, [*UNIQUE_RULES, *JOIN_KEY_RULES, *GRAIN_RULES]),
            references(warehouse),
            one_team_per_batter_game(warehouse.mart_batter_game_stats),
            one_team_per_pitcher_game(warehouse.mart_pitcher_game_stats),
            batter_recoverable(warehouse),
            pitcher_recoverable(warehouse),
            traded,
        ]
    )
