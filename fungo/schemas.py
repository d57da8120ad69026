"""Declared column names and types of the raw tables and feeds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Raw pitch columns as delivered, each with its staged name and type.
# The two clubs of record are derived in staging and follow away_team there.
PITCH_COLUMNS: tuple[tuple[str, str, str], ...] = (
    # identifiers
    ("game_pk", "game_id", "bigint"),
    ("game_date", "game_date", "bigint"),
    ("game_year", "game_year", "bigint"),
    ("game_type", "game_type", "string"),
    ("at_bat_number", "at_bat_number", "bigint"),
    ("pitch_number", "pitch_number", "bigint"),
    # players
    ("batter", "batter_id", "bigint"),
    ("pitcher", "pitcher_id", "bigint"),
    ("player_name", "pitcher_name", "string"),
    ("stand", "batter_side", "string"),
    ("p_throws", "pitcher_throws", "string"),
    ("age_bat", "age_bat", "bigint"),
    ("age_pit", "age_pit", "bigint"),
    # clubs and game state
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
    # pitch
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
    # outcome
    ("type", "pitch_outcome_category", "string"),
    ("description", "pitch_description", "string"),
    ("des", "play_description", "string"),
    ("events", "events", "string"),
    # batted ball
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
    (
        "intercept_ball_minus_batter_pos_x_inches",
        "intercept_ball_minus_batter_pos_x_inches",
        "double",
    ),
    (
        "intercept_ball_minus_batter_pos_y_inches",
        "intercept_ball_minus_batter_pos_y_inches",
        "double",
    ),
    ("hyper_speed", "hyper_speed", "double"),
    # expected and run values
    ("estimated_ba_using_speedangle", "xba", "double"),
    ("estimated_woba_using_speedangle", "xwoba", "double"),
    ("estimated_slg_using_speedangle", "xslg", "double"),
    ("woba_value", "woba_value", "double"),
    ("woba_denom", "woba_denom", "double"),
    ("babip_value", "babip_value", "double"),
    ("iso_value", "iso_value", "double"),
    # fielders
    ("fielder_2", "fielder_2", "bigint"),
    ("fielder_3", "fielder_3", "bigint"),
    ("fielder_4", "fielder_4", "bigint"),
    ("fielder_5", "fielder_5", "bigint"),
    ("fielder_6", "fielder_6", "bigint"),
    ("fielder_7", "fielder_7", "bigint"),
    ("fielder_8", "fielder_8", "bigint"),
    ("fielder_9", "fielder_9", "bigint"),
    # schedule
    ("n_thruorder_pitcher", "n_thruorder_pitcher", "bigint"),
    ("n_priorpa_thisgame_player_at_bat", "n_priorpa_thisgame_player_at_bat", "bigint"),
    ("pitcher_days_since_prev_game", "pitcher_days_since_prev_game", "bigint"),
    ("batter_days_since_prev_game", "batter_days_since_prev_game", "bigint"),
    ("pitcher_days_until_next_game", "pitcher_days_until_next_game", "bigint"),
    ("batter_days_until_next_game", "batter_days_until_next_game", "bigint"),
)


_KINDS: dict[str, DataType] = {
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "string": StringType(),
}


def _struct(**columns: str | DataType) -> StructType:
    return StructType(
        [
            StructField(name, _KINDS[kind] if isinstance(kind, str) else kind)
            for name, kind in columns.items()
        ]
    )


PITCHES = _struct(**{raw: kind for raw, _, kind in PITCH_COLUMNS})

# The landed pitch table carries its two partition columns as well.
LANDED_PITCHES = StructType([*PITCHES.fields, *_struct(year="int", month="int").fields])

PLAYER_LOOKUP = _struct(
    mlbam_id="bigint",
    fangraphs_id="double",
    bbref_id="string",
    last_name="string",
    first_name="string",
    given_name="string",
    mlb_debut_year="double",
    mlb_last_year="double",
    birth_year="double",
)

TEAMS = _struct(
    team_id="bigint",
    team_name="string",
    team_abbrev="string",
    team_short_name="string",
    location_name="string",
    league_id="bigint",
    league_name="string",
    division_id="bigint",
    division_name="string",
    venue_name="string",
)

ROSTERS = _struct(
    mlbam_id="bigint",
    player_full_name="string",
    team_id="bigint",
    jersey_number="string",
    position_code="string",
    position_name="string",
    position_type="string",
    status_code="string",
    status_description="string",
)

# Registry shards as published: every field is text until it is shaped.
REGISTRY_SHARD = _struct(
    key_mlbam="string",
    key_fangraphs="string",
    key_bbref="string",
    name_last="string",
    name_first="string",
    name_given="string",
    pro_played_first="string",
    pro_played_last="string",
    birth_year="string",
)

TEAMS_FEED = _struct(
    teams=ArrayType(
        _struct(
            id="bigint",
            name="string",
            abbreviation="string",
            teamName="string",
            locationName="string",
            league=_struct(id="bigint", name="string"),
            division=_struct(id="bigint", name="string"),
            venue=_struct(name="string"),
        )
    )
)

# roster_type and team_id come from the folder a club's document was landed in.
ROSTER_FEED = _struct(
    roster=ArrayType(
        _struct(
            person=_struct(id="bigint", fullName="string"),
            jerseyNumber="string",
            position=_struct(code="string", name="string", type="string"),
            status=_struct(code="string", description="string"),
        )
    ),
    roster_type="string",
    team_id="bigint",
)

RAW_SCHEMAS: dict[str, StructType] = {
    "statcast_pitches": PITCHES,
    "player_lookup": PLAYER_LOOKUP,
    "mlb_teams": TEAMS,
    "mlb_rosters": ROSTERS,
    "mlb_roster_status": ROSTERS,
}


# From narrow to wide.
_WHOLE = (ByteType(), ShortType(), IntegerType(), LongType())
_FRACTION = (FloatType(), DoubleType())
_TIMES = (DateType(), TimestampNTZType(), TimestampType())
_SCALAR = (*_WHOLE, *_FRACTION, *_TIMES, StringType(), BooleanType())


def common_type(first: DataType, second: DataType) -> DataType | None:
    """The type that holds the values of both, None if there is none.

    Whole numbers widen, beside fractions they become double, dates become times, and different scalars
    meet as text. Arrays meet by their elements, structures field by field. Bytes and maps meet
    only their like.
    """
    if first == second or isinstance(second, NullType):
        return first
    if isinstance(first, NullType):
        return second
    for order in (_WHOLE, _TIMES):
        if first in order and second in order:
            return order[max(order.index(first), order.index(second))]
    numbers = [kind in (*_WHOLE, *_FRACTION) or isinstance(kind, DecimalType) for kind in (first, second)]
    if all(numbers):
        return _common_number(first, second)
    if isinstance(first, ArrayType) and isinstance(second, ArrayType):
        element = common_type(first.elementType, second.elementType)
        return None if element is None else ArrayType(element)
    if isinstance(first, StructType) and isinstance(second, StructType):
        fields = {field.name: field.dataType for field in first}
        for field in second:
            kind = common_type(fields.get(field.name, NullType()), field.dataType)
            if kind is None:
                return None
            fields[field.name] = kind
        return StructType([StructField(name, kind) for name, kind in fields.items()])
    scalar = [kind in _SCALAR or isinstance(kind, DecimalType) for kind in (first, second)]
    return StringType() if all(scalar) else None


def _common_number(first: DataType, second: DataType) -> DataType:
    digits = dict(zip(_WHOLE, (3, 5, 10, 19)))
    if first in _FRACTION or second in _FRACTION:
        return DoubleType()
    parts = [(digits[k], 0) if k in digits else (k.precision - k.scale, k.scale) for k in (first, second)]
    before, after = (max(side) for side in zip(*parts))
    return DecimalType(before + after, after) if before + after <= 38 else DoubleType()


def reconciled(schemas: Iterable[StructType]) -> StructType:
    """One schema for all of them, column by column by name; fails where a column has no common type."""
    found: dict[str, StructField] = {}
    for schema in schemas:
        for field in schema:
            key = field.name.lower()
            known = found.get(key, StructField(field.name, NullType()))
            kind = common_type(known.dataType, field.dataType)
            if kind is None:
                raise SchemaDrift(
                    f"{known.name}: {known.dataType.simpleString()} before, "
                    f"{field.dataType.simpleString()} now"
                )
            found[key] = StructField(known.name, kind)
    return StructType(list(found.values()))


def widened(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``: cast to its types, null where it has none."""
    own = {name.lower(): name for name in df.columns}
    return df.select(
        *(
            _fitted(F.col(f"`{own[field.name.lower()]}`"), df.schema[own[field.name.lower()]].dataType, field.dataType)
            .alias(field.name)
            if field.name.lower() in own
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in schema
        )
    )


def _fitted(value: Column, kind: DataType, wanted: DataType) -> Column:
    if kind == wanted:
        return value
    if isinstance(wanted, StructType) and isinstance(kind, StructType):
        own = {field.name: field.dataType for field in kind}
        parts = [
            _fitted(value[f.name], own[f.name], f.dataType).alias(f.name)
            if f.name in own
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in wanted
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(wanted, ArrayType) and isinstance(kind, ArrayType):
        return F.transform(value, lambda item: _fitted(item, kind.elementType, wanted.elementType))
    return value.cast(wanted)


class SchemaDrift(ValueError):
    """A delivered table does not have the declared columns."""


def conform(df: DataFrame, declared: StructType, keep_others: bool = False) -> DataFrame:
    """Project ``df`` to the declared columns, failing when one is missing or of another type.

    With ``keep_others`` the columns that are not declared follow the declared ones.
    """
    found = {field.name: field.dataType for field in df.schema}
    wrong = [
        f"{field.name}: declared {field.dataType.simpleString()}, found "
        f"{found[field.name].simpleString() if field.name in found else 'nothing'}"
        for field in declared
        if found.get(field.name) != field.dataType
    ]
    if wrong:
        raise SchemaDrift("; ".join(wrong))
    others = [name for name in df.columns if name not in declared.names]
    chosen = [*declared.names, *(others if keep_others else ())]
    return df if df.columns == chosen else df.select(*(f"`{name}`" for name in chosen))
