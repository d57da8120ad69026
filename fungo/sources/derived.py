"""Raw tables derived from the ``lineitem``, ``nation`` and ``region`` tables.

One line item becomes one pitch. The expressions are plain SQL that Spark and DuckDB read
alike, so the comparison queries start from the same text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fungo.functions.dates import ns_to_date
from fungo.schemas import PITCHES, PLAYER_LOOKUP, ROSTERS, TEAMS
from fungo.session import materialize

PLATE = ("game_pk", "at_bat_number")
PITCH_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
# Rows of a plate appearance that one task ranks.
MOST_AT_ONCE = 100_000
# Cells in which the lines of plate appearances are counted before those of one are.
CELLS = 1 << 16
# Parts of one slice, and more slices than a line number can have.
SLICE_PARTS, SLICE_SPAN = 2048, 1 << 40

LINE_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_linestatus",
)

# Each step adds columns computed from the ones before it.
GAME_STEP = {
    "game_pk": "l_orderkey - l_orderkey % 20",
    "g": "cast((l_orderkey - l_orderkey % 20) / 20 as bigint)",
    "seq": "l_orderkey % 20",
    "inning_topbot": "case when l_linestatus = 'O' then 'Top' else 'Bot' end",
}
CLUB_STEP = {
    "hi": "g % 25",
    "ai": "(g % 25 + 1 + cast((g - g % 25) / 25 as bigint) % 24) % 25",
    "dayno": "(g * 37) % 180",
    "at_bat_number": "seq * 2 + (case when inning_topbot = 'Top' then 0 else 1 end) + 1",
}
SIDE_STEP = {
    "bi": "case when inning_topbot = 'Top' then ai else hi end",
    "pi": "case when inning_topbot = 'Top' then hi else ai end",
}
EVENT_STEP = {
    "events": (
        "case when pitch_number <> n_pitch then null else case l_partkey % 13"
        " when 0 then 'single' when 1 then 'double' when 2 then 'triple'"
        " when 3 then 'home_run' when 4 then 'strikeout' when 5 then 'walk'"
        " when 6 then 'field_out' when 7 then 'hit_by_pitch' when 8 then 'sac_fly'"
        " when 9 then 'strikeout_double_play' when 10 then 'intent_walk'"
        " when 11 then 'field_error' else 'grounded_into_double_play' end end"
    ),
}
TYPE_STEP = {
    "type": (
        "case when events in ('single', 'double', 'triple', 'home_run', 'field_out',"
        " 'sac_fly', 'field_error', 'grounded_into_double_play') then 'X'"
        " when events in ('strikeout', 'strikeout_double_play') then 'S'"
        " when events is not null then 'B'"
        " when (l_partkey + l_linenumber) % 5 < 3 then 'S' else 'B' end"
    ),
    "pitch_type": (
        "case l_partkey % 11 when 0 then 'FF' when 1 then 'SI' when 2 then 'FC'"
        " when 3 then 'SL' when 4 then 'ST' when 5 then 'CU' when 6 then 'CH'"
        " when 7 then 'FS' when 8 then 'KN' when 9 then 'FF'"
        " else case when l_suppkey % 5 = 0 then null else 'SL' end end"
    ),
    "pitcher": (
        "case when seq >= 14 then 19000 + (pi + (case when dayno >= 90 then 1 else 0 end)) % 25"
        " when seq >= 7 then 11001 + pi * 10 else 11000 + pi * 10 end"
    ),
}
PITCH_STEP = {
    "game_pk": "game_pk",
    "game_date": "(1774569600 + dayno * 86400) * 1000000000",
    "game_year": "cast(2026 as bigint)",
    "game_type": "'R'",
    "at_bat_number": "at_bat_number",
    "pitch_number": "pitch_number",
    "batter": (
        "case when seq % 9 = 8 then 9000 + (bi + (case when dayno >= 90 then 1 else 0 end)) % 25"
        " else 1000 + bi * 10 + seq % 9 end"
    ),
    "pitcher": "pitcher",
    "player_name": "concat('P', cast(pitcher as string))",
    "stand": "case when l_suppkey % 2 = 0 then 'L' else 'R' end",
    "p_throws": "case when pi % 3 = 0 then 'L' else 'R' end",
    "home_team": "concat('NATION_', cast(hi as string))",
    "away_team": "concat('NATION_', cast(ai as string))",
    "inning": "1 + cast((seq - seq % 3) / 3 as bigint)",
    "inning_topbot": "case when l_partkey % 97 = 5 then null else inning_topbot end",
    "pitch_type": "pitch_type",
    "pitch_name": (
        "case when pitch_type is null then null else concat('Pitch ', pitch_type) end"
    ),
    "release_speed": (
        "case when l_suppkey % 29 = 0 then null"
        " else 80 + l_quantity * cast(0.375 as double) end"
    ),
    "release_spin_rate": (
        "case when l_partkey % 31 = 0 then null"
        " else cast(1500 + l_partkey % 1200 as double) end"
    ),
    "release_extension": (
        "cast(5.0 as double) + (l_linenumber % 7) * cast(0.25 as double)"
    ),
    "zone": "1 + l_partkey % 14",
    "type": "type",
    "description": (
        "case when type = 'X' then 'hit_into_play'"
        " when type = 'B' then case when events = 'hit_by_pitch' then 'hit_by_pitch'"
        " else 'ball' end"
        " else case l_suppkey % 8 when 0 then 'called_strike' when 1 then 'swinging_strike'"
        " when 2 then 'foul' when 3 then 'foul_tip' when 4 then 'swinging_strike_blocked'"
        " when 5 then 'missed_bunt' when 6 then 'foul_bunt' else 'bunt_foul_tip' end end"
    ),
    "events": "events",
    "bb_type": (
        "case when type <> 'X' then null else case l_partkey % 4 when 0 then 'ground_ball'"
        " when 1 then 'line_drive' when 2 then 'fly_ball' else 'popup' end end"
    ),
    "launch_speed": (
        "case when (type = 'X' and l_partkey % 17 <> 0) or (type = 'S' and l_suppkey % 8 = 2)"
        " then 60 + l_quantity * cast(1.125 as double) end"
    ),
    "launch_angle": (
        "case when type <> 'X' then null when l_partkey % 23 = 0 then 'n/a'"
        " else cast(cast(l_quantity as int) - 20 as string) end"
    ),
    "launch_speed_angle": "case when type = 'X' then 1 + l_partkey % 6 end",
    "bat_speed": (
        "case when type = 'X' and l_suppkey % 3 <> 0"
        " then cast(60 + l_suppkey % 25 as double) end"
    ),
    "swing_length": (
        "case when type = 'X' and l_suppkey % 3 <> 0"
        " then cast(6 as double) + (l_linenumber % 5) * cast(0.5 as double) end"
    ),
    "estimated_ba_using_speedangle": (
        "case when type = 'X' and l_partkey % 17 <> 0 then l_discount * 6 end"
    ),
    "estimated_woba_using_speedangle": (
        "case when type = 'X' and l_partkey % 17 <> 0 then l_discount * 8 end"
    ),
    "estimated_slg_using_speedangle": (
        "case when type = 'X' and l_partkey % 17 <> 0 then l_discount * 12 end"
    ),
}

PLAYER_STEP = {
    "mlbam_id": "id",
    "fangraphs_id": "case when id % 3 = 0 then null else cast(id as double) end",
    "bbref_id": "cast(null as string)",
    "last_name": "case when id % 41 = 0 then null else concat('Last', cast(id as string)) end",
    "first_name": "concat('First', cast(id as string))",
    "given_name": "cast(null as string)",
    "mlb_debut_year": "cast(1990 + id % 30 as double)",
    "mlb_last_year": "cast(null as double)",
    "birth_year": "cast(null as double)",
}
PLAYER_KEPT = "id % 37 <> 5"

TEAM_STEP = {
    "team_id": "cast(100 + n_nationkey as bigint)",
    "team_name": "concat('Club ', n_name)",
    "team_abbrev": "n_name",
    "team_short_name": "cast(null as string)",
    "location_name": "cast(null as string)",
    "league_id": "cast(null as bigint)",
    "league_name": (
        "case when n_regionkey % 2 = 0 then 'American League' else 'National League' end"
    ),
    "division_id": "cast(null as bigint)",
    "division_name": "r_name",
    "venue_name": "cast(null as string)",
}

# One club that plays has no entry, so that references have orphans.
TEAM_KEPT = "n_nationkey <> 24"

_STATUS_CODE = (
    "case id % 22 when 0 then 'A' when 1 then 'A' when 2 then 'A' when 3 then 'D7'"
    " when 4 then 'D10' when 5 then 'D15' when 6 then 'D60' when 7 then 'ILF'"
    " when 8 then 'RA' when 9 then 'RM' when 10 then 'RES' when 11 then 'DEV'"
    " when 12 then 'DES' when 13 then 'RST' when 14 then 'NYR' when 15 then 'TI'"
    " when 16 then 'ADM' when 17 then 'IN' when 18 then 'MIL' when 19 then 'SU'"
    " when 20 then 'ZZ' else 'YY' end"
)
_STATUS_TEXT = (
    "case when id % 22 = 20 then null when id % 22 = 21 then 'Other list'"
    " else concat('desc ', cast(id % 22 as string)) end"
)
ON_ROSTER = "id % 17 <> 3"
ON_FORTY = "id % 17 <> 3 and id % 22 <> 6"


def _roster_row(team: str, code: str, text: str) -> dict[str, str]:
    return {
        "mlbam_id": "id",
        "player_full_name": "concat('Player ', cast(id as string))",
        "team_id": team,
        "jersey_number": "cast(id % 99 as string)",
        "position_code": "case when id >= 11000 then '1' else '7' end",
        "position_name": "cast(null as string)",
        "position_type": "cast(null as string)",
        "status_code": code,
        "status_description": text,
    }


STATUS_HOME = _roster_row("100 + id % 25", _STATUS_CODE, _STATUS_TEXT)
STATUS_SECOND = _roster_row("100 + (id + 7) % 25", "'RM'", "'desc 9'")
STATUS_NEVER_PLAYED = _roster_row("100 + id % 25", "'D60'", "'desc 6'")
FORTY_HOME = _roster_row("100 + id % 25", "'A'", "cast(null as string)")
FORTY_SECOND = _roster_row("100 + (id + 7) % 25", "'A'", "cast(null as string)")
NEVER_PLAYED_FIRST, NEVER_PLAYED_COUNT = 30000, 20


def _select(df: DataFrame, step: Mapping[str, str]) -> DataFrame:
    return df.select(*(F.expr(text).alias(name) for name, text in step.items()))


def _extend(df: DataFrame, step: Mapping[str, str]) -> DataFrame:
    return df.select("*", *(F.expr(text).alias(name) for name, text in step.items()))


def _number_pitches(lines: DataFrame) -> DataFrame:
    """Add ``pitch_number`` and ``n_pitch`` within each plate appearance.

    A plate appearance is ranked by one task, unless it has more than ``MOST_AT_ONCE`` rows. The order
    inside such a one, which may hold a third of all rows, is cut into slices by line number and part
    range: each slice is numbered alone and shifted by the sizes of the slices before it.

    All rows move once, with nothing but their own columns and the key; the slices' sizes are those of the large
    plate appearances only, and these are so few (at most one for ``MOST_AT_ONCE`` rows) that
    every task can have them. Lines without an order, a line number or a part count, but are no pitch.
    """
    lines = lines.where(F.col("game_pk").isNotNull())
    part_slice = F.floor(F.col("l_partkey") / F.lit(SLICE_PARTS)).cast("long")
    sliced = lines.withColumn("slice", F.col("l_linenumber").cast("long") * SLICE_SPAN + part_slice)
    large = _large(lines)
    marked = sliced.join(F.broadcast(large.select(*PLATE, F.lit(True).alias("large"))), list(PLATE), "left")
    # Null for a plate appearance that is not cut.
    cut = marked.withColumn("cut", F.when(F.col("large"), F.col("slice"))).drop("large")
    cell = (*PLATE, "cut")

    plate = Window.partitionBy(*PLATE)
    before = plate.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sliced.join(F.broadcast(large.select(*PLATE)), list(PLATE), "left_semi")
        .groupBy(*PLATE, "slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            *PLATE,
            F.col("slice").alias("cut"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"),
            F.sum("n").over(plate).alias("n_plate"),
        )
    )
    # One order for both, so that the lines of a cell are kept and copied once.
    within = Window.partitionBy(*cell).orderBy("slice", *PITCH_ORDER)
    whole = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        cut.withColumns({"place": F.row_number().over(within), "n_cell": F.count(F.lit(1)).over(whole)})
        .where(F.col("slice").isNotNull())
        .join(shifts, list(cell), "left")
        .withColumn("pitch_number", F.col("place") + F.coalesce("shift", F.lit(0)))
        .withColumn("n_pitch", F.coalesce("n_plate", "n_cell"))
        .drop("slice", "cut", "place", "n_cell", "shift", "n_plate")
    )


def _large(lines: DataFrame) -> DataFrame:
    """The plate appearances of more than ``MOST_AT_ONCE`` lines.

    Lines are counted by cell first, on the map side, and plate appearances only in cells with so many lines:
    usually none, and then no line moves for it.
    """
    cell = F.pmod(F.xxhash64(*PLATE), F.lit(CELLS)).alias("cell")
    crowded = lines.groupBy(cell).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_AT_ONCE)
    chosen = lines.select(*PLATE, cell).join(F.broadcast(crowded.select("cell")), "cell", "left_semi")
    return chosen.groupBy(*PLATE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MOST_AT_ONCE)


def pitches(lineitem: DataFrame) -> DataFrame:
    """The raw pitch table; columns without a source in ``lineitem`` are typed nulls."""
    lines = lineitem.select(*LINE_COLUMNS)
    plates = lines
    for step in (GAME_STEP, CLUB_STEP):
        plates = _extend(plates, step)
    # The other steps' columns are made from the lines again once these are numbered.
    lines = _number_pitches(plates.select(*LINE_COLUMNS, *PLATE)).drop(*PLATE)
    for step in (GAME_STEP, CLUB_STEP):
        lines = _extend(lines, step)
    # The landing has a file with a hundred column writers for each month: one month after the other, and while rows are
    # narrow, so that a task does not go from writer to writer with every row.
    lines = lines.withColumn("game_date", F.expr(PITCH_STEP["game_date"]))
    lines = lines.sortWithinPartitions(F.trunc(ns_to_date(F.col("game_date")), "month"))
    for step in (SIDE_STEP, EVENT_STEP, TYPE_STEP):
        lines = _extend(lines, step)
    made = {**PITCH_STEP, "game_date": "game_date"}
    return lines.select(
        *(
            F.expr(made.get(field.name, "null")).cast(field.dataType).alias(field.name)
            for field in PITCHES
        )
    )


def player_ids(raw_pitches: DataFrame) -> DataFrame:
    """Every batter and pitcher id once, from one scan."""
    both = F.explode(F.array("batter", "pitcher"))
    return raw_pitches.select(both.alias("id")).distinct()


def player_lookup(ids: DataFrame) -> DataFrame:
    return _select(ids.where(PLAYER_KEPT), PLAYER_STEP).to(PLAYER_LOOKUP)


def teams(nation: DataFrame, region: DataFrame) -> DataFrame:
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return _select(joined.where(TEAM_KEPT), TEAM_STEP).to(TEAMS)


def roster_status(spark: SparkSession, ids: DataFrame) -> DataFrame:
    listed = ids.where(ON_ROSTER)
    never = spark.range(NEVER_PLAYED_FIRST, NEVER_PLAYED_FIRST + NEVER_PLAYED_COUNT)
    return (
        _select(listed, STATUS_HOME)
        .unionAll(_select(listed.where("id % 5 = 0"), STATUS_SECOND))
        .unionAll(_select(never, STATUS_NEVER_PLAYED))
        .to(ROSTERS)
    )


def rosters(ids: DataFrame) -> DataFrame:
    listed = ids.where(ON_FORTY)
    return (
        _select(listed, FORTY_HOME)
        .unionAll(_select(listed.where("id % 10 = 0"), FORTY_SECOND))
        .to(ROSTERS)
    )


def reference_tables(spark: SparkSession, sf_dir: str, raw_pitches: DataFrame) -> dict[str, DataFrame]:
    """The four raw reference tables for the players found in ``raw_pitches``."""
    ids = materialize(player_ids(raw_pitches), "player-ids")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    return {
        "player_lookup": player_lookup(ids),
        "mlb_teams": teams(nation, region),
        "mlb_rosters": rosters(ids),
        "mlb_roster_status": roster_status(spark, ids),
    }
