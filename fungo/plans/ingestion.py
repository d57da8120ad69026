"""Ingestion round trips: land derived data in a new folder and read it back."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fungo.functions.dates import ns_to_date
from fungo.operators import rollups
from fungo.operators.game_facts import BATTER_GAME_COLUMNS, batter_games, pitcher_games
from fungo.schemas import PITCHES
from fungo.session import fresh_folder
from fungo.sources import feeds, landing, raw_zone
from fungo.sources.loads import Load
from fungo.plans.stored import sets_of
from fungo.streaming.incremental import (
    Build,
    change_set,
    ingest_new_files,
    ingest_new_loads,
    on_dates,
    refresh_mart,
    write_dates,
)
from fungo.streaming.season_totals import SeasonTotals

Result = TypeVar("Result")

SELECTED_DATES = (date(2026, 4, 15), date(2026, 6, 10))
PREVIEWED_DATES = (date(2026, 4, 1), date(2026, 4, 30))
FIRST_BATCH_UNTIL = date(2026, 6, 30)
LATE_AT_BATS = 20
REFRESHED_UNTIL = date(2026, 4, 30)
WITHDRAWN_DATE = date(2026, 4, 15)


def _pitches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_zone.RawZone(spark, sf_dir)["statcast_pitches"]


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All pitches in two date batches."""
    pitches = _pitches(spark, sf_dir)
    early = ns_to_date(F.col("game_date")) <= F.lit(FIRST_BATCH_UNTIL)
    return pitches.where(early), pitches.where(~early)


def chunk_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two chunks, the later one without its fielder columns, and an empty one, stacked."""
    early, late = _batches(spark, sf_dir)
    fielders = [name for name in PITCHES.names if name.startswith("fielder_")]
    none = early.where(F.col("game_date") < 0)
    return landing.union_chunks([early, none, late.drop(*fielders)])


def ingest_append_vs_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and their values per date: appended with one batch repeated, then refreshed."""
    early, late = _batches(spark, sf_dir)
    results = []
    for mode in ("append", "full-refresh"):
        path = fresh_folder(spark, "load")
        for batch in (early, late, late):
            landing.land_pitches(batch, path, mode)
        stored = landing.read_landed(spark, path)
        results.append(_rows_per_date(stored, mode))
        if mode == "append":
            results.append(_rows_per_date(landing.without_repeats(stored), "append-once"))
    first, second, third = results
    return first.unionAll(second).unionAll(third)


def _rows_per_date(stored: DataFrame, mode: str) -> DataFrame:
    return (
        stored.groupBy(ns_to_date(F.col("game_date")).alias("game_date"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.col("batter") * F.col("pitch_number") + F.col("pitcher")).alias("numbers"),
            F.sum(F.length("home_team") + F.length("pitch_type")).alias("letters"),
        )
        .select(F.lit(mode).alias("mode"), "game_date", "n_rows", "numbers", "letters")
    )


def ingest_reference_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The club table loaded twice by full refresh: the second load replaces the first."""
    teams = raw_zone.RawZone(spark, sf_dir)["mlb_teams"]
    path = fresh_folder(spark, "reference")
    for _ in range(2):
        landing.land_table(teams, path)
    return landing.read_reference(spark, path, "mlb_teams")


def ingest_partitioned_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pitches per landed month folder."""
    path = fresh_folder(spark, "landing")
    landing.land_pitches(_pitches(spark, sf_dir), path)
    return (
        landing.read_landed(spark, path)
        .groupBy(F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("game_pk").alias("games"))
    )


def ingest_row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows taken in and rows gained by three loads: a batch, an empty one, another batch."""
    early, late = _batches(spark, sf_dir)
    none = early.where(F.col("game_date") < 0)
    path = fresh_folder(spark, "audit")
    audits = [landing.land_pitches(batch, path) for batch in (early, none, late)]
    rows = [
        (load, audit.mode, audit.rows_extracted, audit.rows_loaded)
        for load, audit in enumerate(audits, start=1)
    ]
    return spark.createDataFrame(
        rows, "load bigint, mode string, rows_extracted bigint, rows_loaded bigint"
    )


@dataclass(frozen=True)
class Ingested:
    """Where a sequence of loads and what is kept up from them lie."""

    zone: str
    batter_mart: str
    pitcher_mart: str
    progress: str
    batter_totals: SeasonTotals
    pitcher_totals: SeasonTotals
    sets: str


def new_ingestion(spark: SparkSession) -> Ingested:
    """A landing zone with both facts and both season totals, all empty."""
    folder = fresh_folder(spark, "ingested")
    return Ingested(
        f"{folder}/zone",
        f"{folder}/batter-games",
        f"{folder}/pitcher-games",
        f"{folder}/progress",
        SeasonTotals(spark, f"{folder}/batter-season", rollups.BATTER_STINTS),
        SeasonTotals(spark, f"{folder}/pitcher-season", rollups.PITCHER_STINTS),
        f"{folder}/sets",
    )


def bring_up_to_date(spark: SparkSession, state: Ingested, batting_only: bool = False) -> None:
    """Take every load published since the last time into the facts, and these into season totals and sets.

    ``batting_only`` keeps up the batters' fact and season; it has to be so from the first load on. Both facts are
    brought up to date at once, and then both totals and the sets: each has steps of few tasks, in which the others
    keep the executors at work.
    """
    sides = [(state.batter_mart, batter_games, state.batter_totals)]
    if not batting_only:
        sides.append((state.pitcher_mart, pitcher_games, state.pitcher_totals))
    # A date is gone as long as one of them holds it, so a run that stopped half way is completed.
    tables = [table for mart, _, totals in sides for table in (mart, totals.by_date)] + [state.sets]

    def refresh(new: Sequence[Load], number: int) -> None:
        changes = change_set(spark, state.zone, tables, new)

        def facts(mart: str, build: Build) -> DataFrame:
            refresh_mart(spark, state.zone, mart, build, changes)
            return spark.read.parquet(mart).where(on_dates("game_date", changes.changed))

        games = _at_once(spark, [partial(facts, mart, build) for mart, build, _ in sides])
        kept = [partial(totals.refresh, own, changes, number) for own, (_, _, totals) in zip(games, sides)]
        if not batting_only:
            kept.append(lambda: write_dates(sets_of(*games), state.sets, changes))
        _at_once(spark, kept)

    ingest_new_loads(spark, state.zone, state.progress, refresh)


def _at_once(spark: SparkSession, steps: Sequence[Callable[[], Result]]) -> list[Result]:
    """What the steps return, each run in a thread of its own; if one fails, the others end before its error is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [one.result() for one in started]


_LATE_FILES: dict[tuple[str, str], Ingested] = {}


def late_files(spark: SparkSession, sf_dir: str) -> Ingested:
    """Two file drops taken in one after the other, the second with late pitches of games already seen.

    Made once per application and folder.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LATE_FILES:
        pitches = _pitches(spark, sf_dir)
        on_time = F.col("at_bat_number") <= LATE_AT_BATS
        state = new_ingestion(spark)
        for drop in (pitches.where(on_time), pitches.where(~on_time)):
            landing.land_pitches(drop, state.zone)
            bring_up_to_date(spark, state)
        _LATE_FILES[key] = state
    return _LATE_FILES[key]


def ingest_incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batter facts after the second file drop."""
    return spark.read.parquet(late_files(spark, sf_dir).batter_mart).select(*BATTER_GAME_COLUMNS)


def ingest_refresh_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batter games after a full refresh that delivers fewer dates, and none of one date between."""
    pitches = _pitches(spark, sf_dir)
    day = ns_to_date(F.col("game_date"))
    state = new_ingestion(spark)
    landing.land_pitches(pitches.where(day <= F.lit(REFRESHED_UNTIL + timedelta(days=14))), state.zone)
    ingest_new_files(spark, state.zone, state.batter_mart, state.progress, batter_games)
    kept = (day <= F.lit(REFRESHED_UNTIL)) & (day != F.lit(WITHDRAWN_DATE))
    landing.land_pitches(pitches.where(kept), state.zone, "full-refresh")
    ingest_new_files(spark, state.zone, state.batter_mart, state.progress, batter_games)
    return spark.read.parquet(state.batter_mart).select(*BATTER_GAME_COLUMNS)


def ingest_refresh_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batter season lines after a refresh took dates away and a late file brought one of them back."""
    pitches = _pitches(spark, sf_dir)
    day = ns_to_date(F.col("game_date"))
    state = new_ingestion(spark)
    first = pitches.where(day <= F.lit(REFRESHED_UNTIL))
    withdrawn = day == F.lit(WITHDRAWN_DATE)
    landing.land_pitches(first, state.zone)
    bring_up_to_date(spark, state, batting_only=True)
    kept = first.where(~withdrawn & (day > F.lit(WITHDRAWN_DATE - timedelta(days=7))))
    landing.land_pitches(kept, state.zone, "full-refresh")
    bring_up_to_date(spark, state, batting_only=True)
    landing.land_pitches(first.where(withdrawn), state.zone)
    bring_up_to_date(spark, state, batting_only=True)
    return state.batter_totals.lines()


def _months(spark: SparkSession, sf_dir: str, first: int, last: int) -> DataFrame:
    """The pitches of some calendar months of the season."""
    day = ns_to_date(F.col("game_date"))
    return _pitches(spark, sf_dir).where(F.month(day).between(first, last))


def _merged_loads(spark: SparkSession, sf_dir: str) -> tuple[str, list[landing.LoadAudit]]:
    """April and May appended, May and June merged twice."""
    path = fresh_folder(spark, "merge")
    loads = ((4, 5, "append"), (5, 6, "merge"), (5, 6, "merge"))
    audits = [
        landing.land_pitches(_months(spark, sf_dir, first, last), path, mode)
        for first, last, mode in loads
    ]
    return path, audits


def ingest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and their values per date after ranges that overlap and repeat were merged."""
    path, _ = _merged_loads(spark, sf_dir)
    return _rows_per_date(landing.read_landed(spark, path), "merge")


def ingest_merge_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of these loads took in and added."""
    _, audits = _merged_loads(spark, sf_dir)
    rows = [
        (load, audit.mode, audit.rows_extracted, audit.rows_loaded)
        for load, audit in enumerate(audits, start=1)
    ]
    return spark.createDataFrame(
        rows, "load bigint, mode string, rows_extracted bigint, rows_loaded bigint"
    )


def ingest_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column delivered as whole number, as fraction, as text and not at all, read back as one."""
    path = fresh_folder(spark, "drift")
    delivered = (
        F.col("pitch_number").cast("int"), F.col("pitch_number") / 2, F.col("home_team"), None
    )
    for month, extra in enumerate(delivered, start=4):
        pitches = _months(spark, sf_dir, month, month)
        landing.land_pitches(pitches if extra is None else pitches.withColumn("extra", extra), path)
    stored = landing.read_landed(spark, path, every_column=True)
    return stored.groupBy(F.col("month").cast("bigint").alias("month"), "extra").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


# reference feeds


def _registry_shards(spark: SparkSession, sf_dir: str) -> list[str]:
    """The registry written as sixteen CSV shards by the last hex digit of the id.

    Every third person also appears without an id, and every seventh with one that is no
    number; both must be dropped on the way in. Ids are written as floats, and the shards carry
    further columns between those that are read, as delivered.
    """
    players = raw_zone.RawZone(spark, sf_dir)["player_lookup"]
    known = players.select(
        F.lower(F.hex(F.col("mlbam_id") % 16)).alias("shard"),
        F.col("bbref_id").alias("key_person"),
        F.col("birth_year").cast("string").alias("birth_year"),
        F.col("mlbam_id").cast("double").cast("string").alias("key_mlbam"),
        F.lit("x").alias("key_uuid"),
        F.col("fangraphs_id").cast("string").alias("key_fangraphs"),
        F.col("bbref_id").alias("key_bbref"),
        F.col("last_name").alias("name_last"),
        F.col("first_name").alias("name_first"),
        F.col("given_name").alias("name_given"),
        F.col("mlb_debut_year").cast("string").alias("pro_played_first"),
        F.col("mlb_last_year").cast("string").alias("pro_played_last"),
        F.lit(1).alias("birth_month"),
    )
    bare_id = F.col("key_mlbam").cast("double").cast("bigint")
    without_id = known.where(bare_id % 3 == 0).withColumn("key_mlbam", F.lit(None).cast("string"))
    bad_id = known.where(bare_id % 7 == 0).withColumn("key_mlbam", F.lit("unknown"))
    folder = fresh_folder(spark, "registry")
    (
        known.unionAll(without_id)
        .unionAll(bad_id)
        .write.partitionBy("shard")
        .option("header", True)
        .csv(folder)
    )
    return [f"{folder}/shard={shard}" for shard in feeds.SHARDS]


def registry_shard_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.read_registry(spark, _registry_shards(spark, sf_dir))


def registry_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.shape_registry(feeds.read_registry(spark, _registry_shards(spark, sf_dir)))


def registry_id_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = feeds.read_registry(spark, _registry_shards(spark, sf_dir))
    return feeds.coerce_registry(feeds.shape_registry(registry))


def teams_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clubs of a league in one nested document, flattened; half lack the whole division object."""
    teams = raw_zone.RawZone(spark, sf_dir)["mlb_teams"]
    division = F.struct(F.col("division_id").alias("id"), F.col("division_name").alias("name"))
    club = F.struct(
        F.col("team_id").alias("id"),
        F.col("team_name").alias("name"),
        F.col("team_abbrev").alias("abbreviation"),
        F.col("team_short_name").alias("teamName"),
        F.col("location_name").alias("locationName"),
        F.struct(F.col("league_id").alias("id"), F.col("league_name").alias("name")).alias("league"),
        F.when(F.col("team_id") % 2 == 0, division).alias("division"),
    )
    path = fresh_folder(spark, "teams-feed")
    documents = teams.groupBy("league_name").agg(F.collect_list(club).alias("teams"))
    documents.select("teams").write.json(path)
    return feeds.flatten_teams(feeds.read_teams_feed(spark, path, lines=True))


def teams_json_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clubs of a feed with a field that is not declared and ids of the wrong kind, nothing of it lost."""
    teams = raw_zone.RawZone(spark, sf_dir)["mlb_teams"]
    club = F.struct(
        F.col("team_id").alias("id"),
        F.col("team_name").alias("name"),
        F.struct(
            F.when(F.col("team_id") % 3 == 0, F.lit("n/a")).otherwise(F.col("league_id").cast("string")).alias("id"),
            F.col("league_name").alias("name"),
        ).alias("league"),
        F.struct((F.col("team_id") + 1800).alias("year"), F.col("location_name").alias("city")).alias("founded"),
    )
    path = fresh_folder(spark, "teams-feed")
    documents = teams.groupBy("division_name").agg(F.collect_list(club).alias("teams"))
    documents.select("teams", F.lit("notice").alias("copyright")).write.json(path)
    flat = feeds.flatten_teams_delivered(feeds.read_feed(spark, path, lines=True))
    return flat.select(
        "team_id", "team_name", "league_id", "league_name", "venue_name",
        F.get_json_object("delivered", "$.founded.year").cast("bigint").alias("founded"),
        F.get_json_object("delivered", "$.founded.city").alias("city"),
        F.get_json_object("delivered", "$.league.id").alias("delivered_league"),
    )


def rosters_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both roster types, a nested document for each club, flattened again.

    Every club also has an empty document, which gives no row, and one spot without a person.
    """
    raw = raw_zone.RawZone(spark, sf_dir)
    spot = F.struct(
        F.when(
            F.col("mlbam_id").isNotNull(),
            F.struct(F.col("mlbam_id").alias("id"), F.col("player_full_name").alias("fullName")),
        ).alias("person"),
        F.col("jersey_number").alias("jerseyNumber"),
        F.struct(
            F.col("position_code").alias("code"),
            F.col("position_name").alias("name"),
            F.col("position_type").alias("type"),
        ).alias("position"),
        F.struct(
            F.col("status_code").alias("code"), F.col("status_description").alias("description")
        ).alias("status"),
    )
    path = fresh_folder(spark, "roster-feed")
    for roster_type, name in (("40Man", "mlb_rosters"), ("fullRoster", "mlb_roster_status")):
        spots = raw[name]
        clubs = raw["mlb_teams"].select("team_id")
        nameless = clubs.select(
            *(
                F.col("team_id") if field.name == "team_id"
                else F.lit(None).cast(field.dataType).alias(field.name)
                for field in spots.schema
            )
        )
        listed = spots.unionAll(nameless).select("team_id", spot.alias("spot"))
        documents = listed.groupBy("team_id").agg(F.collect_list("spot").alias("roster"))
        empty = clubs.select(
            "team_id", F.array().cast(documents.schema["roster"].dataType).alias("roster")
        )
        (
            documents.unionAll(empty)
            .withColumn("roster_type", F.lit(roster_type))
            .write.mode("append")
            .partitionBy("roster_type", "team_id")
            .json(path)
        )
    feed = feeds.read_roster_feed(spark, path, lines=True)
    return _labelled(feed, "40Man").unionAll(_labelled(feed, "fullRoster"))


def _labelled(feed: DataFrame, roster_type: str) -> DataFrame:
    return feeds.flatten_rosters(feed, roster_type).select(
        F.lit(roster_type).alias("roster_type"), "*"
    )
