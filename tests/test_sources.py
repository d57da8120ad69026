"""Landing, feeds, schema checks and the file stream."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F

from fungo.config import Config
from fungo.operators.game_facts import batter_games
from fungo.operators.staging import stage_pitches, stage_roster_status, stage_rosters
from fungo.plans.warehouse import Warehouse, former_versions, register
from fungo.schemas import PITCHES, TEAMS, SchemaDrift
from fungo.session import fresh_folder
from fungo.sources import derived, feeds, landing, loads
from fungo.streaming.incremental import ingest_new_files
from tests import small


def test_append_adds_and_refresh_replaces(spark):
    rows = small.pitches(spark, small.game())
    path = fresh_folder(spark, "test")
    first = landing.land_pitches(rows, path)
    again = landing.land_pitches(rows, path)
    assert (first.rows_extracted, first.rows_loaded, again.rows_loaded) == (11, 11, 11)
    stored = landing.read_landed(spark, path)
    assert stored.count() == 22
    assert landing.without_repeats(stored).count() == 11
    refreshed = landing.land_pitches(rows, path, "full-refresh")
    assert (refreshed.rows_loaded, landing.read_landed(spark, path).count()) == (11, 11)


def test_empty_extract_stops_the_load(spark):
    path = fresh_folder(spark, "test")
    landing.land_pitches(small.pitches(spark, small.game()), path)
    for mode in ("append", "full-refresh"):
        audit = landing.land_pitches(small.pitches(spark, []), path, mode)
        assert (audit.rows_extracted, audit.rows_loaded) == (0, 0)
    assert landing.read_landed(spark, path).count() == 11


def test_partition_follows_the_row_not_the_load(spark):
    rows = [small.pitch(1, 1), small.pitch(1, 1, game_date=small.FIRST_DAY_NS + 10 * small.DAY_NS)]
    path = fresh_folder(spark, "test")
    landing.land_pitches(small.pitches(spark, rows), path)
    found = landing.read_landed(spark, path).select("year", "month").distinct().collect()
    assert {(r.year, r.month) for r in found} == {(2026, 3), (2026, 4)}


def test_date_range_is_inclusive(spark):
    rows = [small.pitch(n, 1, game_date=small.FIRST_DAY_NS + n * small.DAY_NS) for n in range(10)]
    path = fresh_folder(spark, "test")
    landing.land_pitches(small.pitches(spark, rows), path)
    stored = landing.read_landed(spark, path)
    chosen = landing.in_date_range(stored, date(2026, 3, 30), date(2026, 4, 2))
    assert sorted(r.at_bat_number for r in chosen.collect()) == [3, 4, 5, 6]
    nothing = landing.in_date_range(stored, date(2026, 4, 2), date(2026, 3, 30))
    assert nothing.count() == 0


def test_nan_is_stored_as_null(spark):
    rows = [small.ball_in_play(1, 1, "single", float("nan"), "1", 1)]
    path = fresh_folder(spark, "test")
    landing.land_pitches(small.pitches(spark, rows), path)
    staged = stage_pitches(landing.read_landed(spark, path))
    assert batter_games(staged).first().hard_hit_count == 0


def test_chunks_stack_by_name(spark):
    whole = small.pitches(spark, small.game())
    part = small.pitches(spark, small.game()).drop("fielder_2")
    empty = small.pitches(spark, [])
    assert landing.union_chunks([whole, empty, part]).count() == 22
    with pytest.raises(ValueError):
        landing.union_chunks([])


def test_schema_drift_fails(spark):
    raw = small.raw_tables(spark)
    raw["mlb_teams"] = raw["mlb_teams"].withColumn("team_id", F.col("team_id").cast("string"))
    with pytest.raises(SchemaDrift, match="team_id"):
        Warehouse(raw).dim_team.count()
    raw = small.raw_tables(spark)
    raw["statcast_pitches"] = raw["statcast_pitches"].drop("events")
    with pytest.raises(SchemaDrift, match="events"):
        Warehouse(raw).stg_statcast_pitches.count()


def test_registry_shards(spark, tmp_path):
    header = ",".join(feeds.REGISTRY_NAMES)
    for number, path in enumerate(feeds.registry_paths(str(tmp_path))):
        lines = [header, f"{100 + number}.0,{number}.0,bb{number},Last,First,Given,1990.0,,1970.0"]
        if number == 0:
            lines += [",1.0,,NoId,,,,,", "abc,1.0,,BadId,,,,,"]
        with open(path, "w") as shard:
            shard.write("\n".join(lines) + "\n")
    registry = feeds.read_registry(spark, feeds.registry_paths(str(tmp_path)))
    assert registry.count() == 18
    shaped = feeds.shape_registry(registry)
    assert shaped.count() == 17
    typed = feeds.coerce_registry(shaped)
    assert sorted(r.mlbam_id for r in typed.collect()) == list(range(100, 116))
    assert dict(typed.dtypes)["mlbam_id"] == "bigint"
    assert typed.first().mlb_last_year is None


def test_teams_feed_is_null_safe(spark, tmp_path):
    document = {
        "teams": [
            {
                "id": 1, "name": "Club One", "abbreviation": "ONE", "teamName": "One",
                "locationName": "Town", "league": {"id": 103, "name": "AL"},
                "division": {"id": 201, "name": "East"}, "venue": {"name": "Park"},
            },
            {"id": 2, "name": "Club Two", "abbreviation": "TWO", "league": None},
        ]
    }
    (tmp_path / "teams.json").write_text(json.dumps(document, indent=1))
    rows = {r.team_id: r for r in feeds.flatten_teams(feeds.read_teams_feed(spark, str(tmp_path))).collect()}
    assert (rows[1].league_name, rows[1].division_id, rows[1].venue_name) == ("AL", 201, "Park")
    assert (rows[2].league_name, rows[2].division_id, rows[2].venue_name) == (None, None, None)


def test_roster_feed(spark, tmp_path):
    spot = {
        "person": {"id": 7, "fullName": "Bo Batts"}, "jerseyNumber": "9",
        "position": {"code": "7", "name": "Outfield", "type": "Outfielder"},
        "status": {"code": "A", "description": "Active"},
    }
    documents = {
        ("40Man", 1): {"roster": [spot, {"person": None, "jerseyNumber": "1"}]},
        ("40Man", 2): {"roster": []},
        ("fullRoster", 1): {"roster": [spot, {**spot, "person": {"id": 8}, "status": None}]},
    }
    for (kind, club), document in documents.items():
        folder = tmp_path / f"roster_type={kind}" / f"team_id={club}"
        folder.mkdir(parents=True)
        (folder / "roster.json").write_text(json.dumps(document, indent=1))
    feed = feeds.read_roster_feed(spark, str(tmp_path))
    forty = feeds.flatten_rosters(feed).collect()
    assert [(r.mlbam_id, r.team_id, r.position_code) for r in forty] == [(7, 1, "7")]
    full = feeds.flatten_rosters(feed, "fullRoster").orderBy("mlbam_id").collect()
    assert [(r.mlbam_id, r.status_code) for r in full] == [(7, "A"), (8, None)]


def test_feeds_keep_what_is_not_declared(spark, tmp_path):
    clubs = [
        {"id": 1, "name": "One", "league": {"id": "x", "name": "AL"}, "founded": 1901, "colors": ["red", None]},
        {"id": 2, "division": None},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"teams": clubs, "copyright": "c"}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"teams": []}))
    (tmp_path / "c.json").write_text(json.dumps({"other": 1}))
    flat = feeds.flatten_teams_delivered(feeds.read_feed(spark, str(tmp_path)))
    assert flat.columns == [*TEAMS.names, "delivered"] and flat.drop("delivered").schema == TEAMS
    rows = {r.team_id: r for r in flat.collect() if r.delivered}
    assert (rows[1].league_name, rows[1].league_id, rows[2].division_id) == ("AL", None, None)
    assert [json.loads(rows[n].delivered) for n in (1, 2)] == clubs


def test_delivered_rosters_equal_the_declared_ones(spark, tmp_path):
    spots = [
        {"person": {"id": 7, "fullName": "Bo"}, "position": {"code": "7"}, "status": None, "note": {"a": [1]}},
        {"person": None, "jerseyNumber": "1"},
    ]
    for kind, club in (("40Man", 1), ("40Man", 2), ("fullRoster", 1)):
        folder = tmp_path / f"roster_type={kind}" / f"team_id={club}"
        folder.mkdir(parents=True)
        (folder / "r.json").write_text(json.dumps({"roster": spots if club == 1 else []}))
    for kind in ("40Man", "fullRoster"):
        plain = feeds.flatten_rosters(feeds.read_roster_feed(spark, str(tmp_path)), kind)
        whole = feeds.flatten_rosters_delivered(feeds.read_feed(spark, str(tmp_path)), kind)
        assert whole.drop("delivered").collect() == plain.collect()
        assert [json.loads(r.delivered)["note"] for r in whole.collect()] == [{"a": [1]}]


def test_one_club_and_one_status_per_player(spark):
    rosters = [small.spot(1, 5), small.spot(1, 3), small.spot(2, 9)]
    status = [
        small.spot(1, 3, "RM"), small.spot(1, 5, "D10"),
        small.spot(2, 8, "A"), small.spot(2, 4, "D60"),
        small.spot(3, 6, None), small.spot(3, 2, "RM"),
    ]
    raw = small.raw_tables(spark, rosters=rosters, status=status)
    clubs = {r.mlbam_id: r.team_id for r in stage_rosters(raw["mlb_rosters"]).collect()}
    assert clubs == {1: 3, 2: 9}
    chosen = {
        r.mlbam_id: (r.team_id, r.availability, r.is_active)
        for r in stage_roster_status(raw["mlb_roster_status"]).collect()
    }
    assert chosen == {1: (5, "IL — 10-Day", False), 2: (8, "Active", True), 3: (2, "Minors", False)}


def test_layers_answer_sql(spark):
    warehouse = Warehouse(small.raw_tables(spark))
    config = Config(marts_database="marts_test", reporting_database="reporting_test", staging_database="staging_test")
    register(spark, warehouse, fresh_folder(spark, "layers"), config, saved=("staging", "reporting"))
    assert spark.sql("select count(*) n from reporting_test.rpt_pitcher_pitch_mix").first().n == 9
    assert spark.sql("select count(*) n from marts_test.mart_batter_game_stats").first().n == 2
    row = spark.sql(
        "select batter_name, hits from rpt_batter_season where batter_id = 10"
    ).first()
    assert (row.batter_name, row.hits) == ("Bo Batts", 1)
    assert spark.sql("select count(*) n from stg_statcast_pitches").first().n == 10
    assert spark.sql("select count(*) n from raw_statcast_pitches").first().n == 11


def test_registering_again_publishes_new_versions(spark, monkeypatch):
    config = Config(marts_database="marts_versions")
    place = fresh_folder(spark, "layers")
    register(spark, Warehouse(small.raw_tables(spark)), place, config)
    reader = spark.table("marts_versions.dim_team")
    more = small.raw_tables(spark, teams=[small.team(n, f"T{n}") for n in range(5)])
    register(spark, Warehouse(more), place, config)
    assert (reader.count(), spark.table("marts_versions.dim_team").count()) == (2, 5)
    old = former_versions(spark, "marts_versions", 0)
    assert len(old) == 4 and former_versions(spark, "marts_versions", 1) == []
    spark.sql(f"drop table marts_versions.{old[-1]}")
    broken = small.raw_tables(spark)
    fails = F.raise_error(F.lit("bad row")).cast("string")
    broken["mlb_teams"] = broken["mlb_teams"].withColumn("team_name", fails)
    with pytest.raises(Exception, match="bad row"):
        register(spark, Warehouse(broken), place, config)
    assert spark.table("marts_versions.dim_team").count() == 5


def test_stream_picks_each_file_up_once_and_reopens_late_games(spark):
    zone, mart, progress = (fresh_folder(spark, name) for name in ("drops", "mart", "progress"))
    next_day = small.FIRST_DAY_NS + small.DAY_NS
    drops = [
        [small.pitch(1, 1, events="single"), small.pitch(1, 1, game_pk=2, game_date=next_day)],
        [small.pitch(2, 1, events="double")],
    ]
    sizes = []
    for drop in (*drops, None):
        if drop:
            landing.land_pitches(small.pitches(spark, drop), zone)
        ingest_new_files(spark, zone, mart, progress, batter_games)
        stored = spark.read.parquet(mart)
        sizes.append(sorted((r.game_id, r.total_pitches, r.hits) for r in stored.collect()))
    assert sizes == [[(1, 1, 1), (2, 1, 0)], [(1, 2, 2), (2, 1, 0)], [(1, 2, 2), (2, 1, 0)]]
    every = landing.read_landed(spark, zone).select(*PITCHES.names)
    fresh = batter_games(stage_pitches(every))
    assert fresh.exceptAll(spark.read.parquet(mart).select(*fresh.columns)).count() == 0


def full_and_incremental(spark, drops):
    """Facts built from all drops at once, and by one refresh for each drop."""
    zone, mart, progress = (fresh_folder(spark, name) for name in ("drops", "mart", "progress"))
    for drop in drops:
        landing.land_pitches(small.pitches(spark, drop), zone)
        ingest_new_files(spark, zone, mart, progress, batter_games)
    full = batter_games(stage_pitches(landing.read_landed(spark, zone).select(*PITCHES.names)))
    return full, spark.read.parquet(mart).select(*full.columns)


def test_late_pitch_with_another_time_of_day_reopens_its_date(spark):
    hour = small.DAY_NS // 24
    drops = [
        [small.pitch(1, 1, events="single")],
        [small.pitch(2, 1, events="double", game_date=small.FIRST_DAY_NS + hour)],
    ]
    full, mart = full_and_incremental(spark, drops)
    assert full.exceptAll(mart).count() == mart.exceptAll(full).count() == 0
    assert sum(row.total_pitches for row in mart.collect()) == 2


def test_pitches_without_a_date_reach_the_mart(spark):
    drops = [
        [small.pitch(1, 1, events="single"), small.pitch(1, 1, game_pk=3, game_date=None)],
        [small.pitch(2, 1, game_pk=3, game_date=None, events="double")],
    ]
    full, mart = full_and_incremental(spark, drops)
    assert full.exceptAll(mart).count() == mart.exceptAll(full).count() == 0
    assert sum(row.total_pitches for row in mart.collect()) == 3


def test_audit_counts_rows_without_a_date(spark):
    rows = [small.pitch(1, 1), small.pitch(1, 2, game_date=None)]
    path = fresh_folder(spark, "test")
    for _ in range(2):
        audit = landing.land_pitches(small.pitches(spark, rows), path)
        assert (audit.rows_extracted, audit.rows_loaded) == (2, 2)
    assert landing.read_landed(spark, path).count() == 4
    audit = landing.land_pitches(small.pitches(spark, rows[:1]), path, "full-refresh")
    assert (audit.rows_extracted, audit.rows_loaded) == (1, 1)


def test_every_delivered_column_is_landed(spark):
    path = fresh_folder(spark, "test")
    pitches = small.pitches(spark, small.game())
    landing.land_pitches(pitches.withColumn("sv_id", F.lit("s")), path)
    landing.land_pitches(pitches, path)
    stored = landing.read_landed(spark, path, every_column=True)
    assert {r.sv_id: r["count"] for r in stored.groupBy("sv_id").count().collect()} == {"s": 11, None: 11}
    assert "sv_id" not in landing.read_landed(spark, path).columns


@pytest.mark.parametrize(
    "first, second, kind",
    [
        ("int", "string", "string"), ("int", "double", "double"), ("tinyint", "bigint", "bigint"),
        ("date", "timestamp", "timestamp"), ("decimal(5,2)", "int", "decimal(12,2)"), ("boolean", "int", "string"),
        ("array<int>", "array<string>", "array<string>"),
        ("struct<a:int>", "struct<a:string,b:int>", "struct<a:string,b:int>"),
    ],
)
def test_extra_columns_are_read_in_their_common_type(spark, first, second, kind):
    path = fresh_folder(spark, "test")
    pitches = small.pitches(spark, small.game())
    for delivered in (first, second, None):
        extra = pitches if delivered is None else pitches.withColumn("extra", F.lit(None).cast(delivered))
        landing.land_pitches(extra, path)
    stored = landing.read_landed(spark, path, every_column=True)
    assert dict(stored.dtypes)["extra"] == kind and stored.count() == 33


def test_int_then_text_then_fraction_keep_their_values(spark):
    path = fresh_folder(spark, "test")
    pitches = small.pitches(spark, small.game()).limit(2)
    for value in (F.lit(7), F.lit("x"), F.lit(0.5), F.lit(None)):
        landing.land_pitches(pitches.withColumn("Extra", value), path)
    found = landing.read_landed(spark, path, every_column=True)
    assert sorted(row.Extra or "" for row in found.collect()) == ["", "", "0.5", "0.5", "7", "7", "x", "x"]


def test_a_clash_without_a_common_type_fails_before_it_is_landed(spark):
    path = fresh_folder(spark, "test")
    pitches = small.pitches(spark, small.game())
    landing.land_pitches(pitches.withColumn("extra", F.lit(1)), path)
    listed = pitches.withColumn("EXTRA", F.array(F.lit(1)))
    with pytest.raises(SchemaDrift, match="extra: int before, array<int> now"):
        landing.land_pitches(listed, path)
    assert landing.read_landed(spark, path, every_column=True).count() == 11
    landing.land_pitches(listed, path, "full-refresh")
    assert dict(landing.read_landed(spark, path, every_column=True).dtypes)["EXTRA"] == "array<int>"


def test_a_reader_keeps_the_version_it_began_with(spark):
    path = fresh_folder(spark, "test")
    landing.land_pitches(small.pitches(spark, small.game()), path)
    before = landing.read_landed(spark, path)
    landing.land_pitches(small.pitches(spark, small.game()[:4]), path, "full-refresh")
    assert (before.count(), landing.read_landed(spark, path).count()) == (11, 4)
    (old,) = loads.replaced_folders(spark, path, -1)
    assert spark.read.parquet(old).count() == 11
    assert loads.replaced_folders(spark, path, 1) == []


def test_a_refresh_that_dies_changes_nothing(spark, monkeypatch):
    path = fresh_folder(spark, "test")
    teams = small.raw_tables(spark)["mlb_teams"]
    landing.land_pitches(small.pitches(spark, small.game()), path)
    landing.land_table(teams, f"{path}-teams")

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(loads, "commit", dies)
    with pytest.raises(RuntimeError, match="lost"):
        landing.land_pitches(small.pitches(spark, small.game()[:3]), path, "full-refresh")
    with pytest.raises(RuntimeError, match="lost"):
        landing.land_table(teams.limit(1), f"{path}-teams")
    broken = small.pitches(spark, small.game()).withColumn("extra", F.raise_error(F.lit("bad row")).cast("int"))
    with pytest.raises(Exception, match="bad row"):
        landing.land_pitches(broken, path, "full-refresh")
    assert landing.read_landed(spark, path).count() == 11
    assert landing.read_reference(spark, f"{path}-teams", "mlb_teams").count() == 2


def test_loads_at_once_count_their_own_rows(spark):
    path = fresh_folder(spark, "test")
    sizes = list(range(1, 7))
    frames = [small.pitches(spark, small.game()[:n]) for n in sizes]
    with ThreadPoolExecutor(len(sizes)) as pool:
        audits = list(pool.map(lambda frame: landing.land_pitches(frame, path), frames))
    assert [(a.rows_extracted, a.rows_loaded) for a in audits] == [(n, n) for n in sizes]
    assert landing.read_landed(spark, path).count() == sum(sizes)


def on_day(day, *numbers, **values):
    return [small.pitch(n, 1, game_date=small.FIRST_DAY_NS + day * small.DAY_NS, **values) for n in numbers]


def test_a_range_merged_twice_equals_one_load(spark):
    path, once = fresh_folder(spark, "test"), fresh_folder(spark, "test")
    april, may = on_day(10, 1, 2, 3), on_day(40, 1, 2, game_pk=5)
    landing.land_pitches(small.pitches(spark, april + may), path)
    landing.land_pitches(small.pitches(spark, april + may), once)
    kept = {f for f in landing.read_landed(spark, path).inputFiles() if "/month=5/" in f}
    audits = [
        landing.land_pitches(small.pitches(spark, april + on_day(11, 9)), path, "merge") for _ in range(2)
    ]
    assert [(a.rows_extracted, a.rows_loaded) for a in audits] == [(4, 1), (4, 0)]
    landing.land_pitches(small.pitches(spark, on_day(11, 9)), once)
    stored, expected = (landing.read_landed(spark, p) for p in (path, once))
    assert stored.exceptAll(expected).count() == expected.exceptAll(stored).count() == 0
    assert kept and {f for f in stored.inputFiles() if "/month=5/" in f} == kept


def test_a_merge_takes_the_delivered_copy_in_any_order(spark):
    path = fresh_folder(spark, "test")
    landing.land_pitches(small.pitches(spark, on_day(10, 1, 2, events="single")), path)
    copies = on_day(10, 1, events="double") + on_day(10, 1, events="triple")
    found = set()
    for delivered in (copies, copies[::-1]):
        audit = landing.land_pitches(small.pitches(spark, delivered), path, "merge")
        assert audit.rows_loaded == 0
        found.add(tuple(sorted((r.at_bat_number, r.events) for r in landing.read_landed(spark, path).collect())))
    assert len(found) == 1 and found.pop()[0][1] in ("double", "triple")


def test_a_merge_keeps_rows_without_a_key_and_columns_of_both_sides(spark):
    path = fresh_folder(spark, "test")
    nameless = on_day(10, None, None)
    landing.land_pitches(small.pitches(spark, nameless + on_day(10, 1)).withColumn("extra", F.lit(1)), path)
    landing.land_pitches(small.pitches(spark, nameless).withColumn("extra", F.lit("x")), path, "merge")
    rows = landing.read_landed(spark, path, every_column=True).collect()
    assert sorted((r.at_bat_number or 0, r.extra) for r in rows) == [(0, "1"), (0, "1"), (0, "x"), (0, "x"), (1, "1")]


def test_a_merge_keeps_one_of_stored_and_one_of_delivered_repeats(spark):
    path = fresh_folder(spark, "test")
    first = on_day(10, 1, 2, 3, events="single") + on_day(40, 7, 8, events="single")
    for rows in (first, on_day(10, 2, events="walk"), on_day(40, 7, events="walk")):
        landing.land_pitches(small.pitches(spark, rows), path)
    delivered = on_day(10, 3, 4, events="double") + on_day(11, 4, events="triple") + on_day(41, 8, events="double")
    audit = landing.land_pitches(small.pitches(spark, delivered), path, "merge")
    assert (audit.rows_extracted, audit.rows_loaded) == (4, -1)
    found = {r.at_bat_number: r.events for r in landing.read_landed(spark, path).collect()}
    assert landing.read_landed(spark, path).count() == len(found) == 6
    assert (found[1], found[3], found[8]) == ("single", "double", "double")
    assert {found[2], found[7]} <= {"single", "walk"} and found[4] in ("double", "triple")


def test_a_merge_moves_no_row_that_it_only_replaces(spark, monkeypatch):
    path, plans = fresh_folder(spark, "test"), []
    written = landing.write_months

    def seen(rows, folder):
        plans.append(rows._jdf.queryExecution().sparkPlan().toString())
        written(rows, folder)

    monkeypatch.setattr(landing, "write_months", seen)
    rows = small.pitches(spark, on_day(10, 1, 2, 3))
    landing.land_pitches(rows, path)
    landing.land_pitches(rows, path, "merge")
    assert not any(step in plans[-1] for step in ("Exchange", "Sort", "Window", "Join"))
    assert landing.read_landed(spark, path).count() == 3


def test_rows_move_before_repeats_are_sorted_out(spark):
    path = fresh_folder(spark, "test")
    for _ in range(2):
        landing.land_pitches(small.pitches(spark, on_day(10, 1, 2, 3)), path)
    once = landing.without_repeats(landing.read_landed(spark, path)).select("game_date", "batter", "home_team")
    steps = once._jdf.queryExecution().executedPlan().toString().split("Scan parquet")[0]
    # The tree has the scan last: nothing is sorted or joined below the only move of the rows.
    assert steps.count("Exchange") == 1 and "Sort" not in steps.split("Exchange")[1]
    assert once.count() == 3


def test_a_merge_into_nothing_and_of_nothing(spark):
    path = fresh_folder(spark, "test")
    assert landing.land_pitches(small.pitches(spark, []), path, "merge").rows_loaded == 0
    rows = small.pitches(spark, on_day(10, 1) + [small.pitch(1, 1, game_pk=8, game_date=None)])
    assert landing.land_pitches(rows, path, "merge").rows_loaded == 2
    assert landing.land_pitches(rows, path, "merge").rows_loaded == 0
    assert landing.read_landed(spark, path).count() == 2
    with pytest.raises(ValueError, match="mode"):
        landing.land_pitches(rows, path, "replace")


def test_registry_shards_are_read_by_name(spark, tmp_path):
    names = list(feeds.REGISTRY_NAMES)
    orders = [["key_person", *names[::-1], "birth_month"], [*names[4:], "key_uuid", *names[:4]]]
    paths = []
    for k, order in enumerate(orders):
        values = dict.fromkeys(order, "x") | {name: f"{name}{k}" for name in names}
        (tmp_path / f"{k}.csv").write_text(f"{','.join(order)}\n{','.join(values[n] for n in order)}\n")
        paths.append(str(tmp_path / f"{k}.csv"))
    found = sorted(map(tuple, feeds.read_registry(spark, paths).collect()))
    assert found == [tuple(f"{name}{k}" for name in feeds.REGISTRY_SHARD.names) for k in range(2)]
    (tmp_path / "2.csv").write_text("key_person\nx\n")
    with pytest.raises(SchemaDrift, match="key_mlbam"):
        feeds.read_registry(spark, [*paths, str(tmp_path / "2.csv")])


LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_linestatus string"
)


@pytest.mark.parametrize("most", [2, 40, 100_000])
def test_pitches_are_numbered_alike_whether_cut_or_not(spark, monkeypatch, most):
    """A large plate appearance is numbered by slices, others at once; lines without a place count, and go."""
    monkeypatch.setattr(derived, "MOST_AT_ONCE", most)
    rows = [(k % 3, 7919 * k % 20_000, k, 1 + k % 7, float(k), 1.0, 0.0, "OF"[k % 5 == 0]) for k in range(300)]
    rows += [(0, None, 1, 1, 1.0, 1.0, 0.0, "O"), (1, 5, 1, None, 1.0, 1.0, 0.0, "O"), (None, 5, 1, 1, 1.0, 1.0, 0.0, "O")]
    found = derived.pitches(spark.createDataFrame(rows, LINES)).select(
        "at_bat_number", "pitch_number", "events", "release_speed"
    )
    expected = []
    for at_bat, order, status in ((2 * k + 1 + (s == "F"), k, s) for k in range(3) for s in "OF"):
        own = [r for r in rows if r[0] == order and r[7] == status]
        first = [r for r in own if r[1] is None or r[3] is None]
        rest = sorted((r for r in own if r not in first), key=lambda r: (r[3], r[1], r[2], r[5]))
        for place, row in enumerate(rest, start=len(first) + 1):
            speed = None if row[2] % 29 == 0 else 80 + row[4] * 0.375
            expected.append((at_bat, place, place == len(own), speed))
    got = [(r.at_bat_number, r.pitch_number, r.events is not None, r.release_speed) for r in found.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_landing_writes_rows_where_they_lie(spark):
    """Every task adds a file to its months: the wide rows are neither shuffled nor sorted for the write."""
    days = [small.FIRST_DAY_NS + k * small.DAY_NS for k in range(40)]
    rows = small.pitches(spark, [small.pitch(k, 1, game_date=day) for k, day in enumerate(days)])
    path = fresh_folder(spark, "test")
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    assert landing.land_pitches(rows.repartition(3), path).rows_loaded == 40
    assert spark.conf.get(key, None) == before
    stored = landing.read_landed(spark, path)
    april = [f for f in stored.inputFiles() if "/month=4/" in f]
    assert len(april) == 3
    assert sorted(r.game_date for r in stored.collect()) == days


def wide_projections(frame) -> int:
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    return sum(line.lstrip(" +-:").startswith("Project") and "fielder_2" in line for line in plan.split("\n"))


def test_landing_makes_a_wide_row_once(spark, monkeypatch):
    """Types, missing values and months are settled in one projection; a second one would copy every wide row."""
    written, plans = landing.write_months, []

    def seen(rows, folder):
        plans.append(wide_projections(rows))
        written(rows, folder)

    monkeypatch.setattr(landing, "write_months", seen)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        rows = [(k, k, k, 1 + k % 7, float(k), 1.0, 0.0, "O") for k in range(40)]
        audit = landing.land_pitches(derived.pitches(spark.createDataFrame(rows, LINES)), fresh_folder(spark, "test"))
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert (audit.rows_extracted, audit.rows_loaded, plans) == (40, 40, [1])


def test_pitches_are_numbered_in_one_pass_and_only_crowded_cells_counted_by_plate(spark, monkeypatch):
    rows = [(k % 9, k, k, 1 + k % 7, float(k), 1.0, 0.0, "OF"[k % 5 == 0]) for k in range(300)]
    lines = spark.createDataFrame(rows, LINES)
    steps = derived.pitches(lines)._jdf.queryExecution().sparkPlan().toString()
    assert steps.count("Window [row_number") == 1 and "Window [count" not in steps
    plates = lines.selectExpr("l_orderkey as game_pk", "l_linenumber as at_bat_number")
    sizes = {(r.game_pk, r.at_bat_number): r["count"] for r in plates.groupBy("game_pk", "at_bat_number").count().collect()}
    for most, cells in ((4, 1 << 16), (4, 2), (100_000, 2)):
        monkeypatch.setattr(derived, "MOST_AT_ONCE", most)
        monkeypatch.setattr(derived, "CELLS", cells)
        found = {(r.game_pk, r.at_bat_number): r.n for r in derived._large(plates).collect()}
        assert found == {plate: n for plate, n in sizes.items() if n > most}
