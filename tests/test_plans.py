"""Plans: what reaches the scan, what is shuffled, and what must not appear."""

from __future__ import annotations

import re
from datetime import date

import pytest

import __spark_entry__ as contract
from fungo.plans.stored import StoredFacts
from fungo.plans.warehouse import Warehouse
from fungo.sources.raw_zone import RawZone

QUERIES = contract.queries()


def plan(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", ["rpt_batter_season", "rpt_pitcher_pitch_mix", "top_batters",
                                  "profile_outcome_distribution", "dim_roster_status"])
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert word not in text


def pitch_scans(text: str) -> int:
    return len(re.findall(r"Location: .*/statcast_pitches", text))


@pytest.mark.parametrize("name", ["mart_batter_game", "mart_pitcher_game"])
def test_facts_are_hashed_until_a_game_is_a_few_rows(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    text = plan(frame)
    assert "IsNotNull(pitch_type)" in text and pitch_scans(text) == 1
    columns = re.findall(r"ReadSchema: struct<(.*?)>", text)[0]
    assert "fielder_2" not in columns and "Expand" not in text
    tree = text.split("\n\n")[0]
    below_first_exchange = tree[tree.rindex("Exchange") :]
    assert "Sort" not in below_first_exchange
    if name == "mart_batter_game":
        assert "SortAggregate" not in text


@pytest.mark.parametrize(
    "name, scans",
    [
        ("rpt_league_batting", 0), ("rpt_league_pitching", 0), ("rpt_batter_season", 0),
        ("rpt_pitcher_season", 0), ("rpt_pitcher_pitch_mix", 0), ("dq_relationships", 0),
        ("dq_composite_grain", 0), ("dq_not_null", 1), ("dq_accepted_values", 1),
        ("dq_batter_recoverable", 0), ("profile_status_attach", 0), ("profile_team_coverage", 0),
        ("profile_team_distribution", 0), ("sem_batting_by_player", 0), ("all_player_ids", 0),
    ],
)
def test_only_staging_rules_read_pitches(spark, sf_dir, name, scans):
    assert pitch_scans(plan(QUERIES[name](spark, sf_dir))) == scans


@pytest.mark.parametrize(
    "name",
    ["profile_raw_summary", "profile_batter_mart", "profile_pitcher_mart", "season_combined_pitching"],
)
def test_distinct_counts_copy_no_rows(spark, sf_dir, name):
    assert "Expand" not in plan(QUERIES[name](spark, sf_dir))


def test_league_report_reads_its_columns_only(spark, sf_dir):
    text = plan(QUERIES["rpt_league_batting"](spark, sf_dir))
    assert len(re.findall(r"ReadSchema: struct<(.*?)>", text)[0].split(",")) == 5


def test_lookup_is_joined_after_the_fact_is_reduced(spark, sf_dir):
    tree = plan(QUERIES["sem_batting_by_player"](spark, sf_dir)).split("\n\n")[0]
    join = tree.index("Join")
    assert tree[join:].count("Aggregate") >= 4 and "Aggregate" in tree[:join]


def test_bounded_zone_prunes_every_table(spark, sf_dir):
    dates = (date(2026, 5, 1), date(2026, 5, 31))
    text = plan(Warehouse(RawZone(spark, sf_dir, dates)).rpt_batter_season)
    filters = re.findall(r"PartitionFilters: \[(.*?)\]\n", text)
    assert any("year" in found and "month" in found for found in filters)


def test_range_over_a_stored_fact_prunes_folders(spark, sf_dir):
    frame = QUERIES["batter_stints_in_range"](spark, sf_dir)
    filters = re.findall(r"PartitionFilters: \[(.*?)\]\n", plan(frame))[0]
    assert "year" in filters and "month" in filters
    stored = StoredFacts(spark, sf_dir, (date(2026, 5, 1), date(2026, 5, 31)))["mart_batter_game_stats"]
    tree = stored._jdf.queryExecution().executedPlan()
    assert stored.count() and "month" in tree.toString()


def test_date_range_prunes_folders(spark, sf_dir):
    text = plan(QUERIES["date_range_select"](spark, sf_dir))
    filters = re.findall(r"PartitionFilters: \[(.*?)\]\n", text)[0]
    assert "year" in filters and "month" in filters
    assert "GreaterThanOrEqual(game_date" in text


def test_profile_reads_its_input_once(spark, sf_dir):
    for name in ("profile_numeric", "profile_null_rates"):
        assert plan(QUERIES[name](spark, sf_dir)).count("Location: ") == 1


def test_dedup_cuts_rows_before_the_shuffle(spark, sf_dir):
    text = plan(Warehouse(RawZone(spark, sf_dir)).stg_mlb_roster_status)
    assert "Partial" in text and "WindowGroupLimit" in text


def test_top_k_does_not_sort_everything(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_pitchers"](spark, sf_dir))


def test_count_by_date_reads_two_columns(spark, sf_dir):
    text = plan(QUERIES["profile_pitches_by_date"](spark, sf_dir))
    assert "ReadSchema: struct<game_date:bigint,pitch_type:string>" in text


def scans(text: str) -> int:
    return len(re.findall(r"\nLocation: ", text))


@pytest.mark.parametrize(
    "name, tables, exchanges",
    [
        ("dq_not_null", 12, 12), ("dq_accepted_values", 2, 2), ("dq_unique", 5, 2), ("dq_join_keys", 2, 2),
        ("dq_composite_grain", 3, 2), ("dq_relationships", 5, 8), ("profile_status_attach", 4, 4),
        ("profile_team_coverage", 2, 2), ("profile_team_distribution", 3, 5),
    ],
)
def test_rules_and_profiles_scan_each_table_once(spark, sf_dir, name, tables, exchanges):
    frame = QUERIES[name](spark, sf_dir)
    text = plan(frame)
    assert scans(text) == tables
    tree = text.split("\n\n")[0]
    assert len(re.findall(r"[+:]- (?:\* )?Exchange", tree)) <= exchanges


def test_the_suite_scans_row_rules_and_key_rules_once(spark, sf_dir):
    """12 tables for rows, 9 for keys, 5 for references, 2 for clubs by game, 4 and 2 for totals and trades."""
    assert scans(plan(QUERIES["dq_full_suite"](spark, sf_dir))) <= 12 + 9 + 5 + 2 + 4 + 2
