"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from fungo.oracle import oracle_texts
from fungo.plans import registry
from tests.compare import connect, differences

QUERIES = registry.QUERIES
TEXTS = oracle_texts()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = connect(sf_dir)
    yield connection
    connection.close()


def test_every_query_has_a_text():
    assert set(QUERIES) == set(TEXTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches(spark, sf_dir, duck, name):
    assert differences(duck, TEXTS[name], QUERIES[name](spark, sf_dir)) == []


def test_entry_is_the_season_line(spark):
    frame = contract.entry(spark)
    assert frame.columns[:3] == ["batter_id", "batter_name", "batter_team"]
    assert frame.count() > 0
