from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fungo.llm import sharding as s

NAMES = [f"s{k}" for k in range(10)]


def plain_table(names, slots):
    """Each shard walks its whole permutation; turns are taken one slot at a time."""
    orders = []
    for name in sorted(names):
        offset, step = s._preference(name, slots)
        orders.append([(offset + k * step) % slots for k in range(slots)])
    table = [None] * slots
    while None in table:
        for name, order in zip(sorted(names), orders):
            free = next((slot for slot in order if table[slot] is None), None)
            if free is not None:
                table[free] = name
    return table


@pytest.mark.parametrize("slots", [11, 101, 211])
def test_table_equals_brute_force(slots):
    assert s.fill_table(NAMES, slots) == plain_table(NAMES, slots)


def test_shares_are_even_and_few_slots_move():
    table = s.fill_table(NAMES)
    sizes = [table.count(name) for name in NAMES]
    assert max(sizes) - min(sizes) <= 1
    less = s.fill_table(NAMES[:-1])
    moved = sum(a != b for a, b in zip(table, less) if a != NAMES[-1])
    assert moved / len(table) < 0.1


def test_order_of_names_does_not_matter():
    assert s.fill_table(NAMES[::-1], 101) == s.fill_table(NAMES, 101)


@pytest.mark.parametrize("names, slots", [([], 11), (["a", "a"], 11), (["a"], 12), (NAMES, 7)])
def test_wrong_arguments(names, slots):
    with pytest.raises(ValueError):
        s.fill_table(names, slots)


def test_placement(spark):
    rows = [(k, "x", k) for k in range(200)] + [(None, None, None), (None, "y", 2), (5, "z", 9)]
    frame = spark.createDataFrame(rows, "doc_id long, shard string, _extra int")
    placed = s.place(frame, F.col("doc_id"), NAMES, 101).collect()
    table = s.fill_table(NAMES, 101)
    hashes = dict(frame.select("doc_id", F.xxhash64("doc_id")).collect())
    assert len(placed) == len(rows)
    for row in placed:
        assert row.slot == hashes[row.doc_id] % 101 and row.shard == table[row.slot]
    assert "_extra" in placed[0].asDict()
    assert s.place(frame.limit(0), F.col("doc_id"), NAMES, 101).collect() == []


@pytest.mark.parametrize("clash", ["_slot", "_shard", "of_slot", "OF_SHARD", "slot"])
def test_clashing_names(spark, clash):
    frame = spark.createDataFrame([(k, f"own {k}") for k in range(20)], f"doc_id long, `{clash}` string")
    placed = s.place(frame, F.col("doc_id"), NAMES, 101)
    assert placed.columns == (["doc_id", "slot", "shard"] if clash == "slot" else ["doc_id", clash, "slot", "shard"])
    if clash != "slot":
        assert {row[clash] for row in placed.collect()} == {f"own {k}" for k in range(20)}
