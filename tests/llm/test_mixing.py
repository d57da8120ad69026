from __future__ import annotations

import itertools
import random

import pytest

from fungo.llm import mixing as m

SCHEMA = "doc_id long, text string, source string, slot string, epoch int"


@pytest.mark.parametrize("seed", range(12))
def test_schedule_meets_every_window_and_stays_within_a_block(seed):
    rng = random.Random(seed)
    shares = {f"s{k}": rng.random() ** 3 + 0.001 for k in range(rng.randint(1, 25))}
    weights = m.whole_weights(shares, 500)
    assert sum(weights.values()) == 500
    rows = m.schedule(weights)
    assert [row[2] for row in rows] == list(range(500))
    given = dict.fromkeys(weights, 0)
    for source, block, slot, release, deadline in rows:
        assert block == given[source] and release <= slot < deadline
        assert release == block * 500 // weights[source]
        given[source] += 1
        for name, count in given.items():
            assert abs(count - (slot + 1) * weights[name] / 500) < 1
    assert given == weights


def test_weights_are_near_their_shares():
    assert m.whole_weights({"a": 2, "b": 1, "c": 1}, 4) == {"a": 2, "b": 1, "c": 1}
    assert m.whole_weights({"a": 1e9, "b": 1, None: 1}, 10) == {"a": 8, "b": 1, None: 1}
    with pytest.raises(ValueError):
        m.whole_weights(dict.fromkeys(range(11), 1.0), 10)


def plain_mix(rows, hashes, weights, period, block_chars):
    """Blocks by running sums of each source, and the schedule stepped slot by slot."""
    by_source = {}
    for doc, text, source in sorted(rows, key=lambda r: (hashes[r[0], r[1]], r[0] or 0, len(r[1] or ""))):
        by_source.setdefault(source, []).append((doc, max(1, len(text or ""))))
    blocks = {}
    for source, docs in by_source.items():
        at, parts = 0, []
        for doc, size in docs:
            parts.append((doc, at // block_chars))
            at += size
        blocks[source] = (-(-at // block_chars), parts)
    timetable = m.schedule(weights)
    result, used, slot, left = [], dict.fromkeys(blocks, 0), 0, set(blocks)
    while left:
        source = timetable[slot % period][0]
        count, parts = blocks[source]
        epoch, block = divmod(used[source], count)
        result += [(doc, source, epoch, used[source], slot) for doc, b in parts if b == block]
        used[source] += 1
        if used[source] == count:
            left.discard(source)
        slot += 1
    return result


@pytest.mark.parametrize("shares", [None, {"hot": 1.0, "a": 1.0, "b": 3.0, None: 0.5}])
def test_equals_stepping_through_the_slots(spark, shares):
    rng = random.Random(6)
    rows = []
    for k in range(300):
        source = rng.choice(["hot", "hot", "hot", "a", "b", None])
        rows.append((k, "x" * rng.randint(0, 400), source))
    rows += [(900, None, "a"), (901, "", "a"), (902, "y" * 20_000, "b"), (None, "zz", "hot"), rows[4]]
    frame = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)
    measured = m._measured(frame).select("doc_id", "source", "order", "chars")
    hashes = {}
    from pyspark.sql import functions as F

    for row in frame.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h")).collect():
        hashes[row.doc_id, row.text] = row.h
    sizes = {r.source: r.n for r in measured.groupBy("source").agg(F.sum("chars").alias("n")).collect()}
    weights = m.whole_weights(shares or m.tempered(sizes), 50)
    found = m.mix(frame, shares, period=50, block_chars=500, slice_rows=16).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r.doc_id, r.source, r.epoch, r.block, r.slot) for r in found), key=key) == sorted(
        plain_mix(rows, hashes, weights, 50, 500), key=key
    )
    assert {r.doc_id for r in found} == {r[0] for r in rows}
    assert all(r.release <= r.slot < r.deadline for r in found)

    ordered = m.in_order(frame, m.mix(frame, shares, period=50, block_chars=500)).collect()
    places = {}
    for r in m.mix(frame, shares, period=50, block_chars=500).collect():
        places.setdefault(r.doc_id, []).append((r.slot, r.start))
    assert len(ordered) == len(found) and ordered[0].asDict().keys() == set(frame.columns)
    slots = [places[r.doc_id].pop(0) if len(places[r.doc_id]) == 1 else None for r in ordered]
    known = [slot for slot in slots if slot is not None]
    assert known == sorted(known)


def deviations(rows, share):
    """The largest distance of each source from its share of the slots so far; one source a slot."""
    given, worst = dict.fromkeys(share, 0), dict.fromkeys(share, 0.0)
    for slot, source in enumerate(rows):
        given[source] += 1
        for name, count in given.items():
            worst[name] = max(worst[name], abs(count - (slot + 1) * share[name]))
    return worst


def test_shares_far_below_a_thousandth_hold_over_many_slots(spark):
    rows = [(k, "x" * 10, "big") for k in range(9000)] + [(k, "y" * 10, "mid") for k in range(9000, 10_000)]
    rows += [(20_000, "z" * 10, "rare"), (20_001, "z" * 10, None)]
    frame = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)
    shares = {"big": 0.9 - 2e-4 - 1 / 3000, "mid": 0.1 + 1 / 3000, "rare": 1e-4, None: 1e-4}
    found = sorted(m.mix(frame, shares, block_chars=10).collect(), key=lambda r: r.slot)
    assert [r.slot for r in found] == list(range(len(found)))
    assert all(r.release <= r.slot < r.deadline for r in found)
    assert max(deviations([r.source for r in found], shares).values()) < 1
    assert {r.doc_id for r in found} == {r[0] for r in rows}


def test_a_small_document_comes_up_as_often_as_its_share_says(spark):
    rows = [(k, "x" * 100, "big") for k in range(8000)] + [(9000, "z" * 5, "small")]
    frame = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)
    used = {True: 0, False: 0}
    for row in m.mix(frame, block_chars=20).collect():
        used[row.source == "small"] += 1
    # Tempered sizes ask for (800,000 / 5) ** 0.1 = 3.3 uses for each of the other source.
    assert used[False] == 8000 and 3 <= used[True] <= 4


def test_more_than_a_thousand_sources(spark):
    rows = [(k, "x" * (1 + k % 7), f"host{k % 1300}") for k in range(4000)]
    frame = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)
    found = m.mix(frame, block_chars=8).collect()
    assert {r.doc_id for r in found} == {r[0] for r in rows}
    assert all(r.release <= r.slot < r.deadline for r in found)
    assert m.in_order(frame, m.mix(frame, block_chars=8)).count() == len(found)


@pytest.mark.parametrize("seed", range(8))
def test_snapshots_continue_the_same_slots(seed):
    rng = random.Random(seed)
    weights = m.exact_weights({k and f"s{k}" or None: rng.random() + 0.05 for k in range(rng.randint(1, 12))})
    blocks = {name: rng.randint(1, 40) for name in weights}
    whole = list(m.until_used(weights, blocks))
    for every in (1, 7, 1000, len(whole)):
        parts = []
        for first, n, following in m.snapshots(weights, blocks, every):
            assert n <= every
            parts += list(itertools.islice(m.slots(weights, first, following), n))
        assert parts == whole


def test_many_snapshots_give_the_same_mix_without_a_broadcast(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(k, "x" * rng.randint(0, 60), rng.choice(["hot", "hot", "a", None])) for k in range(500)]
    frame = spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)
    whole = m.mix(frame, block_chars=20)
    monkeypatch.setattr(m, "SNAPSHOT_SLOTS_A_SOURCE", 1)
    parts = m.mix(frame, block_chars=20, snapshot_slots=13)
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    tree = whole._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in tree and "Broadcast" not in tree.split("SortMergeJoin")[0]


def test_clashing_names(spark):
    rows = [(k, "x" * 30, "a", k) for k in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, Key int")
    frame = frame.selectExpr("*", "1 as slot", "2 as start", "3 as `order`", "4 as order_")
    found = m.in_order(frame, m.mix(frame, block_chars=50))
    assert found.columns == frame.columns and {r.Key for r in found.collect()} == set(range(20))


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert m.mix(frame).collect() == []
    assert m.in_order(frame, m.mix(frame)).collect() == []
