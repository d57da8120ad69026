from __future__ import annotations

import random

import pytest

from fungo.llm import hamming_search as h

SCHEMA = "vec_id long, embedding array<float>, code string, query int"


def plain_code(vector):
    return sum(1 << k for k, x in enumerate(vector) if x > 0)


def plain_nearest(rows, queries, k):
    codes = sorted({(i, plain_code(v)) for i, v in rows})
    result = []
    for i, code in sorted({(i, plain_code(v)) for i, v in queries}):
        others = sorted(((code ^ c).bit_count(), j) for j, c in codes if j != i)[:k]
        result += [(i, rank, j, d) for rank, (d, j) in enumerate(others, 1)]
    return result


@pytest.mark.parametrize("segments, k", [(5, 3), (8, 10)])
def test_equals_brute_force(spark, segments, k):
    rng = random.Random(segments)
    near = [rng.gauss(0, 1) for _ in range(64)]
    rows = []
    for i in range(120):
        if i % 4 == 0:
            vector = [x + rng.gauss(0, 0.7) for x in near]
        elif i % 4 == 1:
            vector = near
        else:
            vector = [rng.gauss(0, 1) for _ in range(64)]
        rows.append((i, vector))
    rows += [rows[3], (500, [0.0] * 64), (501, [-x for x in near])]
    bad = [(600, None), (601, [1.0] * 63), (602, [1.0] * 63 + [None]), (None, near), (603, [])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + bad], SCHEMA)
    codes = h.coded(frame)
    assert {r.id for r in codes.collect()} == {i for i, _ in rows}
    found = h.nearest(codes, codes.where("id % 20 = 0 or id > 400"), k, segments).collect()
    expected = plain_nearest(rows, [r for r in rows if r[0] % 20 == 0 or r[0] > 400], k)
    assert sorted(map(tuple, found)) == expected


def test_fewer_rows_than_neighbours_and_empty_table(spark):
    rows = [(i, [float(i == b) for b in range(64)], "x", 1) for i in range(4)]
    codes = h.coded(spark.createDataFrame(rows, SCHEMA))
    found = h.nearest(codes, codes.where("id = 0"), 10).collect()
    assert [(r.query_id, r.rank, r.neighbor_id, r.distance) for r in sorted(found)] == [
        (0, 1, 1, 2), (0, 2, 2, 2), (0, 3, 3, 2)
    ]
    empty = codes.limit(0)
    assert h.nearest(empty, empty).collect() == []


def test_rounds_cover_every_distance():
    for segments in (4, 5, 8):
        for radii, covered in h._rounds(segments):
            # A code missed by all segments differs in at least this many bits.
            assert sum(r + 1 for r in radii) > covered
        assert h._rounds(segments)[-1][1] >= 64


def test_a_third_of_all_vectors_equal(spark):
    rng = random.Random(4)
    same = [rng.gauss(0, 1) for _ in range(64)]
    rows = [(i, same if i % 3 == 0 else [rng.gauss(0, 1) for _ in range(64)]) for i in range(90)]
    codes = h.coded(spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA))
    found = h.nearest(codes, codes.where("id % 20 = 0")).collect()
    assert sorted(map(tuple, found)) == plain_nearest(rows, [r for r in rows if r[0] % 20 == 0], 10)
