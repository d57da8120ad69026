from __future__ import annotations

import math
import random

import numpy as np
import pytest

from fungo.llm import whitening
from fungo.llm.queries import op13_embedding_whitening

SCHEMA = "vec_id long, embedding array<float>"


def drawn(n: int, width: int, seed: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    mixing = rng.normal(size=(width, width)) / 8
    return [(k * 3, [float(v) for v in row]) for k, row in enumerate(rng.normal(size=(n, width)) @ mixing + 0.3)]


def plain(rows: list[tuple]) -> tuple[dict, np.ndarray, np.ndarray, int]:
    """Whole numbers of each kept row, the covariance, the centred rows and n, in plain arithmetic."""
    kept = []
    for vec_id, vector in rows:
        if vector and all(c is not None and math.isfinite(c) for c in vector):
            kept.append((vec_id, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in vector]))
    n = len(kept)
    sums = [sum(column) for column in zip(*(x for _, x in kept))]
    deviations = [(vec_id, sum((n * v - s) ** 2 for v, s in zip(x, sums))) for vec_id, x in kept]
    centred = np.array([[(n * v - s) / n for v, s in zip(x, sums)] for _, x in kept])
    return deviations, centred.T @ centred / n, centred, n


def check(found: list, rows: list[tuple]) -> None:
    deviations, covariance, centred, n = plain(rows)
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions[:, ::-1]
    components = min(8, len(values))
    assert len(found) == n * components
    assert {row.n for row in found} == {n}
    (error,) = {row.identity_error for row in found}
    assert error <= 1e-4
    for k in range(components):
        own = [row for row in found if row.component == k + 1]
        expected = centred @ directions[:, k] / math.sqrt(values[k])
        turn = 1 if sum(row.whitened for row in own if row.vec_id == deviations[-1][0]) * expected[-1] > 0 else -1
        wanted = sorted((i, d, turn * w) for (i, d), w in zip(deviations, expected))
        got = sorted((row.vec_id, row.deviation, row.whitened) for row in own)
        assert [row[:2] for row in got] == [row[:2] for row in wanted]
        assert np.allclose([row[2] for row in got], [row[2] for row in wanted], rtol=0, atol=1e-9)
        assert all(row.explained == pytest.approx(values[k] / np.trace(covariance), rel=1e-9) for row in own)


@pytest.mark.parametrize("n,width,block,task", [(300, 12, 1024, 1 << 25), (500, 9, 16, 2000), (130, 5, 7, 1)])
def test_equals_plain_arithmetic(spark, monkeypatch, n, width, block, task):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block)
    monkeypatch.setattr(whitening, "TASK_BYTES", task)
    rows = drawn(n, width, n)
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect(), rows)


def test_odd_vectors_are_left_out(spark):
    rows = drawn(90, 6, 2)
    odd = [(1, None), (2, []), (4, [0.1] * 5 + [None]), (5, [float("nan")] * 6), (7, [float("inf")] + [0.0] * 5)]
    odd += [(8, [0.1] * 5), (10, [1e30] + [0.0] * 5)]
    docs = spark.createDataFrame(rows + odd, SCHEMA).selectExpr("*", "1 as index", "2 as x", "3 as block", "4 as n")
    check(whitening.whiten(docs).collect(), rows)


def test_repeated_rows_and_ids(spark):
    rows = drawn(40, 4, 3)
    many = [(7, rows[0][1])] * 30 + rows + [rows[5]] * 3
    found = whitening.whiten(spark.createDataFrame(many + [(None, rows[1][1])], SCHEMA)).collect()
    _, _, _, n = plain(many + [(None, rows[1][1])])
    assert len(found) == 4 * n and sum(row.vec_id is None for row in found) == 4
    assert len({(row.component, row.whitened) for row in found if row.vec_id == 7}) == 4
    assert found[0].identity_error < 1e-9


def test_nothing_varies(spark):
    rows = [(k, [0.25, -0.5, 0.0]) for k in range(12)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 36 and {row.deviation for row in found} == {0}
    assert {(row.whitened, row.explained, row.identity_error) for row in found} == {(None, None, None)}


def test_one_dimension_varies(spark):
    rng = random.Random(1)
    rows = [(k, [rng.random(), 0.5, 0.5]) for k in range(50)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {row.whitened is None for row in found if row.component > 1} == {True}
    first = [row for row in found if row.component == 1]
    assert first[0].explained == pytest.approx(1) and first[0].identity_error < 1e-9
    assert np.std([row.whitened for row in first]) == pytest.approx(1)


def test_sums_stay_exact_beyond_a_long(spark):
    large = float(1 << 39)
    rows = [(k, [large if k % 2 else -large, 0.25]) for k in range(64)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 128 and {row.deviation for row in found} == {None}
    assert all(abs(row.whitened) == pytest.approx(1) for row in found if row.component == 1)


def test_empty_table(spark):
    found = whitening.whiten(spark.createDataFrame([], SCHEMA))
    assert found.columns == whitening.RESULT.names and found.count() == 0


def test_query(spark, tmp_path):
    rows = drawn(64, 8, 6)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    check(op13_embedding_whitening(spark, str(tmp_path)).collect(), rows)
