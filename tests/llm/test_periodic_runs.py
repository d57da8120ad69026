from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fungo.llm import ntt, periodic_runs
from fungo.llm.periodic_runs import collapsed, runs_of
from fungo.llm.queries import op11_periodic_runs, with_planted_runs

SCHEMA = "doc_id long, text string"


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """Every period, every stretch, every smaller period."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            stretch = words[start : start + length]
            if length >= max(6, 4 * q) and all(stretch[p:] != stretch[:-p] for p in range(1, q)):
                found.append((start, length, q))
            i = max(i, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def planted(doc_id: int, words: list[str]) -> list[str]:
    checksum, n = zlib.crc32(str(doc_id).encode()), len(words)
    if checksum % 10 or not n:
        return words
    g = checksum // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def drawn(rng: random.Random, n: int, kinds: int) -> list[bytes]:
    words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
    if n > 6 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randrange(3, 9)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.fixture(scope="module")
def documents() -> list[list[bytes]]:
    rng = random.Random(11)
    sizes = [0, 1, 5, 6, 7, 20, 64, 150, 400]
    return [drawn(rng, rng.choice(sizes), rng.choice([1, 2, 3, 5, 50])) for _ in range(500)]


@pytest.mark.parametrize("size", [1, 2, 64, 128, 4096, 8192])
def test_transforms_multiply_exactly(size):
    rng = np.random.default_rng(size)
    for prime in ntt.PRIMES:
        a, b = rng.integers(0, prime, (2, 3, size))
        turned = [ntt.forward(ntt.reduced(x.astype(float), prime), prime) for x in (a, b)]
        product = ntt.inverse(ntt.reduced(turned[0] * turned[1], prime), prime)
        at = rng.integers(0, size)
        for row in range(3):
            plain = sum(int(a[row, i]) * int(b[row, (at - i) % size]) for i in range(size))
            assert (plain - int(product[row, at])) % prime == 0


def test_primes_cover_the_largest_sum():
    assert ntt.primes_beyond(10) == ntt.PRIMES[:1]
    assert ntt.primes_beyond(ntt.PRIMES[0]) == ntt.PRIMES[:2]
    assert len(ntt.primes_beyond(ntt.PRIMES[0] * ntt.PRIMES[1])) == 3
    for prime in ntt.PRIMES:
        assert all(prime % d for d in range(2, int(prime**0.5) + 1))


def test_equals_every_period_tried(documents):
    found = runs_of(documents)
    assert found == [plain_runs(words) for words in documents]
    assert sum(map(len, found)) > 100


def test_groups_and_short_blocks_change_nothing(documents, monkeypatch):
    whole = runs_of(documents)
    monkeypatch.setattr(periodic_runs, "GROUP", 90)
    assert runs_of(documents) == whole
    monkeypatch.setattr(periodic_runs, "LONGEST_BLOCK", 4)
    assert runs_of(documents) == whole
    monkeypatch.setattr(periodic_runs, "POINTS", 8)
    assert runs_of(documents) == whole


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=80))
def test_two_words(words):
    assert runs_of([words]) == [plain_runs(words)]


def test_smallest_period_least_lengths_and_nesting():
    assert runs_of([[b"a"] * 5]) == [[]]
    assert runs_of([[b"a"] * 6]) == [[(0, 6, 1)]]
    assert runs_of([[b"a", b"b"] * 4, [b"a", b"b"] * 3 + [b"a"]]) == [[(0, 8, 2)], []]
    inner = [b"x"] * 6 + [b"y"]
    assert runs_of([inner * 4])[0] == [(0, 6, 1), (0, 28, 7), (7, 6, 1), (14, 6, 1), (21, 6, 1)]


def test_runs_do_not_cross_documents():
    assert runs_of([[b"a"] * 3] * 40) == [[]] * 40


def test_long_runs_and_many_words():
    rng = random.Random(5)
    turn = [b"%d" % rng.randrange(1 << 30) for _ in range(40_000)]
    assert runs_of([turn * 4 + turn[:7]]) == [[(0, 160_007, 40_000)]]
    assert runs_of([[b"a"] * 200_000 + [b"b"]]) == [[(0, 200_000, 1)]]


def test_collapsed_keeps_the_first_turn():
    words = "p q a b a b a b a b z".encode().split()
    assert collapsed(words, runs_of([words])[0]) == "p q a b z".encode().split()


def test_query_equals_plain_digests(spark, tmp_path):
    rng = random.Random(3)
    texts: list[tuple] = [(k, " ".join(w.decode() for w in drawn(rng, 60, 4))) for k in range(120)]
    texts += [(500, None), (501, ""), (502, " \t\n"), (None, "a " * 9), (7, texts[7][1]), (503, "é x " * 8)]
    wide = spark.createDataFrame(texts, SCHEMA).selectExpr("*", "1 as start", "2 as words", "3 as checksum", "4 as runs")
    wide.write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc_id, text in texts:
        words = (text or "").encode().split()
        words = planted(doc_id, words) if doc_id is not None else words
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        kept = b" ".join(collapsed(words, runs))
        expected.append(
            (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2],
             hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
        )
    got = [tuple(row) for row in op11_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_planted_tails(spark):
    docs = spark.createDataFrame([(k, " ".join(str(j) for j in range(k % 17))) for k in range(300)], SCHEMA)
    for row in with_planted_runs(docs).collect():
        plain = [str(j) for j in range(row.doc_id % 17)]
        assert row.text.split() == planted(row.doc_id, plain)


def test_empty_table(spark):
    found = periodic_runs.periodic_runs(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 and found.columns == ["doc_id", "n_words", "runs", "collapsed"]
