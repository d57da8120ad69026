from __future__ import annotations

import random

import numpy as np
import xxhash

from fungo.llm import golay, simhash_dedup
from fungo.llm.components import components

SCHEMA = "doc_id long, text string, lead string, a int"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(run), 42) for run in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    """Component by brute force over all pairs; rows: (doc_id, fingerprint)."""
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(rows):
            for j, (_, b) in enumerate(rows):
                if (a ^ b).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    least = {}
    for k, (doc, _) in zip(label, rows):
        if doc is not None:
            least[k] = min(doc, least.get(k, doc))
    return [least.get(k) for k in label]


def test_code_is_perfect_and_indices_are_complete():
    sizes = (golay._tables()[2] >= 0).sum(axis=1)
    assert sorted(set(sizes.tolist())) == [1, 6] and (sizes == 6).sum() == 1771
    rng = random.Random(1)
    for _ in range(300):
        x = rng.getrandbits(23)
        y = x
        for bit in rng.sample(range(23), rng.randint(0, 2)):
            y ^= 1 << bit
        found = [set(golay.indices(np.array([v]))[0].tolist()) - {-1} for v in (x, y)]
        assert found[0] & found[1]


def test_fingerprints_within_three_bits_share_a_key():
    rng = random.Random(2)
    for _ in range(400):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            y ^= 1 << bit
        every, home = (
            [set(golay.keys(np.array([v], np.uint64), only_home)[1].tolist()) for v in (x, y)]
            for only_home in (False, True)
        )
        assert every[0] & home[1] and every[1] & home[0]
        assert home[0] <= every[0] and len(home[0]) <= 4 * 13


def test_links_equal_brute_force(spark):
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(40)}
    for base in list(values)[:25]:
        for _ in range(6):
            y = base
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                y ^= 1 << bit
            values.add(y)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {tuple(row) for row in simhash_dedup.links(frame).collect()}
    mask = (1 << 64) - 1
    expected = {
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3
    }
    assert found == expected and len(expected) > 50


def test_components_of_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    links += [(201, 200), (200, 201)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    roots = {row.node: row.root for row in found}
    assert len(found) == len(roots) == 60 + 40 + 2
    assert {roots[k] for k in range(1, 61)} == {1}
    assert {roots[k] for k in range(100, 140)} == {100}
    assert roots[200] == roots[201] == 200


def test_groups_equal_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(12)]
    texts = [*base, *base[:3], base[0].upper(), base[1].replace(" ", "\n\t"), None, "", "  \n", "one", "One two"]
    for text in base:
        for _ in range(4):
            cut = text.split()
            cut[rng.randrange(len(cut))] = "changed"
            texts.append(" ".join(cut))
    texts.append("long " * 30_000)
    rows = [(k, text, "x", k) for k, text in enumerate(texts, 10)]
    rows += [rows[3], (None, base[4], None, None), (None, "nobody else has these words here", None, 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    groups = simhash_dedup.group(frame)
    found = groups.select("doc_id", "fp", "component_id")
    expected = [(row[0], plain_fingerprint(row[1])) for row in rows]
    full = [
        (doc, value - (1 << 64) if value >> 63 else value, component)
        for (doc, value), component in zip(expected, plain_groups(expected))
    ]
    key = lambda row: tuple((v is None, v) for v in row)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(full, key=key)

    kept = simhash_dedup.survivors(frame, groups).collect()
    assert set(kept[0].asDict()) == {"doc_id", "text", "lead", "a"}
    ids = [row.doc_id for row in kept if row.doc_id is not None]
    assert len(ids) == len(set(ids))
    assert set(ids) == {component for _, _, component in full if component is not None}
    # The copy of base[4] without an id goes with its group, the text of its own stays.
    assert len(kept) - len(ids) == 1


def kept_rows(spark, rows):
    frame = spark.createDataFrame([(*row, 1, 2) for row in rows], "doc_id long, text string, own_id int, KEPT_PART int")
    kept = simhash_dedup.survivors(frame, simhash_dedup.group(frame))
    assert kept.columns == ["doc_id", "text", "own_id", "KEPT_PART"]
    return sorted(((row.doc_id, row.text) for row in kept.collect()), key=str)


def distinct_texts(n):
    rng = random.Random(17)
    return [" ".join(f"{k}v{rng.randrange(10**6)}" for _ in range(150)) for k in range(n)]


def near(text):
    return text + " tail"


def test_no_text_is_lost_under_a_shared_id(spark):
    a, b, c = distinct_texts(3)
    assert simhash_dedup.fingerprint(a) != simhash_dedup.fingerprint(near(a))
    assert kept_rows(spark, [(1, a), (1, b), (2, c)]) == sorted([(1, a), (1, b), (2, c)], key=str)
    assert kept_rows(spark, [(1, a), (5, near(a)), (5, b)]) == sorted([(1, a), (5, b)], key=str)
    assert kept_rows(spark, [(4, a), (4, near(a)), (4, a), (4, b)])[-1] in ((4, b), (4, a), (4, near(a)))
    assert len(kept_rows(spark, [(4, a), (4, near(a)), (4, a), (4, b)])) == 2


def test_near_copies_without_an_id_are_one(spark):
    a, b, c = distinct_texts(3)
    kept = kept_rows(spark, [(None, a), (None, near(a)), (None, a), (None, b), (7, near(b)), (8, c)])
    assert [row for row in kept if row[0] is not None] == [(7, near(b)), (8, c)]
    assert len(kept) == 3 and kept[-1][1] in (a, near(a)) and kept[-1][0] is None


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert simhash_dedup.group(frame).collect() == []
