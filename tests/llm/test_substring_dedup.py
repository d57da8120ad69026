from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from fungo.llm import substring_dedup as dedup

SCHEMA = "doc_id long, text string, heads string, key int"


def plain(rows):
    """Every window of every document against all earlier ones."""
    order = sorted({(doc is None, doc, text or "") for doc, text in rows}, key=lambda r: (r[0], r[1] or 0))
    seen, result = set(), {}
    for none, doc, text in order:
        words = text.encode().split()
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept = [word for k, word in enumerate(words) if k not in gone]
        digest = hashlib.sha256(b" ".join(kept)).hexdigest()
        result[None if none else doc] = (len(words), len(gone), digest)
    return result


def test_cover_meets_every_pair_of_positions():
    for a in range(dedup.PERIOD):
        for b in range(dedup.PERIOD):
            shifts = [s for s in range(dedup.PERIOD) if {(a + s) % 13, (b + s) % 13} <= set(dedup.COVER)]
            assert shifts


def test_candidates_hold_an_anchor_that_is_not_unique():
    n = 200
    anchors = dedup.anchor_starts(n)
    rng = np.random.default_rng(0)
    unique = anchors[rng.random(len(anchors)) < 0.9]
    shared = set(anchors.tolist()) - set(unique.tolist())
    expected = [p for p in range(n - 19) if shared & set(range(p, p + 13))]
    assert dedup.candidate_starts(n, unique).tolist() == expected


def check(spark, rows):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    found = dedup.remove_repeats(frame).collect()
    expected = plain(rows)
    assert len(found) == len(rows)
    for row in found:
        assert (row.n_words, row.n_removed, row.kept_sha256) == expected[row.doc_id], row.doc_id
        assert hashlib.sha256(row.kept_text.encode()).hexdigest() == row.kept_sha256


def test_equals_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(300)] + ["é", "\x1c", " "]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    shared = [say(n) for n in (19, 20, 21, 33, 60)]
    rows = []
    for doc in range(80):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += say(rng.randint(0, 30))
            parts += rng.choice(shared)
        rows.append((doc * 7 % 80, rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(200 + k, rows[5][1]) for k in range(12)]
    rows += [(300, None), (301, ""), (302, " \n "), (303, " ".join(["same"] * 5000))]
    rows += [rows[7], (304, " ".join(shared[3])), (None, " ".join(shared[4] + say(9)))]
    check(spark, rows)


def test_few_words_many_overlaps(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice("ab") for _ in range(rng.randint(15, 90)))) for k in range(60)]
    rows += [(100 + k, "a " * (20 + k)) for k in range(10)]
    check(spark, rows)


def test_texts_without_an_id_and_texts_under_one_id_are_apart(spark):
    rng = random.Random(5)
    say = lambda n: [rng.choice([f"w{k}" for k in range(400)]) for _ in range(n)]
    shared = [say(n) for n in (20, 26, 45)]
    for without, twice in ((12, 0), (1, 4), (12, 4)):
        rows = [(k, " ".join(say(rng.randint(0, 40)) + rng.choice(shared))) for k in range(12)]
        for k in range(without):
            rows.append((None, " ".join(say(5 * k) + rng.choice(shared) + say(k) + shared[k % 3])))
        for k in range(twice):
            rows.append((k, " ".join(say(90 - 20 * k) + shared[k % 3])))
        rows += [(50, None), (50, "a few words"), (None, None), rows[3], rows[12], (None, rows[2][1])]
        frame = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
        hashed = frame.select("text", F.shiftrightunsigned(F.xxhash64("text"), 2).alias("h")).collect()
        rank = {row.text: row.h for row in hashed}
        seen, cut = set(), {}
        for doc, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, rank[r[1]])):
            words, gone = (text or "").split(), set()
            for i in range(len(words) - 19):
                if tuple(words[i : i + 20]) in seen:
                    gone.update(range(i, i + 20))
                seen.add(tuple(words[i : i + 20]))
            cut[doc, text] = len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)
        found = dedup.remove_repeats(frame).select("doc_id", "n_words", "n_removed", "kept_text").collect()
        key = lambda r: (r[0] is None, *(r[0] or 0, *r[1:]))
        assert sorted((tuple(r) for r in found), key=key) == sorted(((d, *cut[d, t]) for d, t in rows), key=key)


def test_empty_table(spark):
    assert dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
