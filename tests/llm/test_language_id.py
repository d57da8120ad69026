from __future__ import annotations

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from fungo.llm import language_id as l

SCHEMA = "doc_id long, text string, lang string, score string, held_out int"
SYLLABLES = {
    "en": "th ing ed the and wh ou ly sh er".split(),
    "de": "sch ung ein der ich ß ü pf tz er".split(),
    "fr": "eau le é tion ou que ç è ai er".split(),
    "es": "ción do ñ el rr ll ó ado ue er".split(),
}


def say(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n)).capitalize()


def table(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((k, say(rng, lang, rng.randint(5, 60)), lang, "s", 9))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = table(spark)
    odd = [
        (900, None, "en", "s", 1), (901, "", "en", "s", 1), (902, "123 !? \n", "de", "s", 1),
        (903, rows[0][1], None, None, None), (None, rows[1][1], "xx", "s", 1), (904, "eau le " * 40_000, "fr", "s", 1),
        rows[2], rows[2],
    ]
    frame = spark.createDataFrame(rows + odd, SCHEMA)
    found = l.identify(frame).collect()
    assert len(found) == len(rows) + len(odd)
    truth = {k: lang for k, _, lang, *_ in rows}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 and r.lang_pred in {*SYLLABLES, "und"} for r in found)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    by_id = {r.doc_id: r for r in found}
    assert all((by_id[k].lang_pred, by_id[k].score) == ("und", 0.0) for k in (900, 901, 902))
    assert by_id[903].lang_pred == rows[0][2] and by_id[904].lang_pred == "fr"


def test_families_first(spark):
    model = l.learn(spark.createDataFrame(table(spark), SCHEMA))
    assert model.families == {"germanic": ("de", "en"), "romance": ("es", "fr")}
    assert len(model.family_duels) == 1 and {k: len(v) for k, v in model.language_duels.items()} == {
        "germanic": 1, "romance": 1
    }


def test_sample_is_bounded(spark):
    sample = l.sample_vectors(spark.createDataFrame(table(spark), SCHEMA), per_language=10)
    assert {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()} == dict.fromkeys(SYLLABLES, 10)


def test_one_or_no_language(spark):
    rows = [(k, say(random.Random(k), "en", 9), "en", "s", 1) for k in range(20)] + [(30, "12", None, "s", 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert {(r.lang_pred, r.score) for r in l.identify(frame).collect()} == {("en", 1.0), ("und", 0.0)}
    unlabelled = frame.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in l.identify(unlabelled).collect()} == {"und"}
    assert l.identify(frame.limit(0)).collect() == []


def test_columns_of_the_same_name_are_replaced(spark):
    frame = spark.createDataFrame(table(spark, 60), SCHEMA)
    found = l.predict(frame, l.learn(frame))
    assert sorted(found.columns) == sorted([*frame.columns, "lang_pred"])
    assert dict(found.dtypes)["score"] == "double"


def test_the_machine_is_the_minimum_of_its_loss():
    rng = np.random.default_rng(3)
    signs = np.where(np.arange(90) % 3 == 0, 1.0, -1.0)
    for width in (4, 200):
        rows = rng.normal(size=(90, width)) + signs[:, None] * 0.3
        weights = l.fit(rows, signs, penalty=0.01)
        full = np.hstack([rows, np.ones((90, 1))])
        slack = np.maximum(0, 1 - signs * (full @ weights))
        gradient = 0.01 * 90 * weights - full.T @ (signs * slack)
        assert np.abs(gradient).max() < 1e-4


def plain_trigrams(text):
    """Share of each hashed trigram, byte by byte."""
    codes = [32]
    for byte in text.encode("utf-8"):
        if 65 <= byte <= 90:
            codes.append(byte + 32)
        else:
            codes.append(byte if byte >= 128 or 97 <= byte <= 122 else 32)
    codes.append(32)
    counts = [0] * l.SIZE
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b != 32:
            counts[((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> (32 - l.BITS)] += 1
    return [(n / max(1, sum(counts))) ** 0.5 for n in counts]


def plain_winner(names, duels, vector):
    votes, sums, least = {n: 0 for n in names}, {n: 0.0 for n in names}, {n: None for n in names}
    for duel in duels:
        margin = sum(w * x for w, x in zip(duel.weights, vector)) + duel.intercept
        for name, own in ((duel.first, margin), (duel.second, -margin)):
            votes[name] += own > 0
            sums[name] += own
            least[name] = own if least[name] is None else min(least[name], own)
    best = sorted(names, key=lambda n: (-votes[n], -sums[n], n))[0]
    return best, 1.0 if len(names) == 1 else 1 / (1 + math.exp(-2 * least[best]))


def test_predictions_equal_a_plain_recomputation(spark):
    rows = table(spark, 200, 5) + [(500, "Ünï 7 \n\tThe THE", "en", "s", 1), (501, "12", "en", "s", 1), (502, "x", "de", "s", 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    model = l.learn(frame)
    for r in l.predict(frame, model).collect():
        if not any(ch.isalpha() for ch in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        vector = plain_trigrams(r.text)
        family, sure = plain_winner(list(model.families), model.family_duels, vector)
        langs = list(model.families[family])
        lang, surer = plain_winner(langs, model.language_duels[family], vector)
        assert r.lang_pred == lang and abs(r.score - min(sure, surer)) < 1e-9


def made_up(labels, families, n, seed=2):
    """Texts of languages no table lists; those of one family share most of their syllables."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    syllable = lambda: "".join(rng.choices(letters, k=3))
    common = [[syllable() for _ in range(12)] for _ in range(families)]
    own = [common[k % families] + [syllable() for _ in range(6)] for k in range(labels)]
    return [
        (i, " ".join("".join(rng.choices(own[i % labels], k=3)) for _ in range(40)), f"q{i % labels:02d}", "s", 1)
        for i in range(n)
    ]


def test_unlisted_languages_find_families(spark):
    rows = made_up(12, 3, 600)
    model = l.learn(spark.createDataFrame(rows, SCHEMA))
    expected = {tuple(f"q{k:02d}" for k in range(start, 12, 3)) for start in range(3)}
    assert set(model.families.values()) == expected
    assert len(model.family_duels) == 3 and all(len(d) == 6 for d in model.language_duels.values())
    found = l.identify(spark.createDataFrame(rows, SCHEMA)).where("held_out").collect()
    assert np.mean([r.lang_pred == f"q{r.doc_id % 12:02d}" for r in found]) > 0.95


def test_listed_families_take_in_but_never_join():
    east, west, north = np.eye(3)
    centres = {"de": east, "fr": east + 0.01 * west, "xa": east + 0.02 * west, "xb": north, "xc": north + 0.1 * west}
    centres = {name: c / np.linalg.norm(c) for name, c in centres.items()}
    groups = l.group_languages(l.FAMILIES, centres)
    assert "xa" in groups["germanic"] + groups["romance"] and groups["xb"] == ("xb", "xc")
    assert len(groups) == 3
    assert l.group_languages({}, {}) == {}
    assert l.group_languages({}, {"a": east}) == {"a": ("a",)}
    assert l.group_languages({}, {"a": east, "b": west}) == {"a": ("a",), "b": ("b",)}


def test_texts_reach_python_in_small_batches(spark):
    frame = spark.createDataFrame(table(spark, 40), SCHEMA)
    plan = l.predict(frame, l.learn(frame))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchEvalPython") == 1 and "MapInArrow" not in plan
