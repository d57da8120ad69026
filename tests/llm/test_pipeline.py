from __future__ import annotations

import random
from collections import Counter

import pytest

import corpus_pipeline
from fungo.llm import language_id, pseudonyms
from fungo.llm.tokens import encoder
from tests.llm.test_language_id import say
from tests.llm.test_simhash_dedup import plain_fingerprint, plain_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, slot int"


def corpus():
    rng = random.Random(9)
    rows = []
    for k in range(160):
        lang = rng.choice(["en", "de", "fr", "es"])
        source = rng.choice(["hot", "hot", "a", "b"])
        rows.append((k, f"{say(rng, lang, rng.randint(30, 60))} call (212) 555-{k:04d}.", lang, source))
    rows += [(200 + k, rows[k][1], rows[k][2], "hot") for k in range(30)]
    rows += [(300, None, "en", "a"), (301, "", "en", "a"), (302, "12 34 !!", "en", "b"), (303, rows[5][1], None, None)]
    rows += [(7, say(rng, "de", 45), "de", "b"), (None, rows[9][1], "en", "a")]
    rows += [rows[8], (None, say(rng, "en", 40), "en", "a"), (304, "ing the of " * 20_000, "en", None)]
    return [(d, t, lang, s, len(t) if t else 0, "clash", 1) for d, t, lang, s in rows]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned for the corpus, written and read as ``run`` does."""
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(corpus(), SCHEMA)
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, path).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        found.append(docs)
    return found


def test_all_but_the_last_stage_return_the_columns_of_documents(stages):
    assert all(tuple(docs.columns) == corpus_pipeline.COLUMNS for docs in stages[1:-1])


def test_language_stage_drops_what_has_no_language(stages):
    before, after = (Counter(row[:5] for row in frame.collect()) for frame in stages[:2])
    assert set((before - after)) == {row[:5] for row in corpus() if row[0] in (300, 301, 302)}
    assert not after - before


def test_one_document_of_each_group_stays(stages):
    """Whatever the ids: one id with two texts, no id, repeated rows."""
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    prints = [plain_fingerprint(text) for _, text in rows]
    # The position of a row in place of its id gives each row's group.
    groups = [group for group in plain_groups(list(enumerate(prints)))]
    expected = set()
    for group in set(groups):
        own = {row for row, of in zip(rows, groups) if of == group}
        least = min(doc_id if doc_id is not None else 1 << 62 for doc_id, _ in own)
        expected.add(frozenset(row for row in own if (row[0] if row[0] is not None else 1 << 62) == least))
    kept = Counter((r.doc_id, r.text) for r in stages[2].collect())
    assert max(kept.values()) == 1 and len(kept) == len(expected)
    assert all(len(candidates & set(kept)) == 1 for candidates in expected)
    assert [doc_id for doc_id, _ in kept].count(7) == 2 and [doc_id for doc_id, _ in kept].count(None) == 1


def test_personal_numbers_are_replaced(stages):
    before = [(r.doc_id, r.text) for r in stages[2].collect()]
    turner = pseudonyms.Turner(pseudonyms.DEMO_KEY)
    after = [(r.doc_id, r.text) for r in stages[3].collect()]
    expected = [(doc_id, pseudonyms.rewrite(text, turner, {})) for doc_id, text in before]
    assert Counter(after) == Counter(expected)
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())
    for (doc_id, text), (_, turned) in zip(before, expected):
        assert text == turned or f"555-{doc_id or 0:04d}" not in turned


def test_mix_repeats_small_sources_and_drops_nothing(stages):
    before, after = (Counter(row[:] for row in frame.collect()) for frame in stages[3:5])
    assert set(before) == set(after)
    assert max(after.values()) <= 1 + max(Counter(k[3] for k in before).values())


def test_pieces_hold_every_token(stages):
    docs = stages[4].collect()
    expected: Counter = Counter()
    for row in docs:
        expected[row.doc_id] += len(encoder().ids(row.text)) + 1
    found, fills = Counter(), Counter()
    for piece in stages[5].collect():
        found[piece.doc_id] += piece.length
        fills[piece.sequence_id] += piece.length
    assert found == expected
    assert all(fill == 1024 or fill < 1024 and fill & (fill - 1) == 0 for fill in fills.values())


def test_run_gives_the_last_stage(spark, sf_dir):
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert pieces and {p.doc_id for p in pieces} <= {r.doc_id for r in docs.select("doc_id").collect()}


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_an_empty_table(spark, sf_dir, stage):
    docs = spark.createDataFrame([], SCHEMA)
    assert corpus_pipeline.STAGES[stage][1](spark, docs, sf_dir).collect() == []


def test_weights_are_learned_from_documents_not_held_out(spark, monkeypatch):
    seen = []
    learn = language_id.learn
    monkeypatch.setattr(language_id, "learn", lambda frame: seen.append(frame) or learn(frame))
    docs = spark.createDataFrame(corpus(), SCHEMA)
    corpus_pipeline.known_language(spark, docs, "").collect()
    assert seen[0].where(language_id.fold() == 0).count() == 0
