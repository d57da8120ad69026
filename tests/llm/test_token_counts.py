from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fungo.llm import token_counts as t
from fungo.llm.tokens import encoder

SCHEMA = "doc_id long, text string, length string, n_docs int"


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab AB'st1é ß\n\t,.!?-_|€ñ中😀\x1c\xa0 "), max_size=60))
def test_ids_equal_the_reference_library(text):
    found = encoder()
    assert found.ids(text) == found._reference.encode(text, add_special_tokens=False).ids


def test_special_tokens_and_nulls():
    found = encoder()
    assert found.ids("a <|endoftext|> b").count(50256) == 1
    assert found.ids(None) == found.ids("") == []


def test_ids_of_the_documents(spark, sf_dir):
    found = encoder()
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        assert found.ids(row.text) == found._reference.encode(row.text, add_special_tokens=False).ids


def expected_rows(lengths):
    return {
        limit: (
            lengths.count(limit),
            sum(x >= limit for x in lengths),
            sum(x for x in lengths if x >= limit),
            sum(min(x, limit) for x in lengths),
            sum(x <= limit for x in lengths) / len(lengths),
        )
        for limit in set(lengths)
    }


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_suffix_sums(spark, block):
    rng = random.Random(block)
    lengths = [rng.choice([0, 0, 1, 5, rng.randint(0, 3000)]) for _ in range(400)]
    frame = spark.createDataFrame([(x,) for x in lengths], "length long")
    sums = t.suffix_sums(t.length_histogram(frame), block)
    found = {
        r.length: (r.n_docs, r.docs_at_least, r.tokens_at_least, r.truncated_tokens, r.docs_share)
        for r in sums.collect()
    }
    assert found == expected_rows(lengths)
    for limit in (0, 4, 700, 10_000):
        row = t.at_limit(sums, limit).first()
        assert row.docs_above == sum(x > limit for x in lengths)
        assert row.tokens_above == sum(x for x in lengths if x > limit)
        assert row.truncated_tokens == sum(min(x, limit) for x in lengths)
    for share in (0.01, 0.5, 1.0):
        least = min(x for x in lengths if sum(y <= x for y in lengths) / len(lengths) >= share)
        assert t.quantile(sums, share).first().length == least


def test_documents(spark):
    rows = [(1, None, "x", 1), (2, "", "x", 1), (None, "one two", None, None), (4, "one two", "x", 1)]
    rows += [(5, "long text " * 30_000, "x", 1), rows[3]]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = {r.length: r.n_docs for r in t.length_histogram(t.encoded_lengths(frame)).collect()}
    assert found == {0: 2, 2: 3, len(encoder().ids(rows[4][1])): 1}


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    sums = t.suffix_sums(t.length_histogram(t.encoded_lengths(frame)))
    assert sums.collect() == []
    assert t.at_limit(sums, 5).first().truncated_tokens == 0
