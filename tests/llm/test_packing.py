from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from fungo.llm import packing as p
from fungo.llm.tokens import encoder

SCHEMA = "doc_id long, text string, start string, length int"


def run_packer(sizes, window, most_open=p.MOST_OPEN):
    done = []
    packer = p.Packer(done.append, window, most_open)
    documents = []
    for k, size in enumerate(sizes):
        ids = np.arange(size, dtype=np.uint32) + 1000 * k
        documents.append(ids)
        packer.add((k, size), ids)
    packer.finish()
    return documents, done


@pytest.mark.parametrize("window, most_open", [(8, 1000), (16, 3), (64, 1000), (1024, 50)])
def test_round_trip_without_padding(window, most_open):
    rng = random.Random(window)
    documents, done = run_packer([rng.randint(1, 3 * window) for _ in range(700)], window, most_open)
    found = {}
    for pieces in done:
        fill = sum(len(ids) for _, _, ids in pieces)
        assert fill == window or (fill < window and fill & (fill - 1) == 0)
        for (doc, total), start, ids in pieces:
            assert total == len(documents[doc]) and len(ids)
            found.setdefault(doc, []).append((start, ids))
    for doc, ids in enumerate(documents):
        parts = sorted(found[doc], key=lambda part: part[0])
        assert [start for start, _ in parts] == list(np.cumsum([0] + [len(x) for _, x in parts])[:-1])
        assert np.array_equal(np.concatenate([x for _, x in parts]), ids)
    # the last remainder alone is shorter than the window
    assert sum(sum(len(x[2]) for x in pieces) < window for pieces in done) <= window.bit_length()


def test_level_is_the_one_with_the_least_sum_of_squares():
    rng = random.Random(2)
    packer = p.Packer(lambda pieces: None, 32)
    for _ in range(400):
        size = rng.randint(1, 31)
        levels = packer._levels.copy()

        def squares(level):
            after = levels.copy()
            if level:
                after[level] -= 1
            if level + size < 32:
                after[level + size] += 1
            return int((after[1:32] ** 2).sum())

        choices = [0] + [h for h in range(1, 33 - size) if levels[h]]
        level = packer.level_for(size)
        assert level in choices and squares(level) == min(map(squares, choices))
        packer.add((0, size), np.zeros(size, np.uint32))


def test_documents(spark):
    rng = random.Random(7)
    words = ["alpha", "beta", "été", "<|endoftext|>", "\n", "中"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 900))), "x", 1) for k in range(60)]
    rows += [(100, None, None, None), (101, "", "x", 1), (102, "long text " * 30_000, "x", 1)]
    rows += [(None, "no id", "x", 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    pieces = p.pack(frame).collect()
    expected = {doc: [*encoder().ids(text), 0] for doc, text, *_ in rows}
    at, fills = dict.fromkeys(expected, 0), {}
    for piece in sorted(pieces, key=lambda x: x.start):
        ids = expected[piece.doc_id]
        assert piece.doc_tokens == len(ids) and piece.start == at[piece.doc_id]
        at[piece.doc_id] += piece.length
        part = np.array(ids[piece.start : piece.start + piece.length], "<u4")
        assert piece.ids_crc32 == zlib.crc32(part.tobytes()) and 0 < len(part) == piece.length
    assert at == {doc: len(ids) for doc, ids in expected.items()}
    for piece in sorted(pieces, key=lambda x: (x.sequence_id, x.offset)):
        assert piece.offset == fills.get(piece.sequence_id, 0)
        fills[piece.sequence_id] = piece.offset + piece.length
    assert all(fill == 1024 or fill & (fill - 1) == 0 and fill < 1024 for fill in fills.values())
    assert [tuple(r) for r in p.pack(frame).collect()] == [tuple(r) for r in pieces]


def test_repeated_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "same text", "x", 1)] * 5, SCHEMA)
    assert sum(piece.length for piece in p.pack(frame).collect()) == 5 * (len(encoder().ids("same text")) + 1)
    assert p.pack(spark.createDataFrame([], SCHEMA)).collect() == []
