"""Removal of passages that occur earlier in the corpus, through difference-cover anchors.

A window is 20 consecutive words. Positions are taken modulo 13, and 0, 1, 3, 9 is a difference cover:
for any two positions there is a shift below 13 that puts both on the cover. Two equal windows therefore
share a run of 8 words that starts, in both, at a cover position: the anchor. Only anchors are hashed
for the whole corpus, 4 of 13 positions.

1. Anchors are counted by hash. A partial aggregation keeps the count, the least document and place, so
   that a passage in a third of all documents is one row for each task. Where the count is 1, document
   and place are those of the only occurrence; these unique anchors go back to their documents.
2. A window is a candidate if one of its four anchors is not unique. Only candidate windows are
   extended to all 20 words and hashed, each once for a document. By hash, the least document and its
   first place hold the head: the occurrence that stays.
3. In each document, candidates that are not heads are repeats, and the words they cover go.

Of documents with equal texts only the one with the least id takes part; the others consist of repeats.
Anchor hashes of 48 bits may collide, which only adds candidates. Windows are compared by 95 bits, within
one document by the first 64 of them: among 10**12 different windows two agree with odds of 1 in 80,000.
All words of a document are read, and no group of equal anchors or windows is ever gathered. Texts travel
to their document's places once, compressed one by one; both later steps read that shuffle.

A document is an id and a text. Its places are kept by ``key``, the id, and ``part``, a hash of the text
where the id alone does not tell the texts apart, else 0.

Null or empty text: no words. Null ``doc_id``: behind all others; every text without an id is a document of its
own, in the order of their hashes, and so are different texts under one id. Repeated rows are one document,
returned for each row. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fungo.llm.common import LAST_ID

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
# Rows that leave a task at once.
CHUNK = 1 << 18
# Bits of an anchor's hash that are shuffled.
ANCHOR_BITS = 48
# Bits of a text's hash that tell documents of one id apart; an id and these fit a decimal of 38 digits.
PART_BITS = 62

_ON_COVER = np.isin(np.arange(PERIOD), COVER)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(word) for word in words), np.uint64, len(words))


def _runs(hashes: np.ndarray, starts: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    """A hash of the ``length`` words from each start."""
    total = np.zeros(len(starts), np.uint64)
    for k in range(length):
        total = total * factor + hashes[starts + k]
    return total ^ (total >> np.uint64(29))


def anchor_starts(n_words: int) -> np.ndarray:
    """Cover positions of a document that begin an anchor."""
    if n_words < WINDOW:
        return np.zeros(0, np.int64)
    starts = np.arange(n_words - ANCHOR + 1)
    return starts[_ON_COVER[starts % PERIOD]]


def candidate_starts(n_words: int, unique: np.ndarray) -> np.ndarray:
    """Starts of windows that hold an anchor outside ``unique``."""
    if n_words < WINDOW:
        return np.zeros(0, np.int64)
    shared = np.zeros(n_words - ANCHOR + 2, np.int64)
    shared[anchor_starts(n_words) + 1] = 1
    shared[unique + 1] = 0
    shared = np.cumsum(shared)
    starts = np.arange(n_words - WINDOW + 1)
    return starts[shared[starts + PERIOD] > shared[starts]]


def _batches(rows: Iterator[tuple], names: list[str], types: list) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about ``CHUNK`` rows from tuples of equally long arrays."""
    waiting, held = [], 0
    for row in rows:
        waiting.append(row)
        held += len(row[0])
        if held >= CHUNK:
            yield _batch(waiting, names, types)
            waiting, held = [], 0
    if held:
        yield _batch(waiting, names, types)


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = [np.concatenate(parts).astype(kind) for parts, kind in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names)


def _words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compress = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        packed = [compress(text.encode("utf-8")) if text else None for text in batch.column(2).to_pylist()]
        columns = [batch.column(0), batch.column(1), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["key", "part", "packed"])


def _unpacked(column: pa.Array) -> Iterator[bytes | None]:
    decompress = zstandard.ZstdDecompressor().decompress
    for packed in column:
        value = packed.as_py()
        yield decompress(value) if value else None


def _positions(places: pa.Scalar) -> np.ndarray:
    return np.zeros(0, np.int64) if not places.is_valid else places.values.to_numpy().astype(np.int64)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for key, part, text in zip(*(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2)):
                value = text.as_py()
                words = _words(value.encode("utf-8") if value else None)
                starts = anchor_starts(len(words))
                if len(starts):
                    found = _runs(_word_hashes(words), starts, ANCHOR, _FACTORS[0])
                    whose = np.full(len(starts), key), np.full(len(starts), part)
                    yield found >> np.uint64(64 - ANCHOR_BITS), *whose, starts

    yield from _batches(rows(), ["hash", "key", "part", "at"], [np.int64, np.int64, np.int64, np.int32])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for key, part, text, unique in zip(
                *(batch.column(k).to_pylist() for k in (0, 1)), _unpacked(batch.column(2)), batch.column(3)
            ):
                words = _words(text)
                starts = candidate_starts(len(words), _positions(unique))
                if len(starts):
                    hashes = _word_hashes(words)
                    first, at = np.unique(_runs(hashes, starts, WINDOW, _FACTORS[0]), return_index=True)
                    second = _runs(hashes, starts[at], WINDOW, _FACTORS[1]) >> np.uint64(33)
                    whose = np.full(len(at), key), np.full(len(at), part)
                    yield first.view(np.int64), second, *whose, starts[at]

    types = [np.int64, np.int32, np.int64, np.int64, np.int32]
    yield from _batches(rows(), ["h1", "h2", "key", "part", "at"], types)


def _covered(n_words: int, starts: np.ndarray) -> np.ndarray:
    edges = np.zeros(n_words + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return np.cumsum(edges[:-1]) > 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept_texts, n_words, n_removed = [], [], []
        for text, first, unique, heads in zip(_unpacked(batch.column(1)), *batch.columns[2:]):
            words = _words(text)
            kept = words
            if len(words) >= WINDOW and not first.is_valid:
                kept = []
            elif len(words) >= WINDOW:
                starts = candidate_starts(len(words), _positions(unique))
                repeats = np.setdiff1d(starts, _positions(heads), assume_unique=False)
                if len(repeats):
                    gone = _covered(len(words), repeats)
                    kept = [word for word, cut in zip(words, gone.tolist()) if not cut]
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            kept_texts.append(b" ".join(kept))
        digests = [hashlib.sha256(text).hexdigest() for text in kept_texts]
        columns = [
            batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
            pa.array(digests), pa.array([text.decode("utf-8") for text in kept_texts]),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "n_removed", "kept_sha256", "kept_text"])


def _by_document(places: DataFrame, name: str) -> DataFrame:
    """``key``, ``part`` and the list of its places: as long as the document at most."""
    return places.repartition("key", "part").groupBy("key", "part").agg(F.collect_list("at").alias(name))


def unique_anchors(texts: DataFrame) -> DataFrame:
    """``key``, ``part`` and ``unique``: places of the anchors that occur once in the corpus."""
    anchors = texts.mapInArrow(_anchors, "hash long, key long, part long, at int")
    counted = anchors.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.min(name).alias(name) for name in ("key", "part", "at")),
    )
    return _by_document(counted.where(F.col("n") == 1).select("key", "part", "at"), "unique")


def window_heads(packed: DataFrame, firsts: DataFrame, unique: DataFrame, parted: bool) -> DataFrame:
    """``key``, ``part`` and ``heads``: places of candidate windows that occur nowhere earlier."""
    taking_part = packed.join(firsts, ["key", "part"], "left_semi").join(unique, ["key", "part"], "left")
    windows = taking_part.select("key", "part", "packed", "unique").mapInArrow(
        _candidates, "h1 long, h2 int, key long, part long, at int"
    )
    order = F.col("key")
    if parted:
        # A number, as the least of a struct would be found by sorting.
        order = order.cast("decimal(19,0)") * F.lit(1 << PART_BITS).cast("decimal(19,0)") + F.col("part")
    heads = windows.groupBy("h1", "h2").agg(
        F.min("key").alias("head"),
        (F.min_by("part", order) if parted else F.min("part")).alias("part"),
        F.min_by("at", order).alias("at"),
    )
    return _by_document(heads.select(F.col("head").alias("key"), "part", "at"), "heads")


def _documents(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``key``, ``part``, ``text`` of every row, and whether any part is set.

    Ids that have one text each, the usual case, need no parts: they would only be shuffled.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    digest = F.shiftrightunsigned(F.xxhash64("text"), 64 - PART_BITS)
    texts = docs.select(key.alias("key"), digest.alias("digest"), "text")
    spread = texts.groupBy("key").agg((F.min("digest") != F.max("digest")).alias("several"))
    several = spread.where("several").agg(
        F.max(F.col("key") == LAST_ID).alias("unnamed"), F.max(F.col("key") != LAST_ID).alias("named")
    ).first()
    apart = F.lit(bool(several.named)) | (F.lit(bool(several.unnamed)) & (F.col("key") == LAST_ID))
    part = F.when(apart, F.col("digest")).otherwise(F.lit(0).cast("long"))
    return texts.select("key", part.alias("part"), "text"), bool(several.named or several.unnamed)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``, ``kept_text`` for every row of ``docs``."""
    texts, parted = _documents(docs)
    firsts = texts.groupBy(F.md5("text").alias("digest")).agg(
        F.min("key").alias("key"), F.min_by("part", "key").alias("part")
    )
    firsts = firsts.select("key", "part").distinct()
    unique = unique_anchors(texts)
    # Keys and parts are never null; said here, both uses of the shuffled texts have the same plan.
    packed = texts.mapInArrow(_compressed, "key long, part long, packed binary")
    packed = packed.where(F.col("key").isNotNull() & F.col("part").isNotNull())
    heads = window_heads(packed, firsts, unique, parted)
    document = ["key", "part"]
    joined = (
        packed.join(firsts.withColumn("first", F.lit(True)), document, "left")
        .join(unique, document, "left")
        .join(heads, document, "left")
    )
    cut = joined.select("key", "packed", "first", "unique", "heads").mapInArrow(
        _cut, "key long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
    return cut.select(
        F.when(F.col("key") != LAST_ID, F.col("key")).alias("doc_id"),
        "n_words", "n_removed", "kept_sha256", "kept_text",
    )
