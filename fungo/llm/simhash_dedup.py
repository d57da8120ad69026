"""Near-duplicate groups by SimHash fingerprints, found through Golay-code keys.

A fingerprint is taken over the whole text: words in lower case (A-Z only), runs of three words with
repeats, XXH64 with seed 42 of each, and a bit is 1 if more than half of the hashes have it. Texts with
fewer words have one run, texts without words the fingerprint zero. Distinct fingerprints get the keys of
``golay.keys``; those that share a key are compared in the join itself, so that only pairs within the
distance leave it. Documents with equal fingerprints never meet as pairs: a group of copies is one
fingerprint, whatever its size. Hot keys are split by the sort-merge join.

A row is known by its id and ``part``, a hash of its text. Of each group ``survivors`` keeps one: the least id, no
id being last, and of several texts under that id the one with the least hash. Only rows alike in both
count as one; another text under the same id is judged in its own group.

Null text: no words. Null ``doc_id``: never the least of a group while another id is there; a group without
any id has a null ``component_id``. Repeated rows are returned each. Empty table: empty result. Columns of
other names do not matter: only ``doc_id`` and ``text`` are read, and names that ``survivors`` adds for its join
are chosen among those not taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fungo.llm import golay
from fungo.llm.common import free_names
from fungo.llm.components import components
from fungo.session import materialize

SHINGLE, SEED = 3, 42
DISTANCE = 3
# Fingerprints expanded into keys at once; each has 152 keys at most.
CHUNK = 2048


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), last)], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``part`` and ``fp``: the fingerprint's 64 bits as a long."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), shingle) for text in batch.column(2)]
            bits = np.array(found, np.uint64).view(np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(bits)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "fp"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _part().alias("part"), "text")
    return chosen.mapInArrow(build, "doc_id long, part long, fp long")


def _part() -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64("text")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _parts(batches):
        rows, keys, _ = golay.keys(part.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["key", "a"])


def _home_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _parts(batches):
        rows, keys, leads = golay.keys(part.view(np.uint64), home=True)
        columns = [pa.array(keys), pa.array(part[rows]), pa.array(leads)]
        yield pa.RecordBatch.from_arrays(columns, ["home_key", "b", "lead"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        bits = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(bits), CHUNK):
            yield bits[at : at + CHUNK]


def _mask(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits)


def _first_meeting(difference: Column, key: Column, lead: Column) -> Column:
    """Whether a pair is counted under this key.

    Of the keys that a pair shares, only those of its first equal segment count. Where a run is equal,
    only its nearest codeword counts (``lead`` is that of the home key); a whole run counts only if the
    other differs in 3 bits.
    """
    segments = range(golay.SEGMENTS)
    equal = [difference.bitwiseAND(_mask(0xFFFF << (golay.SEGMENT_BITS * d))) == 0 for d in segments]
    first = F.coalesce(*[F.when(equal[d], F.lit(d)) for d in segments])
    mark = F.shiftright(key, 40)
    conditions = F.lit(False)
    for d in segments:
        run_a, run_b = (difference.bitwiseAND(_mask(mask)) for mask in golay.run_masks(d))
        indexed = (
            (mark == golay.tag(d, golay.INDEXED))
            & ((run_a != 0) | (lead.bitwiseAND(F.lit(golay.LEAD_A)) != 0))
            & ((run_b != 0) | (lead.bitwiseAND(F.lit(golay.LEAD_B)) != 0))
        )
        whole_a = (mark == golay.tag(d, golay.EXACT_A)) & (F.bit_count(run_b) == DISTANCE)
        whole_b = (mark == golay.tag(d, golay.EXACT_B)) & (F.bit_count(run_a) == DISTANCE)
        conditions = conditions | ((first == d) & (indexed | whole_a | whole_b))
    return conditions


def links(distinct: DataFrame) -> DataFrame:
    """``a`` < ``b``: all pairs of the distinct ``fp`` that differ in at most 3 bits."""
    # A fingerprint becomes a hundred rows and more, so even a small file is dealt out first.
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = distinct.select("fp").repartition(tasks, "fp")
    # Spark does not foresee that either, and would broadcast the keys of a middle-sized table.
    keyed = dealt.mapInArrow(_keys, "key long, a long").hint("merge")
    home = dealt.mapInArrow(_home_keys, "home_key long, b long, lead long")
    difference = F.col("a").bitwiseXOR(F.col("b"))
    meeting = (
        (F.col("key") == F.col("home_key"))
        & (F.col("a") < F.col("b"))
        & (F.bit_count(difference) <= DISTANCE)
        & _first_meeting(difference, F.col("key"), F.col("lead"))
    )
    return keyed.join(home, meeting).select("a", "b").distinct()


def group(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``part``, ``fp``, ``root`` and ``component_id`` for every row of ``docs``.

    ``root`` is the least fingerprint of the group, ``component_id`` its least id.
    """
    marked = materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(nodes), "a", "b")
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = rooted.select(F.col("fp").alias("member"), "root").join(named, "root")
    return marked.join(members, F.col("fp") == F.col("member"), "left").select(
        "doc_id", "part", "fp", "root", "component_id"
    )


def survivors(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of each group, with the columns of ``docs``; ``groups`` is theirs by ``group``."""
    least = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = least.groupBy("root").agg(F.min("component_id").alias("least"), F.min("part").alias("least_part"))
    own_id, own_part, kept_id, kept_part = free_names(docs, "own_id", "own_part", "kept_id", "kept_part")
    # Two groups never share an id and a text, so a row is found once.
    chosen = chosen.select(F.col("least").alias(kept_id), F.col("least_part").alias(kept_part))
    marked = docs.withColumns({own_id: F.col("doc_id").cast("long"), own_part: _part()})
    match = F.col(own_id).eqNullSafe(F.col(kept_id)) & (F.col(own_part) == F.col(kept_part))
    found = marked.join(chosen, match, "left_semi")
    return found.dropDuplicates([own_id, own_part]).select(*docs.columns)
