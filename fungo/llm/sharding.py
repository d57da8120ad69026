"""Placement of rows on shards by a lookup table that the shards fill in turns.

Each shard orders the slots of a prime-sized table by its own permutation (an offset and a step, both
from its name). In turns, each shard claims its most preferred free slot until the table is full. Shards
therefore hold almost equally many slots, and a shard that comes or goes moves few other slots. The table
has as many rows as the prime says, whatever the data: that bounds the broadcast, and placing a row is one
probe of it without a shuffle, so a frequent key costs nothing extra.

A null key has a place like any other value. Rows with equal keys share a shard. The input's own columns
pass through; the two new ones replace columns of the same name, and names needed in between are chosen
among those not taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fungo.llm.common import free_names

SLOTS = 65_537
MOST_SLOTS = 1_000_003


def _is_prime(number: int) -> bool:
    return number > 1 and all(number % k for k in range(2, int(number**0.5) + 1))


def _preference(shard: str, slots: int) -> tuple[int, int]:
    digest = hashlib.blake2b(shard.encode("utf-8"), digest_size=16).digest()
    offset = int.from_bytes(digest[:8], "little") % slots
    step = int.from_bytes(digest[8:], "little") % (slots - 1) + 1
    return offset, step


def fill_table(shards: Sequence[str], slots: int = SLOTS) -> list[str]:
    """The shard of each slot. ``slots`` is a prime of at most a million and at least the shards."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, one at least")
    if not _is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    names = sorted(shards)
    places = [_preference(name, slots) for name in names]
    following = [offset for offset, _ in places]
    owner = [-1] * slots
    free = slots
    while True:
        for shard, (_, step) in enumerate(places):
            slot = following[shard]
            while owner[slot] >= 0:
                slot = (slot + step) % slots
            owner[slot] = shard
            following[shard] = (slot + step) % slots
            free -= 1
            if not free:
                return [names[k] for k in owner]


def place(df: DataFrame, key: Column, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` for the value of ``key``."""
    of_slot, of_shard = free_names(df, "of_slot", "of_shard")
    table = df.sparkSession.createDataFrame(
        list(enumerate(fill_table(shards, slots))), f"{of_slot} long, {of_shard} string"
    )
    keyed = df.withColumn("slot", F.pmod(F.xxhash64(key), F.lit(slots)))
    found = keyed.drop("shard").join(F.broadcast(table), F.col("slot") == F.col(of_slot), "left")
    return found.withColumnRenamed(of_shard, "shard").drop(of_slot)
