"""Interleaving of sources at target weights by proportionate-fair scheduling.

Every source is cut into blocks of equally many characters. Block i of a source with weight w is
released at slot floor(i / w) and due before slot ceil((i + 1) / w); one slot takes one block. Earliest
deadline first meets every deadline, so at any moment each source is less than one block from its
weight. Weights are exact ratios of whole numbers, nothing is rounded. A source can have any weight, and
there can be any number of sources.

What goes before a slot decides what comes in it, so one task steps through all slots, of which there is one
for 16,384 characters. All it holds and writes is each source's next block, once for every
``SNAPSHOT_SLOTS`` slots. From these snapshots many tasks write the timetable, a row for each slot, and it
meets the blocks in a join by source and block that sorts both sides, whatever their sizes.

By default the characters of a source are to grow as its size to the power 0.9. As the last block of a source
is not full, and the only one of a small source nearly empty, its share of the slots is that of the
characters divided by the mean length of its blocks. Given shares are shares of the slots.

A block's number comes from running sums of lengths in a shuffled order of the source. These are taken in
two steps, within slices of the order and over the slices, so that a source with a third of all
rows is spread over many tasks; the sums over the slices of a source, a row for 4,096 documents, are one
task's. Texts are only measured.

No document is left out: the mix ends when every source has been used once, and a source
that runs out earlier begins again (``epoch`` 1, 2, ...), which is how a small source reaches its weight.

Null source: a source of its own. Null text: one character long, like an empty one. Null ``doc_id``: in the
place of its hash. Repeated rows are placed each. Empty table: empty result. Columns of other names do not
matter: names that ``in_order`` adds for its join are chosen among those not taken.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fungo.llm.common import LAST_ID, free_names
from fungo.session import materialize

BLOCK_CHARS = 1 << 14
SLICE_ROWS = 4096
TEMPER = 0.9
# Slots that leave a task at once, and slots from one snapshot to the next: these at least, and so many for
# each source.
CHUNK = 1 << 16
SNAPSHOT_SLOTS, SNAPSHOT_SLOTS_A_SOURCE = 1 << 20, 64


def whole_weights(shares: Mapping[str | None, float], period: int) -> dict[str | None, int]:
    """Shares as whole parts of ``period``: at least 1 each, the largest remainders rounded up."""
    if len(shares) > period:
        raise ValueError(f"{len(shares)} sources do not fit a period of {period} slots")
    total = sum(shares.values())
    names = sorted(shares, key=lambda name: (name is None, name))
    exact = {name: shares[name] / total * period for name in names}
    weights = {name: max(1, int(exact[name])) for name in names}
    while sum(weights.values()) < period:
        name = max(names, key=lambda n: exact[n] - weights[n])
        weights[name] += 1
    while sum(weights.values()) > period:
        name = min((n for n in names if weights[n] > 1), key=lambda n: exact[n] - weights[n])
        weights[name] -= 1
    return weights


def exact_weights(shares: Mapping[str | None, float]) -> dict[str | None, int]:
    """Whole numbers in the very proportions of ``shares``."""
    ratios = {name: share.as_integer_ratio() for name, share in shares.items()}
    if any(over <= 0 for over, _ in ratios.values()):
        raise ValueError("a share must be above 0, or its source would never be used")
    common = math.lcm(*(under for _, under in ratios.values()))
    return {name: over * (common // under) for name, (over, under) in ratios.items()}


def slots(
    weights: Mapping[str | None, int], first: int = 0, following: Sequence[int] | None = None
) -> Iterator[tuple]:
    """``(source, block, slot, release, deadline)`` for one slot after the other, without end.

    From slot ``first`` on, if ``following`` gives the next block of each source in the order of ``ranked``:
    when it is released and due follows from its number.
    """
    total = sum(weights.values())
    names = ranked(weights)
    parts = [weights[name] for name in names]
    following = following or [0] * len(names)
    waiting = [(block * total // parts[rank], rank, block) for rank, block in enumerate(following)]
    heapq.heapify(waiting)  # (release, source, block)
    ready: list[tuple[int, int, int, int]] = []  # (deadline, source, block, release)
    for slot in itertools.count(first):
        while waiting and waiting[0][0] <= slot:
            release, rank, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * total // parts[rank]), rank, block, release))
        deadline, rank, block, release = heapq.heappop(ready)
        yield names[rank], block, slot, release, deadline
        heapq.heappush(waiting, ((block + 1) * total // parts[rank], rank, block + 1))


def ranked(weights: Mapping[str | None, int]) -> list[str | None]:
    """Sources in the order in which equal deadlines are met."""
    return sorted(weights, key=lambda name: (name is None, name))


def schedule(weights: Mapping[str | None, int]) -> list[tuple]:
    """The slots of one period, the sum of the weights, after which they repeat."""
    return list(itertools.islice(slots(weights), sum(weights.values())))


def until_used(weights: Mapping[str | None, int], blocks: Mapping[str | None, int]) -> Iterator[tuple]:
    """The slots until every source has had all its blocks once."""
    left = len(blocks)
    for row in slots(weights) if left else ():
        yield row
        left -= row[1] + 1 == blocks[row[0]]
        if not left:
            return


def snapshots(
    weights: Mapping[str | None, int], blocks: Mapping[str | None, int], every: int
) -> Iterator[tuple[int, int, list[int]]]:
    """First slot, number of slots and each source's next block, for every so many slots of the mix."""
    following = dict.fromkeys(ranked(weights), 0)
    before, first, n = list(following.values()), 0, 0
    for source, block, *_ in until_used(weights, blocks):
        following[source] = block + 1
        n += 1
        if n == every:
            yield first, n, before
            before, first, n = list(following.values()), first + n, 0
    if n:
        yield first, n, before


def tempered(sizes: Mapping[str | None, int], temper: float = TEMPER) -> dict[str | None, float]:
    """Shares that grow as a power of the size: 1 keeps the proportions, 0 makes all sources equal."""
    return {name: size**temper for name, size in sizes.items()}


def _measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, the place in the shuffled order and the length of every row."""
    chars = F.greatest(F.length(F.coalesce(F.col("text"), F.lit(""))), F.lit(1)).cast("long")
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.xxhash64("doc_id", "text").alias("order"),
        chars.alias("chars"),
    )


def _starts(rows: DataFrame, slices: int) -> DataFrame:
    """``rows`` with ``start``: the characters of the source before this row."""
    width = max(0, (slices - 1).bit_length())
    # The leading bits of the hash, so that slices follow the order itself.
    slice_of = F.shiftright(F.col("order"), 64 - width) if width else F.lit(0).cast("long")
    sliced = rows.withColumn("slice", slice_of)
    sums = sliced.groupBy("source", "slice").agg(F.sum("chars").alias("slice_chars"))
    over = Window.partitionBy("source").orderBy("slice")
    before = sums.select(
        F.col("source").alias("of_source"),
        F.col("slice").alias("of_slice"),
        (F.sum("slice_chars").over(over) - F.col("slice_chars")).alias("before"),
    )
    within = Window.partitionBy("source", "slice").orderBy("order", "doc_id", "chars")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    running = sliced.withColumn("inside", F.coalesce(F.sum("chars").over(within), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("slice") == F.col("of_slice"))
    joined = running.join(before, same)
    return joined.select(
        "doc_id", "source", "order", "chars", (F.col("before") + F.col("inside")).alias("start")
    )


def _timetable(
    totals: DataFrame,
    shares: Mapping[str | None, float] | None,
    period: int | None,
    block_chars: int,
    temper: float,
    snapshot_slots: int,
) -> DataFrame:
    """``t_source``, ``t_block`` within the source, ``epoch``, ``block``, ``slot``, ``release``, ``deadline``."""
    names = ["t_source", "t_block", "epoch", "block", "slot", "release", "deadline"]

    def weighed(sizes: Mapping[str | None, int]) -> tuple[dict, dict]:
        """The weight and the number of blocks of each source."""
        blocks = {name: -(-size // block_chars) for name, size in sizes.items()}
        if shares is not None:
            wanted = {name: shares[name] for name in sizes}
        elif period is not None:
            wanted = tempered(sizes, temper)
        else:
            aims = tempered(sizes, temper)
            wanted = {name: aims[name] * blocks[name] / sizes[name] for name in sizes}
        weights = exact_weights(wanted) if period is None or not sizes else whole_weights(wanted, period)
        return weights, blocks

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: dict[str | None, int] = {}
        for batch in batches:
            sizes.update(zip(*(column.to_pylist() for column in batch.columns)))
        weights, blocks = weighed(sizes)
        order = ranked(weights)
        every = max(snapshot_slots, SNAPSHOT_SLOTS_A_SOURCE * len(order))
        for first, n, following in snapshots(weights, blocks, every):
            columns = [
                pa.array([first], pa.int64()), pa.array([n], pa.int64()),
                pa.array([order], pa.list_(pa.string())),
                pa.array([[sizes[name] for name in order]], pa.list_(pa.int64())),
                pa.array([following], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["first", "n", "sources", "sizes", "following"])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for snapshot in batch.to_pylist():
                weights, blocks = weighed(dict(zip(snapshot["sources"], snapshot["sizes"])))
                rows = slots(weights, snapshot["first"], snapshot["following"])
                rows = itertools.islice(rows, snapshot["n"])
                while chunk := list(itertools.islice(rows, CHUNK)):
                    source, block, *times = zip(*chunk)
                    epoch, within = zip(*(divmod(n, blocks[name]) for name, n in zip(source, block)))
                    columns = [pa.array(source, pa.string())]
                    columns += [pa.array(column, pa.int64()) for column in (within, epoch, block, *times)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    state = "first long, n long, sources array<string>, sizes array<long>, following array<long>"
    written = materialize(totals.repartition(1).mapInArrow(step, state), "mixing-snapshots")
    tasks = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    types = "t_source string, " + ", ".join(f"{name} long" for name in names[1:])
    return written.repartition(tasks, "first").mapInArrow(expand, types)


def mix(
    docs: DataFrame,
    shares: Mapping[str | None, float] | None = None,
    period: int | None = None,
    block_chars: int = BLOCK_CHARS,
    temper: float = TEMPER,
    slice_rows: int = SLICE_ROWS,
    snapshot_slots: int = SNAPSHOT_SLOTS,
) -> DataFrame:
    """``doc_id``, ``source``, ``epoch``, ``block``, ``slot``, ``release``, ``deadline``, ``start``, ``order``.

    A row for each use of a document; ``slot`` and ``start`` give its place in the mix. ``shares`` names
    the target of every source in slots, by default from the tempered sizes. Only with a ``period`` are the
    targets rounded to whole parts of it; it must have a slot for every source.
    """
    rows = materialize(_measured(docs), "mixing")
    totals = rows.groupBy("source").agg(F.sum("chars").alias("chars"))
    # The timetable grows with the corpus, so it is never broadcast.
    table = _timetable(totals, shares, period, block_chars, temper, snapshot_slots).hint("merge")
    starts = _starts(rows, -(-rows.count() // slice_rows))
    starts = starts.withColumn("in_source", F.floor(F.col("start") / F.lit(block_chars)))
    found = (F.col("in_source") == F.col("t_block")) & F.col("source").eqNullSafe(F.col("t_source"))
    return starts.join(table, found).select(
        "doc_id", "source", "epoch", "block", "slot", "release", "deadline", "start", "order"
    )


def in_order(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs`` as the mix uses them: repeated by epoch and sorted by their place in it.

    A row is found by its id and a hash of its id and text. Rows alike in both are joined as one and come
    out as often as the mix has places for them.
    """
    key, order, slot, start = free_names(docs, "key", "order", "slot", "start")
    own_key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    uses = mixed.select(
        own_key.alias(key), F.col("order").alias(order), F.col("slot").alias(slot), F.col("start").alias(start)
    )
    rows = docs.withColumns({key: own_key, order: F.xxhash64("doc_id", "text")})
    placed = rows.dropDuplicates([key, order]).join(uses, [key, order])
    return placed.orderBy(slot, start, order).select(*docs.columns)
