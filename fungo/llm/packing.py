"""Online packing of documents into sequences by the sum of squares rule.

Each task encodes its documents and packs them as they come. Whole windows of a long document are
sequences of their own; the rest of it goes where it makes the sum of squared counts of partially filled
sequences, one count for each fill level, least: into a sequence of some level, or a new one. The level
array and the sequences that are still open are all that a task holds. When more than ``most_open`` are
open, and at the end, the open ones are emptied into each other and cut at the window, so that nothing
is padded but the last remainder, and that is cut into powers of two, which need no padding.

Nothing is shuffled: a task's place in the plan and its own count make the sequence ids, so a repeated
task gives the same rows again. A null or empty text is the closing id alone. Repeated rows are packed
each. Documents of any length are read whole. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fungo.llm.tokens import PIECES_FILE, RANKS_FILE, encoder

WINDOW = 1024
END_ID = 0
MOST_OPEN = 2048
# Sequence ids count from the task's number times this.
TASK_SPAN = 1 << 40

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
Piece = tuple  # (document, start, ids); document is (doc_id, number of ids)


class Packer:
    """Packs pieces; finished sequences are handed to ``emit`` as lists of pieces."""

    def __init__(
        self, emit: Callable[[list[Piece]], None], window: int = WINDOW, most_open: int = MOST_OPEN
    ) -> None:
        self._emit, self._window, self._most_open = emit, window, most_open
        self._levels = np.zeros(window + 1, np.int64)
        self._open: list[list[list[Piece]]] = [[] for _ in range(window + 1)]
        self._n_open = 0

    def add(self, document: tuple, ids: np.ndarray) -> None:
        """Cut ``ids`` into whole windows and a rest, and place the rest."""
        whole = len(ids) // self._window * self._window
        for start in range(0, whole, self._window):
            self._emit([(document, start, ids[start : start + self._window])])
        if whole < len(ids):
            self._place((document, whole, ids[whole:]))
        if self._n_open > self._most_open:
            self._empty(self._window)

    def finish(self) -> None:
        rest = self._empty(self._window)
        while rest:
            power = 1 << (rest.bit_length() - 1)
            rest = self._empty(power)

    def level_for(self, size: int) -> int:
        """The fill level to join, 0 for a new sequence; of equal choices the fullest."""
        levels, window = self._levels, self._window
        before, after = levels[: window - size + 1], levels[size:]
        # Joining moves one sequence from a level to a higher one, or off the array when it is full.
        change = 2 * (after - before) + 2
        change[-1] = 1 - 2 * before[-1]
        change[1:][before[1:] == 0] = np.iinfo(np.int64).max
        change[0] = 2 * levels[size] + 1
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def _place(self, piece: Piece) -> None:
        size = len(piece[2])
        level = self.level_for(size)
        if level:
            pieces = self._take(level)
            pieces.append(piece)
        else:
            pieces = [piece]
        self._put(pieces, level + size)

    def _take(self, level: int) -> list[Piece]:
        self._levels[level] -= 1
        self._n_open -= 1
        return self._open[level].pop()

    def _put(self, pieces: list[Piece], level: int) -> None:
        if level == self._window:
            self._emit(pieces)
        else:
            self._levels[level] += 1
            self._n_open += 1
            self._open[level].append(pieces)

    def _empty(self, length: int) -> int:
        """Cut the open sequences, the fullest first, at every ``length`` ids; the rest stays open."""
        held: list[Piece] = []
        fill = 0
        for level in range(self._window - 1, 0, -1):
            while self._open[level]:
                for document, start, ids in self._take(level):
                    while fill + len(ids) >= length:
                        cut = length - fill
                        self._emit([*held, (document, start, ids[:cut])])
                        start, ids, held, fill = start + cut, ids[cut:], [], 0
                    if len(ids):
                        held.append((document, start, ids))
                        fill += len(ids)
        if fill:
            self._put(held, fill)
        return fill


def _columns(sequences: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
    rows = []
    for sequence, pieces in sequences:
        offset = 0
        for (doc_id, total), start, ids in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            rows.append((doc_id, start, len(ids), crc, total, sequence, offset))
            offset += len(ids)
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
    return pa.RecordBatch.from_arrays(columns, names)


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    pieces_file: str = PIECES_FILE,
    ranks_file: str = RANKS_FILE,
    most_open: int = MOST_OPEN,
) -> DataFrame:
    """A row for each piece of a document: where it starts there, and its sequence and offset in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[int, list[Piece]]] = []
        following = iter(range(TaskContext.get().partitionId() * TASK_SPAN, 1 << 63))
        packer = Packer(lambda pieces: done.append((next(following), pieces)), window, most_open)
        ids_of = encoder(pieces_file, ranks_file).ids
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*ids_of(text.as_py()), END_ID], np.uint32)
                packer.add((doc_id, len(ids)), ids)
                if len(done) >= 4096:
                    yield _columns(done)
                    done.clear()
        packer.finish()
        if done:
            yield _columns(done)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return chosen.mapInArrow(run, SCHEMA)
