"""Maximal periodic stretches of words, found by block convolution.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no
neighbouring word extends and that is at least ``LEAST_TURNS`` periods and ``LEAST_WORDS`` words long.

Scale B = 1, 2, 4, ... finds the periods q from B to 2B - 1. The text is cut into blocks of B words. A run
of such a period leaves at least 3q words that equal those q further on, so two neighbouring blocks at least
occur again at distance q without a mismatch. Per block, the number theoretic transform gives the sum of
squared differences of word numbers at all B distances at once: the squares by running sums, the products
by a cyclic convolution of 2B points, modulo as many primes as the largest possible sum needs. The sum is
zero only where all words agree. Distances at which two neighbouring blocks fit seed an extension to both
sides, word by word; blocks inside a run whose period divides the distance are passed over, because they
only repeat that run. Blocks of more than ``LONGEST_BLOCK`` words are compared by their first
``LONGEST_BLOCK``; the extension checks the rest. The work is n log^2 n for n words.

Documents are taken in groups of about ``GROUP`` words so that short ones share their transforms. A
document is one row of one task: no shuffle, and memory for the longest text only.

Null or empty text: no words, no runs, an empty collapsed text. Null ``doc_id``: kept as it is. Repeated rows
are treated each. Very long texts are processed whole. Empty table: empty result. Only ``doc_id`` and
``text`` are read, so other columns can not clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fungo.llm import ntt

LEAST_WORDS, LEAST_TURNS = 6, 4
LONGEST_BLOCK = 1 << 15
# Words whose documents are searched together, and points of a batch of transforms.
GROUP = 1 << 18
POINTS = 1 << 17

RUNS_TYPE = "array<struct<start:long,length:long,period:long>>"


class _Texts:
    """Documents as one row of word numbers, each counted from 0 within its document."""

    def __init__(self, documents: list[list[bytes]]) -> None:
        self.sizes = np.array([len(words) for words in documents], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        self.words = np.empty(int(self.sizes.sum()), np.int64)
        self.distinct = 1
        for begin, end, words in zip(self.begins.tolist(), self.ends.tolist(), documents):
            numbers: dict[bytes, int] = {}
            self.words[begin:end] = [numbers.setdefault(word, len(numbers)) for word in words]
            self.distinct = max(self.distinct, len(numbers))
        self.squares = np.concatenate(([0], np.cumsum(self.words * self.words)))

    def blocks(self, scale: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the blocks that can occur again in their document, and the document's end."""
        least = max(LEAST_WORDS, LEAST_TURNS * scale)
        counts = np.where(self.sizes >= least, (self.sizes - block) // scale, 0)
        whose = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(whose)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.begins[whose] + within * scale, self.ends[whose]


def _fitting(texts: _Texts, starts: np.ndarray, first: int, block: int) -> np.ndarray:
    """For each block and distance from ``first`` to ``first + block - 1``: whether no word differs."""
    words, size = texts.words, 2 * block
    last = len(words) - 1
    reversed_blocks = np.zeros((len(starts), size))
    reversed_blocks[:, :block] = words[starts[:, None] + np.arange(block - 1, -1, -1)]
    windows = words[np.minimum(starts[:, None] + first + np.arange(size), last)].astype(np.float64)
    at = np.minimum(starts[:, None] + first + np.arange(block), last + 1 - block)
    squares = texts.squares[at + block] - texts.squares[at]
    squares += (texts.squares[starts + block] - texts.squares[starts])[:, None]
    fits = np.ones((len(starts), block), bool)
    for prime in ntt.primes_beyond(block * (texts.distinct - 1) ** 2):
        products = ntt.forward(ntt.reduced(reversed_blocks, prime), prime)
        products *= ntt.forward(ntt.reduced(windows, prime), prime)
        products = ntt.inverse(ntt.reduced(products, prime), prime)[:, block - 1 : size - 1]
        fits &= ntt.reduced((squares % prime) - 2 * products, prime) == 0
    return fits


def _seeds(texts: _Texts, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and distances of the blocks of a scale that occur again without a mismatch."""
    block = min(scale, LONGEST_BLOCK)
    starts, ends = texts.blocks(scale, block)
    at_once = max(1, POINTS // (2 * block))
    found_starts, found_distances = [], []
    for k in range(0, len(starts), at_once):
        some, some_ends = starts[k : k + at_once], ends[k : k + at_once]
        for first in range(scale, 2 * scale, block):
            inside = some + first + block <= some_ends
            if not inside.any():
                break
            some, some_ends = some[inside], some_ends[inside]
            rows, steps = np.nonzero(_fitting(texts, some, first, block))
            whole = some[rows] + first + steps + block <= some_ends[rows]
            found_starts.append(some[rows[whole]])
            found_distances.append(first + steps[whole])
    if not found_starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_starts), np.concatenate(found_distances)


def _neighbours(starts: np.ndarray, distances: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the seeds, those in a row of blocks that can be long enough, by distance and start."""
    order = np.lexsort((starts, distances))
    starts, distances = starts[order], distances[order]
    begins = np.ones(len(starts), bool)
    begins[1:] = (distances[1:] != distances[:-1]) | (starts[1:] != starts[:-1] + scale)
    row = np.cumsum(begins) - 1
    lengths = np.bincount(row, minlength=1)
    needed = np.maximum(LEAST_WORDS, LEAST_TURNS * distances) - distances
    kept = (lengths[row] + 2) * scale - 2 >= needed
    if scale <= LONGEST_BLOCK:
        # Whole blocks touch: the extension from the first covers the row.
        kept &= begins
    return starts[kept], distances[kept]


def _outside(
    starts: np.ndarray, distances: np.ndarray, known: dict[int, list[tuple[int, int]]]
) -> np.ndarray:
    """Seeds that lie in no known run whose period divides their distance."""
    new = np.ones(len(starts), bool)
    for period, stretches in known.items():
        begins, ends = (np.array(side) for side in zip(*sorted(stretches)))
        at = np.searchsorted(begins, starts, "right") - 1
        inside = (at >= 0) & (ends[np.maximum(at, 0)] >= starts + distances)
        new &= ~(inside & (distances % period == 0))
    return new


def _agreeing(left: np.ndarray, right: np.ndarray) -> int:
    """How many leading items are equal, looking at twice as many each time."""
    done, step = 0, 64
    while done < len(left):
        equal = left[done : done + step] == right[done : done + step]
        if not equal.all():
            return done + int(equal.argmin())
        done, step = done + len(equal), 2 * step
    return done


def _is_primitive(turn: np.ndarray) -> bool:
    """Whether the words of one period are no repetition of fewer."""
    rest, divisor = len(turn), 2
    while rest > 1:
        if rest % divisor:
            divisor = divisor + 1 if divisor * divisor <= rest else rest
            continue
        while rest % divisor == 0:
            rest //= divisor
        part = len(turn) // divisor
        if np.array_equal(turn[part:], turn[:-part]):
            return False
    return True


def _runs_of_group(texts: _Texts) -> list[list[tuple[int, int, int]]]:
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts.sizes]
    known: dict[int, list[tuple[int, int]]] = {}
    longest = int(texts.sizes.max(initial=0))
    words, scale = texts.words, 1
    while LEAST_TURNS * scale <= longest:
        starts, distances = _neighbours(*_seeds(texts, scale), scale)
        new = _outside(starts, distances, known)
        before, covered = 0, 0
        for start, distance in zip(starts[new].tolist(), distances[new].tolist()):
            if distance == before and start < covered:
                continue
            document = int(np.searchsorted(texts.ends, start, "right"))
            begin, end = int(texts.begins[document]), int(texts.ends[document])
            right = start + _agreeing(words[start : end - distance], words[start + distance : end])
            left = start - _agreeing(
                words[begin:start][::-1], words[begin + distance : start + distance][::-1]
            )
            before, covered = distance, right
            length = right - left + distance
            long_enough = length >= max(LEAST_WORDS, LEAST_TURNS * distance)
            if long_enough and _is_primitive(words[left : left + distance]):
                found[document].append((left - begin, length, distance))
                known.setdefault(distance, []).append((left, left + length))
        scale *= 2
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in found]


def runs_of(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """``start``, ``length``, ``period`` of every run of each document, by start and period."""
    found, waiting, held = [], [], 0
    for words in documents:
        waiting.append(words)
        held += len(words)
        if held >= GROUP:
            found += _runs_of_group(_Texts(waiting))
            waiting, held = [], 0
    return found + (_runs_of_group(_Texts(waiting)) if waiting else [])


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats: all after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    dropped = (np.cumsum(edges[:-1]) > 0).tolist()
    return [word for word, gone in zip(words, dropped) if not gone]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
    for batch in batches:
        for part in _parts(batch):
            documents = [text.as_py().encode("utf-8").split() if text.is_valid else [] for text in part.column(1)]
            runs = runs_of(documents)
            texts = [b" ".join(collapsed(*one)).decode("utf-8") for one in zip(documents, runs)]
            rows = [[dict(zip(("start", "length", "period"), run)) for run in one] for one in runs]
            columns = [
                part.column(0), pa.array([len(words) for words in documents], pa.int64()),
                pa.array(rows, run_type), pa.array(texts, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows with about ``4 * GROUP`` bytes of text at once."""
    sizes = [len(text.as_py() or "") for text in batch.column(1)]
    begin, held = 0, 0
    for k, size in enumerate(sizes):
        held += size
        if held >= 4 * GROUP or k == len(sizes) - 1:
            yield batch.slice(begin, k + 1 - begin)
            begin, held = k + 1, 0


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` by start and period, and the ``collapsed`` text of every row."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = f"doc_id long, n_words long, runs {RUNS_TYPE}, collapsed string"
    return chosen.mapInArrow(_search, schema)
