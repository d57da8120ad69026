"""The binary Golay code of length 23, and keys that vectors a few bits apart share.

Every 23-bit vector lies within distance 3 of exactly one codeword. The indices of a vector are those of
all codewords within distance 4: one if the nearest is at most 2 away, else six. Two vectors that differ
in at most 2 bits share an index: a vector halfway differs from each in at most 1 bit and has a codeword
within 3.

A 64-bit fingerprint is cut into four segments of 16 bits. If two fingerprints differ in at most 3 bits,
some segment D is equal in both. Of the other 48 bits, two runs A and B of 23 are decoded. Either both
differ in at most 2 bits, and then the fingerprints share D, an index of A and an index of B; or one
differs in 3, and then they share D and the whole other run. Hence the keys of a fingerprint, for each D:
D with every pair of indices (at most 36), D with A, and D with B. A key holds at least 39 bits, so
that chance companions stay few in a large corpus.

One side of a comparison needs fewer. Of two runs that both differ in at most 2 bits, one differs in at
most 1, and there the nearest codeword of either vector is within 4 of the other. So the home keys, those
pairs that hold the nearest codeword of A or of B (at most 11), meet a key of every companion.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np

LENGTH, CHECK_BITS = 23, 11
RUN = (1 << LENGTH) - 1
# Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the code.
GENERATOR = 0b110001110101
SEGMENTS, SEGMENT_BITS = 4, 16
INDEXED, EXACT_A, EXACT_B = range(3)
LEAD_A, LEAD_B = 1, 2


def syndrome(vector: int) -> int:
    """The remainder of ``vector`` by the generator; 0 for codewords."""
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if vector >> bit & 1:
            vector ^= GENERATOR << (bit - CHECK_BITS)
    return vector


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits, and per syndrome up to six errors (else -1)."""
    low = np.array([syndrome(x) for x in range(1 << 12)], np.int64)
    high = np.array([syndrome(x << 12) for x in range(1 << 11)], np.int64)
    errors: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(5):
        for places in itertools.combinations(range(LENGTH), weight):
            error = sum(1 << place for place in places)
            errors[syndrome(error)].append(error)
    nearby = np.full((1 << CHECK_BITS, 6), -1, np.int64)
    for row, found in zip(nearby, errors):
        row[: len(found)] = found
    return low, high, nearby


def indices(vectors: np.ndarray) -> np.ndarray:
    """Codeword indices of 23-bit vectors, the nearest first; -1 where there are fewer than six."""
    low, high, nearby = _tables()
    errors = nearby[low[vectors & 0xFFF] ^ high[vectors >> 12]]
    return np.where(errors < 0, -1, (vectors[:, None] ^ errors) >> CHECK_BITS)


def _runs(fingerprints: np.ndarray, segment: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment D and the runs A and B of the remaining bits."""
    shift = SEGMENT_BITS * segment
    above = shift + SEGMENT_BITS
    chosen = (fingerprints >> np.uint64(shift)) & np.uint64(0xFFFF)
    rest = fingerprints & np.uint64((1 << shift) - 1)
    if above < 64:
        rest = rest | (fingerprints >> np.uint64(above)) << np.uint64(shift)
    run_a = rest & np.uint64(RUN)
    run_b = (rest >> np.uint64(LENGTH)) & np.uint64(RUN)
    return chosen.astype(np.int64), run_a.astype(np.int64), run_b.astype(np.int64)


def run_masks(segment: int) -> tuple[int, int]:
    """The bits of a fingerprint that form A and B when ``segment`` is D."""
    places = [bit for bit in range(64) if bit // SEGMENT_BITS != segment]
    cut = places[:LENGTH], places[LENGTH : 2 * LENGTH]
    return tuple(sum(1 << bit for bit in run) for run in cut)


def tag(segment: int, kind: int) -> int:
    return segment * 3 + kind


def keys(fingerprints: np.ndarray, home: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parallel arrays: row of the fingerprint, key, and which of its indices are the nearest ones.

    ``home`` gives the home keys only. A key is ``tag << 40 | D << 24 | indices or run``.
    """
    rows, found, leads = [], [], []
    each = np.arange(len(fingerprints))
    none = np.zeros(len(each), np.int64)
    first = np.arange(6) == 0
    lead = (first[:, None] * LEAD_A + first[None, :] * LEAD_B).reshape(1, 36)
    for segment in range(SEGMENTS):
        chosen, run_a, run_b = _runs(fingerprints, segment)
        index_a, index_b = indices(run_a), indices(run_b)
        both = (index_a[:, :, None] << 12 | index_b[:, None, :]).reshape(-1, 36)
        real = ((index_a >= 0)[:, :, None] & (index_b >= 0)[:, None, :]).reshape(-1, 36)
        base = chosen << 24
        at, which = np.nonzero(real & (lead > 0) if home else real)
        rows += [at, each, each]
        found += [
            tag(segment, INDEXED) << 40 | base[at] | both[at, which],
            tag(segment, EXACT_A) << 40 | base | run_a,
            tag(segment, EXACT_B) << 40 | base | run_b,
        ]
        leads += [lead[0, which], none, none]
    return np.concatenate(rows), np.concatenate(found), np.concatenate(leads)
