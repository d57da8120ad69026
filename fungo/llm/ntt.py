"""Exact cyclic convolutions of integers by number-theoretic transforms, many short ones at once.

Residues are kept between -p/2 and p/2 in doubles, and a transform is split into steps of at most 64
points, each a matrix product. No sum exceeds ``64 * (p / 2) ** 2 < 2 ** 53``, so every product is exact
whatever order it is added in.
"""

from __future__ import annotations

import functools

import numpy as np

# Primes k * 2**m + 1 below 2**24.5, in the order of use.
PRIMES = (23068673, 13631489, 7340033)
# All have roots of unity of this order.
LONGEST = 1 << 20
RADIX = 64


def reduced(values: np.ndarray, prime: int) -> np.ndarray:
    """Residues nearest to zero; zero exactly for multiples of the prime."""
    return values - prime * np.rint(values * (1.0 / prime))


@functools.lru_cache(maxsize=None)
def _root(size: int, prime: int) -> int:
    """A root of unity of order ``size``."""
    for base in range(2, prime):
        root = pow(base, (prime - 1) // size, prime)
        if size == 1 or pow(root, size // 2, prime) == prime - 1:
            return root
    raise ValueError(f"{prime} has no root of order {size}")


def _powers(root: int, exponents: np.ndarray, size: int, prime: int) -> np.ndarray:
    table = np.ones(size, np.int64)
    for k in range(1, size):
        table[k] = table[k - 1] * root % prime
    return reduced(table[exponents % size].astype(np.float64), prime)


@functools.lru_cache(maxsize=None)
def _step(size: int, prime: int) -> tuple[np.ndarray, ...]:
    """For one step: transform matrix and its inverse, and the turns between this step and the rest."""
    points = min(size, RADIX)
    rest = size // points
    grid = np.outer(np.arange(points), np.arange(points))
    root = _root(size, prime)
    inverse, share = pow(root, -1, prime), pow(points, -1, prime)
    there = _powers(pow(root, rest, prime), grid, points, prime)
    back = reduced(_powers(pow(inverse, rest, prime), grid, points, prime) * share, prime)
    turns = np.outer(np.arange(points), np.arange(rest))
    return there, back, _powers(root, turns, size, prime), _powers(inverse, turns, size, prime)


def forward(values: np.ndarray, prime: int) -> np.ndarray:
    """Transform of the last axis, in an order that only ``inverse`` undoes."""
    size = values.shape[-1]
    there, _, turn, _ = _step(size, prime)
    if size <= RADIX:
        return reduced(values @ there, prime)
    split = values.reshape(-1, RADIX, size // RADIX)
    turned = reduced(reduced(np.matmul(there, split), prime) * turn, prime)
    return forward(turned, prime).reshape(values.shape)


def inverse(values: np.ndarray, prime: int) -> np.ndarray:
    size = values.shape[-1]
    _, back, _, turn = _step(size, prime)
    if size <= RADIX:
        return reduced(values @ back, prime)
    split = inverse(values.reshape(-1, RADIX, size // RADIX), prime)
    turned = reduced(split * turn, prime)
    return reduced(np.matmul(back, turned), prime).reshape(values.shape)


def primes_beyond(bound: int) -> tuple[int, ...]:
    """The fewest primes whose product exceeds ``bound``: a sum up to it is zero if it is modulo each."""
    product = 1
    for k, prime in enumerate(PRIMES):
        product *= prime
        if product > bound:
            return PRIMES[: k + 1]
    raise ValueError(f"{bound} is beyond the product of the primes")
