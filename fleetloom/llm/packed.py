"""Sums and exchanges of 64-bit keys as sorted arrays.

A task adds up the keys that it has gathered and sends each range of the key space as one row
(``bucket``, ``keys`` and ``counts`` as bytes), so that a key costs its bytes and no row of its own.
Keys are hashes: every range gets about the same number, and a frequent key is one entry per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Keys that one task holds at a time, on both sides of an exchange.
HELD_KEYS = 2_000_000
# Ranges per receiving task, so that tasks get even shares.
RANGES_PER_TASK = 8


def in_order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of unsigned ``keys``, and the keys in it. Their high bits are sorted with their places in
    the low ones, which is much faster than an argsort; where that leaves two keys wrong, an argsort decides."""
    mask = np.uint64((1 << max(len(keys) - 1, 1).bit_length()) - 1)
    both = (keys & ~mask) | np.arange(len(keys), dtype=np.uint64)
    both.sort()
    order = (both & mask).astype(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys)
        ordered = keys[order]
    return order, ordered


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, a place where each stands, and the sums of its counts."""
    if not len(keys):
        return keys, np.empty(0, np.int64), counts
    order, ordered = in_order(keys)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], order[first], np.add.reduceat(counts[order], first)


def range_bits(n_keys: int, tasks: int) -> tuple[int, int]:
    """Receiving tasks for ``n_keys`` keys in all, and the bits that number their ranges."""
    tasks = max(tasks, -(-n_keys // HELD_KEYS))
    return tasks, (tasks * RANGES_PER_TASK - 1).bit_length()


def ranges(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the ranges of sorted unsigned ``keys`` that hold any."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(keys) else []
    for at, to in zip(edges[:-1], edges[1:]):
        yield int(bucket[at]), int(at), int(to)
