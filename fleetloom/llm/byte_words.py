"""Words as spans of bytes, with hashes, for a whole Arrow column at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from fleetloom.llm.jaccard import _A, mixed

# Bytes that are hashed at a time; a longer word is hashed alone.
SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C55


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column without nulls, and where each row begins (one more for
    the end)."""
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of bytes that are ``inside``; rows end a run."""
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = offsets[(offsets > 0) & (offsets < len(inside))]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    first[cut] = inside[cut]
    last[:-1] &= ~inside[1:]
    last[cut - 1] = inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class WordHasher:
    """64-bit hashes of spans of bytes, or of other numbers below ``size``: polynomials over random numbers for
    these, mixed with the length."""

    def __init__(self, size: int = 256):
        self.values = mixed((np.arange(size, dtype=np.uint64) + np.uint64(1)) * _A) | np.uint64(1)
        self.powers = self.inverse = np.empty(0, np.uint64)

    def _reach(self, n: int) -> None:
        if n > len(self.powers):
            self.powers = np.cumprod(np.full(n, _BASE, np.uint64))
            self.inverse = np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            base = int(starts[at])
            to = max(at + 1, int(np.searchsorted(ends, base + SLICE, "right")))
            part = data[base:int(ends[to - 1])]
            self._reach(len(part))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values[part] * self.powers[:len(part)])])
            s, e = starts[at:to] - base, ends[at:to] - base
            out[at:to] = mixed((sums[e] - sums[s]) * self.inverse[s] + (e - s).astype(np.uint64) * _A)
            at = to
        return out


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each key its number among the distinct ones, these in order of first sight, and where each
    stands first."""
    known = pa.array(keys).dictionary_encode()
    numbers = known.indices.to_numpy()
    distinct = known.dictionary.to_numpy()
    first = np.empty(len(distinct), np.int64)
    first[numbers[::-1]] = np.arange(len(keys) - 1, -1, -1)
    return numbers, distinct, first
