"""Benchmark passages in documents by the q-gram lemma and banded alignment.

A passage of m characters and a region that differs from it by at most e edits share at least
m + 1 - q (e + 1) q-grams, and these lie on diagonals (place in the document minus place in the
passage) that differ by at most e. Shared q-grams are counted in overlapping bands of diagonals,
so that any e + 1 neighbouring diagonals lie in one band; bands that reach the bound are verified
by an alignment inside the band, with a free start and end in the document.

The benchmark is a query set: it is read in blocks of bounded size, each block meets every
document, and documents are never shuffled. Texts are compared in lower case with runs of white
space as one space; long items are cut into half-overlapping passages. Very long documents are
read in overlapping slices.

Defined results: null and empty texts, and items with fewer than ``q`` characters, match nothing.
Equal items, equal rows and null ids are treated one by one. Columns of the documents stay.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Q = 8
EDIT_RATE = 0.1
# Characters of a passage, of a slice of a document, and of a block of benchmark items.
PASSAGE, SLICE, BLOCK = 256, 1 << 19, 1 << 22
_FILTER_BITS = 22
_ODD = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def grams(chars: np.ndarray, q: int) -> np.ndarray:
    """One 64-bit hash per run of ``q`` characters."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    found = np.zeros(n, np.uint64)
    for k in range(q):
        found = (found + chars[k:k + n] + np.uint64(1)) * _ODD
        found ^= found >> np.uint64(29)
    return found


@dataclass
class Match:
    item: int
    shared: int
    edits: int
    start: int
    end: int


_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _cost(passage: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int]:
    """Fewest edits between ``passage`` and a part of ``text`` on diagonals ``low`` to ``high``,
    and the end of that part; more than ``most`` edits are not counted out.

    Outside of the text stands a character that equals none: to meet it costs as much as to leave
    the passage's character out.
    """
    width, m, n = high - low + 1, len(passage), len(text)
    around = np.full(m + width, _NONE)
    first, last = max(low, 0), min(low + m + width, n)
    if last > first:
        around[first - low:last - low] = text[first:last]
    steps = np.arange(width)
    cost, up = np.zeros(width, np.int64), np.empty(width, np.int64)
    for i in range(m):
        up[:-1] = cost[1:]
        up[-1] = m
        up += 1
        best = np.minimum(cost + (around[i:i + width] != passage[i]), up)
        # Extra characters of the text: from a lower diagonal, one edit each.
        best -= steps
        cost = np.minimum.accumulate(best) + steps
        if i % 8 == 7 and cost.min() > most:
            break
    k = int(np.argmin(cost))
    return int(cost[k]), min(max(m + low + k, 0), n)


def align(passage: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """The best alignment in the band, if it takes at most ``most`` edits: edits, start and end in the text."""
    m, n = len(passage), len(text)
    first, last = max(low, 0), min(high + m, n)
    exact = text[first:last].tobytes().find(passage.tobytes())
    if exact >= 0 and exact % passage.itemsize == 0:
        start = first + exact // passage.itemsize
        return 0, start, start + m
    edits, end = _cost(passage, text, low, high, most)
    if edits > most:
        return None
    # The same from right to left, from that end, gives the start.
    part = text[max(end - m - most, 0):end]
    back, length = _cost(passage[::-1], part[::-1], -most, most, m)
    start = end - length if back <= edits else max(end - m, 0)
    return edits, start, end


class Passages:
    """A block of benchmark items, ready for search."""

    def __init__(self, texts: Sequence[str], q: int = Q, rate: float = EDIT_RATE):
        self.q = q
        self.item: list[int] = []
        self.chars: list[np.ndarray] = []
        for item, text in enumerate(texts):
            whole = codes(normal(text or ""))
            starts = [0] if len(whole) <= PASSAGE else [
                *range(0, len(whole) - PASSAGE, PASSAGE // 2), len(whole) - PASSAGE]
            for s in starts:
                part = whole[s:s + PASSAGE]
                if len(part) >= q:
                    self.item.append(item)
                    self.chars.append(part)
        size = np.array([len(c) for c in self.chars], np.int64)
        # No more edits than leave one shared q-gram for certain.
        self.edits = np.minimum((size * rate).astype(np.int64), size // q - 1).clip(0)
        self.bound = size + 1 - q * (self.edits + 1)
        self.band = self.edits + 1
        hashes = [grams(c, q) for c in self.chars]
        gram = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.empty(0, np.int64)
        order = np.argsort(gram, kind="stable")
        self.gram, self.owner, self.place = gram[order], owner[order], place[order]
        self.hit = np.zeros(1 << _FILTER_BITS, bool)
        self.hit[self._slot(self.gram)] = True
        self.reach = int(size.max() + 2 * self.band.max()) if len(size) else 0

    @staticmethod
    def _slot(gram: np.ndarray) -> np.ndarray:
        return (gram >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def find(self, text: str | None) -> list[Match]:
        """The best match per item."""
        if not text or not self.chars:
            return []
        chars, best = codes(normal(text)), {}
        at = 0
        while True:
            for m in self._slice(chars[at:at + SLICE + self.reach], at):
                if m.item not in best or (m.edits, m.start) < (best[m.item].edits, best[m.item].start):
                    best[m.item] = m
            at += SLICE
            if at >= len(chars):
                return [best[k] for k in sorted(best)]

    def _slice(self, chars: np.ndarray, offset: int) -> Iterator[Match]:
        gram = grams(chars, self.q)
        where = np.flatnonzero(self.hit[self._slot(gram)])
        if not len(where):
            return
        low = np.searchsorted(self.gram, gram[where], "left")
        count = np.searchsorted(self.gram, gram[where], "right") - low
        total = int(count.sum())
        if not total:
            return
        # One entry per place in the text and equal q-gram of a passage.
        text_at = np.repeat(where, count)
        entry = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(total)
        owner, diagonal = self.owner[entry], text_at - self.place[entry]
        band = diagonal // self.band[owner]
        # Every diagonal lies in two bands of twice the width.
        span = int(band.max() - band.min()) + 3
        base = int(band.min()) - 1
        key = np.concatenate([owner * span + (band - base), owner * span + (band - base - 1)])
        found, shared = np.unique(key, return_counts=True)
        keep = shared >= self.bound[found // span]
        found, shared = found[keep], shared[keep]
        exact: set[int] = set()
        for i in np.argsort(-shared, kind="stable"):
            p, b = int(found[i] // span), int(found[i] % span) + base
            if p in exact:
                continue
            width = int(self.band[p])
            aligned = align(self.chars[p], chars, b * width, (b + 2) * width - 1, int(self.edits[p]))
            if aligned:
                edits, start, end = aligned
                if not edits:
                    exact.add(p)
                yield Match(self.item[p], int(shared[i]), edits, start + offset, end + offset)


def _blocks(items: DataFrame, text: str, keys: Sequence[str], block_chars: int) -> Iterator[list]:
    """The items in parts of about ``block_chars`` characters."""
    size = items.agg(F.sum(F.char_length(F.col(f"`{text}`")))).first()[0] or 0
    n = max(1, -(-size // block_chars))
    block = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`")), F.lit(n))
    for b in range(n):
        rows = items.filter(block == b).select(*keys, text).collect()
        if rows:
            yield sorted(rows, key=lambda r: (str(r[0]), r[text] or ""))


def matches(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id", text: str = "text",
    q: int = Q, rate: float = EDIT_RATE, block_chars: int = BLOCK,
) -> DataFrame:
    """One row per document and item found in it: shared q-grams of the band, edits, and the span
    in the normalised text."""
    kind, item_kind = docs.schema[key].dataType, items.schema[item_key].dataType
    schema = T.StructType([
        T.StructField(key, kind), T.StructField(item_key, item_kind),
        *T.StructType.fromDDL("shared long, edits long, start long, end long").fields,
    ])
    result = None
    for rows in _blocks(items, text, (item_key,), block_chars):
        search, ids = [r[text] for r in rows], [r[item_key] for r in rows]

        def run(batches: Iterator[pa.RecordBatch], search=search, ids=ids) -> Iterator[pa.RecordBatch]:
            passages = Passages(search, q, rate)
            for batch in batches:
                kinds = [batch.schema.field(0).type, pa.array(ids).type] + [pa.int64()] * 4
                out = [
                    (doc, ids[m.item], m.shared, m.edits, m.start, m.end)
                    for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for m in passages.find(t)
                ]
                columns = list(zip(*out)) if out else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names
                )

        found = docs.select(key, text).mapInArrow(run, schema)
        result = found if result is None else result.union(found)
    return result if result is not None else docs.sparkSession.createDataFrame([], schema)


def clean(
    docs: DataFrame, items: DataFrame, item_key: str = "item_id", text: str = "text",
    q: int = Q, rate: float = EDIT_RATE, block_chars: int = BLOCK,
) -> DataFrame:
    """The documents without any item in them, all columns unchanged."""
    place = docs.columns.index(text)
    for rows in _blocks(items, text, (item_key,), block_chars):
        search = [r[text] for r in rows]

        def run(batches: Iterator[pa.RecordBatch], search=search) -> Iterator[pa.RecordBatch]:
            passages = Passages(search, q, rate)
            for batch in batches:
                keep = [not passages.find(t) for t in batch.column(place).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
