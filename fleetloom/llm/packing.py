"""Hierarchical packing into several context sizes.

The context sizes are powers of two. A document is tokenised, ends with an end id, gives its full
longest windows at once, and its rest is routed to the smallest size that holds it. A task packs
its rests in buffers of bounded size: windows of a size start with a document of that size, their
gaps are filled from shorter tiers, longest first, and what does not fit is cut, so that every
window is full. What is left of a buffer goes into the next one; the tail of a partition is
cut at powers of two, which need no padding. Finished sequences are put into step groups of equal
token sums.

One pass without a shuffle: a partition is packed by the task that reads it. Ids of sequences hold
the partition, so a task that runs again yields the same ids.

Defined results: a null text is an empty one and consists of the end id alone. Equal rows, null
ids and repeated ids are separate documents. Only the named key columns are returned.
"""

from __future__ import annotations

import re
from array import array
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetloom.llm.tokens import Cache, byte_letters, content, load

SIZES = (256, 512, 1024, 2048)
# A task packs what it holds at this many tokens or waiting pieces.
BUFFER_TOKENS = 4_000_000
BUFFER_PIECES = 100_000
STEP_SEQUENCES = 16

# White space that the library drops; the four separators \\x1c-\\x1f are none to it.
_SEPARATORS = tuple("\x1c\x1d\x1e\x1f")


@dataclass
class Piece:
    """Tokens ``start`` to ``start + len(ids)`` of a document."""

    row: int
    start: int
    ids: np.ndarray

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.row, self.start, self.ids[:n]), Piece(self.row, self.start + n, self.ids[n:])


# The vocabulary's own splitting rule, written out for the first 256 characters.
_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºÀ-ÖØ-öø-ÿ]+|[0-9²³¹¼½¾]|[^\sa-zªµºÀ-ÖØ-öø-ÿ0-9²³¹¼½¾]+"
)


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Ids of a text whose vocabulary drops white space and case. A text within the first 256
    characters is split here, and its pieces are merged once each and kept in a cache. Of other texts the
    words come one by one from a cache; those beyond these characters go through the whole library."""

    def __init__(self, json_text: str):
        self.tokenizer = load(json_text)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.code = np.dtype(self.kind).char
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters, self.merge = byte_letters(self.tokenizer), self.tokenizer.model.tokenize
        self.words, self.pieces = Cache(self._word), Cache(self._piece)

    def _piece(self, piece: str) -> bytes:
        return array(self.code, [t.id for t in self.merge(piece.translate(self.letters))]).tobytes()

    def _word(self, word: str) -> bytes:
        return b"".join(self._split(word)) if self._plain(word) else self._whole(word)

    def _plain(self, text: str) -> bool:
        return _latin(text) and not any(s in text for s in self.special)

    def _split(self, text: str) -> list[bytes]:
        return list(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def __call__(self, text: str, end: int) -> np.ndarray:
        if any(c in text for c in _SEPARATORS):
            parts = [self._whole(text)]
        elif self._plain(text):
            parts = self._split(text)
        else:
            parts = list(map(self.words.__getitem__, text.split()))
        parts.append(np.asarray([end], self.kind).tobytes())
        return np.frombuffer(b"".join(parts), self.kind)


@dataclass
class Packer:
    """Packs the rests of one partition; ``pack`` yields full sequences as lists of pieces."""

    sizes: Sequence[int] = SIZES
    tiers: dict[int, deque[Piece]] = field(default_factory=dict)
    held: int = 0

    def __post_init__(self) -> None:
        self.tiers = {s: deque() for s in self.sizes}

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        longest = self.sizes[-1]
        while len(piece.ids) >= longest:
            window, piece = piece.cut(longest)
            yield [window]
        if len(piece.ids):
            self._route(piece)
            self.held += len(piece.ids)

    def _route(self, piece: Piece) -> None:
        self.tiers[next(s for s in self.sizes if s >= len(piece.ids))].append(piece)

    def _fill(self, size: int) -> list[Piece] | None:
        """A full window of ``size``, begun with a document of that tier; None if too little is left."""
        if sum(len(p.ids) for p in _upto(self.tiers, size, size)) < size:
            return None
        window, gap = [self.tiers[size].popleft()], size
        gap -= len(window[0].ids)
        for tier in [s for s in reversed(self.sizes) if s < size] + [size]:
            while gap and self.tiers[tier]:
                piece = self.tiers[tier].popleft()
                if len(piece.ids) > gap:
                    piece, rest = piece.cut(gap)
                    self._route(rest)
                window.append(piece)
                gap -= len(piece.ids)
        return window

    def pack(self) -> Iterator[list[Piece]]:
        for size in reversed(self.sizes):
            while self.tiers[size] and (window := self._fill(size)):
                yield window
        self.held = sum(len(p.ids) for q in self.tiers.values() for p in q)

    def tail(self) -> Iterator[list[Piece]]:
        """Everything that is left, cut at powers of two."""
        rest = [p for q in self.tiers.values() for p in q]
        left = sum(len(p.ids) for p in rest)
        while left:
            gap = min(1 << (left.bit_length() - 1), self.sizes[-1])
            left -= gap
            window = []
            while gap:
                piece = rest.pop(0)
                if len(piece.ids) > gap:
                    piece, more = piece.cut(gap)
                    rest.insert(0, more)
                window.append(piece)
                gap -= len(piece.ids)
            yield window


def _upto(tiers: dict[int, deque[Piece]], size: int, enough: int) -> Iterator[Piece]:
    """Pieces of the tiers up to ``size`` until they hold ``enough`` tokens."""
    seen = 0
    for tier in sorted(tiers, reverse=True):
        if tier > size:
            continue
        for piece in tiers[tier]:
            yield piece
            seen += len(piece.ids)
            if seen >= enough:
                return


class Steps:
    """Puts sequences into groups of ``capacity`` tokens, the fullest that still has room first."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next, self.room = capacity, first, {}

    def group(self, length: int) -> int:
        fits = [r for r in self.room if r >= length]
        if fits:
            room = min(fits)
            group = self.room[room].pop()
            if not self.room[room]:
                del self.room[room]
        else:
            room, group, self.next = self.capacity, self.next, self.next + 1
        if room > length:
            self.room.setdefault(room - length, []).append(group)
        return group


def pack(
    df: DataFrame, vocabulary_path: str, end_id: int, keys: Sequence[str], text: str = "text",
    sizes: Sequence[int] = SIZES,
) -> DataFrame:
    """One row per piece: the key columns, ``start``, ``length``, ``ids`` (little-endian unsigned
    32-bit), ``doc_tokens``, ``sequence_id``, ``offset``, ``context`` (tokens of the sequence) and
    ``step_group``."""
    json_text = content(vocabulary_path)
    sizes = tuple(sorted(sizes))
    assert all(s & (s - 1) == 0 for s in sizes), "context sizes are powers of two"
    key_fields = [df.schema[k] for k in keys]
    added = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, " \
            "context int, step_group long"
    schema = T.StructType([*key_fields, *T.StructType.fromDDL(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(json_text), Packer(sizes)
        base = TaskContext.get().partitionId() << 40
        steps = Steps(sizes[-1] * STEP_SEQUENCES, base)
        sequence = base
        held_keys: dict[int, tuple] = {}  # row -> key values, tokens of the document
        out: list[tuple] = []

        def emit(window: list[Piece]) -> None:
            nonlocal sequence
            length = sum(len(p.ids) for p in window)
            group, at = steps.group(length), 0
            for p in window:
                key, n = held_keys[p.row]
                out.append((*key, p.start, len(p.ids), p.ids.astype("<u4").tobytes(), n, sequence, at, length, group))
                at += len(p.ids)
            sequence += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[] for _ in schema.fields]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, arrow_types)], names=schema.names
            )
            out.clear()
            return batch

        arrow_types: list[pa.DataType] = []
        row = 0
        for batch in batches:
            if not arrow_types:
                arrow_types = [batch.schema.field(f"_k{i}").type for i in range(len(keys))] + [
                    pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            key_rows = zip(*[batch.column(f"_k{i}").to_pylist() for i in range(len(keys))])
            for key, t in zip(key_rows, batch.column("_text").to_pylist()):
                ids = encoder(t or "", end_id)
                held_keys[row] = (key, len(ids))
                for window in packer.add(Piece(row, 0, ids)):
                    emit(window)
                row += 1
                if len(out) >= 2000:
                    yield flush()
                if packer.held >= BUFFER_TOKENS or len(held_keys) >= BUFFER_PIECES:
                    for window in packer.pack():
                        emit(window)
                        if len(out) >= 2000:
                            yield flush()
                    waiting = {p.row for q in packer.tiers.values() for p in q}
                    held_keys = {r: v for r, v in held_keys.items() if r in waiting}
        for window in packer.pack():
            emit(window)
        for window in packer.tail():
            emit(window)
        if out:
            yield flush()

    source = df.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.col(f"`{text}`").alias("_text"))
    return source.mapInArrow(run, schema)
