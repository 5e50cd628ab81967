"""Phrases whose words stand together more often than chance, by prefix-free parsing.

Texts are cut into pieces at punctuation and line ends, and pieces into chunks: a chunk begins where
a piece begins or where a window of words hashes to zero modulo ``STRIDE``, and runs on over the
window that begins the next chunk. Where a chunk ends depends on the words alone, so repeated text
gives repeated chunks, and a chunk's windows at both ends overlap with its neighbours. The distinct
chunks with their frequencies are the dictionary. N-grams are counted inside distinct chunks, times
the chunk's frequency; one that begins in the overlap belongs to the next chunk, so each occurrence
counts once.

The dictionary is counted twice. First n-grams as 64-bit hashes, whose sums say which can reach
``min_count``; then these alone as text, exactly. A map of the frequent hashes, sized by their
number up to ``MAP_BITS``, goes to the tasks; where it is full it lets more text through, and the
result is the same.

Defined results: null, empty and blank texts have no words; a null language is ``und``; repeated rows
count as often as they stand there; a very long text or piece is read whole, a piece without any
trigger is one chunk; without texts the result is empty. Only the two named columns are read, so
others may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.llm.byte_words import WordHasher, column_bytes, spans
from fleetloom.llm.common import dropped, written
from fleetloom.llm.jaccard import _A, mixed, word_hash
from fleetloom.llm.packed import HELD_KEYS, range_bits, ranges, summed
from fleetloom.session import shuffle_partitions

MAX_WORDS, MIN_COUNT, TOP, INSIDE_PERCENT = 3, 10, 2000, 50
# One window of words in this many begins a chunk.
STRIDE = 16
# Distinct chunks that a task holds before it sends them.
HELD_CHUNKS = 300_000
# The map of frequent hashes has this many bits per hash, and 64 MB at most.
BITS_PER_KEY, MAP_BITS = 16, 29
# Bytes of the dictionary that a task counts at a time.
HELD_BYTES = 1 << 23
# What ends a piece becomes a line end, other white space a blank, A-Z small.
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_READ = bytes.maketrans(bytes(range(65, 91)) + _BREAKS + b"\t", bytes(range(97, 123)) + b"\n" * len(_BREAKS) + b" ")


def chunks(texts: pa.Array, hasher: WordHasher, overlap: int, stride: int = STRIDE) -> tuple[list[bytes], np.ndarray]:
    """The chunks of all texts: ``+`` or ``.`` (another chunk of the piece follows, or none), then the
    bytes of its words and the blanks between; and the row of each."""
    data, offsets = column_bytes(texts)
    data = np.frombuffer(_READ, np.uint8)[data]
    breaks = data == 10
    starts, ends = spans(~breaks & (data != 32), offsets)
    n = len(starts)
    if not n:
        return [], np.empty(0, np.int64)
    # A word is its piece's first if a row or a break lies between it and the word before.
    row = np.searchsorted(offsets, starts, "right") - 1
    gaps = np.flatnonzero(breaks)
    before = np.searchsorted(gaps, starts)
    first = np.ones(n, bool)
    first[1:] = (row[1:] != row[:-1]) | (before[1:] != before[:-1])
    h = hasher(data, starts, ends)
    window = h.copy()
    for k in range(1, overlap):
        window[:n - k] = mixed(window[:n - k] * _A + h[k:])
    heads = np.append(np.flatnonzero(first), n)
    trigger = (mixed(window) % np.uint64(stride) == 0) & (np.arange(n) + overlap <= heads[np.cumsum(first)])
    start = np.flatnonzero(first | trigger)
    follows = np.append(~first[start[1:]], False)
    stop = np.append(start[1:], n) + np.where(follows, overlap, 0)
    body = data.tobytes()
    found = [
        (b"+" if more else b".") + body[a:b]
        for a, b, more in zip(starts[start].tolist(), ends[stop - 1].tolist(), follows.tolist())
    ]
    return found, row[start]


def dictionary(docs: DataFrame, overlap: int) -> DataFrame:
    """(lang, chunk, n) over ``lang`` and ``text``; tasks add up what they read before they send."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = WordHasher(), {}, 0
        for batch in batches:
            found, row = chunks(batch.column(1), hasher, overlap)
            known = batch.column(0).dictionary_encode()
            number = known.indices.to_numpy()[row]
            order = np.argsort(number, kind="stable")
            edges = np.searchsorted(number[order], np.arange(len(known.dictionary) + 1))
            for k, lang in enumerate(known.dictionary.to_pylist()):
                counter = held.setdefault(lang, Counter())
                size -= len(counter)
                counter.update(map(found.__getitem__, order[edges[k]:edges[k + 1]].tolist()))
                size += len(counter)
            if size > HELD_CHUNKS:
                yield from send(held)
                held, size = {}, 0
        yield from send(held)

    def send(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counter), pa.string()), pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())],
                names=["lang", "chunk", "n"],
            )

    readable = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter(F.length("text") > 0)
    sent = readable.mapInArrow(run, "lang string, chunk binary, n long")
    return written(sent.groupBy("lang", "chunk").agg(F.sum("n").alias("n")))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``HELD_BYTES``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > HELD_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


class _Grams:
    """The n-grams of a batch of the dictionary, each of a chunk's own part."""

    def __init__(self, batch: pa.RecordBatch, hasher: WordHasher, overlap: int):
        self.langs = batch.column(0).dictionary_encode()
        self.data, self.offsets = column_bytes(batch.column(1))
        inside = self.data != 32
        inside[self.offsets[:-1]] = False
        self.starts, self.ends = spans(inside, self.offsets)
        self.row = np.searchsorted(self.offsets, self.starts, "right") - 1
        last = np.searchsorted(self.row, np.arange(batch.num_rows), "right")
        self.end = last[self.row]
        more = self.data[self.offsets[:-1]] == ord("+")
        self.own = np.arange(len(self.row)) < self.end - np.where(more, overlap, 0)[self.row]
        self.h = hasher(self.data, self.starts, self.ends)
        self.n = batch.column(2).to_numpy()

    def sizes(self, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(size, first word, key, weight) of the n-grams up to ``most`` words."""
        seeds = np.array([word_hash(x.encode()) for x in self.langs.dictionary.to_pylist()], np.uint64)
        key = seeds[self.langs.indices.to_numpy()][self.row]
        for size in range(1, most + 1):
            left = max(len(self.h) - size + 1, 0)
            key = mixed(key[:left] * _A + self.h[size - 1:])
            at = np.flatnonzero(self.own[:left] & (np.arange(left) + size <= self.end[:left]))
            yield size, at, key[at], self.n[self.row[at]]

    def texts(self, at: np.ndarray, size: int) -> list[bytes]:
        body = self.data.tobytes()
        parts = [
            [body[a:b] for a, b in zip(self.starts[at + k].tolist(), self.ends[at + k].tolist())] for k in range(size)
        ]
        return [b" ".join(ws) for ws in zip(*parts)]


def frequent_hashes(chunk: DataFrame, most: int, min_count: int, n_words: int) -> DataFrame:
    """(key) of the n-grams up to ``most`` words that stand ``min_count`` times or more."""
    tasks, bits = range_bits(most * n_words, shuffle_partitions(chunk.sparkSession))

    def send(keys: list[np.ndarray], weights: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found, _, n = summed(np.concatenate(keys), np.concatenate(weights))
        cut = list(ranges(found, bits))
        if cut:
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _, _ in cut], pa.int64()), pa.array([found[a:z].tobytes() for _, a, z in cut], pa.binary()),
                 pa.array([n[a:z].tobytes() for _, a, z in cut], pa.binary())],
                names=["bucket", "keys", "counts"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in _blocks(batches):
            found = list(_Grams(batch, hasher, most - 1).sizes(most))
            yield from send([key for _, _, key, _ in found], [n for _, _, _, n in found])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums of what has come are kept, so a task holds its distinct keys.
        keys, n = np.empty(0, np.uint64), np.empty(0, np.int64)
        new: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for k, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                new.append((np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64)))
                size += len(new[-1][0])
            if size > HELD_KEYS:
                keys, _, n = summed(np.concatenate([keys, *[k for k, _ in new]]), np.concatenate([n, *[c for _, c in new]]))
                new, size = [], 0
        keys, _, n = summed(np.concatenate([keys, *[k for k, _ in new]]), np.concatenate([n, *[c for _, c in new]]))
        yield pa.RecordBatch.from_arrays([pa.array(keys[n >= min_count].view(np.int64))], names=["key"])

    sent = chunk.mapInArrow(count, "bucket long, keys binary, counts binary").repartition(tasks, "bucket")
    return written(sent.mapInArrow(add, "key long"))


def _map(keys: DataFrame) -> np.ndarray:
    """A map of bits for ``key``, of a size that follows their number."""
    bits = min(MAP_BITS, max(16, (keys.count() * BITS_PER_KEY).bit_length()))
    place = F.shiftrightunsigned("key", 64 - bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    found = keys.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bitmap


def counted(chunk: DataFrame, keys: DataFrame, most: int, min_count: int) -> DataFrame:
    """(lang, gram, size, f) of all n-grams that stand ``min_count`` times or more, exactly."""
    sent = chunk.sparkSession.sparkContext.broadcast(_map(keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value
        shift = np.uint64(64 - (len(bitmap) * 64).bit_length() + 1)
        hasher = WordHasher()
        for batch in _blocks(batches):
            grams = _Grams(batch, hasher, most - 1)
            for size, at, key, weight in grams.sizes(most):
                place = key >> shift
                hit = np.flatnonzero((bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)).astype(np.int64)) & 1)
                _, first, n = summed(key[hit], weight[hit])
                first = at[hit[first]]
                yield pa.RecordBatch.from_arrays(
                    [grams.langs.take(pa.array(grams.row[first])).cast(pa.string()),
                     pa.array(grams.texts(first, size), pa.binary()).cast(pa.string()),
                     pa.array(np.full(len(first), size, np.int32)), pa.array(n)],
                    names=["lang", "gram", "size", "f"],
                )

    found = chunk.mapInArrow(run, "lang string, gram string, size int, f long")
    return written(found.groupBy("lang", "gram", "size").agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count))


def scored(grams: DataFrame, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases that no longer one holds too often."""
    phrases = grams.filter("size > 1").withColumn("ws", F.split("gram", " "))
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = phrases.select("lang", "gram", "size", F.col("f").alias("a"), "ws", cut).select(
        "lang", "gram", "a", "k",
        F.array_join(F.slice("ws", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("ws", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    part = {side: grams.select("lang", F.col("gram").alias(side), F.col("f").alias(name)) for side, name in (("head", "l"), ("rest", "r"))}
    # Numbers below 10 ** 16: the product with a million has 38 digits at most.
    whole = {c: f"cast({c} as decimal(16,0))" for c in "alr"}
    score = F.expr(f"(cast({whole['a']} * {whole['a']} as decimal(32,0)) * cast(1000000 as decimal(7,0))) div ({whole['l']} * {whole['r']})")
    best = (
        cuts.join(part["head"], ["lang", "head"]).join(part["rest"], ["lang", "rest"])
        .groupBy("lang", F.col("gram").alias("phrase"))
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"), F.first("a").alias("a"))
    )
    size, k, ws = F.col("size"), F.col("k"), F.col("ws")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda at: F.array_join(F.slice(ws, at, m), " "))))
    longer = (
        phrases.filter("size > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "f")
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    )
    kept = best.join(longer, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("longer") < inside_percent * F.col("a"), F.lit(True)))
    return kept.select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", most: int = MAX_WORDS, min_count: int = MIN_COUNT,
    top: int = TOP, inside_percent: int = INSIDE_PERCENT,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    spark = docs.sparkSession
    chunk = dictionary(docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")), most - 1)
    own = F.size(F.split(F.decode("chunk", "utf-8"), " +")) - F.when(F.substring("chunk", 1, 1) == F.lit(b"+"), most - 1).otherwise(0)
    words = written(chunk.groupBy("lang").agg(F.sum(F.col("n") * own).alias("n"), F.sum(own).alias("distinct")))
    n_words = words.agg(F.sum("distinct")).first()[0] or 0
    keys = frequent_hashes(chunk, most, min_count, n_words)
    grams = counted(chunk, keys, most, min_count)
    dropped(chunk, keys)
    # Two steps, so that no task orders all phrases of a language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    spread = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(spark)))
    few = (
        scored(grams, inside_percent).withColumn("spread", spread)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "spread").orderBy(*order)))
        .filter(F.col("rank") <= top)
    )
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(words.select("lang", "n"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
