"""N-gram Jaccard self-join by parity sketches.

A document's set holds its distinct word n-grams. Every element flips one bit of a sketch, so the
bits in which two sketches differ are at most the elements in which the sets differ. Linked sets
of sizes a and b differ in at most d(a + b) elements; elements are dealt into parts by their hash,
and of d + 1 parts at least one has the same parity in both (pigeonhole). Parts are
laid out per size band; a set takes part in its own band and, if smaller partners can link, in the
band below, with as many parts as its own size demands. Parts without elements prove nothing: a
few parts more are used, so that as many empty ones can be left out.

Equal part words meet in buckets. First each bucket links its members to its smallest one; sizes
and sketches (1024 bits in the join, then about a bit per element) rule pairs out before the sets
are compared exactly. Rounds with other pivots follow, one per bucket, as long as they merge
components. Then members of a bucket that are still in different components are paired, so a large
group of near copies costs its members and not its pairs, and no link between different components
is lost.

Equal sets are one node with a 64-bit hash of the set; counts of copies are narrow rows. A bucket
that holds much of the corpus is split by the join (adaptive skew handling) and its size bounds
no task's memory.

Defined results: texts without words, null or empty, have no set and are linked with nothing;
their component is their own id. Equal rows and repeated ids are separate documents in the same
component. A null id never becomes a component's id unless all ids in it are null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.llm.common import dropped, written
from fleetloom.llm.components import components
from fleetloom.llm.shared import shared_values
from fleetloom.llm.tokens import Cache

SKETCH_WORDS = 16
BAND_RATIO = 1.5
# Parts to spare for empty ones, in standard deviations of their number.
SPARE_SIGMAS = 2.2
# Rows up to which a list of text hashes is broadcast; longer lists meet the texts in a shuffle.
BROADCAST_ROWS = 1_000_000

# Bytes of text whose sets a task holds at a time, or one text.
SLICE_BYTES = 1 << 21
# Another round of pivots follows while the last one left at most this share of the open memberships.
STILL_MERGING = 0.9

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def shingles(words: list[bytes], hashes: Cache, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(n, len(h))
    found = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        found = mixed(found * _A + h[k:len(h) - size + 1 + k])
    return np.unique(found)


def words_of(text: str) -> list[bytes]:
    """Words with A-Z in lower case; bytes know no other letters and no other white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


@dataclass(frozen=True)
class Bands:
    """How a similarity of at least ``percent`` / 100 is cut into size bands and parts."""

    percent: int

    def differ(self, total: int) -> int:
        """The most elements in which two linked sets with ``total`` elements together differ."""
        return total - 2 * -(-self.percent * total // (100 + self.percent))

    def partner(self, size: int) -> int:
        return 100 * size // self.percent

    @lru_cache(maxsize=None)
    def edge(self, band: int) -> int:
        return 1 if band == 0 else max(self.edge(band - 1) + 1, int(self.edge(band - 1) * BAND_RATIO))

    def of(self, size: int) -> int:
        band = 0
        while self.edge(band + 1) <= size:
            band += 1
        return band

    @lru_cache(maxsize=None)
    def layout(self, band: int) -> tuple[int, int]:
        """Parts of a band, and how many of a set's parts may be empty before it uses empty ones."""
        least, most = self.edge(band), self.edge(band + 1) - 1
        need = self.differ(most + self.partner(most)) + 1
        spare = 0
        while spare < need:
            empty = (need + spare) * math.exp(-least / (need + spare))
            if empty + SPARE_SIGMAS * math.sqrt(empty) <= spare + 0.2:
                break
            spare += 1
        return need + spare, spare

    def places(self, size: int) -> list[tuple[int, int]]:
        """(band, parts to use) for a set."""
        own = self.of(size)
        found = [(own, self.differ(size + self.partner(size)) + 1)]
        if own and self.partner(self.edge(own) - 1) >= size:
            # ``differ`` has the parity of its argument: the largest partner may differ in one less
            # than the one below it.
            most = size + self.edge(own) - 1
            found.append((own - 1, max(self.differ(most), self.differ(most - 1)) + 1))
        return found

    def signatures(self, elements: np.ndarray) -> np.ndarray:
        """One 64-bit value per part used: band, number and XOR of the elements of the part."""
        out = []
        # Whole hashes are XORed here: the one bit that an element has in the sketch tells few apart.
        hashes = mixed(elements + _B)
        for band, need in self.places(len(elements)):
            parts, spare = self.layout(band)
            part = ((elements >> np.uint64(6)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            filled, starts = np.unique(part[order], return_index=True)
            words = np.zeros(parts, np.uint64)
            words[filled] = np.bitwise_xor.reduceat(hashes[order], starts)
            used = min(need + spare, parts)
            full = np.zeros(parts, bool)
            full[filled] = True
            empty = np.flatnonzero(~full[:used])
            # More empty parts than spare ones: a partner with which only empty parts agree shares
            # more than ``spare`` of them, and so one of these.
            pick = np.concatenate([np.flatnonzero(full[:used]), empty[:max(len(empty) - spare, 0)]])
            tag = mixed(np.uint64(band << 32) + pick.astype(np.uint64) + _B)
            out.append(mixed(words[pick] * _A + tag))
        return np.unique(np.concatenate(out))


def sketch(elements: np.ndarray) -> np.ndarray:
    """Parity of about a bit per element, in a power of two of words: halves fold into a smaller one."""
    words = max(SKETCH_WORDS, 1 << (-(-len(elements) // 64) - 1).bit_length())
    place = mixed(elements ^ _B)
    word = (place & np.uint64(words - 1)).astype(np.int64)
    bits = np.uint64(1) << ((place >> np.uint64(32)) & np.uint64(63))
    order = np.argsort(word, kind="stable")
    filled, starts = np.unique(word[order], return_index=True)
    found = np.zeros(words, np.uint64)
    found[filled] = np.bitwise_xor.reduceat(bits[order], starts)
    return found


def folded(fine: np.ndarray) -> np.ndarray:
    return np.bitwise_xor.reduce(fine.reshape(-1, SKETCH_WORDS), axis=0)


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows with about ``SLICE_BYTES`` of text, or a single row beyond that."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        run = np.cumsum(sizes.astype(np.int64)) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(int(a), int(b - a))


def _sets(df: DataFrame, n: int, percent: int) -> DataFrame:
    """Per document: id, hash of the text, size and hash of its set, signatures and sketch."""
    kind = df.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bands, longs = Cache(word_hash), Bands(percent), pa.list_(pa.int64())
        for batch in slices(batches, 2):
            sizes, nodes, signs, sketches, fine = [], [], [], [], []
            for text in batch.column(2).to_pylist():
                elements = shingles(words_of(text or ""), hashes, n)
                sizes.append(len(elements))
                if len(elements):
                    nodes.append(int.from_bytes(
                        hashlib.blake2b(elements.tobytes(), digest_size=8).digest(), "little", signed=True))
                    signs.append(bands.signatures(elements).view(np.int64))
                    whole = sketch(elements)
                    sketches.append(folded(whole).view(np.int64))
                    fine.append(whole.view(np.int64) if len(whole) > SKETCH_WORDS else None)
                else:
                    for column in (nodes, signs, sketches, fine):
                        column.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(signs, longs), pa.array(sketches, longs), pa.array(fine, longs)],
                names=["doc_id", "text_hash", "n", "node", "signs", "sketch", "fine"],
            )

    return df.mapInArrow(
        run, f"doc_id {kind}, text_hash long, n long, node long, signs array<long>, sketch array<long>, fine array<long>"
    )


def _elements(df: DataFrame, n: int) -> DataFrame:
    """The sets themselves, for the few texts that have a candidate partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Cache(word_hash)
        for batch in slices(batches, 0):
            found = [shingles(words_of(t), hashes, n) for t in batch.column(0).to_pylist()]
            nodes = [int.from_bytes(hashlib.blake2b(e.tobytes(), digest_size=8).digest(), "little", signed=True) for e in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array([e.view(np.int64) for e in found], pa.list_(pa.int64()))],
                names=["node", "elements"],
            )

    return df.select("text").mapInArrow(run, "node long, elements array<long>")


def _allowed(na: Column, nb: Column, percent: int) -> Column:
    """The most elements in which linked sets of these sizes differ."""
    return (na + nb) - 2 * F.ceil(percent * (na + nb) / F.lit(100 + percent))


def _near(a: str, b: str, percent: int) -> Column:
    """Sizes and small sketches of two sets allow a link."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = None
    for k in range(SKETCH_WORDS):
        d = F.bit_count(F.get(f"{a}.sketch", F.lit(k)).bitwiseXOR(F.get(f"{b}.sketch", F.lit(k))))
        apart = d if apart is None else apart + d
    return (100 * na >= percent * nb) & (100 * nb >= percent * na) & (apart <= _allowed(na, nb, percent))


def _nearer(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sketches allow a link: long sets outgrow the small ones."""
    own = known.select("node", "n", F.coalesce("fine", "sketch").alias("s"))
    both = pairs.join(own.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa")), "a").join(
        own.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb")), "b")

    def halved(s: Column, other: Column) -> Column:
        half = F.size(other)
        return F.when(F.size(s) > half, F.zip_with(
            F.slice(s, F.lit(1), half), F.slice(s, half + 1, half), lambda x, y: x.bitwiseXOR(y))).otherwise(s)

    sa, sb = F.col("sa"), F.col("sb")
    apart = F.aggregate(
        F.zip_with(halved(sa, sb), halved(sb, sa), lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long")),
        F.lit(0).cast("long"), lambda t, d: t + d,
    )
    return both.filter(apart <= _allowed(F.col("na"), F.col("nb"), percent)).select("a", "b")


def _few(df: DataFrame) -> DataFrame:
    """A broadcast hint for a written list that is short enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets really reach the similarity."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    texts = written(sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("text_hash").alias("text_hash")).select("text_hash").distinct())
    rows = docs.join(_few(texts), "text_hash", "left_semi")
    elements = written(_elements(rows, n).dropDuplicates(["node"]))
    left = elements.select(F.col("node").alias("a"), F.col("elements").alias("_a"))
    right = elements.select(F.col("node").alias("b"), F.col("elements").alias("_b"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("_a", "_b")).cast("long")
    edges = written(
        both.withColumn("_i", shared)
        .filter(100 * F.col("_i") >= percent * (F.size("_a").cast("long") + F.size("_b").cast("long") - F.col("_i")))
        .select("a", "b")
    )
    dropped(texts, elements)
    return edges


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, sign, label) of the buckets whose members are in different components."""
    labelled = members.join(labels, "node", "left").select("node", "sign", F.coalesce("label", "node").alias("label"))
    several = labelled.groupBy("sign").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l != h")
    return labelled.join(several.select("sign"), "sign", "left_semi")


def _rest(members: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(a, b), once each: the pairs of ``members`` (node, sign, label) that share a bucket, are in different
    components and have sketches that allow a link. Near copies share most of their buckets; only
    the first one that two members share gives their pair."""
    signs = members.groupBy("node").agg(F.collect_set("sign").alias("signs"))
    # With each membership the buckets before it.
    rows = members.join(known.select("node", "n", "sketch"), "node").join(signs, "node").withColumn(
        "before", F.filter("signs", lambda s: s < F.col("sign")))
    x = rows.select("sign", F.col("node").alias("a"), F.struct("label", "n", "sketch", "before").alias("x"))
    y = rows.select("sign", F.col("node").alias("b"), F.struct("label", "n", "sketch", "before").alias("y"))
    return x.join(
        y, (x["sign"] == y["sign"]) & (F.col("a") < F.col("b")) & (F.col("x.label") != F.col("y.label"))
        & _near("x", "y", percent) & ~F.arrays_overlap("x.before", "y.before")
    ).select("a", "b")


def link(df: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``node`` (hash of the set, null without words) and
    ``label`` (one node of its component) per row of ``df`` (doc_id, text)."""
    docs = df.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sets = written(_sets(docs, n, percent).withColumn("row", F.monotonically_increasing_id()))
    # Of equal sets one row takes part.
    first_row = sets.filter("node is not null").groupBy("node").agg(F.min("row").alias("_r"), F.count(F.lit(1)).alias("c"))
    copies = written(sets.select("node", "row").join(first_row.filter("c > 1"), "node").filter("row > _r").select("row"))
    single = sets.filter("node is not null").join(_few(copies), "row", "left_anti")
    buckets = written(shared_values(single, ("node",), "signs").withColumnRenamed("value", "sign"))
    known = written(
        single.select("node", "n", "sketch", "fine").join(buckets.select("node").distinct(), "node", "left_semi")
    )

    # Every member with the smallest of its bucket.
    first = buckets.groupBy("sign").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a != z")
    stars = buckets.withColumnRenamed("node", "b").join(first, "sign").filter("a != b").select("a", "b").distinct()
    one = known.select(F.col("node").alias("a"), F.struct("n", "sketch").alias("x"))
    two = known.select(F.col("node").alias("b"), F.struct("n", "sketch").alias("y"))
    pairs = written(stars.join(one, "a").join(two, "b").filter(_near("x", "y", percent)).select("a", "b"))
    edges = _verified(written(_nearer(pairs, known, percent)), docs, sets, n, percent)
    labels = components(edges)

    # Members of the buckets that still hold several components meet other pivots, a pivot per bucket
    # and round: a round costs its members, and groups that their smallest member does not reach merge.
    checked, left = [pairs], written(_open(buckets.join(known.select("node"), "node"), labels))
    before, now, turn = None, left.count(), 0
    while now and (before is None or now <= STILL_MERGING * before):
        turn += 1
        pivots = left.groupBy("sign").agg(
            F.min_by(F.struct("node", "label"), F.xxhash64("node", F.lit(turn))).alias("p"))
        stars = (
            left.join(pivots, "sign").filter(F.col("p.label") != F.col("label"))
            .select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()
        )
        for old in checked:
            stars = stars.join(old, ["a", "b"], "left_anti")
        pairs = written(stars.join(one, "a").join(two, "b").filter(_near("x", "y", percent)).select("a", "b"))
        checked.append(pairs)
        edges = edges.union(_verified(written(_nearer(pairs, known, percent)), docs, sets, n, percent))
        labels = components(edges)
        old_left, left = left, written(_open(left.drop("label"), labels))
        dropped(old_left)
        before, now = now, left.count()

    # What is left: members of a bucket in different components, each pair of them once.
    rest = _rest(left, known, percent)
    for old in checked:
        rest = rest.join(old, ["a", "b"], "left_anti")
    rest = written(rest)
    more = _verified(written(_nearer(rest, known, percent)), docs, sets, n, percent)
    labels = components(edges.union(more))
    result = sets.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "node").join(labels, "node", "left").select(
        "doc_id", "text_hash", "n_shingles", "node", F.coalesce("label", "node").alias("label")
    )
    result = written(result)
    dropped(sets, copies, buckets, known, left, rest, *checked)
    return result


def near_duplicates(df: DataFrame, n: int, percent: int) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest id in the component) per document."""
    linked = link(df, n, percent)
    smallest = linked.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return linked.join(smallest, "label", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_per_component(df: DataFrame, n: int, percent: int) -> DataFrame:
    """The rows of ``df`` (with ``doc_id`` and ``text``) that stay: of each component the one with
    the smallest id (then the smallest text hash), once. Rows without words stay. Null ids come last."""
    linked = link(df, n, percent)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    kept = linked.filter("label is not null").groupBy("label").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("c"))
    mine = linked.join(kept.filter("c > 1"), "label")
    gone = written(mine.filter(rank != F.col("best")).select("doc_id", "text_hash").distinct())
    # The row that stays may itself be there several times.
    again = written(
        mine.filter(rank == F.col("best")).groupBy("doc_id", "text_hash").count().filter("count > 1").drop("count")
    )
    rows = df.withColumn("_th", F.xxhash64("text"))

    def on(keys: DataFrame) -> Column:
        return rows["doc_id"].eqNullSafe(keys["doc_id"]) & (rows["_th"] == keys["text_hash"])

    few_gone, few_again = _few(gone), _few(again)
    rows = rows.join(few_gone, on(few_gone), "left_anti")
    single = rows.join(few_again, on(few_again), "left_anti")
    several = rows.join(few_again, on(few_again), "left_semi").dropDuplicates(["doc_id", "_th"])
    return single.unionByName(several).drop("_th")
