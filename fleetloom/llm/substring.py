"""Repeated spans by De Bruijn compaction.

Every window of ``K`` words is an edge of a De Bruijn graph. Only edges that occur in several
documents matter. To find them without dealing out all windows, each window names its minimizer,
the smallest hash of its runs of ``M`` words: equal windows name the same one, neighbours share
theirs, so about a sixth as many rows are counted. Windows whose minimizer is unique are unique.
The rest are dealt out by their hash; those in at least two documents are the graph's edges, each
owned by the first document that has it. Edges that follow each other without branching, in one
owner, are compacted into paths by joins over their successors and predecessors; a document's
windows then fold into a few spans along paths. The words of every span are compared, by a
128-bit digest, with the words at the source coordinates before anything is removed.

Documents whose whole word sequence occurs in an earlier one are found by a digest of it and stay
out of the graph, so large groups of copies cost a narrow row each.

Defined results: a null, empty or blank text has no words. A null id counts as larger than all
others; among equal ids no one is first, so equal ids never remove each other's words. Equal rows
get equal results. A span whose words differ from the source (a hash collision) stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.llm.byte_words import WordHasher, column_bytes, spans as word_spans
from fleetloom.llm.common import dropped, written
from fleetloom.llm.jaccard import BROADCAST_ROWS, mixed, slices
from fleetloom.llm.shared import shared_values
from fleetloom.llm.tokens import Cache

# Words of a window and of the runs that its minimizer is chosen from; the hashes below are put
# together from parts for just these lengths.
K = 13
M = 5
LAST = (1 << 63) - 1
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x165667B19E3779F9)
_BLANK = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _next(left: np.ndarray, right: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Hashes of runs, each of a left and a right part."""
    n = len(right)
    return mixed((left[:n] + seed) * _A + right)


def minimizers(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the hashes of the words: the hashes of runs of two, and every window's minimizer."""
    pairs = _next(h, h[1:], _A)
    least, width, want = _next(pairs, _next(pairs, h[2:], _B)[2:], _B), 1, K - M + 1
    while width * 2 <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least = np.minimum(least[:width - want], least[want - width:])
    return pairs, least


def windows(words: list[bytes], hashes: Cache, both: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash (if asked for ``both``) and minimizer of every window of ``K`` words."""
    if len(words) < K:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return _windows_of(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), both)


def _windows_of(h: np.ndarray, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """``windows`` of at least ``K`` words, from their hashes."""
    pairs, least = minimizers(h)
    if not both:
        return np.empty(0, np.uint64), least
    fours = _next(pairs, pairs[2:], _A)
    twelves = _next(_next(fours, fours[4:], _A), fours[8:], _A)
    return _next(twelves, h[12:], _A), least


def runs_of_windows(texts: list[list[bytes]], hashes: Cache, both: bool) -> tuple[np.ndarray, ...]:
    """All texts in one go. Per window that lies in one text: its text, its place there, its hash (if asked
    for ``both``) and its minimizer; then, of the runs of windows with one minimizer, where each begins."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return _runs_of(np.fromiter(map(hashes.__getitem__, chain.from_iterable(texts)), np.uint64, int(sizes.sum())), sizes, both)


def _runs_of(h: np.ndarray, sizes: np.ndarray, both: bool) -> tuple[np.ndarray, ...]:
    """``runs_of_windows`` from the hashes of all words and the number of words of each text."""
    if len(h) < K:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64), np.empty(0, np.uint64), none
    edge, least = _windows_of(h, both)
    of = np.repeat(np.arange(len(sizes)), sizes)
    # A window that begins in one text and ends in the next one is none.
    inside = np.flatnonzero(of[:len(least)] == of[K - 1:])
    of, least = of[inside], least[inside]
    at = inside - (np.cumsum(sizes) - sizes)[of]
    begins = np.ones(len(least), bool)
    begins[1:] = (least[1:] != least[:-1]) | (of[1:] != of[:-1])
    return of, at, edge[inside] if both else edge, least, np.flatnonzero(begins)


def hashed(texts: pa.Array, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts; per text the number of its words, and their bytes."""
    data, offsets = column_bytes(pc.fill_null(texts, ""))
    starts, ends = word_spans((data != 32) & ((data < 9) | (data > 13)), offsets)
    first = np.searchsorted(starts, offsets)
    letters = np.concatenate([[0], np.cumsum(ends - starts)])
    return hasher(data, starts, ends), np.diff(first), np.diff(letters[first])


def joined_words(text: bytes | None, n: int, letters: int) -> bytes:
    """The ``n`` words of a text, of ``letters`` bytes in all, with one space between them."""
    if not n:
        return b""
    # As many other bytes as gaps between words: each gap is one blank.
    return text.translate(_BLANK) if len(text) == letters + n - 1 else b" ".join(text.split())


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _read(docs: DataFrame) -> DataFrame:
    """Per document: key, number and digest of its words, its minimizers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in slices(batches, 2):
            h, n, letters = hashed(batch.column(2), hasher)
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            shas = [hashlib.sha256(joined_words(*row)).hexdigest() for row in zip(texts, n.tolist(), letters.tolist())]
            of, _, _, least, begins = _runs_of(h, n, both=False)
            of, least = of[begins], least[begins]
            order = np.lexsort((least, of))
            of, least = of[order], least[order]
            new = np.ones(len(of), bool)
            new[1:] = (of[1:] != of[:-1]) | (least[1:] != least[:-1])
            ends = np.searchsorted(of[new], np.arange(len(texts) + 1))
            named = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(least[new].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(shas, pa.string()), named],
                names=["ord", "th", "n_words", "sha", "minimizers"],
            )

    return docs.mapInArrow(run, "ord long, th long, n_words long, sha string, minimizers array<long>")


def _windows(work: DataFrame) -> DataFrame:
    """(edge, ord, th, at) for the windows whose minimizer is shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in slices(batches, 2):
            h, n, _ = hashed(batch.column(2), hasher)
            of, at, edge, least, begins = _runs_of(h, n, both=True)
            lists = batch.column(3)
            owner = np.repeat(np.arange(len(n), dtype=np.uint64), lists.value_lengths().to_numpy())
            shared = np.sort(mixed(lists.flatten().to_numpy().view(np.uint64) * _A + owner))
            if not len(begins) or not len(shared):
                continue
            # A hash of two windows' names that happens to be equal keeps a window that nothing meets.
            asked = mixed(least[begins] * _A + of[begins].astype(np.uint64))
            found = shared[np.minimum(np.searchsorted(shared, asked), len(shared) - 1)] == asked
            keep = np.flatnonzero(np.repeat(found, np.diff(np.append(begins, len(of)))))
            ords, ths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(edge[keep].view(np.int64)), pa.array(ords[of[keep]]), pa.array(ths[of[keep]]), pa.array(at[keep])],
                names=["edge", "ord", "th", "at"],
            )

    return work.select("ord", "th", "text", "minimizers").mapInArrow(run, "edge long, ord long, th long, at long")


def _source_digests(sources: DataFrame) -> DataFrame:
    """(ord, th, text, wanted [(at, n)]) → the digest of each wanted run of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ord_, th, text, wanted in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                words = words_of(text)
                out += [(ord_, th, w["from_at"], w["n"], _digest(words[w["from_at"]:w["from_at"] + w["n"]])) for w in wanted]
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["from_ord", "from_th", "from_at", "n", "digest"]
            )

    return sources.mapInArrow(run, "from_ord long, from_th long, from_at long, n long, digest binary")


def _removed(targets: DataFrame) -> DataFrame:
    """(ord, th, text, spans [(at, n, digest)]) → words removed, digest and text of the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas, kept = [], [], []
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = words_of(text)
                gone = np.zeros(len(words), bool)
                for s in spans:
                    if _digest(words[s["at"]:s["at"] + s["n"]]) == s["digest"]:
                        gone[s["at"]:s["at"] + s["n"]] = True
                rest = [w for w, g in zip(words, gone) if not g]
                removed.append(int(gone.sum()))
                shas.append(_sha(rest))
                kept.append(b" ".join(rest).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(kept, pa.string())],
                names=["ord", "th", "removed", "kept_sha", "kept"],
            )

    return targets.mapInArrow(run, "ord long, th long, removed long, kept_sha string, kept string")


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def edges(rows: DataFrame) -> DataFrame:
    """Occurrences (edge, ord, th, at) of edges that several documents have, with ``owner``, the
    smallest of them."""
    several = rows.groupBy("edge").agg(F.min("ord").alias("owner"), F.max("ord").alias("_last")).filter("owner < _last")
    return rows.join(several.drop("_last"), "edge")


def paths(found: DataFrame) -> DataFrame:
    """(edge, from_ord, from_th, from_at, path): where an edge stands in its owner, and the place
    there at which its unbranched path begins."""
    here = Window.partitionBy("ord", "th").orderBy("at")
    follow = found.select(
        "edge", "owner",
        F.when(F.lead("at").over(here) == F.col("at") + 1, F.lead("edge").over(here)).alias("next"),
        F.when(F.lag("at").over(here) == F.col("at") - 1, F.lag("edge").over(here)).alias("before"),
    )
    # One successor and one predecessor over all documents: no branch. An end is no branch either.
    sides = written(follow.groupBy("edge", "owner").agg(
        F.min("next").alias("next"), F.max("next").alias("_n"), F.min("before").alias("before"), F.max("before").alias("_b"),
    ).select(
        "edge", "owner", F.when(F.col("next") == F.col("_n"), F.col("next")).alias("next"),
        F.when(F.col("before") == F.col("_b"), F.col("before")).alias("before"),
    ))
    joint = sides.filter("before is not null").select("edge", "owner", F.col("before").alias("left")).join(
        sides.select(F.col("edge").alias("left"), F.col("next").alias("edge_"), F.col("owner").alias("owner_")), "left"
    ).filter("edge = edge_ and owner = owner_").select("edge", "left")
    # Any place in the owner will do; the table written in the end holds the choice.
    source = found.filter("ord = owner").select(
        "edge", F.col("ord").alias("from_ord"), F.col("th").alias("from_th"), F.col("at").alias("from_at")
    ).dropDuplicates(["edge"])
    along = Window.partitionBy("from_ord", "from_th").orderBy("from_at")
    goes_on = (F.lag("edge").over(along) == F.col("left")) & (F.lag("from_at").over(along) == F.col("from_at") - 1)
    begun = source.join(joint, "edge", "left").withColumn("_new", ~F.coalesce(goes_on, F.lit(False)))
    start = F.max(F.when(F.col("_new"), F.col("from_at"))).over(along.rowsBetween(Window.unboundedPreceding, 0))
    return begun.select("edge", "from_ord", "from_th", "from_at", start.alias("path"))


def spans(found: DataFrame, placed: DataFrame) -> DataFrame:
    """(ord, th, at, n, from_ord, from_th, from_at): runs of ``n`` words of a document that stand
    in an earlier one, along one path."""
    rows = found.filter("ord > owner").select("edge", "ord", "th", "at").join(placed, "edge")
    here = Window.partitionBy("ord", "th").orderBy("at")

    def same(column: str, step: int = 0) -> Column:
        return F.lag(column).over(here) == F.col(column) - step

    goes_on = same("at", 1) & same("from_at", 1) & same("from_ord") & same("from_th") & same("path")
    numbered = rows.withColumn("_new", (~F.coalesce(goes_on, F.lit(False))).cast("long"))
    numbered = numbered.withColumn("_span", F.sum("_new").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("ord", "th", "_span").agg(
        F.min("at").alias("at"), (F.count(F.lit(1)) + (K - 1)).alias("n"),
        F.first("from_ord").alias("from_ord"), F.first("from_th").alias("from_th"), F.min("from_at").alias("from_at"),
    ).drop("_span")


def dedup(df: DataFrame, with_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` per row of ``df`` (doc_id, text); with
    ``with_text`` also ``kept`` (the words left, joined by one space)."""
    docs = df.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"), F.xxhash64("text").alias("th"), "text")
    whole = written(_read(docs.select("ord", "th", "text")))
    read = written(whole.drop("minimizers"))
    # Copies: the same words stand in a document with a smaller id.
    first = read.filter(F.col("n_words") >= K).groupBy("sha").agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("c"))
    copies = written(
        read.select("ord", "th", "sha").join(first.filter("c > 1"), "sha").filter("ord > first").select("ord", "th").distinct()
    )
    # At most the minimizers of one document per row.
    per_doc = written(
        shared_values(whole.join(_few(copies), ["ord", "th"], "left_anti"), ("ord", "th"), "minimizers")
        .groupBy("ord", "th").agg(F.collect_set("value").alias("minimizers"))
    )
    dropped(whole)
    ids = written(per_doc.select("ord", "th"))
    texts = docs.select("ord", "th", "text").join(_few(ids), ["ord", "th"], "left_semi").dropDuplicates(["ord", "th"])
    work = written(texts.join(per_doc, ["ord", "th"]))
    dropped(per_doc, ids)
    rows = written(_windows(work))
    found = written(edges(rows))
    dropped(rows)
    placed = written(paths(found))
    runs = written(spans(found, placed))
    wanted = runs.select("from_ord", "from_th", "from_at", "n").distinct().groupBy("from_ord", "from_th").agg(
        F.collect_list(F.struct("from_at", "n")).alias("wanted")
    ).select(F.col("from_ord").alias("ord"), F.col("from_th").alias("th"), "wanted")
    digests = written(_source_digests(work.select("ord", "th", "text").join(wanted, ["ord", "th"])))
    # At most the spans of one document per row.
    per_target = runs.join(digests, ["from_ord", "from_th", "from_at", "n"]).groupBy("ord", "th").agg(
        F.collect_list(F.struct("at", "n", "digest")).alias("spans")
    )
    cleaned = _removed(work.select("ord", "th", "text").join(per_target, ["ord", "th"]))
    cleaned = written(cleaned if with_text else cleaned.drop("kept"))
    empty = hashlib.sha256(b"").hexdigest()
    result = (
        read.select("ord", "th", "n_words", "sha")
        .join(copies.withColumn("copy", F.lit(True)), ["ord", "th"], "left")
        .join(cleaned, ["ord", "th"], "left")
        .select(
            "ord", "th", "n_words",
            F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0).cast("long"))).alias("n_removed"),
            F.when(F.col("copy"), F.lit(empty)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
            *([F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept")).alias("kept")] if with_text else []),
        )
    )
    dropped(work, found, placed, runs, digests)
    if with_text:
        rest = result.select("ord", "th", "n_removed", "kept_sha256", "kept", "n_words").dropDuplicates(["ord", "th"])
        words = F.array_join(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""), " ")
        return docs.join(rest, ["ord", "th"]).select(
            "doc_id", "n_words", "n_removed", "kept_sha256", F.coalesce("kept", words).alias("kept")
        )
    kind = df.schema["doc_id"].dataType
    return result.select(
        F.when(F.col("ord") != LAST, F.col("ord").cast(kind)).alias("doc_id"), "n_words", "n_removed", "kept_sha256"
    )
