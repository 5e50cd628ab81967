"""Spelling variants: words one edit apart, by asymmetric q-chunks.

A word asks with two disjoint chunks, its halves of q = length // 2 code points; the other word offers
its positional grams of that q. One inserted, deleted or replaced code point leaves one of the two
chunks whole, the first in place, the second shifted by the difference of the lengths, so at most by
one. An offer therefore names the length it is meant for, and only the grams that stand where a chunk
of such a word can have gone are sent, for three lengths. As halves of short words are common, the rule is
used twice: where one half stays whole the edit lies in the other, of whose two chunks again one
stays whole, so a key is a half and a quarter. Pairs that meet are verified; one that meets by several
keys counts by the first. Nothing but words (not their texts) is joined, and a task returns near pairs
only.

Forms are followed to the root by doubling: each round every chain halves, so a few rounds settle
it. A form stands at least ``ratio`` times as often, so there are no circles.

Defined results: a null, empty or wordless text has no words; with a null id nothing is deleted from
its words; repeated rows count as often as they stand there; very long texts are read whole; among near words
of equal count the smallest in code-point order is the form; without words the result is empty. Only
the named columns are read, so others may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.llm.common import dropped, written

MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
# Of all pairs of text and run, one in this many loses a code point.
SLIPS = 97
# Distinct words that a task holds before it sends them.
HELD_WORDS = 300_000


def runs(doc_id, text: str, min_length: int = MIN_LENGTH, slips: int = SLIPS) -> Counter:
    """The words of a text: runs of letters with A-Z in lower case, some with a code point deleted by
    the hash of the id and the run; shorter runs give no word."""
    found = Counter(re.findall(rf"[a-zÀ-ÿ]{{{min_length},}}", text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
    if doc_id is None:
        return found
    seed, changed = zlib.crc32(f"{doc_id}:".encode()), []
    for run in found:
        h = zlib.crc32(run.encode(), seed)
        if h % slips == 0:
            at = h % len(run)
            changed.append((run, run[:at] + run[at + 1:]))
    counts = [found.pop(run) for run, _ in changed]
    for (_, word), n in zip(changed, counts):
        if len(word) >= min_length:
            found[word] += n
    return found


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that stand ``min_count`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.update(runs(doc_id, body, min_length))
                if len(held) > HELD_WORDS:
                    yield send(held)
                    held.clear()
        yield send(held)

    def send(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    sent = docs.select(F.col(key), F.col(text)).filter(F.col(text).isNotNull()).mapInArrow(run, "word string, n long")
    return written(sent.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))


def _chunks(word: Column, own: Column, shift: Column | int) -> list[list[tuple[Column, Column]]]:
    """Where ``word`` has the chunks that a word of ``own`` code points, ``shift`` fewer than it, asks for:
    [[(half, quarter)]] by the half that stays whole and the quarter of the other that does."""
    def part(at: Column, size: Column, moved: bool) -> Column:
        return F.substr(word, at + 1 + (shift if moved else 0), size)

    q = F.floor(own / 2).cast("int")
    tail, head = F.floor((own - q) / 2).cast("int"), F.floor(q / 2).cast("int")
    zero = F.lit(0)
    first, second = part(zero, q, False), part(q, q, True)
    return [
        [(first, part(q, tail, False)), (first, part(q + tail, tail, True))],
        [(second, part(zero, head, False)), (second, part(head, head, True))],
    ]


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) for all ordered pairs of ``words`` (word, n) that differ by one edit."""
    word, length = F.col("word"), F.char_length("word")

    def keys(own: Column, shift: int) -> list[Column]:
        return [
            F.xxhash64(own, F.lit(2 * side + k), *grams)
            for side, pairs in enumerate(_chunks(word, own, shift)) for k, grams in enumerate(pairs)
        ]

    asks = words.select("word", "n", F.posexplode(F.array(*keys(length, 0))).alias("by", "key"))
    offers = words.select(
        F.col("word").alias("near"), F.col("n").alias("near_n"),
        F.explode(F.array(*[k for d in (-1, 0, 1) for k in keys(length - d, d)])).alias("key"),
    )
    # A pair may meet by several keys; the first of them counts.
    own, moved = F.char_length("word"), F.char_length("near") - F.char_length("word")
    mine, theirs = _chunks(word, own, 0), _chunks(F.col("near"), own, moved)
    same = [[(a[0] == b[0], a[1] == b[1]) for a, b in zip(x, y)] for x, y in zip(mine, theirs)]
    half = same[0][0][0]
    once = (
        F.when(F.col("by") == 0, True).when(F.col("by") == 1, ~same[0][0][1])
        .when(F.col("by") == 2, ~half).otherwise(~half & ~same[1][0][1])
    )
    return (
        asks.join(offers, "key")
        .filter((word != F.col("near")) & (F.levenshtein("word", "near", 1) == 1) & once)
        .select("word", "n", "near", "near_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): forms followed to the last."""
    left = written(forms.select("word", F.col("form").alias("root")))
    while True:
        up = left.select(F.col("word").alias("root"), F.col("root").alias("top"))
        step = written(left.join(up, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("on")))
        dropped(left)
        left = step.select("word", "root")
        if step.filter("on").isEmpty():
            return left
        left = step.drop("on")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) over ``words`` (word, n), one row per word."""
    near = near_pairs(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    found = written(words.join(near, "word", "left"))
    form = F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best"))
    found = found.withColumn("best", form).select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("form"), (-F.col("best.n")).alias("form_n"))
    followed = roots(found.filter("form is not null").select("word", "form"))
    return found.join(followed, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
