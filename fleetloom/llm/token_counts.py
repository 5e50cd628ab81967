"""Token counts with a whole-token shortcut for byte-level BPE vocabularies.

Offline, every string of the vocabulary is encoded alone; those that come out as their own single
token are proven. Texts are cut where no pre-token can reach across (before a single space
between two visible characters), pieces found before are looked up, the pre-tokens of new pieces
that are proven count one each, and only the rest go through the merges.

One pass without a shuffle; a worker keeps the proven set and a bounded cache.

Defined results: a null or empty text has 0 bytes and 0 tokens. Strings of special tokens inside
a text are one token, as the library has it. Other columns stay; ``n_bytes``, ``n_tokens`` and
``over_limit`` are replaced if they exist.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetloom.llm.tokens import Cache, byte_letters, content, load

# Before a single space that stands between visible characters a pre-token always ends, and
# likewise around a single line feed.
CUT = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
# The vocabulary's splitting rule written out for the first 256 characters, for
# pieces whose only white space is a blank in front.
PARTS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+| ?[0-9²³¹¼½¾]+| ?[^\sA-Za-zªµºÀ-ÖØ-öø-ÿ0-9²³¹¼½¾]+"
)
SPACES = re.compile(r" ?\S+")
ODD_SPACE = re.compile(r"\s\s|[^\S \n]|\A\s|\s\Z")


def whole_tokens(json_text: str) -> frozenset[str]:
    """Strings of the vocabulary, in byte-level letters, that encode alone as one token."""
    tokenizer = load(json_text)
    model, special = tokenizer.model, {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    return frozenset(
        s for s in tokenizer.get_vocab(with_added_tokens=False)
        if s not in special and len(model.tokenize(s)) == 1
    )


def counter(json_text: str, whole: frozenset[str]) -> Callable[[str], int]:
    tokenizer = load(json_text)
    pre, merge = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    letters = byte_letters(tokenizer)

    def merged(part: str) -> int:
        return 1 if part in whole else len(merge(part))

    parts = Cache(lambda part: merged(part.translate(letters)))

    def count(piece: str) -> int:
        if any(s in piece for s in special):
            return len(tokenizer.encode(piece, add_special_tokens=False).ids)
        try:
            piece.encode("latin-1")
        except UnicodeEncodeError:
            return sum(merged(p) for p, _ in pre(piece))
        if not SPACES.fullmatch(piece):
            return sum(merged(p) for p, _ in pre(piece))
        return sum(map(parts.__getitem__, PARTS.findall(piece)))

    pieces = Cache(count)
    spaced = Cache(lambda word: count(" " + word))
    line_feed = count("\n")

    def total(text: str) -> int:
        if ODD_SPACE.search(text):
            return sum(map(pieces.__getitem__, CUT.split(text)))
        n = 0
        lines = text.split("\n")
        for line in lines:
            first, *rest = line.split(" ")
            n += pieces[first] + sum(map(spaced.__getitem__, rest))
        return n + line_feed * (len(lines) - 1)

    return total


def count_tokens(df: DataFrame, vocabulary_path: str, limit: int, text: str = "text") -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    json_text = content(vocabulary_path)
    whole = whole_tokens(json_text)
    kept = [f for f in df.schema.fields if f.name not in ("n_bytes", "n_tokens", "over_limit", text)]
    schema = T.StructType([*kept, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = counter(json_text, whole)
        for batch in batches:
            counts = [total(t) if t else 0 for t in batch.column("_text").to_pylist()]
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column("_bytes"), pa.array(counts, pa.int64())], names=schema.names
            )

    source = df.select(
        *[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`").alias("_text"),
        F.coalesce(F.octet_length(f"`{text}`").cast("long"), F.lit(0).cast("long")).alias("_bytes"),
    )
    return source.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
