"""Phrases by prefix-free parsing against literal counting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetloom.llm import collocations, queries
from fleetloom.llm.byte_words import WordHasher, numbered, spans
from tests.llm.test_text_operators import SCHEMA, awkward

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def plain(rows, most=3, min_count=10, top=2000, inside=50):
    counts = {}
    for text, lang in rows:
        for words in pieces(text):
            f = counts.setdefault(lang or "und", Counter())
            for size in range(1, most + 1):
                f.update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in chosen.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            longer = [b for q, b in chosen.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= inside * a for b in longer):
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        n = sum(c for p, c in f.items() if len(p) == 1)
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def made(seed, n=400):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("ka", "Lo", "mi", "É", "漢") for b in ("", "ra", "ti")]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(vocab[:2 + i % 14]) + rng.choice(("  ", " ", "\t", " ", ". ", "\n", "\x0b", " !")) for _ in range(rng.randrange(1, 60)))
        rows.append((text, rng.choice(("en", "de", None))))
    return rows + rows[:40] * 3 + [("New York City " * 30, "en"), ("a " * 5000, "de"), (None, "en"), ("", None), (" .\n", "xx")]


@pytest.mark.parametrize("most,min_count,inside", [(3, 10, 50), (2, 3, 50), (4, 6, 80)])
def test_matches_literal_counts(spark, most, min_count, inside):
    rows = made(most)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    found = collocations.collocations(docs, most=most, min_count=min_count, top=150, inside_percent=inside)
    expected = plain(rows, most, min_count, 150, inside)
    assert rows_of(found) == expected and len(expected) > 100


def test_each_occurrence_belongs_to_one_chunk():
    rng = random.Random(5)
    hasher = WordHasher()
    for stride in (1, 2, 5, 10**9):
        texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 40))) + rng.choice(("", ". x", "\n\ny z")) for _ in range(50)]
        got, expected = Counter(), Counter()
        for chunk in collocations.chunks(pa.array(texts), hasher, 2, stride)[0]:
            words = chunk[1:].decode().split()
            own = len(words) - (2 if chunk[:1] == b"+" else 0)
            assert own > 0
            got.update(tuple(words[i:i + 3]) for i in range(own))
        for text in texts:
            for words in pieces(text):
                expected.update(tuple(words[i:i + 3]) for i in range(len(words)))
        # Of a chunk with a next one, each n-gram of the own part is whole.
        assert got == expected


def test_hashes_of_spans(monkeypatch):
    from fleetloom.llm import byte_words

    words = [b"a", b"b", b"ab", b"ba", b"abc" * 50, b"\x00", b"\x00\x00", b"ab"]
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends = spans(data != 32, np.array([0, len(data)]))
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == words
    found = WordHasher()(data, starts, ends)
    assert len(set(found.tolist())) == 7 and found[2] == found[7]
    monkeypatch.setattr(byte_words, "SLICE", 4)
    assert (WordHasher()(data, starts, ends) == found).all()
    numbers, distinct, first = numbered(found)
    assert (distinct[numbers] == found).all() and first.tolist() == list(range(7))


def test_sends_and_full_maps_change_nothing(spark, monkeypatch):
    rows = made(9)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    monkeypatch.setattr(collocations, "HELD_CHUNKS", 7)
    monkeypatch.setattr(collocations, "HELD_KEYS", 50)
    monkeypatch.setattr(collocations, "HELD_BYTES", 200)
    monkeypatch.setattr(collocations, "MAP_BITS", 8)
    assert rows_of(collocations.collocations(docs, min_count=8)) == plain(rows, min_count=8)


def test_large_counts_stay_exact(spark):
    big = 3_000_000_000
    grams = spark.createDataFrame(
        [("en", "a", 1, big + 1), ("en", "b", 1, big + 3), ("en", "a b", 2, big - 7)], "lang string, gram string, size int, f long")
    assert collocations.scored(grams).first()["score"] == 1_000_000 * (big - 7) ** 2 // ((big + 1) * (big + 3))


def test_awkward_rows_and_clashing_names(spark):
    rows = awkward()
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("chunk", "n", "gram", "f", "rank", "phrase")])
    expected = plain([(r[1], r[2]) for r in rows], min_count=5)
    assert rows_of(collocations.collocations(docs, min_count=5)) == expected and expected
    other = docs.select(F.col("text").alias("lang"), F.col("lang").alias("text"))
    assert rows_of(collocations.collocations(other, text="lang", lang="text", min_count=5)) == expected


def test_no_documents(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(empty).count() == 0
    assert "op11_prefix_free_collocations" in queries.QUERIES
