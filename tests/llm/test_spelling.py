"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetloom.llm import queries, spelling
from tests.llm.test_text_operators import ROOT, SCHEMA, awkward, tables

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FIELDS = ("word", "form", "root", "n", "n_near", "form_n")


def plain_words(rows, slips=97, min_count=3):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % slips == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(words, ratio=2):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] is not None else None))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in FIELDS) for r in df.select(*FIELDS).collect())


@pytest.mark.parametrize("seed", range(3))
def test_near_words_match_all_pairs(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(5, 8))): 3 + int(rng.paretovariate(0.5)) % 10**9 for _ in range(250)}
    for w in list(words)[:60]:  # one edit at every place of some words, ends and middle included
        for i in range(len(w) + 1):
            words.setdefault(w[:i] + "x" + w[i:], rng.randrange(3, 9))
            if i < len(w):
                words.setdefault(w[:i] + "y" + w[i + 1:], rng.randrange(3, 9))
                if len(w) > 5:
                    words.setdefault(w[:i] + w[i + 1:], rng.randrange(3, 9))
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    assert rows_of(spelling.variants(df)) == plain(words)


def test_long_chains_of_forms(spark):
    words = {"a" * k: 2**k for k in range(5, 45)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    found = rows_of(spelling.variants(df))
    assert found == plain(words) and {r[2] for r in found} == {"a" * 44}


def test_slips_do_not_mix(spark):
    # A run whose slip gives another run that slips itself.
    pairs = [(i, "abcdefg abcdef abcde abcdefgh") for i in range(3000)]
    found = Counter()
    for i, t in pairs:
        found.update(spelling.runs(i, t, slips=2))
    assert dict(found) == plain_words(pairs, slips=2, min_count=1)


@tables
def test_documents(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    expected = plain(plain_words([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]))
    assert rows_of(queries.op13_q_chunk_spelling(spark, ROOT)) == expected
    assert sum(r[1] is not None for r in expected) > 20


def test_awkward_rows_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 5)
    rows = awkward()
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("word", "n", "near", "root", "length")])
    assert rows_of(spelling.variants(spelling.vocabulary(docs))) == plain(plain_words([(r[0], r[1]) for r in rows]))


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "1 2 3")], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(docs)).count() == 0
    assert spelling.variants(spelling.vocabulary(docs.limit(0))).count() == 0
