"""The text operators against plain versions on small and awkward inputs."""

import hashlib
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetloom.llm import (
    decontaminate, dom, jaccard, kneser_ney, packing, quality_rules, queries, secret_scan, sharding, substring,
    token_counts, wrapper,
)
from fleetloom.llm.components import components
from fleetloom.llm.tokens import content, vocabulary
from tests.oracle import compare, connect

ROOT = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
tables = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


def awkward() -> list[tuple]:
    """Nulls, empty, blank and long texts, ties, repeated rows and ids, odd white space."""
    rng = random.Random(3)
    vocab = [f"{a}{b}" for a in ("tha", "Ing", "er", "É", "ßu", "漢") for b in ("", "on", "ti,", "X9", "<b>")]

    def text(n):
        return "".join(rng.choice(vocab) + rng.choice((" ", " ", " ", "\n", "\t", "  ")) for _ in range(n))

    base, passage = text(60), text(30)
    rows = [
        (None, base), (1, None), (2, ""), (3, " \n\t "), (4, base), (5, base), (5, base), (6, base + " tail"),
        (7, text(40) + passage + text(20)), (8, passage + text(25)), (9, "one"), (10, "one"), (11, "One two"),
        (12, text(30_000)), (13, "a" * 50_000), (14, "x y z " * 400), (15, "l1 w\nl1 w\nl2\n\nl1 w"), (15, text(25)),
        (None, None), (16, base.upper()), (17, "one\x1ctwo three four \x85 five"), (-3, base),
    ]
    words = base.split()
    for k in range(12):
        changed = list(words)
        for i in rng.sample(range(len(words)), k % 4):
            changed[i] = f"new{k}"
        rows.append((100 + k, " ".join(changed)))
    return [(i, t, "en", f"src{n % 3}", len(t) if t else 0) for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple("" if v is None else str(v) for v in row)


# Quality rules

def plain_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def test_quality_counts(docs, rows, none):
    got = quality_rules.judge(docs.withColumn("kept", F.lit("clash"))).collect()
    counts = sorted(key((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got)
    assert counts == sorted(key((r[0], *plain_counts(r[1]))) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert isinstance(r.kept, bool) and not (r.base_failed and r.kept) and r.kept == (not r.base_failed and not r.failed_rules)
    assert quality_rules.judge(none).count() == 0


def test_quality_rules_by_language(spark):
    body = " ".join(f"слово{i}" for i in range(60))
    long_words = " ".join("вода" * 4 + str(i) for i in range(30))
    source = [(1, body, "ru", "s", 0), (2, body, "en", "s", 0), (3, body, "de_AT", "s", 0), (4, body, None, "s", 0),
              (5, long_words, "zh", "s", 0), (6, long_words, "en-US", "s", 0)]
    df = spark.createDataFrame(source, SCHEMA).withColumns({c: F.lit("x") for c in ("_words", "_lines", "_stop", "n_words")})
    got = {r.doc_id: r for r in quality_rules.judge(df).collect()}
    assert [i for i in got if got[i].kept] == [1, 4, 5]
    assert got[2].failed_rules == got[3].failed_rules == ["stop_words"] and got[6].failed_rules == ["word_length"]
    assert got[1]["_words"] == got[1]["_lines"] == got[1]["_stop"] == "x" and got[1].n_words == 60
    assert all(r.kept for r in quality_rules.judge(df, lang=None).collect())


def test_helper_columns_do_not_clash(spark):
    source = [(i, f'api_key = "AKIA4Q7RZ2M8K1X9{i:04d}" word', "en", "s", 0) for i in range(40)]
    df = spark.createDataFrame(source, SCHEMA).withColumns({c: F.lit(7) for c in ("_row", "_secrets", "_key", "_range", "_at")})
    for got in (secret_scan.redacted(df, "doc_id", path="source"),
                sharding.shard(df, 4, F.xxhash64("doc_id"), F.lit(1).cast("long"), ("doc_id",))):
        rows = got.collect()
        assert set(df.columns) <= set(got.columns) and len(rows) == 40
        assert all(r["_row"] == r["_secrets"] == r["_key"] == r["_range"] == r["_at"] == 7 for r in rows)


@tables
@pytest.mark.parametrize("name", ["op10_quality_rules", "op5_parity_sketch_join", "op6_de_bruijn_dedup"])
def test_query_equals_its_twin(spark, name):
    query, sql = queries.QUERIES[name]
    assert compare(query(spark, ROOT), connect(ROOT), sql) == ""


# Sharding

def sharded(df, n=8):
    text = F.col("text")
    return sharding.shard(
        df.select("doc_id", sharding.utf8_size(text).alias("size"), F.crc32(text).alias("crc"),
                  sharding.spread_key(text, F.col("doc_id")).alias("place"), F.lit(7).alias("slot")),
        n, F.col("place"), F.col("size"), ("doc_id", "size", "crc"))


def test_shards_are_even_and_slots_gapless(spark, docs, rows, none):
    for df, source in ((docs, rows), (None, None)):
        if df is None:
            source = [(i, "same text" if i % 3 == 0 else f"text {i} " * (i % 11), "", "", 0) for i in range(3000)]
            df = spark.createDataFrame(source, SCHEMA)
        got = sharded(df).collect()
        assert sorted(key((r.doc_id, r.size)) for r in got) == sorted(
            key((r[0], len((r[1] or "").encode("utf-8")) + 1)) for r in source)
        slots, sizes = defaultdict(list), Counter()
        for r in got:
            slots[r.shard].append(r.slot)
            sizes[r.shard] += r.size
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
        largest, mean = max(r.size for r in got), sum(r.size for r in got) / 8
        assert all(abs(sizes[s] - mean) <= largest + 1e-3 * mean for s in range(8))
    assert sharded(none).count() == 0


def test_boundaries_count_exactly(spark):
    keys = [(random.Random(i).getrandbits(64) - (1 << 63), i % 50 + 1) for i in range(500)] + [(5, 3)] * 100
    df = spark.createDataFrame(keys, "_key long, _size long")
    for b in sharding.boundaries(df, [0.1, 0.25, 0.5, 0.9], [0.0] * 4):
        assert b.size == sum(s for k, s in keys if b.key is None or k < b.key)
        assert b.rows == sum(1 for k, _ in keys if b.key is None or k < b.key)


# Tokens

ALPHABET = list("abAB'sStdlmrev019²½ªº  \n\t.,!?-_éÉßüñ\xa0\x85\x1c\x1d\x0b 　漢字Σσς İıѣ€😀́​﻿") + [
    "<|endoftext|>", "<|startoftext|>", " the", "'ll", "'re", "  ", "\n\n", "\r\n"]


def test_token_counts_and_ids_equal_the_library():
    word, byte = content(vocabulary("word_bpe_49k.json")), content(vocabulary("byte_bpe_50k.json"))
    a, b = Tokenizer.from_str(word), Tokenizer.from_str(byte)
    encoder, total = packing.Encoder(word), token_counts.counter(byte, token_counts.whole_tokens(byte))
    rng = random.Random(5)
    for _ in range(4000):
        t = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 14)))
        assert encoder(t, 1).tolist() == [*a.encode(t, add_special_tokens=False).ids, 1], t
        assert total(t) == len(b.encode(t, add_special_tokens=False).ids), t


def test_token_counts(docs, rows, none):
    path = vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = token_counts.count_tokens(docs, path, 1024).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    want = [(r[0], len((r[1] or "").encode()), n := len(library.encode(r[1] or "", add_special_tokens=False).ids), n > 1024) for r in rows]
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert token_counts.count_tokens(none, path, 1024).count() == 0


def test_packing(spark, docs, rows, none):
    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    # Unique ids, so that pieces can be told apart.
    source = [(n, *r[1:]) for n, r in enumerate(rows)]
    got = packing.pack(spark.createDataFrame(source, SCHEMA).repartition(2), path, 1, ("doc_id",)).collect()
    pieces, sequences, steps = defaultdict(list), defaultdict(list), Counter()
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        steps[r.step_group] += r.length
    for r in source:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]
        own = sorted(pieces.pop(r[0]), key=lambda p: p.start)
        assert [i for p in own for i in np.frombuffer(p.ids, "<u4")] == ids
        assert all(p.doc_tokens == len(ids) for p in own)
    assert not pieces
    for s in sequences.values():
        s.sort(key=lambda p: p.offset)
        total = sum(p.length for p in s)
        assert [p.offset for p in s] == [sum(q.length for q in s[:i]) for i in range(len(s))]
        assert total == s[0].context and total <= 2048 and total & (total - 1) == 0
    assert max(steps.values()) <= 16 * 2048
    assert packing.pack(docs, path, 1, ("doc_id",)).count() >= len(rows)
    assert packing.pack(none, path, 1, ("doc_id",)).count() == 0


def test_packer_buffers_keep_everything():
    rng = random.Random(1)
    packer, total, packed = packing.Packer((4, 8, 16)), 0, 0
    for row in range(400):
        n = rng.choice((1, 2, 3, 5, 9, 15, 40))
        total += n
        packed += sum(len(p.ids) for w in packer.add(packing.Piece(row, 0, np.arange(n))) for p in w)
        if packer.held > 50:
            for window in packer.pack():
                size = sum(len(p.ids) for p in window)
                assert size in (4, 8, 16)
                packed += size
    packed += sum(len(p.ids) for w in [*packer.pack(), *packer.tail()] for p in w)
    assert packed == total


# Near copies

def plain_sets(source, n):
    sets = []
    for r in source:
        words = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in WORD.findall(r[1] or "")]
        sets.append({tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set())
    return sets


def plain_components(source, n, percent):
    sets = plain_sets(source, n)
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if a and sets[j] and 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(sets)):
        members[find(i)].append(i)
    out = []
    for group in members.values():
        ids = [source[i][0] for i in group if source[i][0] is not None]
        out += [(source[i][0], len(sets[i]), min(ids) if ids else None) for i in group]
    return sets, out, [g for g in members.values()]


def families(seed=11):
    """Groups of near copies around the threshold, chains, and texts that share passages."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(40)]
    source, n = [], 0
    for length in (1, 2, 3, 4, 7, 12, 20, 35, 60, 110, 200, 420):
        for _ in range(3):
            base = [rng.choice(vocab) for _ in range(length)]
            if length >= 60:
                base[5:45] = passage
            for _ in range(7):
                source.append((n, " ".join(base), "", "", 0))
                n += 1
                for _ in range(rng.choice((0, 1, 1, 1 + length // 60, 1 + length // 30))):
                    kind, i = rng.random(), rng.randrange(len(base))
                    if kind < 0.5:
                        base[i] = rng.choice(vocab)
                    elif kind < 0.75 and len(base) > 1:
                        del base[i]
                    else:
                        base.insert(i, rng.choice(vocab))
    return source


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_near_duplicates(spark, docs, rows, none, n, percent):
    source = families() + [(10_000 + i if r[0] is not None else None, *r[1:]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(source, SCHEMA)
    _, want, groups = plain_components(source, n, percent)
    assert any(len(g) > 3 for g in groups)
    assert sorted(map(key, jaccard.near_duplicates(df, n, percent).collect())) == sorted(map(key, want))
    assert sorted(map(key, jaccard.near_duplicates(docs, n, percent).collect())) == sorted(map(key, plain_components(rows, n, percent)[1]))
    assert jaccard.near_duplicates(none, n, percent).count() == 0


def test_pairs_of_near_copies_come_from_one_bucket(spark):
    """Members of the same many buckets, in different components, give each pair of them once."""
    nodes, signs = range(1, 13), range(40)
    members = spark.createDataFrame([(v, 7 * s, v % 6) for v in nodes for s in signs if s >= v % 3], "node long, sign long, label long")
    known = spark.createDataFrame([(v, 100, [0] * jaccard.SKETCH_WORDS) for v in nodes], "node long, n long, sketch array<long>")
    got = [(r.a, r.b) for r in jaccard._rest(members, known, 80).collect()]
    assert sorted(got) == [(a, b) for a in nodes for b in nodes if a < b and a % 6 != b % 6]


def test_one_per_component(docs, rows, none):
    kept = jaccard.one_per_component(docs, 5, 80).collect()
    sets, _, groups = plain_components(rows, 5, 80)
    with_words = [g for g in groups if sets[g[0]]]
    without = sum(1 for s in sets if not s)
    assert len(kept) == len(with_words) + without
    ids = Counter(r.doc_id for r in kept)
    for g in with_words:
        assert min((rows[i][0] is None, rows[i][0] or 0) for i in g)[1] in {i or 0 for i in ids}
    assert jaccard.one_per_component(none, 5, 80).count() == 0


def test_signatures_keep_every_link():
    rng = np.random.default_rng(2)
    for percent in (80, 90):
        bands = jaccard.Bands(percent)
        for size in (1, 2, 5, 19, 20, 40, 99, 100, 149, 150, 333, 1000):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            for _ in range(15):
                swap = int(rng.integers(0, size // 8 + 1))
                b = np.unique(np.concatenate([a[swap:], rng.integers(0, 2**63, int(rng.integers(0, size // 8 + 1)), dtype=np.uint64)]))
                shared = len(np.intersect1d(a, b))
                if len(b) and 100 * shared >= percent * (len(a) + len(b) - shared):
                    assert len(np.intersect1d(bands.signatures(a), bands.signatures(b)))
                    apart = sum(int(x).bit_count() for x in jaccard.folded(jaccard.sketch(a)) ^ jaccard.folded(jaccard.sketch(b)))
                    assert apart <= len(a) + len(b) - 2 * shared <= bands.differ(len(a) + len(b))


def test_parts_suffice_for_every_pair_of_sizes():
    for percent in (80, 90):
        bands = jaccard.Bands(percent)
        for large in range(1, 500):
            for small in range(-(-percent * large // 100), large + 1):
                places = dict(bands.places(large))
                band = bands.of(small)
                assert min(places[band], dict(bands.places(small))[band]) > bands.differ(small + large), (percent, small, large)


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(60)]
    edges = chain + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(500, 500 + i) for i in range(1, 50)]
    label = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        return i if parent[i] == i else find(parent[i])

    for a, b in edges:
        parent[find(a)] = find(b)
    pairs = [(a, b) for a in label for b in label]
    assert all((label[a] == label[b]) == (find(a) == find(b)) for a, b in pairs)


# Repeated spans

def plain_dedup(source):
    words = [WORD.findall(r[1] or "") for r in source]
    first = {}
    for r, w in zip(source, words):
        rank = float("inf") if r[0] is None else r[0]
        for i in range(len(w) - 12):
            first[tuple(w[i:i + 13])] = min(rank, first.get(tuple(w[i:i + 13]), float("inf")))
    out = []
    for r, w in zip(source, words):
        rank = float("inf") if r[0] is None else r[0]
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i:i + 13])] < rank for j in range(i, i + 13)}
        rest = [x for i, x in enumerate(w) if i not in gone]
        out.append((r[0], len(w), len(gone), hashlib.sha256(" ".join(rest).encode()).hexdigest()))
    return out


def test_repeated_spans(spark, docs, rows, none):
    source = families(5) + [(10_000 + i if r[0] is not None else None, *r[1:]) for i, r in enumerate(rows)]
    for df, own in ((spark.createDataFrame(source, SCHEMA), source), (docs, rows)):
        assert sorted(map(key, substring.dedup(df).collect())) == sorted(map(key, plain_dedup(own)))
    kept = substring.dedup(docs, with_text=True).collect()
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in kept) and len(kept) == len(rows)
    assert substring.dedup(none).count() == 0


def test_windows_of_many_texts_at_once():
    """The windows of several texts in one go are those of each text."""
    from fleetloom.llm.tokens import Cache
    rng = random.Random(12)
    hashes = Cache(jaccard.word_hash)
    for sizes in ((), (0, 3), (12, 13, 0, 40, 1, 14, 100), (5, 6, 7)):
        texts = [[rng.choice([b"a", b"b"]) for _ in range(n)] for n in sizes]
        of, at, edge, least, begins = substring.runs_of_windows(texts, hashes, both=True)
        want = [substring.windows(words, hashes) for words in texts]
        assert of.tolist() == [i for i, (e, _) in enumerate(want) for _ in e]
        assert at.tolist() == [k for e, _ in want for k in range(len(e))]
        assert edge.tolist() == [int(x) for e, _ in want for x in e] and least.tolist() == [int(x) for _, m in want for x in m]
        names = list(zip(of, least))
        assert begins.tolist() == [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]
        assert len(substring.runs_of_windows(texts, hashes, both=False)[2]) == 0


def test_words_of_a_column_at_once():
    """Hashes, numbers of words and joined words of a column are those of its texts one by one; equal words have equal hashes."""
    texts = [None, "", " \t", "a b", "a  b", "\na\x0bb ", "x", "é\u00a0b\x85 ü\r\na", "a b\tc\nd", " a"]
    column = pa.array(["unused", *texts], pa.string()).slice(1)
    h, n, letters = substring.hashed(column, substring.WordHasher())
    words = [w for t in texts for w in (t or "").encode().split()]
    assert n.tolist() == [len((t or "").encode().split()) for t in texts]
    assert letters.tolist() == [len(b"".join((t or "").encode().split())) for t in texts]
    name = dict(zip(words, h.tolist()))
    assert h.tolist() == [name[w] for w in words] and len(set(name.values())) == len(name)
    for t, k, m in zip(texts, n.tolist(), letters.tolist()):
        assert substring.joined_words(t and t.encode(), k, m) == b" ".join((t or "").encode().split())


def test_equal_windows_name_equal_minimizers():
    from fleetloom.llm.tokens import Cache
    rng = random.Random(8)
    words = [rng.choice([b"a", b"b", b"c"]) for _ in range(300)]
    edge, least = substring.windows(words, Cache(jaccard.word_hash))
    named = {}
    for i, e in enumerate(edge):
        assert named.setdefault(int(e), int(least[i])) == int(least[i])
        assert int(e) in named and len(edge) == 288
    assert len(np.unique(edge)) == len({tuple(words[i:i + 13]) for i in range(288)})


# Benchmark passages

def plain_edits(passage, text):
    last = [0] * (len(text) + 1)
    for i, a in enumerate(passage):
        now = [i + 1]
        for j, b in enumerate(text):
            now.append(min(last[j] + (a != b), last[j + 1] + 1, now[j] + 1))
        last = now
    return min(last)


def test_passages_within_the_edit_budget():
    rng = random.Random(2)
    items = ["".join(rng.choice("abcde ") for _ in range(rng.randint(30, 120))).strip() for _ in range(8)]
    passages, found = decontaminate.Passages([*items, "", None, "short"]), 0
    for _ in range(80):
        s = list(decontaminate.normal(rng.choice(items)))
        for _ in range(rng.randint(0, 14)):
            i = rng.randrange(len(s))
            s[i:i + 1] = rng.choice(([], [rng.choice("abcde")], [s[i], rng.choice("abcde")]))
        text = decontaminate.normal("".join(rng.choice("abcde") for _ in range(rng.randint(0, 90))) + "".join(s) + "".join(
            rng.choice("abcde") for _ in range(rng.randint(0, 90))))
        got = {m.item: m for m in passages.find(text)}
        want = {}
        for k, item in enumerate(items):
            m = len(decontaminate.normal(item))
            edits = plain_edits(decontaminate.normal(item), text)
            if edits <= min(int(m * 0.1), m // 8 - 1):
                want[k] = edits
        found += len(want)
        assert {k: m.edits for k, m in got.items()} == want
        assert all(plain_edits(decontaminate.normal(items[k]), text[m.start:m.end]) == m.edits for k, m in got.items())
    assert found > 30


def test_decontamination(spark, docs, rows, none, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE", 5_000)
    long_text = " ".join(f"z{i}" for i in range(20_000))
    items = spark.createDataFrame([(1, rows[8][1]), (2, None), (3, ""), (4, long_text[70_000:70_700]), (4, rows[8][1])], "item_id long, text string")
    more = docs.unionByName(spark.createDataFrame([(900, long_text, "en", "s", 0)], SCHEMA))
    for block in (1 << 22, 300):
        found = {(r.doc_id, r.item_id) for r in decontaminate.matches(more, items, block_chars=block).collect()}
        assert {(7, 1), (7, 4), (900, 4)} <= found
        kept = decontaminate.clean(more, items, block_chars=block)
        assert kept.columns == docs.columns
        assert sorted(key((r.doc_id,)) for r in kept.collect()) == sorted(
            key((r[0],)) for r in rows if r[0] not in {d for d, _ in found})
    assert decontaminate.matches(none, items).count() == 0 and decontaminate.matches(docs, items.limit(0)).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == len(rows)


# Pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p><p>no";</script></head><body>
<nav><ul><li><a href=/x>menu {n}</a></ul></nav><div class="side-bar sidebar">side {n}</div>
<div class="shell"><div class="content"><h1>Head {n}</h1><p>First <b>bo</b>ld&nbsp;word &amp; more {n}.<p>Second<br>line {n}
<div class=note>Always the same.</div><ul><li>a{n}<li>b</ul></div><section id="comments"><p>reader {n}</section></div>
<footer>foot {n}</footer>"""


def test_main_text_by_wrapper(spark):
    pages = [(i, f"http://h.example/{i}", PAGE.format(n=i)) for i in range(6)] + [
        (10, None, None), (11, "http://x.example", ""), (12, "::bad::[", "plain text only"), (10, None, None),
        (13, "http://h.example/odd", "<article>odd &lt;page&gt;<aside>no</aside></article><p>out"),
        (14, "http://deep.example", "<div>" * 3000 + "deep" + "</div>" * 3000), (15, "http://cut.example", "<main><p>cut <a hre"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r for r in wrapper.main_text(df, ("page_id", "url")).collect()}
    for i in range(6):
        assert got[i].text == f"Head {i} First bold word & more {i}. Second line {i} a{i} b"
    assert got[10].text == "" and got[11].text == "" and got[12].text == "plain text only"
    assert got[13].text == "odd <page>" and got[14].text == "deep" and got[15].text == "cut"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert wrapper.main_text(df.limit(0), ("page_id", "url")).count() == 0


def test_copies_and_odd_pages_do_not_decide(spark):
    body = "<div class=page><section class=text><p>{}</section><div class=box><p>{}</div></div>"
    pages = [(i, "http://copies.example", body.format("the same article", "its box")) for i in range(4)]
    # A slot that only copies have, on a host with other pages.
    pages += [(10 + i, "http://some.example", body.format(f"article {i} " * 9, "box")) for i in range(6)]
    pages += [(20 + i, "http://some.example", body.format("one article " * 9, "box") + "<div class=late><p>only here " + "x " * 300 + "</div>") for i in range(4)]
    # One odd page among many.
    pages += [(100 + i, "http://large.example", body.format(f"text {i} " * 9, "odd" if i == 7 else "box")) for i in range(60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrapper.main_text(df, ("page_id", "url")).collect()}
    assert all(got[i] == "the same article its box" for i in range(4))
    assert all("article" in got[i] and "box" not in got[i] for i in range(10, 16))
    assert all("one article" in got[i] for i in range(20, 24))
    assert all(got[100 + i] == (f"text {i} " * 9).strip() for i in range(60))


def test_tree_match():
    a, b = dom.parse("body(div(p(),p()),main(div()),footer())"), dom.parse("body(main(div(),div()),footer())")
    size, pairs = dom.tree_match(a, b)
    assert size == 4 and (0, 0) in pairs and (4, 1) in pairs


def plain_match(a, b):
    """The largest order-keeping match, by trying every child with or without every other."""
    if a.label != b.label or a.around != b.around:
        return 0

    def best(x, y):
        if not x or not y:
            return 0
        inner = plain_match(x[0], y[0])
        return max(best(x[1:], y), best(x, y[1:]), inner + best(x[1:], y[1:]) if inner else 0)

    return 1 + best(a.children, b.children)


def test_tree_matching_equals_brute_force():
    rng = random.Random(17)

    def tree(depth):
        inner = ",".join(tree(depth - 1) for _ in range(rng.randrange(4))) if depth else ""
        return f"{rng.choice(['div', 'div.a', 'nav!'])}({inner})"

    for _ in range(300):
        a, b = (dom.parse(f"body({tree(2)},{tree(2)})") for _ in range(2))
        size, pairs = dom.tree_match(a, b)
        assert size == plain_match(a, b) == len(set(pairs))


def test_marks_that_enclose_the_article():
    article = "<p>" + "The article itself. " * 20 + "</p>"
    around = "<nav>MENU</nav>{}<div class=ads>Buy</div><footer>foot</footer>"
    for page in (
        '<main class="no-comments">{}</main>', '<div class="with-sidebar">{}</div>', '<div class="header-fixed">{}</div>',
        '<article class="social-post">{}</article>', '<form id="page">{}</form>', '<article class="promoted">{}</article>',
        '<div class="with-sidebar"><div class="sidebar">links</div><article>{}</article></div>',
        '<div class="post">{}</div><section class="comment-list"><article class="comment-body">well said</article></section>',
        '<article>{}</article><section class="comment-list"><article class="comment">well said</article></section>',
    ):
        for text in (page.format(article), around.format(page.format(article))):
            assert [t for _, t in dom.read(f"<html><body>{text}</body></html>")[1]] == [("The article itself. " * 20).strip()]
    for depth in (10, 120, 3000):
        page = "<div>" * depth + "<nav>MENU HOME</nav>" + "<i>" * 700 + article + "<p>in i</p><div class=ads>Buy</div>" + "</div>" * depth
        assert [t for _, t in dom.read(page + "<p>end</p>")[1]][1:] == ["in i", "end"]



# Secrets

def test_secrets(spark, none):
    rng = random.Random(6)

    def run(n, letters="0123456789abcdef"):
        return "".join(rng.choice(letters) for _ in range(n))

    texts, secrets = [], []
    for i in range(300):
        value = run(40) if i % 3 == 0 else run(18) if i % 3 == 1 else "AKIA" + run(16, "ABCDEFGHIJKLMNOP234567") + ""
        secret = i % 2 == 0
        if secret:
            value = value if re.search(r"\d", value) else value[:-1] + "7"
            form = {0: f'token = "{value}"', 1: f"password={value}", 2: f"see {value} there"}[i % 3]
            secrets.append(value)
        else:
            form = {0: f"commit {run(40)}", 1: f"card {run(16, '0123456789')} ", 2: "averylongwordwithoutdigits plain text"}[i % 3]
        texts.append((i, f"some words {form} and more words", "en", "src", 0))
    texts += [(None, None, None, None, None), (500, "", "en", "src", 0), texts[0], (501, "plain", None, None, 0)]
    df = spark.createDataFrame(texts, SCHEMA)
    found = secret_scan.scan(df, ("doc_id",), path="source").collect()
    assert {r.value for r in found if r.is_secret} == set(secrets)
    cleaned = secret_scan.redacted(df, "doc_id", path="source")
    assert cleaned.columns == df.columns and cleaned.count() == len(texts)
    rest = " ".join(r.text or "" for r in cleaned.collect())
    assert not any(s in rest for s in secrets) and rest.count("[SECRET]") == len(secrets) + 1
    one_class = df.filter("doc_id = 0")
    assert secret_scan.scan(one_class, ("doc_id",)).filter("is_secret").count() == 2
    assert secret_scan.scan(none, ("doc_id",)).count() == 0 and secret_scan.redacted(none, "doc_id").count() == 0


def test_copies_do_not_fill_the_training_sample(spark):
    rng = random.Random(31)

    def run():
        return "a7" + "".join(rng.choice("0123456789abcdef") for _ in range(38))

    groups = [f"token = {run()}" if i < 2 else f"commit {run()}" for i in range(10)]
    texts = [(i, f"some words {groups[i % 10]} and", "en", "src", 0) for i in range(500)]
    df = spark.createDataFrame(texts, SCHEMA)
    found = secret_scan.candidates(df, ("doc_id",))
    for rows in (20, 6):
        labels = Counter(r.label for r in secret_scan.sample(found, rows).collect())
        assert labels == {0.0: min(8, rows // 2), 1.0: 2}
    got = secret_scan.scan(df, ("doc_id",), rows=6).collect()
    assert all(r.is_secret == (int(r.doc_id) % 10 < 2) for r in got) and len(got) == 500
    # Labels of one class do not overrule evidence of the other.
    for label in (0.0, 1.0):
        one = found.limit(5).withColumn("label", F.lit(label))
        got = secret_scan.scan(df, ("doc_id",), labelled=one).collect()
        assert all(r.is_secret == (int(r.doc_id) % 10 < 2) for r in got)


# Kneser-Ney

def plain_model(texts):
    """p(run) by the recursion of interpolated modified Kneser-Ney, with dictionaries."""
    order, v = kneser_ney.ORDER, kneser_ney.SYMBOLS
    full = Counter(int(r) for t in texts for r in kneser_ney.runs(t))
    levels = [full]
    for k in range(order - 1, 0, -1):
        levels.insert(0, Counter(r % v**k for r in levels[0]))

    def discounts(c):
        n = [sum(1 for x in c.values() if x == k) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else None
        out = []
        for k in (1, 2, 3):
            raw = 0.5 * k if y is None or not n[k - 1] else k - (k + 1) * y * n[k] / n[k - 1]
            out.append(0.5 * k if n[0] + n[1] == 0 else max(0.1 * k, min(0.9 * k, raw)))
        return out

    def p(k, run):
        below = 1 / v if k == 1 else p(k - 1, run % v ** (k - 1))
        c = levels[k - 1]
        mine = {r: x for r, x in by_context[k - 1].get(run // v, {}).items()}
        if not mine:
            return below
        d = cuts[k - 1]
        total = sum(mine.values())
        weight = sum(d[min(x, 3) - 1] for x in mine.values()) / total
        own = max(c[run] - d[min(c[run], 3) - 1], 0) / total if c[run] else 0
        return own + weight * below

    by_context = []
    for c in levels:
        grouped = defaultdict(dict)
        for r, x in c.items():
            grouped[r // v][r] = x
        by_context.append(grouped)
    cuts = [discounts(c) for c in levels]
    return lambda run: p(order, run)


def test_kneser_ney_equals_the_recursion(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcé ,A1") for _ in range(rng.randint(5, 60))) for _ in range(30)]
    df = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    model = kneser_ney.Model(kneser_ney.model(kneser_ney.counts(df)).toArrow())
    logs, plain = model.logs("en"), plain_model(texts)
    seen = {int(r) for t in texts for r in kneser_ney.runs(t)}
    for run in [*list(seen)[:150], *[rng.randrange(kneser_ney.SYMBOLS**kneser_ney.ORDER) for _ in range(100)]]:
        assert np.exp(logs[run]) == pytest.approx(plain(run), rel=1e-4)
    sums = np.exp(logs.reshape(-1, kneser_ney.SYMBOLS)).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-3) and np.allclose(model.logs("*"), logs, atol=1e-4)


def test_kneser_ney_tells_held_out_texts_apart(spark, none):
    rng = random.Random(10)
    vocab = {"en": ["the", "and", "thing", "of", "nation"], "de": ["der", "und", "schon", "über", "zeit"]}
    source, labels = [], []
    for i in range(400):
        lang = ("en", "de")[i % 2]
        good = i % 5 != 0
        text = " ".join(rng.choice(vocab[lang]) for _ in range(60)) if good else "".join(rng.choice("XQZ%$#|9") for _ in range(300))
        source.append((i, text, lang, "s", 0))
        if i < 200:  # the other half is held out
            labels.append((i, int(good)))
    source += [(None, "the and of", None, "s", 0), (900, "", "en", "s", 0), (901, None, "en", "s", 0), (902, "the and thing", "xx", "s", 0), source[0]]
    df = spark.createDataFrame(source, SCHEMA)
    marks = spark.createDataFrame([*labels, labels[0], (None, 1)], "doc_id long, quality int")
    got = kneser_ney.score(df, marks, quantile=1.0).collect()
    assert len(got) == len(source)
    kept = {r.doc_id: r.kept for r in got}
    assert not any(kept[i] for i in range(200, 400, 5))
    assert sum(kept[i] for i in range(200, 400)) >= 0.95 * 160
    assert not kept[900] and not kept[901] and {r.lang for r in got if r.doc_id == 902} == {"xx"}
    assert kneser_ney.score(none, marks).count() == 0
    assert kneser_ney.score(df, marks.limit(0)).filter("kept").count() == len(source) - 2


def test_word_order_and_every_script_count(spark):
    """Shuffled words and junk of a non-Latin script have the symbols of good texts."""
    rng = random.Random(21)
    cyrillic = [chr(c) for c in range(0x430, 0x450)]
    chains = {
        "en": [f"{a}{b}" for a in ("tha", "ing", "er", "no") for b in ("s", "nd", "ra", "el", "mo")],
        "ru": ["".join(rng.choice(cyrillic) for _ in range(6)) for _ in range(20)],
    }

    def good(lang):
        at, out = rng.randrange(20), []
        for _ in range(80):
            out.append(chains[lang][at])
            at = (at + rng.choice((1, 2, 3))) % 20
        return out

    source, labels, bad = [], [], []
    for i in range(240):
        lang = ("en", "ru")[i % 2]
        text = good(lang)
        if i >= 200:
            bad.append(i)
            text = rng.sample(text, len(text)) if lang == "en" else ["".join(rng.choice(cyrillic) for _ in range(6)) for _ in range(80)]
        elif i < 150:
            labels.append((i, 1))
        source.append((i, " ".join(text), lang, "s", 0))
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in kneser_ney.score(spark.createDataFrame(source, SCHEMA), marks, quantile=1.0).collect()}
    assert not any(got[i].kept for i in bad)
    assert sum(got[i].kept for i in range(150, 200)) >= 45
    assert kneser_ney.word_model.words("Тест 漢字, it's") == ["тест", "漢", "字", ",", "it", "'", "s"]


def test_outliers_among_labels_do_not_open_the_filter(spark):
    rng = random.Random(41)
    vocab = ["the", "and", "thing", "of", "nation"]

    def text(good):
        return " ".join(rng.choice(vocab) for _ in range(60)) if good else "".join(rng.choice("XQZ%$#|9 ") for _ in range(300))

    # Bad texts milder than the two outliers among the labels.
    source = [(i, text(i >= 2) if i < 500 else text(True)[:150] + " " + text(False)[:150], "en", "s", 0) for i in range(540)]
    marks = spark.createDataFrame([(i, 1) for i in range(400)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in kneser_ney.score(spark.createDataFrame(source, SCHEMA), marks).collect()}
    assert not any(kept[i] for i in range(500, 540))
    assert sum(kept[i] for i in range(400, 500)) >= 92


def test_words_of_many_texts_are_read_like_one_by_one():
    wm = kneser_ney.word_model
    texts = ["Тест 漢字, it's İstanbul_x\u3000a\ud800b ไทย…", "", " \t ", "a\x1cb a", "THE the. Ärger 9_"]
    hashes, lengths = wm.Reader()(texts)
    read = [wm.words(t) for t in texts]
    assert list(lengths) == [len(r) + 1 for r in read]
    flat = [w for r in read for w in [*r, None]]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_runs_of_words_are_sent_packed(spark, monkeypatch):
    """A table with a row per run of words takes several times the room of the texts."""
    wm, rng, made = kneser_ney.word_model, random.Random(8), []
    for name in ("written", "_written_by_block"):
        def count(df, own=getattr(wm, name)):
            made.append(own(df))
            assert made[-1].count() < 5000
            return made[-1]

        monkeypatch.setattr(wm, name, count, raising=False)
    vocab = [f"w{k}" for k in range(300)]
    source = [(i, " ".join(rng.choice(vocab) for _ in range(200)), "en", "s", 0) for i in range(100)]
    marks = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int")
    docs = spark.createDataFrame(source, SCHEMA)
    whole = {r.doc_id: r.word_perplexity for r in kneser_ney.score(docs, marks).collect()}
    assert made and len(whole) == 100
    # In passes and groups, and in several blocks, the result is the same.
    monkeypatch.setattr(wm, "PASS_TOKENS", 3000)
    monkeypatch.setattr(wm, "BLOCK_TOKENS", 2000)
    parts = {r.doc_id: r.word_perplexity for r in kneser_ney.score(docs, marks).collect()}
    assert parts == pytest.approx(whole, rel=1e-9)


def test_words_are_scored_like_by_the_recursion(spark):
    """Perplexities of words by interpolated Kneser-Ney with dictionaries, out of fold; a null language has all texts' model."""
    wm, rng = kneser_ney.word_model, random.Random(12)
    vocab = [f"w{k}" for k in range(25)]
    made = [(i, " ".join(rng.choice(vocab[:rng.randint(2, 25)]) for _ in range(rng.randint(1, 40))), ("en", "de", None)[i % 3], "s", 0) for i in range(90)]
    made += [(i + 100, *made[i][1:]) for i in range(9)]
    marks = spark.createDataFrame([(i, 1) for i in (*range(60), 100, 101, 102)], "doc_id long, quality int")
    docs = spark.createDataFrame(made, SCHEMA)
    fold = {r.doc_id: r.f for r in docs.select("doc_id", wm.fold(F.col("text")).alias("f")).collect()}
    trusted = {*range(60), 100, 101, 102}

    def trained(own, lang):
        threes = Counter()
        for i, text, other, *_ in made:
            if i in trusted and fold[i] != own and lang in (other, None):
                read = ["<", "<", *wm.words(text), ">"]
                threes.update(zip(read, read[1:], read[2:]))
        levels = [threes]
        for _ in range(2):
            levels.insert(0, Counter(run[1:] for run in levels[0]))
        cuts = []
        for c in levels:
            n = [sum(1 for x in c.values() if x == k) for k in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else None
            cuts.append([0.5 * k if y is None else max(0.1 * k, min(0.9 * k, k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5 * k)) for k in (1, 2, 3)])
        followed = [defaultdict(list) for _ in levels]
        for c, out in zip(levels, followed):
            for run, x in c.items():
                out[run[:-1]].append(x)

        def p(run):
            k = len(run) - 1
            below = p(run[1:]) if k else 1 / (len(levels[0]) + 1)
            n = followed[k].get(run[:-1], [])
            if not n:
                return below
            d, c = cuts[k], levels[k][run]
            return ((c - d[min(c, 3) - 1] if c else 0) + sum(d[min(x, 3) - 1] for x in n) * below) / sum(n)

        return p

    models = {(f, lang): trained(f, lang) for f in range(wm.FOLDS) for lang in ("en", "de", None)}
    got = {r.doc_id: r.word_perplexity for r in kneser_ney.score(docs, marks).collect()}
    for i, text, lang, *_ in made:
        read = ["<", "<", *wm.words(text), ">"]
        logs = [np.log(models[fold[i], lang](run)) for run in zip(read, read[1:], read[2:])]
        assert got[i] == pytest.approx(np.exp(-np.mean(logs)), rel=1e-9)


def test_workers_hold_little_however_many_languages_there_are(spark, monkeypatch, tmp_path):
    """Arrays of Python tasks, at the most, with a dozen languages in each task."""
    rng, frame = random.Random(13), type(spark.range(1))
    made = []
    for k in range(12):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(800)]
        made += [(len(made) + i, " ".join(rng.choice(words) for _ in range(150)), f"l{k}", "s", 0) for i in range(10)]
    rng.shuffle(made)
    docs = spark.createDataFrame(made, SCHEMA).coalesce(1)
    marks = spark.createDataFrame([(r[0], 1) for r in made], "doc_id long, quality int")
    folder = str(tmp_path)

    def watched(self, run, *args, own=frame.mapInArrow, **kwargs):
        def traced(batches):
            import os
            import tracemalloc
            import uuid

            tracemalloc.start()
            try:
                yield from run(batches)
            finally:
                with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                    f.write(str(tracemalloc.get_traced_memory()[1]))
                tracemalloc.stop()

        return own(self, traced, *args, **kwargs)

    monkeypatch.setattr(frame, "mapInArrow", watched)
    assert kneser_ney.score(docs, marks).filter("word_perplexity > 0 and perplexity > 0").count() == len(made)
    peaks = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert len(peaks) > 10 and max(peaks) < 250e6


# Pipeline and registered queries

def test_pipeline_stages(spark, docs, rows, none, tmp_path):
    import corpus_pipeline

    letters = random.Random(12)
    words = ["".join(letters.choice("abcdefghijklmnop") for _ in range(9)) + " the and" for _ in range(40)]
    clean = [(1000 + i, " ".join(random.Random(i).sample(words, 30)), "en", "s", 0) for i in range(5)]
    leak = random.Random(99).sample(words, 20)
    source = [*rows, *clean, (2000, clean[0][1], "en", "s", 0), (2001, clean[1][1] + " end", "en", "s", 0),
              (2002, " ".join(random.Random(7).sample(words, 25) + leak), "en", "s", 0),
              (2003, " ".join(random.Random(8).sample(words, 25)) + ' token = "27beb58b8af68854f0e01b4ad40cdbb6ae7f578a"', "en", "s", 0)]
    spark.createDataFrame(source, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(leak))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        table = stage(spark, table, str(tmp_path))
        if name != "packing":
            assert table.columns == docs.columns
        ids.append({r.doc_id for r in table.select("doc_id").collect()})
        table.write.parquet(f"{tmp_path}/{name}")
        table = spark.read.parquet(f"{tmp_path}/{name}")
    quality, near, leaks, secrets, packed = ids
    assert {r[0] for r in clean} | {2003} <= packed and {2000, 2001} <= quality - near and 2002 in near - leaks
    assert secrets == leaks == packed
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tmp_path}/secret_scan").collect()}
    assert "[SECRET]" in texts[2003] and "27beb58b" not in texts[2003]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == packed
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0


@tables
def test_registered_queries_carry_their_columns(spark):
    want = {
        "op1_histogram_shards": "doc_id size text_crc32 law shard slot grown_shard",
        "op7_tiered_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op8_token_counts": "doc_id n_bytes n_tokens over_limit",
        "op9_wrapper_induction": "page_id url text n_chars",
    }
    for name, columns in want.items():
        df = queries.QUERIES[name][0](spark, ROOT)
        assert set(columns.split()) <= set(df.columns) and df.count() >= 50
    crc = queries.QUERIES["op1_histogram_shards"][0](spark, ROOT).filter("doc_id = 14").first()
    text = spark.read.parquet(f"{ROOT}/documents.parquet").filter("doc_id = 14").first().text.encode()
    assert crc.text_crc32 == zlib.crc32(text) and crc["size"] == len(text) + 1


@tables
def test_workers_need_no_copy_of_the_package(tmp_path):
    """Queries whose tasks run Python, from a folder and with a path that do not show workers the package."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).parents[2])!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {str(tmp_path / "scratch")!r}).getOrCreate())
for name in ("op3_kneser_ney_quality", "op4_qgram_decontamination", "op7_tiered_packing", "op8_token_counts", "op9_wrapper_induction"):
    assert e.queries()[name](spark, {ROOT!r}).count() > 0
print("all ran")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.stdout.strip().endswith("all ran"), done.stderr[-3000:]
