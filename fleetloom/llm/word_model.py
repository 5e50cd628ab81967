"""Interpolated modified Kneser-Ney over words, by exchanges of packed counts.

Texts are read as words in lower case, single signs, and single characters of scripts that write
no blanks, followed by an end mark; every script keeps its own words. Trusted texts give the counts
of all runs of three words; they grow with the trusted texts and are never broadcast.

Texts are dealt into ``FOLDS`` by their hash, and each is scored by the model of the trusted texts
outside of its own fold, so a trusted text meets no model that has read it or a copy of it.

How it is spread: texts are read once into blocks of about ``BLOCK_TOKENS``, those of a model together, trusted ones
apart. Blocks of trusted texts teach: they send their distinct runs as sorted arrays by ranges of the key space and get
counts back. A run of three is named by one block, which adds it up for its two pairs; likewise pairs for their
words. After each exchange the block keeps what it got as small numbers next to its words.

The logarithm of a probability is a sum: of the last word's, of the weight of its context, and for each longer run that
training text has, of what this run adds to the lower order. So every word, pair and run of three has one number, and a
text's score is the sum of those that its runs find. In passes by the first word, teaching blocks send the
numbers that they name, all blocks send their distinct runs with the texts in which these stand, and sums per text
come back. Nothing but these sums outlasts a pass, and no task holds more than a block or ``ANSWERED_KEYS`` keys.

Runs are named by 64-bit hashes that hold the model's name too. A text whose model has no trusted
text has no score.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.llm.byte_words import WordHasher, numbered, spans
from fleetloom.llm.common import dropped, small_batches, written
from fleetloom.llm.jaccard import _A, mixed, word_hash
from fleetloom.llm.packed import in_order
from fleetloom.session import shuffle_partitions

FOLDS = 2
BLOCK_TOKENS = 1_000_000
# Blocks' worth of tokens that a task holds, to put those of a model together.
HELD_BLOCKS = 4
# The highest bits of a first word's key say in which pass a run is exchanged.
PASS_BITS = 4
PASSES = 1 << PASS_BITS
# Keys up to which one exchange holds all; more go in 2, 4, ... or ``PASSES`` passes.
PASS_TOKENS = 20_000_000
# Parts of the blocks that meet their answers one after another.
GROUPS = 4
# Keys that a task answers at a time.
ANSWERED_KEYS = 1_000_000
# Scripts without blanks between words (Thai to Khmer, kana, Han).
_SINGLE = "฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_SINGLE}]|[^\W{_SINGLE}]+|[^\w\s]")
_ONE = re.compile(rf"[{_SINGLE}]|[^\w\s]")
_END, _START = np.uint64(word_hash(b"\xff end")), np.uint64(word_hash(b"\xff start"))

_BLOCKS = "block long, n long, rows binary, models binary, lengths binary, tokens binary, words binary, entries binary"
_STATE = "block long, models binary, lengths binary, tokens binary, words binary, entries binary, threes binary, twos binary, ones binary"
_SENT = "block long, bucket long, keys binary, counts binary"
_FOUND = "block long, bucket long, found binary"
_ASKED = "block long, bucket int, keys binary, counts binary, texts binary"
_SUMS = "block long, bucket int, texts binary, sums binary"
# Rows of a model's numbers, among those of blocks.
_MODEL = -1


def fold(text: Column) -> Column:
    return F.pmod(F.xxhash64(text, F.lit("fold")), F.lit(FOLDS)).cast("int")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Reader:
    """The hashes of the ``words`` of many texts at once, each text ended by its end mark."""

    def __init__(self):
        self.hasher = WordHasher(0x110000)
        self.classes = np.full(0x110000, 255, np.uint8)

    def _class(self, codes: np.ndarray) -> np.ndarray:
        """Of each character: 0 between words, 1 in a word, 2 a word of its own."""
        found = self.classes[codes]
        if (found == 255).any():
            for code in np.unique(codes[found == 255]):
                ch = chr(code)
                self.classes[code] = 0 if ch.isspace() and not _ONE.match(ch) else 2 if _ONE.match(ch) else 1
            found = self.classes[codes]
        return found

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes, and their number per text."""
        encoded = [t.lower().encode("utf-32-le", "surrogatepass") for t in texts]
        codes = np.frombuffer(b"".join(encoded), np.uint32)
        offsets = np.concatenate([[0], np.cumsum([len(e) // 4 for e in encoded])])
        kind = self._class(codes)
        # A single sign is a span of its own; letters in a row are one.
        starts, ends = spans(kind == 1, offsets)
        single = np.flatnonzero(kind == 2)
        starts, ends = np.concatenate([starts, single]), np.concatenate([ends, single + 1])
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
        per_text = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
        out = np.full(len(starts) + len(texts), _END, np.uint64)
        out[np.arange(len(starts)) + np.repeat(np.arange(len(texts)), per_text)] = self.hasher(codes, starts, ends)
        return out, per_text + 1


# ---- blocks -----------------------------------------------------------------------------------


def blocks(texts: DataFrame, models: _Models, teaches: bool) -> DataFrame:
    """Blocks of ``row``, ``used`` (a language), ``fold`` and ``text``, numbered apart from those that teach or do not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, next_block = Reader(), 2 * TaskContext.get().partitionId() + teaches << 32
        held, size = [], 0
        for part in (batch.slice(at, 100) for batch in batches for at in range(0, batch.num_rows, 100)):
            rows, used, own, texts = (part.column(k).to_pylist() for k in range(4))
            tokens, lengths = reader(texts)
            ends = np.cumsum(lengths).tolist()
            held += [(f * models.n_langs + models.number[u], r, tokens[a:z]) for u, f, r, a, z in zip(used, own, rows, [0, *ends], ends)]
            size += len(tokens)
            if size >= HELD_BLOCKS * BLOCK_TOKENS:
                for texts in cut(held):
                    yield block(next_block, texts)
                    next_block += 1
                held, size = [], 0
        for texts in cut(held):
            yield block(next_block, texts)
            next_block += 1

    def cut(held: list[tuple]) -> Iterator[list[tuple]]:
        part, size = [], 0
        for text in sorted(held, key=lambda t: t[0]):
            if size >= BLOCK_TOKENS:
                yield part
                part, size = [], 0
            part.append(text)
            size += len(text[2])
        if part:
            yield part

    def block(number: int, texts: list[tuple]) -> pa.RecordBatch:
        own, rows = (np.array([t[k] for t in texts], kind) for k, kind in ((0, np.int32), (1, np.int64)))
        tokens, lengths = np.concatenate([t[2] for t in texts]), np.array([len(t[2]) for t in texts], np.int32)
        used, own_place = np.unique(own, return_inverse=True)
        # Entries are words of a model, in order of first sight: those of a model stand together, frequent ones
        # first. After them come the models' starts, two of which stand before each text.
        numbers, _, first = numbered(mixed(models.bases[np.repeat(own, lengths)] * _A + tokens))
        entries = np.bincount(np.repeat(own_place, lengths)[first], minlength=len(used)).astype(np.int32)
        begins = np.cumsum(lengths) - lengths
        numbers = np.insert(numbers, np.repeat(begins, 2), np.repeat(len(first) + own_place, 2))
        values = [rows, own, lengths, _of_numbers(numbers, len(first) + len(used)), tokens[first], entries]
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([len(tokens)], pa.int64()), *[pa.array([v if isinstance(v, bytes) else v.tobytes()], pa.binary()) for v in values]],
            names=["block", "n", "rows", "models", "lengths", "tokens", "words", "entries"],
        )

    return _written_by_block(texts.select("row", "used", "fold", "text").mapInArrow(run, _BLOCKS))


class _Models:
    """Models, numbered by fold and language, with hashes of their names; ``pooled`` is the language that all trusted
    texts teach, if any."""

    def __init__(self, langs: list[str], pooled: str | None):
        self.n_langs, self.n = len(langs), FOLDS * len(langs)
        self.number = {lang: k for k, lang in enumerate(langs)}
        self.bases = np.array([word_hash(f"{f}/{lang}".encode()) for f in range(FOLDS) for lang in langs], np.uint64)
        self.pooled = langs.index(pooled) if pooled is not None else None
        # What a trusted text teaches: for each other fold its language's model, and the pooled one.
        self.kinds = [(k, own) for own in ((True,) if pooled is None else (True, False)) for k in range(1, FOLDS)]

    def taught(self, models: np.ndarray, kind: int) -> np.ndarray:
        fold, lang = np.divmod(models, self.n_langs)
        k, own = self.kinds[kind]
        return (fold + k) % FOLDS * self.n_langs + (lang if own else self.pooled)

    def unit(self, row: dict) -> _Runs:
        """The runs of a block that teaches, numbered by block and kind."""
        return _Runs(row, self, row["block"] % len(self.kinds))


class _Runs:
    """The runs of a row of ``blocks`` in the texts' own models, or in those that they teach by ``kind``. All texts
    stand one after another, each with two starts before it."""

    def __init__(self, row: dict, models: _Models, kind: int | None = None):
        own = np.frombuffer(row["models"], np.int32)
        lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.ids = _numbers(row["tokens"], int(lengths.sum()) + 2 * len(lengths))
        words, entries = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["entries"], np.int32)
        used = np.unique(own)
        names = used if kind is None else models.taught(used, kind)
        # Per entry (the starts of the models are the last ones) its model and its word's key there.
        self.entry_models = np.concatenate([np.repeat(names, entries), names])
        self.words = mixed(models.bases[self.entry_models] * _A + np.append(words, np.full(len(used), _START)))
        place = np.searchsorted(used, own)
        if kind is not None and not models.kinds[kind][1]:
            # Texts of the pooled language have taught it already.
            on = own % models.n_langs != models.pooled
            self.ids, lengths, place = self.ids[np.repeat(on, lengths + 2)], lengths[on], place[on]
        self.models, self.lengths = names[place], lengths
        self.ends = np.cumsum(lengths + 2)
        self.begins = self.ends - lengths - 2
        self.size = len(self.ids)

    def of_turn(self, turn: int, turns: int) -> np.ndarray:
        """Per entry, whether runs that begin with it are exchanged in this pass."""
        bits = turns.bit_length() - 1
        return self.words >> np.uint64(64 - bits) == turn if bits else np.ones(len(self.words), bool)

    def at(self, turn: int = 0, turns: int = 1, lengths: tuple[int, ...] = (1, 2, 3)) -> list[np.ndarray]:
        """For each of some lengths, where runs of so many words begin: all but those that reach into the next text; a word
        stands once, and one start before each text."""
        inside, out = self.of_turn(turn, turns)[self.ids] if turns > 1 else np.ones(self.size, bool), []
        for n in lengths:
            own = inside.copy()
            if n == 1:
                own[self.begins] = False
            for k in range(1, n):
                own[self.ends - k] = False
            out.append(np.flatnonzero(own))
        return out

    def key(self, at: np.ndarray, n: int) -> np.ndarray:
        key = self.words[self.ids[at]]
        for k in range(1, n):
            key = mixed(key * _A + self.words[self.ids[at + k]])
        return key

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, "right")

    def model_of(self, at: np.ndarray) -> np.ndarray:
        return self.models[self.text_of(at)]


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def _written_by_block(df: DataFrame) -> DataFrame:
    with small_batches(df.sparkSession):
        return written(df)


def _rows(rows: list[tuple], names: tuple[str, ...], bucket=pa.int64()) -> pa.RecordBatch:
    kinds = {"block": pa.int64(), "bucket": bucket}
    return pa.RecordBatch.from_arrays([pa.array(x, kinds.get(n, pa.binary())) for n, x in zip(names, zip(*rows))], names=[*names])


def _planes(values: np.ndarray) -> bytes:
    """Byte by byte, so that small numbers take little room when compressed."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _of_planes(planes: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _small(data: bytes) -> bytes:
    """Compressed here, as what the JVM copies again and again should be small."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _whole(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(memoryview(data)[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _of_numbers(numbers: np.ndarray, limit: int) -> bytes:
    """Numbers below ``limit``, without the bytes that none of them needs."""
    width = max(1, -(-(limit - 1).bit_length() // 8))
    return _small(_planes(numbers.astype(np.int32))[:width * len(numbers)])


def _numbers(data: bytes, size: int) -> np.ndarray:
    planes, out = np.frombuffer(_whole(data), np.uint8).reshape(-1, size), np.zeros((size, 4), np.uint8)
    for k, plane in enumerate(planes):
        out[:, k] = plane
    return out.view(np.int32).ravel()


def _ints(columns: np.ndarray) -> bytes:
    """Columns one after another, of four bytes where that is enough."""
    wide = columns.size > 0 and int(columns.max()) >= 1 << 31
    return bytes([wide]) + _small(_planes(columns.astype(np.int64 if wide else np.int32, copy=False)))


def _of_ints(data: bytes, width: int) -> np.ndarray:
    return _of_planes(_whole(data[1:]), np.int64 if data[0] else np.int32).reshape(width, -1)


def _all_ints(parts: list[bytes], width: int) -> np.ndarray:
    return np.concatenate([np.empty((width, 0), np.int32), *[_of_ints(p, width) for p in parts]], axis=1)


def _marked(on: np.ndarray, columns: np.ndarray) -> bytes:
    """Which of some places are marked, and a column of numbers for each of these."""
    return np.packbits(on).tobytes() + _ints(columns)


def _of_marked(data: bytes, places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The marked ones of ``places``, and their columns."""
    n = (len(places) + 7) // 8
    on = np.unpackbits(np.frombuffer(data[:n], np.uint8), count=len(places)).astype(bool)
    return places[on], _of_ints(data[n:], width)


def _joined(parts: list[bytes]) -> bytes:
    return np.array([len(parts), *[len(p) for p in parts]], np.int64).tobytes() + b"".join(parts)


def _part(data: bytes, k: int) -> bytes:
    n = int(np.frombuffer(data[:8], np.int64)[0])
    edges = 8 + 8 * n + np.append(0, np.cumsum(np.frombuffer(data[8:8 + 8 * n], np.int64)))
    return data[int(edges[k]):int(edges[k + 1])]


def _tasks(spark: SparkSession, n_keys: int) -> int:
    return max(2 * spark.sparkContext.defaultParallelism, -(-n_keys // ANSWERED_KEYS))


def _turns(n_keys: int) -> int:
    return 1 << min(PASS_BITS, max(0, -(-n_keys // PASS_TOKENS) - 1).bit_length())


def _ranges(keys: np.ndarray, tasks: int) -> Iterator[tuple[int, int, int]]:
    """(task, from, to) of the ranges of sorted ``keys`` that hold any."""
    edges = np.searchsorted(keys, np.array([(k << 64) // tasks for k in range(tasks)], np.uint64))
    for k, (at, to) in enumerate(zip(edges, np.append(edges[1:], len(keys)))):
        if to > at:
            yield k, int(at), int(to)


def _sent(number: int, turn: int, keys: np.ndarray, body: np.ndarray, tasks: int) -> Iterator[pa.RecordBatch]:
    """Sorted keys by ranges, with the columns of ``body``."""
    cut = [(number, turn << 32 | b, _planes(keys[a:z]), _ints(body[:, a:z])) for b, a, z in _ranges(keys, tasks)]
    if cut:
        yield _rows(cut, ("block", "bucket", "keys", "counts"))


class _Distinct:
    """Distinct ``keys`` in order, where each stands first, how often, and (``number``) each key's place among them."""

    def __init__(self, keys: np.ndarray):
        order, ordered = in_order(keys)
        new = np.ones(len(keys), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        first = np.flatnonzero(new)
        self.order, self.new = order, new
        self.keys, self.first = ordered[first], order[first]
        self.n = np.diff(np.append(first, len(keys)))

    def number(self) -> np.ndarray:
        out = np.empty(len(self.order), np.int32)
        out[self.order] = np.cumsum(self.new) - 1
        return out


def _levels(level: int, models: np.ndarray, counts: np.ndarray, n_models: int) -> Iterator[tuple]:
    """For each model: how many runs have the counts 1 to 4, their sum and their number."""
    for model in np.unique(models):
        c = counts[models == model]
        found = [*np.bincount(np.minimum(c, 5), minlength=6)[1:5], c.sum(), len(c)]
        yield level * n_models + int(model), np.array(found, np.int64).tobytes()


def _context_sums(at: np.ndarray, n: np.ndarray, size: int) -> list[np.ndarray]:
    """Per context: the sum of the counts ``n``, and how many of them are 1, 2 and more."""
    return [np.bincount(at, n, size).astype(np.int64), *[np.bincount(at[k], minlength=size) for k in (n == 1, n == 2, n > 2)]]


# ---- counts -----------------------------------------------------------------------------------


def exchanged(sent: DataFrame, width: int, tasks: int) -> DataFrame:
    """Answers to the rows ``sent``, key by key: the sums of their columns, the first one times two, one more where the
    row names the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, keys, body = [], [], []
        for row in _each(batches):
            rows.append((row["block"], row["bucket"]))
            keys.append(_of_planes(row["keys"], np.uint64))
            body.append(_of_ints(row["counts"], width))
        if not rows:
            return
        # In this order whatever came first, so that a task that is run again names the same.
        order = sorted(range(len(rows)), key=rows.__getitem__)
        rows, keys = [rows[k] for k in order], [keys[k] for k in order]
        body = np.concatenate([body[k] for k in order], axis=1)
        found = _Distinct(np.concatenate(keys))
        number = found.number()
        out = np.stack([np.bincount(number, x, len(found.keys)).astype(np.int64)[number] for x in body])
        owner = np.full(len(found.keys), -1)
        owner[number[::-1]] = np.arange(len(number) - 1, -1, -1)
        out[0] *= 2
        out[0, owner] += 1
        ends = np.cumsum([len(k) for k in keys]).tolist()
        for part in range(0, len(rows), 1000):
            here = slice(part, part + 1000)
            yield _rows([(*row, _ints(out[:, a:z])) for row, a, z in zip(rows[here], [0, *ends][here], ends[here])], ("block", "bucket", "found"))

    return _written_by_block(sent.repartitionById(tasks, F.col("bucket").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")).mapInArrow(run, _FOUND))


def _met(states: list[DataFrame], found: DataFrame, run, kinds: str) -> list[DataFrame]:
    """Tables of ``run`` over pairs of a row of ``states`` and its list of ``found``, in order of the ranges. They meet in a
    sorted stream, so that no task holds more than one of them. The tables of ``states`` (groups of ``_group``, or one) are
    taken one after another, and removed."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[bytes]]]:
        state, parts = None, []
        for row in _each(batches):
            if row["found"] is not None:
                parts.append(row["found"])
                continue
            if state is not None:
                yield state, parts
            state, parts = row, []
        if state is not None:
            yield state, parts

    out = []
    for k, part in enumerate(states):
        got = found.select("block", F.col("bucket").cast("long").alias("bucket"), "found")
        both = part.withColumns({"bucket": F.lit(-1).cast("long"), "found": F.lit(None).cast("binary")}).unionByName(
            got.filter(_group(len(states)) == k) if len(states) > 1 else got, allowMissingColumns=True)
        dealt = both.repartition(shuffle_partitions(part.sparkSession), "block").sortWithinPartitions("block", "bucket")
        out.append(_written_by_block(dealt.mapInArrow(lambda batches: run(pairs(batches)), kinds)))
        dropped(part)
    return out


def _group(groups: int) -> Column:
    return F.pmod(F.xxhash64("block"), F.lit(groups))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    return out


_COLUMNS = tuple(c.split()[0] for c in _STATE.split(", "))


def _state(row: dict, **changed: bytes) -> pa.RecordBatch:
    return _rows([tuple({**row, **changed}.get(c) for c in _COLUMNS)], _COLUMNS)


def _counted(taught: DataFrame, models: _Models, n_keys: int, n_words: int, score_turns: int) -> list[DataFrame]:
    """Tables with a row (``_STATE``) per block of trusted texts and kind of what it teaches. ``threes`` and ``twos`` mark, for
    each pass of the scores, where the runs that it names stand first; for those of three their counts, the counts of their
    contexts' last words (once, twice, more) and of their suffixes, for pairs their counts, and the sum and the counts of
    what follows. ``ones`` has the same of each word as of a pair, the first one times two, one more where the block names it."""
    spark = taught.sparkSession
    n_kinds = len(models.kinds)
    units = taught.drop("rows", "n").withColumn("kind", F.explode(F.array(*[F.lit(k) for k in range(n_kinds)])))
    units = units.withColumn("block", F.col("block") * n_kinds + F.col("kind")).drop("kind")
    turns = _turns(n_keys)
    groups = min(GROUPS, turns)
    tasks, word_tasks = _tasks(spark, n_keys // turns), _tasks(spark, n_words)

    def send_threes(turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _each(batches):
                block = models.unit(row)
                found = _Distinct(block.key(*block.at(turn, turns, (3,)), 3))
                yield from _sent(row["block"], turn, found.keys, found.n[None], tasks)

        return run

    def take_threes(pairs: Iterator[tuple[dict, list[bytes]]]) -> Iterator[pa.RecordBatch]:
        for row, parts in pairs:
            block, answer = models.unit(row), _all_ints(parts, 1)[0]
            n, done = np.zeros(block.size, answer.dtype), 0
            for turn in range(turns):
                at, = block.at(turn, turns, (3,))
                found = _Distinct(block.key(at, 3))
                own = answer[done:done + len(found.keys)]
                done += len(own)
                n[at[found.first]] = np.where(own & 1, own >> 1, 0)
            yield _state(row, threes=_marked(n > 0, n[None, n > 0]))

    def pairs_of_turn(block: _Runs, threes: np.ndarray, n: np.ndarray, turn: int) -> tuple:
        """The pass's distinct pairs that stand in a run that the block names: where they stand first, keys, sums; and of all
        positions the number among them, or -1."""
        at, = block.at(turn, turns, (2,))
        found = _Distinct(block.key(at, 2))
        number, size = np.full(block.size, -1, np.int32), len(found.keys)
        number[at] = found.number()
        context, suffix = number[threes], number[threes + 1]
        sums = np.stack([np.bincount(suffix[suffix >= 0], minlength=size), *_context_sums(context[context >= 0], n[context >= 0], size)])
        on = sums.any(axis=0)
        number[at] = np.where(on, np.cumsum(on) - 1, -1).astype(np.int32)[number[at]]
        return at[found.first[on]], found.keys[on], sums[:, on], number

    def send_twos(turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _each(batches):
                block = models.unit(row)
                threes, n = _of_marked(row["threes"], np.arange(block.size), 1)
                _, keys, sums, _ = pairs_of_turn(block, threes, n[0], turn)
                yield from _sent(row["block"], turn, keys, sums, tasks)

        return run

    def take_twos(pairs: Iterator[tuple[dict, list[bytes]]]) -> Iterator[pa.RecordBatch]:
        for row, parts in pairs:
            block, answer = models.unit(row), _all_ints(parts, 5)
            threes, n = _of_marked(row["threes"], np.arange(block.size), 1)
            columns, own, done = np.zeros((5, len(threes)), answer.dtype), [], 0
            columns[0] = n[0]
            for turn in range(turns):
                first, keys, _, number = pairs_of_turn(block, threes, n[0], turn)
                got = answer[:, done:done + len(keys)]
                done += len(keys)
                place = number[threes]
                columns[1:4, place >= 0] = got[2:, place[place >= 0]]
                place = number[threes + 1]
                columns[4, place >= 0] = got[0, place[place >= 0]] >> 1
                mine = got[0] & 1 == 1
                own.append((first[mine], got[:, mine]))
            twos, pair_columns = (np.concatenate(x, axis=-1) for x in zip(*own))
            pair_columns[0] >>= 1
            yield _state(row, threes=by_turn(block, 3, threes, columns), twos=by_turn(block, 2, twos, pair_columns))

    def by_turn(block: _Runs, n: int, places: np.ndarray, columns: np.ndarray) -> bytes:
        number, parts = np.full(block.size, -1, np.int32), []
        number[places] = np.arange(len(places))
        for turn in range(score_turns):
            at, = block.at(turn, score_turns, (n,))
            own = number[at]
            parts.append(_marked(own >= 0, columns[:, own[own >= 0]]))
        return _joined(parts)

    def send_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            block = models.unit(row)
            found = _Distinct(block.words)
            number, size = found.number(), len(found.keys)
            sums = np.zeros((5, size), np.int64)
            for at, columns in (named(block, row, 2, turn, score_turns) for turn in range(score_turns)):
                at, n = at[columns[0] > 0], columns[0, columns[0] > 0]
                sums += [np.bincount(number[block.ids[at + 1]], minlength=size), *_context_sums(number[block.ids[at]], n, size)]
            yield from _sent(row["block"], 0, found.keys, sums, word_tasks)

    def take_ones(pairs: Iterator[tuple[dict, list[bytes]]]) -> Iterator[pa.RecordBatch]:
        for row, parts in pairs:
            found, answer = _Distinct(models.unit(row).words), _all_ints(parts, 5)
            columns = answer[:, found.number()]
            columns[0] = columns[0] >> 1 << 1
            columns[0, found.first] += answer[0] & 1
            yield _state(row, ones=_ints(columns))

    answers = [exchanged(units.mapInArrow(send_threes(k), _SENT), 1, tasks) for k in range(turns)]
    grouped = [_written_by_block(units.filter(_group(groups) == k)) for k in range(groups)]
    dropped(taught)
    states = _met(grouped, _union(answers), take_threes, _STATE)
    dropped(*answers)
    answers = [exchanged(_union(states).mapInArrow(send_twos(k), _SENT), 5, tasks) for k in range(turns)]
    states = _met([t.drop("twos", "ones") for t in states], _union(answers), take_twos, _STATE)
    dropped(*answers)
    answers = [exchanged(_union(states).mapInArrow(send_ones, _SENT), 5, word_tasks)]
    states = _met([t.drop("ones") for t in states], _union(answers), take_ones, _STATE)
    dropped(*answers)
    return states


def named(block: _Runs, row: dict, n: int, turn: int, turns: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a pass of the scores, where the runs of ``n`` words that a block names stand first, and their columns (``_counted``)."""
    return _of_marked(_part(row["threes" if n == 3 else "twos"], turn), *block.at(turn, turns, (n,)), 5)


def _level_sums(states: DataFrame, models: _Models, turns: int) -> DataFrame:
    """Counts of counts of the runs that each block names, by level and model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            block, ones, out = models.unit(row), _of_ints(row["ones"], 5)[0], []
            for n, turn in ((n, turn) for n in (3, 2) for turn in range(turns)):
                at, columns = named(block, row, n, turn, turns)
                on = columns[0] > 0
                out += _levels(n, block.model_of(at[on]), columns[0, on], models.n)
            own = (ones & 1 == 1) & (ones > 1)
            out += _levels(1, block.entry_models[own], ones[own] >> 1, models.n)
            if out:
                yield _rows(out, ("bucket", "counts"))

    return states.mapInArrow(run, "bucket long, counts binary")


# ---- scores -----------------------------------------------------------------------------------


class _Numbers:
    """What a word, a pair and a run of three add to the logarithm of a probability. ``cuts`` has the discounts by level,
    count (1, 2, more) and model, ``total`` and ``unseen`` are by model."""

    def __init__(self, cuts: np.ndarray, total: np.ndarray, unseen: np.ndarray):
        self.cuts, self.total, self.unseen = cuts, total, unseen

    def kept(self, level: int, model: np.ndarray, n: np.ndarray) -> np.ndarray:
        """A count less its discount, 0 for 0."""
        return np.where(n > 0, n - self.cuts[level][np.minimum(np.maximum(n, 1), 3) - 1, model], 0.0)

    def left(self, level: int, model: np.ndarray, context: np.ndarray) -> np.ndarray:
        """What the runs of a context (seen once, twice, more) leave to the lower order."""
        return (context * self.cuts[level][:, model]).sum(axis=0)

    def sent(self, block: _Runs, row: dict, turn: int, turns: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys, and the numbers, of what the block names in a pass."""
        ones = _of_ints(row["ones"], 5)
        of_turn = block.of_turn(turn, turns)
        n_one, mine = ones[0] >> 1, ones[0] & 1 == 1
        p_one = self.kept(1, block.entry_models, n_one) / np.maximum(self.total[block.entry_models], 1) + self.unseen[block.entry_models]
        left = self.left(2, block.entry_models, ones[2:])
        with np.errstate(divide="ignore", invalid="ignore"):
            # Words: their probability against that of an unknown one, and their weight as a context.
            on = mine & of_turn & ((n_one > 0) | (ones[1] > 0))
            value = np.log(p_one[on] / self.unseen[block.entry_models[on]]) + np.where(ones[1, on] > 0, np.log(left[on] / ones[1, on]), 0.0)
            keys, values = [block.words[on]], [value]
            # Pairs: what they add to their words, and their weight as a context.
            at, n = named(block, row, 2, turn, turns)
            model, a, b = block.model_of(at), block.ids[at], block.ids[at + 1]
            value = np.where(n[0] > 0, np.log1p(self.kept(2, model, n[0]) / (left[a] * p_one[b])), 0.0)
            value += np.where(n[1] > 0, np.log(self.left(3, model, n[2:]) / n[1]), 0.0)
            keys.append(block.key(at, 2))
            values.append(value)
            at, n = named(block, row, 3, turn, turns)
            model, b, c = block.model_of(at), block.ids[at + 1], block.ids[at + 2]
            p_two = (self.kept(2, model, n[4]) + left[b] * p_one[c]) / ones[1, b]
            keys.append(block.key(at, 3))
            values.append(np.log1p(self.kept(3, model, n[0]) / (self.left(3, model, n[1:4]) * p_two)))
        return np.concatenate(keys), np.concatenate(values)


def _summed_up(asks: list[tuple], model: np.ndarray, values: np.ndarray) -> Iterator[tuple]:
    """For rows (block, bucket, keys, counts, texts): texts, and the sums of the values that their runs find."""
    keys, counts, texts = (np.concatenate([a[k] for a in asks]) for k in (2, 3, 4))
    place = np.minimum(np.searchsorted(model, keys), len(model) - 1)
    value = np.repeat(np.where(model[place] == keys, values[place], 0.0), counts)
    sizes = np.array([int(a[4].max()) + 1 for a in asks])
    offsets = np.cumsum(sizes) - sizes
    sums = np.bincount(texts + np.repeat(offsets, [len(a[4]) for a in asks]), value, int(sizes.sum()))
    found = np.flatnonzero(sums)
    edges = np.searchsorted(found, np.append(offsets, sizes.sum()))
    for (block, bucket, *_), offset, a, z in zip(asks, offsets, edges[:-1], edges[1:]):
        if z > a:
            yield block, bucket, _planes((found[a:z] - offset).astype(np.int32)), sums[found[a:z]].tobytes()


def _scored(blocked: DataFrame, states: DataFrame, models: _Models, numbers: _Numbers, n_keys: int, meta: DataFrame) -> DataFrame:
    """(row, word_perplexity) of every text of the blocks whose model has trusted text."""
    spark = blocked.sparkSession
    turns = _turns(n_keys)
    tasks = _tasks(spark, n_keys // turns)
    sent = spark.sparkContext.broadcast({"cuts": numbers.cuts, "total": numbers.total, "unseen": numbers.unseen})

    def teach(turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers = _Numbers(**sent.value)
            for row in _each(batches):
                keys, values = numbers.sent(models.unit(row), row, turn, turns)
                order, keys = in_order(keys)
                values = values[order]
                cut = [(_MODEL, b, _planes(keys[a:z]), _planes(values[a:z]), b"") for b, a, z in _ranges(keys, tasks)]
                if cut:
                    yield _rows(cut, ("block", "bucket", "keys", "counts", "texts"), pa.int32())

        return run

    def ask(turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _each(batches):
                block = _Runs(row, models)
                at = block.at(turn, turns)
                text = [block.text_of(x).astype(np.uint16 if len(block.lengths) <= 1 << 16 else np.uint32) for x in at]
                found = _Distinct(np.concatenate([block.key(x, n) for n, x in enumerate(at, 1)]))
                text = np.concatenate(text)[found.order]
                counts = found.n.astype(np.uint8 if found.n.max(initial=0) < 256 else np.uint32)
                edges = np.append(0, np.cumsum(found.n))
                cut = [(row["block"], b, _planes(found.keys[a:z]), _planes(counts[a:z]), _planes(text[edges[a]:edges[z]]))
                       for b, a, z in _ranges(found.keys, tasks)]
                if cut:
                    yield _rows(cut, ("block", "bucket", "keys", "counts", "texts"), pa.int32())

        return run

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, asks = [], [], []
        for row in _each(batches):
            if row["block"] == _MODEL:
                keys.append(_of_planes(row["keys"], np.uint64))
                values.append(_of_planes(row["counts"], np.float64))
            else:
                asks.append(row)
        if not keys:
            return
        order, model = in_order(np.concatenate(keys))
        values = np.concatenate(values)[order]
        part, size = [], 0
        for k, row in enumerate(asks):
            asked = _of_planes(row["keys"], np.uint64)
            counts = _of_planes(row["counts"], f"u{len(row['counts']) // len(asked)}")
            kind = f"u{len(row['texts']) // int(counts.sum())}"
            part.append((row["block"], row["bucket"], asked, counts, _of_planes(row["texts"], kind).astype(np.int64)))
            size += len(counts)
            asks[k] = None
            if size >= 50_000 or k + 1 == len(asks):
                out = list(_summed_up(part, model, values))
                part, size = [], 0
                if out:
                    yield _rows(out, ("block", "bucket", "texts", "sums"), pa.int32())

    def add(turn: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = defaultdict(list)
            for row in _each(batches):
                parts[row["block"]].append((row["bucket"], row["texts"], row["sums"]))
            for block, rows in parts.items():
                # In order of the ranges, so that a sum is the same in every run.
                rows.sort()
                texts = np.concatenate([_of_planes(r[1], np.int32) for r in rows])
                sums = np.bincount(texts, np.concatenate([np.frombuffer(r[2], np.float64) for r in rows]))
                yield _rows([(block, turn, sums.tobytes())], ("block", "bucket", "found"))

        return run

    def close(pairs: Iterator[tuple[dict, list[bytes]]]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(**sent.value)
        for row, parts in pairs:
            rows, model = np.frombuffer(row["rows"], np.int64), np.frombuffer(row["models"], np.int32)
            lengths, sums = np.frombuffer(row["lengths"], np.int32), np.zeros(len(rows))
            for part in parts:
                part = np.frombuffer(part, np.float64)
                sums[:len(part)] += part
            known = np.flatnonzero(numbers.total[model] > 0)
            mean = sums[known] / lengths[known] + np.log(numbers.unseen[model[known]])
            yield pa.RecordBatch.from_arrays([pa.array(rows[known]), pa.array(np.exp(-mean))], names=["row", "word_perplexity"])

    sums = []
    for k in range(turns):
        rows = blocked.mapInArrow(ask(k), _ASKED).union(states.mapInArrow(teach(k), _ASKED))
        partial = rows.repartitionById(tasks, "bucket").mapInArrow(answer, _SUMS)
        sums.append(_written_by_block(partial.repartition(shuffle_partitions(spark), "block").mapInArrow(add(k), _FOUND)))
    scored, = _met([meta], _union(sums), close, "row long, word_perplexity double")
    dropped(*sums)
    sent.unpersist()
    return scored


def perplexities(texts: DataFrame, langs: list[str], pooled: str, discounts) -> DataFrame:
    """(row, word_perplexity) over ``row``, ``used`` (one of ``langs``), ``teaches`` and ``text``; the texts that
    teach make up the language ``pooled`` too. Texts are not null."""
    # The model of all languages is counted if a text asks for it.
    asked = not texts.filter(F.col("used") == pooled).isEmpty()
    models = _Models(sorted({*langs, pooled}), pooled if asked else None)
    texts = texts.withColumn("fold", fold("text"))
    # Blocks that teach are kept with what they get back, the others ask only.
    rest, taught = (blocks(texts.filter(F.col("teaches") == teaches), models, teaches) for teaches in (False, True))
    (n_rest, _), (n_taught, n_words) = (
        t.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.length("words") / 8).cast("long"), F.lit(0))).first() for t in (rest, taught))
    # Distinct runs of three, pairs and words come to less than twice the tokens.
    n_keys = 2 * (n_rest + n_taught)
    meta = written(rest.union(taught).select("block", "rows", "models", "lengths"))
    states = _counted(taught, models, len(models.kinds) * n_taught, len(models.kinds) * n_words, _turns(n_keys))
    numbers = _Numbers(*_by_model(_written_by_block(_level_sums(_union(states), models, _turns(n_keys))), models.n, discounts))
    n_kinds = len(models.kinds)
    asking = ["block", "models", "lengths", "tokens", "words", "entries"]
    own = _union(states).filter(F.col("block") % n_kinds == 0).withColumn("block", F.expr(f"block div {n_kinds}"))
    scored = _scored(rest.select(asking).union(own.select(asking)), _union(states), models, numbers, n_keys, meta)
    dropped(rest, *states)
    # Copies of a text have the same row.
    return written(scored.groupBy("row").agg(F.min("word_perplexity").alias("word_perplexity")))


def _by_model(levels: DataFrame, n_models: int, discounts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By level and count (1, 2, more) the discounts of each model; each model's pairs of words, and the probability
    of a word that it does not know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = np.array([np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x) for x in body.T.astype(np.float64)]], names=["bucket", *names])

    names = ["n1", "n2", "n3", "n4", "total", "size"]
    kinds = ", ".join(["bucket long", *[f"{c} double" for c in names]])
    found = written(levels.mapInArrow(run, kinds).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names]))
    cuts, total, unseen = np.zeros((4, 3, n_models)), np.zeros(n_models), np.zeros(n_models)
    # One row per model and level.
    for r in found.join(discounts(found, "bucket"), "bucket").collect():
        level, model = divmod(r["bucket"], n_models)
        d = np.array([r["d1"], r["d2"], r["d3"]])
        cuts[level, :, model] = d
        if level == 1:
            total[model] = r["total"]
            unseen[model] = d @ [r["n1"], r["n2"], r["size"] - r["n1"] - r["n2"]] / r["total"] / (r["size"] + 1)
    return cuts, total, unseen
