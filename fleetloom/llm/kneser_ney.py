"""Quality by two interpolated modified Kneser-Ney models: of words and of symbols.

The words (``word_model.py``) see order and vocabulary in every script; their counts grow
with the trusted texts and meet the documents' runs in exchanges. The symbols see spelling.

For the symbols, texts are read as symbols: small letters, common accented letters, any capital, any digit, blank,
line end and a few groups of punctuation, ``len(SYMBOLS)`` in all. Trusted documents give the
counts of all runs of ``ORDER`` symbols per language; the lower orders count in how many contexts
a run continues. Discounts, totals per context and interpolated probabilities are Spark joins of
count tables, sharded by language and context. A language's model has at most
``len(SYMBOLS) ** ORDER`` entries whatever the corpus holds, so models travel to the documents
(in blocks of languages), and no text is shuffled. A document is kept if both its perplexities are
at most the chosen quantile of its language's trusted documents; without trusted texts in another
fold there is no perplexity of words, and the symbols decide.

Defined results: a null or empty text has no perplexity and is not kept. A null language, or one
without trusted text, uses the model and threshold of all trusted text together. Equal rows are
scored one by one; a repeated id is trusted if any of its labels says so, a null id never. Without
any trusted document nothing can be judged: perplexity and threshold are null and all texts kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.llm import word_model
from fleetloom.llm.common import small_batches, written

ORDER = 4
# A stated loss of about 3 % of good texts over both models, see README; nearer to 1 a few outliers
# among the labels would set the threshold.
QUANTILE = 0.99
# One symbol each; then the groups below, in this order.
LETTERS = "\n abcdefghijklmnopqrstuvwxyzàáâäçèéêíñóöùúüß"
GROUPS = ("capital", "digit", ".", ",", "dash or quote", "other")
SYMBOLS = len(LETTERS) + len(GROUPS)
ALL = "*"
# Entries of the models that travel together, and rows up to which a list of ids is broadcast.
MODEL_ROWS = 8_000_000
BROADCAST_IDS = 1_000_000
# Runs of symbols that a task adds up at a time, and languages whose model it holds as a table of every run.
HELD_RUNS = 1_000_000
LAID = 4


def _table() -> np.ndarray:
    base = len(LETTERS)
    table = np.full(0x250, base + 5, np.int32)
    for code in range(0x250):
        ch = chr(code)
        if ch in LETTERS:
            table[code] = LETTERS.index(ch)
        elif ch.isupper():
            table[code] = base
        elif ch.isdigit():
            table[code] = base + 1
        elif ch in ".,":
            table[code] = base + 2 + ".,".index(ch)
        elif ch in "'\"-()":
            table[code] = base + 4
    return table


_TABLE = _table()


def runs(text: str) -> np.ndarray:
    """The number of the run of ``ORDER`` symbols that ends at each character; line ends stand
    before the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = np.concatenate([np.zeros(ORDER - 1, np.int32), _TABLE[np.minimum(codes, len(_TABLE) - 1)]])
    n = len(codes)
    found = symbols[:n].copy()
    for k in range(1, ORDER):
        found *= SYMBOLS
        found += symbols[k:k + n]
    return found


def counts(docs: DataFrame) -> DataFrame:
    """(lang, run, c) over ``lang`` and ``text``. Each task adds up what it reads before it sends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    held.setdefault(lang, []).append(runs(text))
                    size += len(text)
                    if size >= HELD_RUNS:
                        add(sums, held)
                        size = 0
                        if sum(len(c) for _, c in sums.values()) >= HELD_RUNS:  # send what there is
                            yield from send(sums)
                            sums.clear()
        add(sums, held)
        yield from send(sums)

    def add(sums: dict, held: dict) -> None:
        for lang, parts in held.items():
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            if lang in sums:
                both = np.concatenate([sums[lang][0], found])
                order = np.argsort(both, kind="stable")
                both, n = both[order], np.concatenate([sums[lang][1], n])[order]
                first = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
                found, n = both[first], np.add.reduceat(n, first)
            sums[lang] = found, n
        held.clear()

    def send(sums: dict) -> Iterator[pa.RecordBatch]:
        for lang, (found, n) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int64()), pa.array(n, pa.int64())],
                names=["lang", "run", "c"],
            )

    sent = docs.select("lang", "text").mapInArrow(run, "lang string, run long, c long")
    with small_batches(docs.sparkSession):
        own = written(sent.groupBy("lang", "run").agg(F.sum("c").alias("c")))
    pooled = own.groupBy("run").agg(F.sum("c").alias("c")).select(F.lit(ALL).alias("lang"), "run", "c")
    return written(own.filter(F.col("lang") != ALL).union(pooled))


def _discounts(level: DataFrame) -> DataFrame:
    """The three discounts of a language from its counts of counts."""
    n = [F.sum(F.when(F.col("c") == k, 1).otherwise(0)).cast("double") for k in (1, 2, 3, 4)]
    return discounts(level.groupBy("lang").agg(*[x.alias(f"n{k}") for k, x in enumerate(n, 1)]), "lang")


def discounts(found: DataFrame, model: str) -> DataFrame:
    """``model``, ``d1`` to ``d3`` from the doubles ``n1`` to ``n4``: how many runs have these counts."""
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def discount(k: int) -> Column:
        # Counts of counts that are 0 (tiny or very dense corpora) leave a fixed discount.
        value = F.try_divide((k + 1) * y * F.col(f"n{k + 1}"), F.col(f"n{k}"))
        return F.when(F.col("n1") + F.col("n2") == 0, 0.5 * k).otherwise(
            F.greatest(F.lit(0.1 * k), F.least(F.lit(0.9 * k), F.coalesce(k - value, F.lit(0.5 * k))))
        )

    return found.select(model, *[discount(k).alias(f"d{k}") for k in (1, 2, 3)])


def model(full: DataFrame) -> DataFrame:
    """(lang, level, run, p, weight): the probability of the last symbol of a run after the others,
    and the weight of the lower order in its context (the same for all runs of a context)."""
    level = full
    levels = [full]
    for k in range(ORDER - 1, 0, -1):
        # In how many contexts the last k symbols continue.
        level = written(level.groupBy("lang", F.pmod("run", F.lit(SYMBOLS**k)).alias("run")).agg(F.count(F.lit(1)).alias("c")))
        levels.insert(0, level)
    lower, out = None, None
    for k, level in enumerate(levels, 1):
        cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        context = Window.partitionBy("lang", "context")
        seen = (
            level.withColumn("context", F.floor(F.col("run") / SYMBOLS).cast("long"))
            .join(F.broadcast(_discounts(level)), "lang")
            .withColumns({"cut": cut, "total": F.sum("c").over(context)})
            .withColumns({"weight": F.sum("cut").over(context) / F.col("total"), "own": (F.col("c") - F.col("cut")) / F.col("total")})
        )
        if lower is None:
            p = seen.withColumn("below", F.lit(1.0 / SYMBOLS))
        else:
            p = seen.withColumn("suffix", F.pmod("run", F.lit(SYMBOLS ** (k - 1)))).join(
                lower.select("lang", F.col("run").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"]
            )
        lower = written(p.select(
            "lang", F.lit(k).alias("level"), "run", (F.col("own") + F.col("weight") * F.col("below")).alias("p"), "weight",
        ))
        out = lower if out is None else out.unionByName(lower)
    return out


def _parts(rows: pa.Table) -> dict[str, list[tuple]]:
    """Per language and level: runs, probabilities and weights, of four bytes each."""
    lang = rows.column("lang").combine_chunks().dictionary_encode()
    lang, names = lang.indices.to_numpy(), lang.dictionary.to_pylist()
    level, run, p, weight = (rows.column(c).to_numpy().astype(t) for c, t in (("level", np.int8), ("run", np.int32), ("p", np.float32), ("weight", np.float32)))
    return {
        name: [(run[m], p[m], weight[m]) for k in range(1, ORDER + 1) for m in [(lang == names.index(name)) & (level == k)]]
        for name in sorted(names)
    }


class Model:
    """Models of a block of languages (rows of ``model``, or ``_parts`` of them) as arrays; a language is laid out when it is
    first used."""

    def __init__(self, rows: pa.Table | dict):
        self.parts = rows if isinstance(rows, dict) else _parts(rows)
        self.laid: dict[str, np.ndarray] = {}

    def logs(self, lang: str) -> np.ndarray:
        """log p for every possible run."""
        if lang not in self.laid:
            if len(self.laid) >= LAID:
                self.laid.pop(next(iter(self.laid)))
            below = np.full(SYMBOLS, 1.0 / SYMBOLS, np.float32)
            for k, (run, p, weight) in enumerate(self.parts[lang], 1):
                # An unseen run has the lower order's probability, times its context's weight.
                share = np.ones(SYMBOLS ** (k - 1), np.float32)
                share[run // SYMBOLS] = weight
                first = min(SYMBOLS, len(share))
                below = (share.reshape(first, -1, 1) * below.reshape(1, -1, SYMBOLS)).ravel()
                below[run] = p
            self.laid[lang] = np.log(below, out=below)
        return self.laid[lang]

    def perplexities(self, langs: list[str], texts: list[str | None]) -> list[float | None]:
        """Of each text in its language; None of an empty one. A language after the other."""
        out: list[float | None] = [None] * len(texts)
        for k in sorted((k for k, text in enumerate(texts) if text), key=lambda k: langs[k]):
            out[k] = float(np.exp(-self.logs(langs[k])[runs(texts[k])].mean(dtype=np.float64)))
        return out


def _trusted_ids(labels: DataFrame) -> DataFrame:
    ids = written(labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct())
    # Small lists go to the documents; longer ones meet them in a shuffled join.
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def score(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``doc_id``, ``lang``, ``perplexity``, ``threshold``, ``word_perplexity``, ``word_threshold``
    and ``kept`` per document."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.coalesce("lang", F.lit(ALL)).alias("lang"), "text")
    trusted = _trusted_ids(labels)
    probabilities = written(model(counts(texts.join(trusted, "doc_id", "left_semi"))))
    size = {r["lang"]: r["count"] for r in probabilities.groupBy("lang").count().collect()}
    if not size:
        return docs.select(
            "doc_id", "lang", F.lit(None).cast("double").alias("perplexity"),
            *[F.lit(None).cast("double").alias(c) for c in ("threshold", "word_perplexity", "word_threshold")], (F.coalesce(F.length("text"), F.lit(0)) > 0).alias("kept"),
        )
    used = F.when(F.col("lang").isin(list(size)), F.col("lang")).otherwise(F.lit(ALL))
    texts = texts.withColumn("used", used).withColumn("row", F.xxhash64("used", "text"))
    scored = None
    for block in _blocks(size):
        part = texts.filter(F.col("used").isin(block)) if len(block) < len(size) else texts
        # At most len(SYMBOLS) ** ORDER entries per language, MODEL_ROWS or one language per block.
        # Only arrays are sent: an object of this package cannot be read where the package is not installed.
        # A worker keeps the model built on them next to them, for its next task.
        rows = probabilities.filter(F.col("lang").isin(block)).select(
            "lang", F.col("level").cast("tinyint"), F.col("run").cast("int"), F.col("p").cast("float"), F.col("weight").cast("float"))
        sent = spark.sparkContext.broadcast({"parts": _parts(rows.toArrow())})

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            held = sent.value
            if "model" not in held:
                held["model"] = Model(held["parts"])
            for batch in batches:
                found = held["model"].perplexities(batch.column(2).to_pylist(), batch.column(3).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k) for k in (0, 1, 2, 4)], pa.array(found, pa.float64())],
                    names=["doc_id", "lang", "used", "row", "perplexity"],
                )

        kind = docs.schema["doc_id"].dataType.simpleString()
        found = part.select("doc_id", "lang", "used", "text", "row").mapInArrow(
            run, f"doc_id {kind}, lang string, used string, row long, perplexity double"
        )
        scored = found if scored is None else scored.union(found)
    readable = texts.filter(F.length("text") > 0).join(trusted.withColumn("teaches", F.lit(True)), "doc_id", "left")
    by_words = word_model.perplexities(readable.withColumn("teaches", F.coalesce("teaches", F.lit(False))), [*size], ALL, discounts)
    with small_batches(spark):
        scored = written(scored)
    scored = written(scored.join(by_words, "row", "left"))
    good = scored.join(trusted, "doc_id", "left_semi")
    limit = [F.percentile_approx(c, quantile, 100_000).alias(t) for c, t in (
        ("perplexity", "threshold"), ("word_perplexity", "word_threshold"))]
    own = good.filter(F.col("used") != ALL).groupBy("used").agg(*limit)
    limits = own.union(good.agg(*limit).select(F.lit(ALL), "threshold", "word_threshold"))
    return scored.join(limits, "used", "left").select(
        "doc_id", F.when(F.col("lang") != ALL, F.col("lang")).alias("lang"), "perplexity", "threshold",
        "word_perplexity", "word_threshold",
        (F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False))
         & F.coalesce(F.col("word_perplexity") <= F.col("word_threshold"), F.lit(True))).alias("kept"),
    )


def _blocks(size: dict[str, int]) -> list[list[str]]:
    blocks: list[list[str]] = [[]]
    held = 0
    for lang in sorted(size):
        if blocks[-1] and held + size[lang] > MODEL_ROWS:
            blocks.append([])
            held = 0
        blocks[-1].append(lang)
        held += size[lang]
    return blocks
