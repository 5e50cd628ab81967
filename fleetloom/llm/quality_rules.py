"""Quality rules: a threshold table compiled into one projection.

Each rule names a measure, the bounds between which a document passes, the number of words
from which the rule is applied, and the languages for which it holds. Measures and verdict are
built-in Column expressions only; a document is read once and nothing is shuffled.

Defined results: a null, empty or blank text has no words, all counts 0, and fails the base
rule. Rules of certain languages are not applied to a document whose language is null or another
one; ``en-US`` and ``en_US`` count as ``en``. Repeated rows are judged one by one. Columns of the input stay; a
column that has the name of a result is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.llm.common import WORD_CHAR, let, spare, words

WINDOW = 8

# Frequent function words of English, German, French and Spanish. They count in lower
# case or capitalised, so that a text set in capitals has none.
STOP_WORD_LANGUAGES = ("en", "de", "fr", "es")
STOP_WORDS = (
    "the of and to in is that it was for on with as are be this by from at or an "
    "der die das und den von mit ist des im dem nicht ein eine als auch sich auf für "
    "le la les et de du un une est que qui dans pour par sur pas au avec "
    "el los las y en del se por con no una su para es lo como más"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes while ``low <= measure <= high``, has fewer than ``from_words`` words, or is in
    none of ``languages`` (None: the rule holds for all)."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0
    languages: tuple[str, ...] | None = None


# Ratios per word, line or character; documents labelled as good keep clear of all bounds.
RULES = (
    Rule("length", "n_words", low=20),
    # Of languages written with blanks between words, those with a list of stop words.
    Rule("word_length", "chars_per_word", low=2.0, high=14.0, languages=STOP_WORD_LANGUAGES),
    Rule("symbols", "symbols_per_word", high=0.25),
    Rule("stop_words", "stop_word_ratio", low=0.04, from_words=50, languages=STOP_WORD_LANGUAGES),
    Rule("duplicate_lines", "dup_line_ratio", high=0.6),
    Rule("repeats", "repeat_ratio", high=0.3),
)


def _windows(tokens: Column, size: int = WINDOW) -> Column:
    """One hash for each run of ``size`` consecutive words."""
    runs = let(
        F.transform(tokens, lambda w: F.xxhash64(w)),
        lambda h: F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, size)])),
    )
    return F.slice(runs, F.lit(1), F.greatest(F.size(tokens) - (size - 1), F.lit(0)))


def _repeated_words(windows: Column, size: int = WINDOW) -> Column:
    """Words inside windows that occur at least twice in the same array."""

    def positions(ranked: Column) -> Column:
        """Starts of windows whose neighbour in sorted order is the same window."""

        def repeated(s: Column, k: Column) -> Column:
            here = s["h"]
            return F.when((F.get(ranked, k - 1)["h"] == here) | (F.get(ranked, k + 1)["h"] == here), s["i"])

        return F.sort_array(F.filter(F.transform(ranked, repeated), lambda i: i.isNotNull()))

    def covered(starts: Column) -> Column:
        gaps = F.zip_with(
            F.slice(starts, F.lit(2), F.size(starts) - 1), F.slice(starts, F.lit(1), F.size(starts) - 1),
            lambda b, a: F.least(b - a, F.lit(size)),
        )
        return F.aggregate(gaps, F.lit(size).cast("long"), lambda s, g: s + g)

    ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), let(let(ranked, positions), covered)
    ).otherwise(F.lit(0).cast("long"))


def _measures(text: Column, tokens: Column, windows: Column, mark: str) -> dict[str, Column]:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(WORD_CHAR))
    symbols = F.char_length(text) - F.char_length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    return {
        f"{mark}n_words": F.size(tokens).cast("long"),
        f"{mark}word_chars": F.char_length(F.array_join(tokens, "")).cast("long"),
        f"{mark}n_symbols": F.coalesce(symbols, F.lit(0)).cast("long"),
        f"{mark}lines": let(lines, lambda x: F.struct(
            F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
        )),
        f"{mark}n_repeat_words": _repeated_words(windows),
        f"{mark}stop": F.size(F.filter(tokens, lambda w: w.isin(*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)))),
    }


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def passes(rules: Sequence[Rule], measures: dict[str, Column]) -> Column:
    """The threshold table as one boolean expression over the measures, ``n_words`` and ``lang`` among them."""
    verdict = F.lit(True)
    for r in rules:
        value, ok = measures[r.measure], F.lit(True)
        if r.low is not None:
            ok = ok & (value >= r.low)
        if r.high is not None:
            ok = ok & (value <= r.high)
        if r.from_words:
            ok = ok | (measures["n_words"] < r.from_words)
        if r.languages is not None:
            ok = ok | ~F.coalesce(measures["lang"].isin(*r.languages), F.lit(False))
        verdict = verdict & ok
    return verdict


def judge(
    df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", lang: str | None = "lang",
) -> DataFrame:
    """Add counts, ``base_failed`` (fewer than 20 words, or more than 30 % of the words in
    repeated windows), ``failed_rules`` (names, in table order) and ``kept``. Without a column of
    languages (``lang`` None) only the rules for all languages are applied."""
    mark, source = spare(df), F.col(f"`{text}`")
    tokens, windows, lines = (F.col(f"{mark}{c}") for c in ("words", "windows", "lines"))
    counts = ("n_words", "word_chars", "n_symbols", "n_repeat_words")
    n, chars, symbols, repeated = (F.col(f"{mark}{c}") for c in counts)
    language = F.split_part(F.lower(F.replace(F.col(f"`{lang}`"), F.lit("_"), F.lit("-"))), F.lit("-"), F.lit(1)) if lang else None
    measures = {
        "lang": language if lang else F.lit(None).cast("string"),
        "n_words": n,
        "chars_per_word": _ratio(chars, n),
        "symbols_per_word": _ratio(symbols, n),
        "stop_word_ratio": _ratio(F.col(f"{mark}stop"), n),
        "dup_line_ratio": _ratio(lines["dup"], lines["n"]),
        "repeat_ratio": _ratio(repeated, n),
    }
    base_failed = (n < 20) | (100 * repeated > 30 * n)
    failed = F.filter(
        F.array(*[F.when(~passes([r], measures), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()
    ) if rules else F.array().cast("array<string>")
    # Separate steps: what a later one uses more than once is computed once, and outside of
    # lambdas Spark compiles the array functions.
    added = {
        **{c: F.col(f"{mark}{c}") for c in counts}, "n_dup_lines": lines["dup"], "failed_rules": failed,
        "base_failed": base_failed, "kept": ~base_failed & passes(rules, measures),
    }
    return (
        df.withColumn(f"{mark}words", words(source))
        .withColumn(f"{mark}windows", _windows(tokens))
        .withColumns(_measures(source, tokens, windows, mark))
        .select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in added], *[v.alias(c) for c, v in added.items()])
    )
