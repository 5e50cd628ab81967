"""Secret scan: pattern candidates, then a random forest that removes false findings.

Candidates are long runs of key characters with a digit in them. For each, features are built
from Column expressions: length, shares of character kinds, transitions between kinds, how much of
it is dictionary words, the path it comes from, and the words before it. An MLlib forest is
trained on labelled findings and scores all candidates. No user function runs on the main path.

Labels: pass ``labelled`` findings, or leave it out and the scan labels a bounded sample of its
own candidates by strong evidence (a key word that assigns the value, a vendor's key shape, or a
shape that is known to be harmless) and the forest generalises to candidates without it. The
sample takes, of each class, up to half of ``TRAINING_ROWS`` distinct findings (value and words
before it) with the smallest hash; everything else covers all rows.

Defined results: null, empty and blank texts have no candidates. Equal rows yield equal findings,
one set per row. A null path counts as plain. If the labels hold one class only, candidates get
that class, but those whose own evidence says otherwise keep their own; without any candidate the
result is empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.llm.common import let, spare, words, written

TRAINING_ROWS = 20_000
TREES, DEPTH, SEED = 40, 6, 7
THRESHOLD = 0.5
MIN_LENGTH = 16

# Characters of keys; a run of them with a digit inside.
_KEY_RUN = r"[A-Za-z0-9+/_\-]"
CANDIDATE = rf"(?<!{_KEY_RUN})(?=[A-Za-z+/_\-]*+[0-9]){_KEY_RUN}{{{MIN_LENGTH},}}"
# Words that announce a secret, and words that announce a harmless long value.
ANNOUNCE = r"(?i)(token|secret|passw(or)?d|pwd|api[_\-]?key|access[_\-]?key|private[_\-]?key|credential|bearer|auth)"
HARMLESS = r"(?i)(sha\d*|md5|checksum|digest|commit|revision|etag|uuid|guid|isbn|order|invoice|phone|card|version|build)"
# Shapes of vendors' keys.
VENDOR = (
    r"^(AKIA|ASIA|AGPA|AIDA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-|^sk_(live|test)_"
    r"|^AIza[A-Za-z0-9_\-]{35}$|^glpat-[A-Za-z0-9_\-]{20}$|^eyJ[A-Za-z0-9_\-]{10,}"
)
# Words whose presence in a value speaks for a placeholder or a name.
DICTIONARY = (
    "example sample test demo dummy placeholder changeme your default secret password token key user admin "
    "value string version release build module package index image file path home data user name page article "
    "http https www html json config local host server client the and for with from this that"
).split()
_WORD_IN_VALUE = "(?i)(" + "|".join(sorted(set(DICTIONARY), key=lambda w: (-len(w), w))) + ")"
PLAIN_PATH = r"(?i)(test|example|sample|fixture|doc|vendor|third_party|lock|\.min\.)"

FEATURES = (
    "length", "digit_share", "upper_share", "hex", "transitions", "distinct_share", "dictionary_share",
    "announced", "assigned", "harmless", "vendor", "plain_path", "separators",
)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def candidates(df: DataFrame, keys: Sequence[str], text: str = "text", path: str | None = None) -> DataFrame:
    """One row per candidate: keys, ``value``, ``before`` (up to three words and what stands before
    the value in its own word), ``n_at`` (number of its word in the text) and the features."""
    source = F.col(f"`{text}`")
    found = F.filter(
        F.transform(F.col("_w"), lambda w, i: F.when(w.rlike(CANDIDATE), F.struct(
            F.regexp_extract_all(w, F.lit(f"({CANDIDATE})"), F.lit(1)).alias("values"), w.alias("word"), i.alias("at"),
        ))), lambda c: c.isNotNull(),
    )
    where = F.col(f"`{path}`") if path else F.lit(None).cast("string")
    rows = (
        # Most texts have no candidate: one scan of the pattern spares the splitting.
        df.filter(source.rlike(CANDIDATE))
        .select(*[F.col(f"`{k}`") for k in keys], where.alias("_path"), words(source).alias("_w"))
        .select(*keys, "_path", "_w", F.explode(found).alias("c"))
        .select(
            *keys, "_path", F.col("c.word").alias("_word"), F.col("c.at").cast("long").alias("n_at"),
            F.array_join(F.slice("_w", F.greatest(F.col("c.at") - 2, F.lit(1)), F.least(F.col("c.at"), F.lit(3))), " ").alias("_near"),
            F.explode("c.values").alias("value"),
        )
    )
    value, near = F.col("value"), F.col("_near")
    own = F.substring(F.col("_word"), F.lit(1), F.instr(F.col("_word"), value) - 1)
    length = F.char_length(value)
    kinds = F.regexp_replace(value, "[^A-Za-z0-9]", "")
    before = F.concat_ws(" ", near, own)
    return rows.withColumn("before", before).select(
        *keys, "value", "before", "n_at",
        length.cast("double").alias("length"),
        _share(F.char_length(F.regexp_replace(value, "[^0-9]", "")), length).alias("digit_share"),
        _share(F.char_length(F.regexp_replace(value, "[^A-Z]", "")), length).alias("upper_share"),
        value.rlike("^(0x)?[0-9a-fA-F]+$").cast("double").alias("hex"),
        _share(F.regexp_count(kinds, F.lit(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])")), length).alias("transitions"),
        let(F.split(value, ""), lambda c: _share(F.size(F.array_distinct(c)), F.size(c))).alias("distinct_share"),
        _share(length - F.char_length(F.regexp_replace(value, _WORD_IN_VALUE, "")), length).alias("dictionary_share"),
        F.col("before").rlike(ANNOUNCE).cast("double").alias("announced"),
        F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double").alias("assigned"),
        F.col("before").rlike(HARMLESS).cast("double").alias("harmless"),
        value.rlike(VENDOR).cast("double").alias("vendor"),
        F.coalesce(F.col("_path").rlike(PLAIN_PATH), F.lit(False)).cast("double").alias("plain_path"),
        F.char_length(F.regexp_replace(value, "[A-Za-z0-9]", "")).cast("double").alias("separators"),
    )


def evidence() -> Column:
    """1 or 0 where the shape and surroundings leave no doubt, null elsewhere."""
    placeholder = (F.col("dictionary_share") > 0.4) | (F.col("distinct_share") < 0.2)
    return (
        F.when((F.col("digit_share") == 1.0) | placeholder, 0.0)
        .when(F.col("vendor") == 1.0, 1.0)
        .when((F.col("announced") == 1.0) & (F.col("assigned") == 1.0) & (F.col("digit_share") > 0.1), 1.0)
        .when((F.col("harmless") == 1.0) & (F.col("announced") == 0.0), 0.0)
        .when((F.col("separators") > 2) & (F.col("announced") == 0.0), 0.0)
    )


def trained(labelled: DataFrame):
    """The forest for ``labelled`` findings (the features and ``label``), or the only label there is."""
    classes = [r["label"] for r in labelled.select("label").distinct().orderBy("label").limit(2).collect()]
    if len(classes) < 2:
        return classes[0] if classes else 0.0
    forest = RandomForestClassifier(
        featuresCol="_v", labelCol="label", probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_class",
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="_v"), forest]).fit(labelled)


def sample(found: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """Features and ``label`` of candidates with strong evidence: of each class up to half of
    ``rows``, copies of a finding once."""
    sure = (
        found.withColumn("label", evidence()).filter("label is not null")
        .groupBy("value", "before").agg(*[F.min(c).alias(c) for c in (*FEATURES, "label")])
    )
    order = (F.xxhash64("value", "before"), "value", "before")
    parts = [sure.filter(F.col("label") == c).orderBy(*order).limit(max(rows // 2, 1)) for c in (0.0, 1.0)]
    return parts[0].unionByName(parts[1]).select(*FEATURES, "label")


def scan(
    df: DataFrame, keys: Sequence[str], text: str = "text", path: str | None = None,
    labelled: DataFrame | None = None, rows: int = TRAINING_ROWS,
) -> DataFrame:
    """All candidates with ``score`` and ``is_secret``: keys, ``value``, ``before``, ``n_at``, features."""
    found = written(candidates(df, keys, text, path))
    if labelled is None:
        labelled = written(sample(found, rows))
    model = trained(labelled)
    if isinstance(model, float):
        scored = found.withColumn("score", F.coalesce(evidence(), F.lit(model)))
    else:
        scored = model.transform(found).withColumn("score", F.get(vector_to_array("_p"), F.lit(1)))
        scored = scored.drop("_v", "_p", "_raw", "_class")
    return scored.withColumn("is_secret", F.col("score") >= THRESHOLD)


def redacted(
    df: DataFrame, key: str, text: str = "text", path: str | None = None, mark: str = "[SECRET]",
    labelled: DataFrame | None = None,
) -> DataFrame:
    """``df`` with every secret in ``text`` replaced; all rows and columns stay.

    Only texts with a candidate meet the findings in a join. Rows are matched by id and text, so
    null and repeated ids do no harm.
    """
    source, helper = F.col(f"`{text}`"), spare(df)
    place, values = f"{helper}row", f"{helper}secrets"
    marked = F.coalesce(source.rlike(CANDIDATE), F.lit(False))
    row = F.sha2(F.concat_ws("|", F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), source), 256)
    suspects = df.filter(marked).withColumn(place, row)
    secrets = (
        scan(suspects, (place,), text, path, labelled).filter("is_secret")
        # At most the words of one text.
        .groupBy(place).agg(F.array_distinct(F.collect_list("value")).alias(values))
    )
    # Longer values first, so that no value is cut by one that is part of it.
    ordered = F.array_sort(
        F.coalesce(values, F.array().cast("array<string>")),
        lambda a, b: F.when(F.char_length(a) > F.char_length(b), -1).when(F.char_length(a) < F.char_length(b), 1)
        .when(a < b, -1).when(a > b, 1).otherwise(0),
    )
    cleaned = suspects.join(secrets, place, "left").withColumn(
        text, F.aggregate(ordered, source, lambda t, s: F.replace(t, s, F.lit(mark)))
    ).select(*[F.col(f"`{c}`") for c in df.columns])
    return df.filter(~marked).unionByName(cleaned)
