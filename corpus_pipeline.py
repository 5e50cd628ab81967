"""From raw documents to packed training sequences, in five written stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's documents, so a lost executor costs at most the stage that runs. Stages
keep the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.llm import decontaminate, jaccard, quality_rules, secret_scan
from fleetloom.llm.common import documents, written
from fleetloom.llm.queries import benchmark, packed

# Near copies: five-word shingles, a similarity of 0.8 or more.
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go; null and empty texts are rejected."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text", "lang")
    return quality_rules.judge(rows).filter("kept").select("_row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return jaccard.one_per_component(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.clean(docs, benchmark(spark, sf_dir))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark in their text; every document stays."""
    cleaned = secret_scan.redacted(docs, "doc_id", path="source")
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs.select("doc_id", "text"))


STAGES = [
    ("quality_rules", quality),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("packing", packing),
]

# Tokenising, sketches and the forest cannot be written in SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
