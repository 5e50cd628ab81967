"""What the text operators share: words, written intermediate tables, inline tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.session import scratch_dir

# The white space that separates words, and one or more of it as a pattern.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{root}/documents.parquet")
    return df.select(*columns) if columns else df


def words(text: Column) -> Column:
    """The words of a text as an array; empty for a null, empty or blank text."""
    body = F.btrim(text, F.lit(BLANKS))
    return F.when(body.isNull() | (body == ""), F.array().cast("array<string>")).otherwise(
        F.split(body, BLANK_RUN, -1)
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spare(df: DataFrame) -> str:
    """A prefix for helper columns that begins no column of ``df``."""
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in df.columns), default=0))


@contextmanager
def _shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python workers are handed a few MB of rows at a time, however long their rows are."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, "4m")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; the shuffle files that it took are
    removed as soon as the table stands, so that only tables take space between steps."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/fleetloom/{uuid.uuid4().hex}"
    with _shuffle_files_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` that no later step reads."""
    for df in tables:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
