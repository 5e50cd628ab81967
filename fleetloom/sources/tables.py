"""Reading and writing tables and files (declared schemas, no inference)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

READERS = ("parquet", "csv", "json", "orc")
# Tasks that write one partition of a table at most.
SPREAD = 32


def load_table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A catalog table by its one- to three-part name, or ``<root>/<name>.parquet``."""
    return spark.table(name) if root is None else spark.read.parquet(f"{root}/{name}.parquet")


def load_file(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """A file source. Text formats need a schema: ids stay strings, dates stay dates."""
    if fmt not in READERS:
        raise ValueError(f"unsupported format {fmt!r}; convert it to one of {READERS} upstream")
    if schema is None and fmt in ("csv", "json"):
        raise ValueError(f"{fmt} needs a declared schema")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def save(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
    partition_by: tuple[str, ...] = (),
) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Write the partitions that ``df`` has and leave all others as they are.

    A run that is repeated replaces what it wrote before, so a day written twice stands there once.
    Rows are dealt by partition and a part of their hash, so that a task holds few open files and a
    large day is written by several tasks.
    """
    if not partition_by:
        raise ValueError("a repeatable write needs the columns that name a partition")
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD))
    dealt = df.repartition(*[F.col(c) for c in partition_by], spread)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt).partitionBy(*partition_by).save(path)


def inline_table(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: str) -> DataFrame:
    """A few literal rows as a table (``schema`` in ``name type, …`` form), without a Python RDD."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]

    def value(v: Any, kind: str) -> str:
        text = "null" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"cast({text} as {kind})"

    structs = [
        "struct(" + ", ".join(f"{value(v, kind)} as {name}" for v, (name, kind) in zip(row, fields)) + ")"
        for row in rows
    ]
    one = spark.range(1).selectExpr(f"inline(array({', '.join(structs)}))") if rows else None
    return one if one is not None else spark.createDataFrame([], schema)


def run_sql(
    spark: SparkSession, sql: str, params: Mapping[str, Any] | None = None,
    views: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """A parameterised query. ``:name`` marks bind scalars or lists (``array_contains(:list, c)``);
    ``{view}`` marks bind DataFrames. Nothing is pasted into the text."""
    args = {k: _literal(v) for k, v in (params or {}).items()}
    return spark.sql(sql, args=args, **(views or {}))


def _literal(value: Any) -> Any:
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(v) for v in value])
    return value if isinstance(value, Column) else F.lit(value)
