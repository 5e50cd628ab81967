"""Row numbers and running totals inside groups that may be arbitrarily large.

A window puts one whole group into one task. That is fine up to a checked size; beyond it
the rows are range-partitioned by (group, order), numbered inside each range, and shifted by
the totals of the ranges before it. A range boundary cuts at most one group, so only the few
groups that span ranges need a shift, and the table of shifts stays tiny.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.session import hot_group_rows, materialize, shuffle_partitions


def hottest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group (partial counts are combined before the shuffle)."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "rn",
    totals: Mapping[str, str] | None = None, may_be_hot: bool = True,
) -> DataFrame:
    """Add ``name`` = 1, 2, … in ``order`` inside each group of ``keys``, and for each
    ``totals`` entry (new column → summed column) the running total up to the row.

    ``order`` must be total within a group. ``may_be_hot=False`` is for groups whose size is
    bounded by construction and skips the check.
    """
    totals = dict(totals or {})
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    if may_be_hot and hottest_group(df, keys) > hot_group_rows(df.sparkSession):
        return _number_ranges(df, list(keys), order, name, totals)
    return df.withColumns(_running(list(keys), order, name, totals))


def _running(keys: list[str], order: list[Column], name: str, totals: dict[str, str]) -> dict[str, Column]:
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return {name: F.count(F.lit(1)).over(rows)} | {n: F.sum(c).over(rows) for n, c in totals.items()}


def _number_ranges(
    df: DataFrame, keys: list[str], order: list[Column], name: str, totals: dict[str, str]
) -> DataFrame:
    # Written once: the range a row falls into must be the same wherever it is used, also
    # after a lost executor makes Spark recompute part of the plan.
    ranged = materialize(
        df.repartitionByRange(shuffle_partitions(df.sparkSession), *[F.col(k) for k in keys], *order)
        .withColumn("_range", F.spark_partition_id())
    )
    added = {name: F.count(F.lit(1))} | {n: F.sum(c) for n, c in totals.items()}
    per_range = ranged.groupBy(*keys, "_range").agg(*[a.alias(f"_{n}") for n, a in added.items()])
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_range.select(
        *keys, "_range", *[F.sum(f"_{n}").over(before).alias(f"_{n}") for n in added]
    ).filter(F.col(f"_{name}").isNotNull())
    # At most one shifted group per range boundary: the row count is bounded by the partitions.
    shifts = F.broadcast(shifts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_r"),
                                       *[f"_{n}" for n in added]))
    same = F.col("_range") == F.col("_r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    local = ranged.withColumns(_running([*keys, "_range"], order, name, totals))
    shifted = local.join(shifts, same, "left")
    result = {n: F.col(n) + F.coalesce(F.col(f"_{n}"), F.lit(0)) for n in added}
    return shifted.withColumns(result).select(*df.columns, *added)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order`` (NULLs first). Each task keeps its own first row of a key
    before rows are sent (the planner's group limit), so a key that holds much of the table stays small."""
    first = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_first(o) for o in order])
    return df.withColumn("_place", F.row_number().over(first)).filter("_place = 1").select(*df.columns)
