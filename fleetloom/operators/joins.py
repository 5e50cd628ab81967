"""Joins with the key checks and NULL rules that the analyses rely on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.session import materialize

# Dimensions up to this many rows are broadcast; larger ones are shuffled (AQE splits skew).
BROADCAST_ROWS = 200_000


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().filter("count > 1")


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "dimension") -> None:
    """Refuse a key that would fan rows out."""
    bad = duplicated_keys(df, keys).take(1)
    if bad:
        raise ValueError(f"{what} has more than one row for {bad[0].asDict()}")


def small(dim: DataFrame, limit: int = BROADCAST_ROWS, computed: bool = True) -> DataFrame:
    """``dim`` with a broadcast hint if its row count allows it, plain otherwise.

    A computed dimension is written first: it is derived once instead of once for the count
    and once for the join. Pass ``computed=False`` for literal or stored tables.
    """
    dim = materialize(dim) if computed else dim
    return F.broadcast(dim) if dim.count() <= limit else dim


def enrich(
    df: DataFrame, dim: DataFrame, on: dict[str, str], how: str = "left",
    null_safe: bool = False, check_unique: bool = False,
) -> DataFrame:
    """Join a dimension; ``on`` maps df columns to dim columns, which are dropped afterwards.

    ``null_safe`` treats NULL keys as equal (as data-frame merges do) and stays a hash join.
    """
    if check_unique:
        assert_unique(dim, list(on.values()))
    keys = {d: f"_key_{i}" for i, d in enumerate(on.values())}
    dim = dim.withColumnsRenamed(keys)
    return df.join(dim, _same({s: keys[d] for s, d in on.items()}, null_safe), how).drop(*keys.values())


def _same(on: dict[str, str], null_safe: bool) -> Column:
    cond: Column | None = None
    for left, right in on.items():
        eq = F.col(left).eqNullSafe(F.col(right)) if null_safe else F.col(left) == F.col(right)
        cond = eq if cond is None else cond & eq
    assert cond is not None
    return cond


def one_to_one(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join after proving that neither side repeats a key."""
    assert_unique(left, on, "left side")
    assert_unique(right, on, "right side")
    return left.join(right, list(on), "inner")


def keep_listed(df: DataFrame, listed: DataFrame, on: dict[str, str]) -> DataFrame:
    ids = listed.select(*[F.col(d).alias(f"_{s}") for s, d in on.items()])
    return df.join(ids, _same({s: f"_{s}" for s in on}, False), "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, on: dict[str, str]) -> DataFrame:
    """Anti join: rows whose key is NULL are not listed and stay."""
    ids = listed.select(*[F.col(d).alias(f"_{s}") for s, d in on.items()])
    return df.join(ids, _same({s: f"_{s}" for s in on}, False), "left_anti")


def option_list(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)
