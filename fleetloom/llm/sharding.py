"""Sharding by histogram sort.

Rows get a 64-bit key: the upper half from a hash of the text, the lower half from a hash of the
id. Copies of a text are neighbours in key order, and a text that holds much of the corpus can
still be cut between its copies. The boundaries between shards are found by counting: each round
sums the exact bytes and rows of the cells of a finer and finer grid over the key space, but only
inside the cells that still hold an unsettled boundary, until every boundary lies within the
tolerance of its target or between two neighbouring keys. The driver sees at most ``PROBES``
counters per round. Shards are further cut into ranges, so that the one exchange that follows
deals the rows of a shard to many tasks; the counts below each boundary number the rows.

Defined results: a null text weighs one byte and has no checksum; null ids are hashed like any
value; equal rows are neighbours in any order; an empty table has no boundary and no row. Columns
of the input are kept; ``shard`` and ``slot`` are replaced if they exist.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.llm.common import dropped, spare, written
from fleetloom.session import shuffle_partitions
from fleetloom.sources.tables import inline_table

PROBES = 1 << 16
KEY_BITS = 64


@dataclass
class Boundary:
    """Rows with a smaller key lie below; ``key`` None: nothing lies above."""

    key: int | None
    size: int
    rows: int


def spread_key(text: Column, doc_id: Column) -> Column:
    """Copies adjacent, and each copy at its own place."""
    upper = F.shiftleft(F.shiftright(F.xxhash64(text), 32), 32)
    return upper.bitwiseOR(F.xxhash64(doc_id).bitwiseAND(F.lit(0xFFFFFFFF)))


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")) + 1


def boundaries(keyed: DataFrame, targets: Sequence[float], tolerances: Sequence[float]) -> list[Boundary]:
    """For each target share of all bytes (ascending) the boundary nearest to it.

    ``keyed`` has ``_key`` and ``_size``; tolerances are shares of all bytes.
    """
    spark = keyed.sparkSession
    settled: list[Boundary | None] = [None] * len(targets)
    # Cell 0 of the coarsest grid is everything; open cells: id -> (bytes below, rows below).
    bits, total = 0, 0
    open_cells: dict[int, tuple[int, int]] = {0: (0, 0)}
    waiting: dict[int, list[int]] = {0: list(range(len(targets)))}
    goals: list[float] = []
    while waiting and bits < KEY_BITS:
        step = min(KEY_BITS - bits, max(1, (PROBES // len(waiting)).bit_length() - 1))
        rows = keyed
        if bits:
            cells = inline_table(spark, [(c,) for c in waiting], "_cell bigint")
            cell = F.shiftright("_key", KEY_BITS - bits)
            # One row per unsettled boundary at most.
            rows = keyed.withColumn("_cell", cell).join(F.broadcast(cells), "_cell", "left_semi")
        bits += step
        counted = rows.groupBy(F.shiftright("_key", KEY_BITS - bits).alias("cell")).agg(
            F.sum("_size").alias("size"), F.count(F.lit(1)).alias("rows")
        ).orderBy("cell").collect()
        if not goals:
            total = sum(r["size"] for r in counted)
            goals = [t * total for t in targets]
        inside: dict[int, list] = {}
        for r in counted:
            inside.setdefault(r["cell"] >> step if bits > step else 0, []).append(r)
        next_waiting: dict[int, list[int]] = {}
        next_cells: dict[int, tuple[int, int]] = {}
        for parent, places in waiting.items():
            fine, below = inside.get(parent, []), open_cells[parent]
            edges = [below]
            for r in fine:
                edges.append((edges[-1][0] + r["size"], edges[-1][1] + r["rows"]))
            for place in places:
                if not fine:
                    settled[place] = Boundary(None, *below)
                    continue
                i = min(max(bisect_right([e[0] for e in edges], goals[place]) - 1, 0), len(fine) - 1)
                near = min((i, i + 1), key=lambda k: abs(edges[k][0] - goals[place]))
                miss = abs(edges[near][0] - goals[place])
                if miss <= tolerances[place] * total or bits == KEY_BITS:
                    settled[place] = _edge(fine, edges, near, bits)
                else:
                    next_waiting.setdefault(fine[i]["cell"], []).append(place)
                    next_cells[fine[i]["cell"]] = edges[i]
        waiting, open_cells = next_waiting, next_cells
    return _ascending([b if b else Boundary(None, 0, 0) for b in settled])


def _edge(fine: list, edges: list[tuple[int, int]], k: int, bits: int) -> Boundary:
    """The boundary below the k-th occupied cell; above the last one, the end of that cell."""
    cell = fine[k]["cell"] if k < len(fine) else fine[-1]["cell"] + 1
    key = cell << (KEY_BITS - bits)
    return Boundary(key if key < 1 << (KEY_BITS - 1) else None, *edges[k])


def _ascending(found: list[Boundary]) -> list[Boundary]:
    """Boundaries that met their tolerance at different depths may have swapped places."""
    return sorted(found, key=lambda b: (b.key is None, b.key or 0))


def _array(values: Sequence[int]) -> Column:
    """A constant array; one literal, however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _count_at_or_below(sorted_values: Sequence[int], key: Column) -> Column:
    """How many of the constants are at most ``key``, by bisection."""
    if not sorted_values:
        return F.lit(0)
    values = _array(sorted_values)
    steps = [1 << k for k in reversed(range(len(sorted_values).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when(F.get(values, at + step - 1) <= key, at + step).otherwise(at),
    )


def shard(
    df: DataFrame, n_shards: int, key: Column, size: Column, order: Sequence[str],
    tolerance: float = 1e-4, ranges_per_shard: int | None = None,
) -> DataFrame:
    """Add ``shard`` (0 to ``n_shards`` - 1, nearly equal sums of ``size``) and ``slot`` (0, 1, …
    inside the shard, in key order, ties in ``order``). Shard boundaries are settled to
    ``tolerance`` of a shard, those of the ranges inside a shard to a twentieth of a range.
    """
    per_shard = ranges_per_shard or max(1, -(-2 * shuffle_partitions(df.sparkSession) // n_shards))
    n = n_shards * per_shard
    sizes = written(df.select(key.alias("_key"), size.alias("_size")))
    found = boundaries(
        sizes, [i / n for i in range(1, n)],
        [tolerance / n_shards if i % per_shard == 0 else 0.05 / n for i in range(1, n)],
    )
    dropped(sizes)
    below = [0, *(b.rows for b in found)]
    first = [below[i // per_shard * per_shard] for i in range(n)]
    splitters = [b.key for b in found if b.key is not None]
    mark = spare(df)
    place, span, at = f"{mark}key", f"{mark}range", f"{mark}at"
    in_range = Window.partitionBy(span).orderBy(place, *order)
    return (
        df.drop("shard", "slot").withColumn(place, key)
        .withColumn(span, _count_at_or_below(splitters, F.col(place)).cast("long"))
        .withColumn(at, F.count(F.lit(1)).over(in_range.rowsBetween(Window.unboundedPreceding, 0)) - 1)
        .withColumns({
            "shard": F.floor(F.col(span) / per_shard).cast("int"),
            "slot": F.col(at) + F.get(_array([b - f for b, f in zip(below, first)]), F.col(span).cast("int")),
        })
        .drop(place, span, at)
    )
