"""Which values of an array column occur in more than one row."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetloom.llm.common import written

# Bits of the map of shared values that every task holds (16 MB).
MAP_BITS = 27


def shared_values(df: DataFrame, keys: Sequence[str], values: str) -> DataFrame:
    """(keys, value) for the values (distinct within a row) that several rows of ``df`` have; keys
    and values are longs without nulls.

    Values are counted first; most are unique. A bitmap of the others, of fixed size, lets rows
    send only what can be shared, and a join settles it.
    """
    common = written(
        df.select(F.explode(values).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("c"))
        .filter("c > 1").select("value")
    )
    # At most 2 ** MAP_BITS / 64 numbers, however many values there are.
    place = F.col("value").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = common.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (MAP_BITS - 6), np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    sent = df.sparkSession.sparkContext.broadcast(bitmap)
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value
        for batch in batches:
            lists = batch.column(n)
            flat, lengths = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            at = flat & ((1 << MAP_BITS) - 1)
            found = np.flatnonzero((bitmap[at >> 6] >> (at & 63)) & 1)
            owner = np.repeat(np.arange(len(lengths)), lengths)[found]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(batch.column(i).to_numpy()[owner]) for i in range(n)], pa.array(flat[found])],
                names=[*keys, "value"],
            )

    schema = T.StructType([T.StructField(k, T.LongType()) for k in (*keys, "value")])
    return df.select(*keys, values).mapInArrow(run, schema).join(common, "value")
