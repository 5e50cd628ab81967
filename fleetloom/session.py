"""Session helpers: where intermediate tables go and how they are cut from their lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# One window group up to this many narrow rows sorts and spills comfortably in one task;
# larger groups take the range-partitioned path (operators/ordered.py).
HOT_GROUP_ROWS = 2_000_000


def hot_group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get("fleetloom.hotGroupRows", str(HOT_GROUP_ROWS)))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` if the session names one.

    A machine-local folder is only acceptable where the driver and every executor are the
    same process, so without the setting anything but a local master is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="fleetloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The copy survives lost executors, ends the lineage of iterative jobs, and carries real
    sizes, so that the planner picks broadcasts from facts instead of estimates.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/fleetloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
