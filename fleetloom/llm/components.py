"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetloom.llm.common import dropped, written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the label is one node of its component.

    In each round every node hooks on to its smallest neighbour, hooks are followed twice, and the
    edges are rewritten between what is left. Only tables grow with the graph: the driver asks
    whether an edge is left. Minima are pre-aggregated, so a hub costs its edges and no more.
    """
    spark = edges.sparkSession
    left = written(edges.filter("a != b").distinct())
    labels: DataFrame | None = None
    while not left.isEmpty():
        ends = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = written(ends.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("parent")))
        up = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        parents = written(hooks.join(up, "parent").select("node", F.col("top").alias("parent")))

        def moved(df: DataFrame, column: str, to: DataFrame = parents) -> DataFrame:
            step = to.select(F.col("node").alias(column), F.col("parent").alias("_p"))
            return df.join(step, column, "left").withColumn(column, F.coalesce("_p", column)).drop("_p")

        old_left, old_labels = left, labels
        left = written(moved(moved(left, "a"), "b").filter("a != b").select("a", "b").distinct())
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("label"))
        else:
            labels = moved(labels, "label").select("node", "label")
        labels = written(labels)
        dropped(old_left, hooks, parents, *([old_labels] if old_labels is not None else []))
    return labels if labels is not None else spark.createDataFrame([], "node long, label long")
