"""Queries over files: results saved, loaded again with a declared schema, and parameterised SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.plans.views_sql import with_views
from fleetloom.session import scratch_dir
from fleetloom.sources import domain as D
from fleetloom.sources import tables as T


def _saved(spark: SparkSession, root: str, fmt: str) -> DataFrame:
    """Forecast lines per model and day, saved in ``fmt`` and loaded again."""
    daily = D.forecast(spark, root).groupBy("model_powertrain", "order_date").agg(F.count(F.lit(1)).alias("orders"))
    path = f"{scratch_dir(spark).rstrip('/')}/fleetloom/{uuid.uuid4().hex}"
    T.save(daily, path, fmt)
    return T.load_file(spark, path, fmt, daily.schema)


def saved_csv(spark: SparkSession, root: str) -> DataFrame:
    return _saved(spark, root, "csv")


def saved_orc(spark: SparkSession, root: str) -> DataFrame:
    return _saved(spark, root, "orc")


def parameterised(spark: SparkSession, root: str) -> DataFrame:
    """Forecast lines per model for bound models and a bound first day."""
    return T.run_sql(
        spark,
        "select model_powertrain, count(*) as orders, max(order_date) as last_day from {lines}"
        " where array_contains(:models, model_powertrain) and order_date >= cast(:since as date) group by model_powertrain",
        {"models": ["M1 LARGE", "M2 SMALL"], "since": "1995-01-01"}, {"lines": D.forecast(spark, root)},
    )


def repeated_run(spark: SparkSession, root: str) -> DataFrame:
    """Forecast lines per day and model of two years, saved by year; the second year is saved first with
    double numbers and then again, as a repeated run does."""
    lines = D.forecast(spark, root).withColumn("order_year", F.year("order_date"))
    yearly = lines.groupBy("order_year", "model_powertrain", "order_date").agg(F.count(F.lit(1)).alias("orders"))
    path = f"{scratch_dir(spark).rstrip('/')}/fleetloom/{uuid.uuid4().hex}"
    both = yearly.filter(F.col("order_year").isin(*RUN_YEARS))
    T.save_partitions(both.withColumn("orders", F.when(F.col("order_year") == RUN_YEARS[1], 2 * F.col("orders")).otherwise(F.col("orders"))), path, ["order_year"])
    T.save_partitions(yearly.filter(F.col("order_year") == RUN_YEARS[1]), path, ["order_year"])
    return T.load_file(spark, path, schema=both.schema)


RUN_YEARS = (1996, 1997)
_DAILY = with_views("forecast", "select model_powertrain, order_date, count(*) as orders from forecast group by 1, 2")

QUERIES = {
    "save_load_csv": (saved_csv, _DAILY),
    "save_load_orc": (saved_orc, _DAILY),
    "save_repeated_run": (repeated_run, with_views("forecast", """
select cast(year(order_date) as int) as order_year, model_powertrain, order_date, count(*) as orders from forecast
where year(order_date) in (1996, 1997) group by all""")),
    "run_sql": (parameterised, with_views("forecast", """
select model_powertrain, count(*) as orders, max(order_date) as last_day from forecast
where model_powertrain in ('M1 LARGE', 'M2 SMALL') and order_date >= date '1995-01-01' group by 1""")),
}
