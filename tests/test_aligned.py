"""Answers that the fixtures alone would not tell apart."""

from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fleetloom.functions.distributions import normal_quantile
from fleetloom.operators import allocate, compliance, models, ordered
from fleetloom.operators import safety_stock as S

ROOT = "/root/testdata/sf0.001"


def test_freeze_summary_counts_similar_vehicles(spark):
    """The summary knows how many units get a vehicle without deciding which one."""
    queries = entry.queries()
    matched = queries["similar_match"](spark, ROOT).filter("vehicle_id is not null or similar_id is not null")
    want = {r.config_string: r["count"] for r in matched.groupBy("config_string").count().collect()}
    got = {r.config_string: r.vehicle_id_count for r in queries["freeze_summary"](spark, ROOT).collect()}
    assert {k: v for k, v in got.items() if v} == want


def test_counters_and_unit_ids_hold_large_numbers(spark):
    units = spark.createDataFrame([("c", 3)], "config_string string, added_volume long")
    assert allocate.expand_units(units).schema["unit"].dataType.simpleString() == "bigint"
    rows = spark.createDataFrame([("a", i) for i in range(20)], "k string, v long")
    for conf in ("2000000", "5"):
        spark.conf.set("fleetloom.hotGroupRows", conf)
        numbered = ordered.number_rows(rows, ["k"], ["v"], "rn")
        assert numbered.schema["rn"].dataType.simpleString() == "bigint"
        assert [r.rn for r in numbered.orderBy("v").collect()] == list(range(1, 21))
    spark.conf.unset("fleetloom.hotGroupRows")
    number = F.col("n").cast("string")
    ranked = F.concat(F.lpad(F.length(number).cast("string"), 2, "0"), number)
    values = [1234567890123, 9, 10, 123456789, 1234567890]
    df = spark.createDataFrame([(v,) for v in values], "n long")
    assert [r.n for r in df.orderBy(ranked).collect()] == sorted(values)


def test_a_centre_with_two_codes_does_not_split_a_key(spark):
    orders = spark.createDataFrame(
        [("o1", "c", "10001", "2025-01-06"), ("o2", "c", "10002", "2025-01-07"), ("o3", "c", "10001", "2025-01-14")],
        "order_id string, config_string string, zip_code string, order_date string",
    ).withColumn("order_date", F.to_date("order_date"))
    remap = spark.createDataFrame([("x", "y")], "config_string_original string, mapped_config_string string")
    zips = spark.createDataFrame(
        [("10001", "7001", "Centre"), ("10002", "7002", "Centre")], "customer_zip_code string, sap_sc_code string, sc_name string")
    weekly = S.weekly_orders(S.daily_orders(orders, remap, zips))
    assert sorted(r.weekly_orders for r in weekly.collect()) == [1, 2]
    assert sorted(r.weekly_orders for r in S.dense_demand(weekly).collect()) == [1, 2]
    stats = S.weekly_stats(weekly, S.week_count(orders)).collect()
    assert len(stats) == 1 and stats[0].average_weekly_demand == 1.5 and stats[0].sap_sc_code == "7001"


def test_factory_lead_time(spark):
    df = spark.createDataFrame([("8101", 9.0), ("7001", 3.0), (None, 2.0)], "sap_sc_code string, total_lead_time double")
    got = S.assign_lead_time(df, 5.0, 0.5, 0.25).collect()
    assert [(r.lead_time, r.lead_time_std) for r in got] == [(5.0, 2.5), (3.0, 0.75), (2.0, 0.5)]


def test_quantile_column(spark):
    levels = [1e-9, 0.001, 0.02425, 0.3, 0.5, 0.85, 0.9, 0.95, 0.975, 0.98, 0.9999]
    df = spark.createDataFrame([(p,) for p in levels], "p double")
    for r in df.select("p", normal_quantile(F.col("p")).alias("z")).collect():
        assert r.z == pytest.approx(NormalDist().inv_cdf(r.p), rel=1e-8, abs=1e-8)
    outside = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double").select(normal_quantile(F.col("p")).alias("z"))
    assert all(r.z is None for r in outside.collect())


def test_undefined_ratios_are_null(spark):
    df = spark.createDataFrame([("a", None, "Compliant")], "g string, vehicle_id string, inventory_policy_compliance string")
    assert compliance.compliance_table(df, ["g"]).first().percent_compliant is None
    two = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0)], "x double, y double")
    row = models.simple_ols(two, "x", "y").first()
    assert row.slope == pytest.approx(2.0) and row.t is None and row.adj_r2 is None
