import datetime as dt
import random
from statistics import NormalDist, mean, stdev

import pytest

from fleetloom.operators import safety_stock as S

WEEKLY = f"{S.KEY} string, mapped_config_string string, sap_sc_code string, sc_name string, order_week date, weekly_orders long"


@pytest.fixture
def weekly(spark):
    rng = random.Random(2)
    weeks = [dt.date(2025, 1, 6) + dt.timedelta(days=7 * i) for i in range(10) if i != 4]
    rows = [(f"k{k}", f"c{k}", "8105", "SC", w, rng.randrange(1, 9)) for k in range(6) for w in weeks if rng.random() < 0.6 or k == 0]
    return rows, weeks, spark.createDataFrame(rows, WEEKLY)


def test_dense_and_stats_agree(spark, weekly):
    rows, weeks, df = weekly
    dense = S.dense_demand(df).collect()
    assert len(dense) == 6 * len(weeks)
    stats = {r[S.KEY]: r for r in S.weekly_stats(df, spark.createDataFrame([(len(weeks),)], "num_of_weeks long")).collect()}
    for key, r in stats.items():
        filled = [d.weekly_orders for d in dense if d[S.KEY] == key]
        assert r.average_weekly_demand == pytest.approx(mean(filled), abs=1e-4)
        assert r.annualized_demand == pytest.approx(52 * mean(filled), abs=1e-4)
        assert r.standard_deviation_of_weekly_demand == pytest.approx(stdev(filled), abs=1e-4)
    assert S.dense_demand(df, "full").count() == 6 * 10


def test_one_week_has_no_deviation(spark):
    df = spark.createDataFrame([("k", "c", "1", "s", dt.date(2025, 1, 6), 3)], WEEKLY)
    r = S.weekly_stats(df, spark.createDataFrame([(1,)], "num_of_weeks long")).first()
    assert r.standard_deviation_of_weekly_demand is None and r.average_weekly_demand == 3


def test_z_matches_the_standard_library(spark):
    levels = spark.createDataFrame([(p,) for p in (0.5, 0.9, 0.95, 0.95, 0.99, 1.0, None)], "service_level double")
    got = {r.service_level: r.z for r in S.service_level_z(levels).collect()}
    assert got == {p: pytest.approx(NormalDist().inv_cdf(p)) for p in (0.5, 0.9, 0.95, 0.99)}


def test_final_rules(spark):
    cols = "annualized_demand double, annual_demand_threshold double, rounded_safety_stock_coverage long, ss_coverage_max double, average_weekly_demand double, rounded_safety_stock_units long"
    rows = [(10.0, 10.0, 9, 5.0, 1.0, 9), (11.0, 10.0, 5, 5.0, 0.5, 3), (11.0, 10.0, 4, 5.0, 2.0, 8),
            (11.0, None, None, None, 2.0, None), (11.0, 10.0, 4, 5.0, 0.0, 8)]
    got = [(r.final_safety_stock_units, r.final_safety_stock_coverage_weeks) for r in S.final_safety_stock(spark.createDataFrame(rows, cols)).collect()]
    # 5 · 0.5 = 2.5 rounds half-even to 2
    assert got == [(0, 0.0), (2, 4.0), (8, 4.0), (None, 0.0), (8, 0.0)]


def test_lead_time(spark):
    df = spark.createDataFrame([("8101.0", 9.0), ("8102", 3.0), (None, 2.0)], "sap_sc_code string, total_lead_time double")
    got = [(r.lead_time, r.lead_time_std) for r in S.assign_lead_time(df, 2.0, 0.25, 0.5).collect()]
    assert got == [(2.0, 0.5), (3.0, 1.5), (2.0, 1.0)]


def test_missing_service_level_gives_null(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0, 3.0, 0.5)], "service_level double, standard_deviation_of_weekly_demand double, average_weekly_demand double, lead_time double, lead_time_std double")
    z = spark.createDataFrame([(0.9, 1.28)], "service_level double, z double")
    assert S.raw_safety_stock(df, z).first().rounded_safety_stock_units is None
