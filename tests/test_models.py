import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetloom.functions.distributions import f_upper, t_two_sided
from fleetloom.operators import models as M
from fleetloom.operators import order_facts as O

# Eight placeholder months: orders, discount, spend, clicks.
MONTHS = [
    (2000, 1500, 50000, 10000), (2200, 1600, 55000, 12000), (2500, 1800, 85000, 15000), (2300, 1700, 60000, 13000),
    (2800, 2000, 90000, 18000), (2600, 1900, 80000, 16000), (3000, 2200, 95000, 19000), (3200, 2400, 100000, 21000),
]


@pytest.fixture
def months(spark):
    rows = [(dt.date(2024, i, 1), *map(float, m)) for i, m in enumerate(MONTHS, 1)]
    return spark.createDataFrame(rows, "m date, y double, a double, b double, c double")


def ols(cols):
    data = np.array(MONTHS, dtype=float)
    x = np.column_stack([np.ones(len(data)), data[:, cols]])
    y = data[:, 0]
    beta = np.linalg.solve(x.T @ x, x.T @ y)
    res = y - x @ beta
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * (res @ res) / (len(y) - x.shape[1]))
    return x, y, beta, se, res


def test_simple_and_multiple_ols(spark, months):
    _, y, beta, se, res = ols([1])
    r = M.simple_ols(months, "a", "y").first()
    assert (r.intercept, r.slope, r.slope_se) == pytest.approx((beta[0], beta[1], se[1]))
    assert r.r2 == pytest.approx(1 - res @ res / ((y - y.mean()) ** 2).sum())
    _, _, beta, se, _ = ols([1, 2])
    table = {t.term: t for t in M.multiple_ols(months, "y", ["a", "b"]).collect()}
    assert [table[t].coefficient for t in ("const", "a", "b")] == pytest.approx(list(beta), rel=1e-6)
    assert [table[t].std_err for t in ("const", "a", "b")] == pytest.approx(list(se), rel=1e-5)
    # The p-values of MLlib and of the tail functions agree.
    assert table["a"].p_value == pytest.approx(t_two_sided(table["a"].t, 5), rel=1e-6)


def test_diagnostics(spark, months):
    x, y, beta, _, res = ols([1, 2])
    d = {r.statistic: r.value for r in M.fit_diagnostics(months, "y", ["a", "b"], "m").collect()}
    n = len(y)
    assert d["durbin_watson"] == pytest.approx((np.diff(res) ** 2).sum() / (res @ res), rel=1e-5)
    assert d["log_likelihood"] == pytest.approx(-n / 2 * (np.log(2 * np.pi * (res @ res) / n) + 1), rel=1e-6)
    z = res / res.std()
    assert (d["skew"], d["kurtosis"]) == pytest.approx(((z ** 3).mean(), (z ** 4).mean()), rel=1e-4)
    assert d["condition_number"] == pytest.approx(np.linalg.cond(x), rel=1e-2)
    assert d["f_p_value"] == pytest.approx(f_upper(d["f"], 2, n - 3))


def test_tails_against_known_values():
    assert t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert t_two_sided(0.0, 3) == pytest.approx(1.0)
    assert t_two_sided(-12.7062, 1) == pytest.approx(0.05, abs=1e-6)
    assert f_upper(4.964603, 1, 10) == pytest.approx(0.05, abs=1e-6)
    assert f_upper(3.885294, 2, 12) == pytest.approx(0.05, abs=1e-6)


def test_correlation(spark, months):
    data = np.array(MONTHS, dtype=float)
    r = M.correlate(months, "a", "y").first()
    want = np.corrcoef(data[:, 1], data[:, 0])[0, 1]
    assert r.r == pytest.approx(want) and r.n == 8 and r.significant
    assert r.p_value == pytest.approx(M.simple_ols(months, "a", "y").first().p_value, rel=1e-6)
    matrix = {(x.a, x.b): x.r for x in M.correlation_matrix(months, ["y", "a", "b"]).collect()}
    assert matrix[("y", "a")] == pytest.approx(want) and len(matrix) == 3


def test_lasso_equals_coordinate_descent(spark, months):
    data = np.array(MONTHS, dtype=float)
    x, y = data[:, 1:], data[:, 0] - data[:, 0].mean()
    x = (x - x.mean(0)) / x.std(0)
    beta, alpha = np.zeros(3), 100.0
    for _ in range(20000):
        for j in range(3):
            rho = x[:, j] @ (y - x @ beta + x[:, j] * beta[j]) / len(y)
            beta[j] = np.sign(rho) * max(abs(rho) - alpha, 0)
    got = {r.feature: r for r in M.lasso_select(months, "y", ["a", "b", "c"], alpha).collect()}
    assert [got[f].coefficient for f in "abc"] == pytest.approx(list(beta), abs=1.0)
    kept = [f for f in "abc" if got[f].selected]
    assert kept and {t.term for t in M.selected_ols(months, "y", ["a", "b", "c"], alpha).collect()} == {*kept, "const"}


def test_scenario_equation(spark):
    df = spark.createDataFrame([(3000.0, 75000.0, 0)], "d double, s double, h int")
    assert df.select(M.linear_score(1850, {"d": 0.21, "s": 0.04, "h": 500})).first()[0] == pytest.approx(5480)


def test_versions(spark):
    rows = [(1, "r1", "0+12", 2025), (1, "r2", "12+0", 2025), (1, "r3", "12+0", 2024), (2, "r4", None, None), (2, "r5", "12+0", 2026),
            (3, "r7", "9+3", 2024), (3, "r6", "9+3", 2024)]
    df = spark.createDataFrame(rows, "oms_order_id int, row_id string, forecast_version string, forecast_version_year int")
    assert {r.oms_order_id: r.row_id for r in O.latest_version(df).collect()} == {1: "r2", 2: "r4", 3: "r6"}
    ranks = {(r.forecast_version, r.forecast_version_year): r.forecast_version_rank for r in O.version_ranking(df).collect()}
    assert ranks[(None, None)] == 1 and ranks[("12+0", 2026)] == 2 and ranks[("12+0", 2025)] == 3


def test_money_and_rollup(spark):
    df = spark.createDataFrame([(1, 5.0, 2.0, None, -3.0, None, None, 4.0, None, 1.5)], "oms_order_id int, revenue double, base_price double, options double, total_discount double,"
                               " referral_discount double, price_adjustments double, lease_down_payment_credit double, lease_subvention double, apr_subvention double")
    r = O.normalize_money(df).first()
    assert (r.total_price, r.base_price, r.total_discount, r.referral_discount) == (0.0, 2.0, 3.0, 0.0)
    fact = spark.createDataFrame([(1, dt.date(2025, 1, 1), 2.0), (1, dt.date(2025, 1, 1), 3.0), (2, None, 1.0), (3, dt.date(2025, 1, 1), None)],
                                 "order_id int, order_month date, total_discount double")
    assert [tuple(r) for r in O.period_rollup(fact).collect()] == [(dt.date(2025, 1, 1), 2, 2.0)]  # 2.5 rounds half-even


def test_row_totals_count_totals_twice(spark):
    df = spark.createDataFrame([(1, 2, None)], "leads_web int, leads_total int, spend_x int")
    assert O.row_totals(df).first().total_leads == 3
    assert O.row_totals(df, exclude_totals=True).first().total_leads == 1
    assert O.row_totals(df).first().total_spend == 0


def test_lag_and_holiday(spark):
    df = spark.createDataFrame([(dt.date(2025, m, 1), float(m)) for m in range(1, 13)], "order_month date, s double")
    got = O.lag_features(df, ["s"], 3).orderBy("order_month").collect()
    assert len(got) == 9 and got[0].s_lag_3 == 1.0
    assert df.agg(F.sum(O.holiday_flag())).first()[0] == 3


def test_diagnostics_without_degrees_of_freedom(spark):
    """As many rows as coefficients, and a y that does not vary: no statistic that divides by them."""
    two = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 5.0)], "t int, x double, y double")
    got = {r.statistic: r.value for r in M.fit_diagnostics(two, "y", ["x"], "t").collect()}
    assert got["n"] == 2 and got["f"] is None and got["f_p_value"] is None and got["adj_r2"] is None
    assert abs(got["r2"] - 1) < 1e-9 and got["condition_number"] > 1
    flat = spark.createDataFrame([(i, float(i), 3.0) for i in range(6)], "t int, x double, y double")
    got = {r.statistic: r.value for r in M.fit_diagnostics(flat, "y", ["x"], "t").collect()}
    assert got["n"] == 6 and got["r2"] is None and got["f"] is None
