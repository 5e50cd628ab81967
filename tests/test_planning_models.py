"""Rolling backtests, prediction intervals, staged and stepwise models, counted freezes, repeated writes, packed ranks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetloom.operators import allocate as A
from fleetloom.operators import models as M
from fleetloom.operators import order_facts as O
from fleetloom.operators.ordered import first_per_key
from fleetloom.sources import tables as T


def line(rng, n, noise=1.0):
    x = [rng.uniform(0, 10) for _ in range(n)]
    return [(i, a, 3 + 2 * a + rng.gauss(0, noise)) for i, a in enumerate(x)]


def test_rolling_backtest_sees_only_earlier_periods(spark):
    rows = line(random.Random(1), 30) + [(30, None, 5.0), (31, 1.0, None)]
    df = spark.createDataFrame(rows, "month int, x double, y double").repartition(3)
    got = {(r.origin, r.ahead): r.predicted for r in M.rolling_backtest(df, "month", "y", "x", 8, 4).collect()}
    expected = {}
    for origin in range(8, 30):
        b, a = np.polyfit([r[1] for r in rows[:origin]], [r[2] for r in rows[:origin]], 1)
        for ahead in range(1, 5):
            if origin + ahead <= 30:
                expected[origin, ahead] = a + b * rows[origin + ahead - 1][1]
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(v) for k, v in expected.items())
    drift = {r.ahead: (r.mae, r.n) for r in M.error_drift(M.rolling_backtest(df, "month", "y", "x", 8, 4)).collect()}
    assert drift[4][1] == 19 and drift[1][0] == pytest.approx(
        np.mean([abs(rows[o][2] - expected[o, 1]) for o in range(8, 30)]))
    assert M.rolling_backtest(df, "month", "y", "x", 99, 2).count() == 0
    assert M.rolling_backtest(df.limit(0), "month", "y", "x", 2, 2).count() == 0


def test_prediction_interval_matches_matrices(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 3)) * [1, 50, 0.01] + [5, 1000, 0]
    y = x @ [2.0, 0.1, 30.0] + 7 + rng.normal(size=60)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    got = M.prediction_interval(df, df, "y", ["a", "b", "c"], 0.9).collect()
    full = np.column_stack([np.ones(60), x])
    beta, *_ = np.linalg.lstsq(full, y, rcond=None)
    s2 = ((y - full @ beta) ** 2).sum() / 56
    h = np.einsum("ij,jk,ik->i", full, np.linalg.inv(full.T @ full), full)
    width = 1.6448536269514722 * np.sqrt(s2 * (1 + h))
    for r, f, lev, w in zip(got, full @ beta, h, width):
        assert (r.fitted, r.leverage, r.lower, r.upper) == pytest.approx((f, lev, f - w, f + w), rel=1e-6)


def test_prediction_interval_covers_its_share(spark):
    rows = line(random.Random(5), 3000, noise=4.0)
    df = spark.createDataFrame(rows, "i int, x double, y double")
    train, held = df.filter("i < 1000"), df.filter("i >= 1000")
    r = M.prediction_interval(train, held, "y", ["x"], 0.8).agg(F.avg((F.col("y").between(F.col("lower"), F.col("upper"))).cast("double"))).first()[0]
    assert 0.77 < r < 0.83


def test_prediction_interval_without_a_fit(spark):
    two = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "x double, y double")
    same = spark.createDataFrame([(1.0, float(i)) for i in range(9)], "x double, y double")
    twice = same.withColumns({"x": F.col("y"), "z": 2 * F.col("y")})
    for df, xs in ((two, ["x"]), (same, ["x"]), (twice, ["x", "z"])):
        assert M.prediction_interval(df, df, "y", xs).filter("lower is not null or fitted is not null").isEmpty()


def test_two_stage_equals_two_fits(spark):
    rng = np.random.default_rng(3)
    spend, season = rng.uniform(0, 100, 80), rng.normal(size=80)
    leads = 5 + 0.4 * spend + rng.normal(size=80)
    orders = 2 * leads + 3 * season + rng.normal(size=80)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(spend, season, leads, orders)], "spend double, season double, leads double, orders double")
    model = M.two_stage(df, "orders", {"leads": ["spend"]}, ["season"])
    plan = df.select("spend", "season")  # neither leads nor orders are known
    got = [r.fitted for r in model.transform(plan).collect()]
    b, a = np.polyfit(spend, leads, 1)
    design = np.column_stack([np.ones(80), a + b * spend, season])
    beta, *_ = np.linalg.lstsq(design, orders, rcond=None)
    assert got == pytest.approx(list(design @ beta), rel=1e-6)


def literal_stepwise(x, y, enter, leave):
    """Names chosen by fitting every candidate; p by the normal equations and MLlib's t distribution."""
    from fleetloom.functions.distributions import t_two_sided

    def p_values(cols):
        d = np.column_stack([np.ones(len(y)), *[x[c] for c in cols]])
        beta, *_ = np.linalg.lstsq(d, y, rcond=None)
        free = len(y) - d.shape[1]
        s2 = ((y - d @ beta) ** 2).sum() / free
        se = np.sqrt(s2 * np.diag(np.linalg.inv(d.T @ d)))
        return dict(zip(cols, [t_two_sided(t, free) for t in (beta / se)[1:]]))

    chosen, seen = [], set()
    while len(chosen) < len(x):
        trials = {c: p_values([*chosen, c]) for c in x if c not in chosen}
        best = min(trials, key=lambda c: trials[c][c])
        if trials[best][best] >= enter or frozenset([*chosen, best]) in seen:
            break
        chosen = [*chosen, best]
        seen.add(frozenset(chosen))
        while len(chosen) > 1:
            p = p_values(chosen)
            worst = max(chosen, key=p.get)
            if p[worst] < leave:
                break
            chosen.remove(worst)
    return chosen


@pytest.mark.parametrize("seed", range(3))
def test_stepwise_equals_the_literal_search(spark, seed):
    rng = np.random.default_rng(seed)
    n = 60
    a, b, c, d = (rng.normal(size=n) for _ in range(4))
    x = {"mix": a + b + 0.3 * rng.normal(size=n), "a": a, "b": b, "c": c, "d": d}
    y = 2 * a + 2 * b + 0.5 * c + rng.normal(size=n)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*x.values(), y)], ", ".join(f"{k} double" for k in (*x, "y")))
    table = M.stepwise(df, "y", list(x), 0.1, 0.15)
    assert [r.term for r in table.collect()][:-1] == literal_stepwise(x, y, 0.1, 0.15)
    noise = df.withColumn("y", F.rand(seed))
    assert M.stepwise(noise, "y", ["c", "d"], 1e-9, 1e-9) is None
    with pytest.raises(ValueError):
        M.stepwise(df, "y", list(x), 0.2, 0.1)


def test_covered_counts_equal_the_loop(spark):
    rng = random.Random(8)
    planned = [(f"{2025 + i % 2}_{i}", f"m{i % 3}", rng.randrange(0, 6)) for i in range(20)]
    stock = [(c, rng.randrange(0, 5)) for c, _, _ in planned[::2]] + [("2025_other", 7), ("2026_bad", 9)]
    compliant = [c for c, _ in stock if c != "2026_bad"]
    year = F.split_part("config_string", F.lit("_"), F.lit(1))
    got = A.covered_counts(
        spark.createDataFrame(planned, "config_string string, model_powertrain string, added_volume long"),
        spark.createDataFrame(stock, "config_string string, n long"),
        spark.createDataFrame([(c,) for c in compliant], "config_string string"), year).collect()
    left = dict(stock)
    expected, waiting = {}, []
    for c, _, n in sorted(planned, key=lambda r: r[0] + "#"):
        if n:
            exact = min(n, left.get(c, 0))
            left[c] = left.get(c, 0) - exact
            expected[c] = exact
            waiting += [c] * (n - exact)
    pool = {y: sum(n for c, n in left.items() if c in compliant and c.startswith(y)) for y in ("2025", "2026")}
    for c in waiting:
        if pool[c[:4]]:
            pool[c[:4]] -= 1
            expected[c] += 1
    assert {r.config_string: r.covered for r in got} == expected and any(waiting)


def test_a_repeated_write_replaces_its_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "day int, v string")
    T.save_partitions(df, path, ["day"])
    T.save_partitions(spark.createDataFrame([(2, "d"), (3, "e")], "day int, v string"), path, ["day"])
    T.save_partitions(spark.createDataFrame([(2, "d"), (3, "e")], "day int, v string"), path, ["day"])
    T.save_partitions(df.limit(0), path, ["day"])
    got = T.load_file(spark, path, schema=df.schema).collect()
    assert sorted((r.day or 0, r.v) for r in got) == [(0, "n"), (1, "a"), (1, "b"), (2, "d"), (3, "e")]
    with pytest.raises(ValueError):
        T.save_partitions(df, path, [])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_version_without_sort_aggregates(spark):
    rng = random.Random(6)
    versions = [*O.VERSION_ORDER, None, "other"]
    rows = [(rng.choice([*range(30), None]), f"r{i:04d}", rng.choice(versions), rng.choice([None, 2023, 2024, 2025]), float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "oms_order_id long, row_id string, forecast_version string, forecast_version_year int, money double").repartition(5)
    got = O.latest_version(df)
    assert "SortAggregate" not in plan_of(got) and "HashAggregate" in plan_of(got)

    def rank(r):
        place = 0 if r[2] is None else O.VERSION_ORDER.index(r[2]) + 1 if r[2] in O.VERSION_ORDER else len(O.VERSION_ORDER) + 1
        return (r[3] is not None, -(r[3] or 0), place, r[1])

    best = {}
    for r in rows:
        if r[0] not in best or rank(r) < rank(best[r[0]]):
            best[r[0]] = r
    assert sorted(map(str, map(tuple, got.select(*df.columns).collect()))) == sorted(map(str, best.values()))


def test_first_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([(k % 3 if k else None, None if k % 7 == 0 else k, f"v{k}") for k in range(100)], "k int, o int, v string").repartition(4)
    got = first_per_key(df, ["k"], ["o", "v"])
    plan = plan_of(got)
    assert "SortAggregate" not in plan and plan.count("WindowGroupLimit") == 2
    assert sorted((r.k if r.k is not None else -1, r.v) for r in got.collect()) == [(-1, "v0"), (0, "v21"), (1, "v28"), (2, "v14")]
