"""Correlation and linear models of order volume.

All passes over rows are Spark aggregates or MLlib fits; only coefficients and sums of a few
columns reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations
from math import exp, log, pi
from statistics import NormalDist

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetloom.functions.distributions import f_upper, t_two_sided
from fleetloom.sources.tables import inline_table


def correlate(df: DataFrame, x: str, y: str, level: float = 0.05) -> DataFrame:
    """Pearson r with t, two-sided p and the verdict, as one row."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    r, n = both.agg(F.corr(x, y), F.count(F.lit(1))).first()
    t = p = None
    if r is not None and n > 2:
        t = float("inf") if abs(r) >= 1 else r * ((n - 2) / (1 - r * r)) ** 0.5
        p = t_two_sided(t, n - 2)
    row = (r, n, t, p, None if p is None else p < level)
    return inline_table(df.sparkSession, [row], "r double, n long, t double, p_value double, significant boolean")


def correlation_matrix(df: DataFrame, cols: Sequence[str], threshold: float = 0.7) -> DataFrame:
    """Pairwise r in long form from one aggregate; pairs above ``threshold`` are flagged."""
    pairs = list(combinations(cols, 2))
    # A pair uses the rows where both of its values are known.
    sums = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs])
    return sums.select(F.inline(rows)).withColumn("high", F.abs("r") > threshold)


def simple_ols(df: DataFrame, x: str, y: str) -> DataFrame:
    """y on x as one row: coefficients, standard error, t, p, R² and adjusted R²."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    b, a, r2, n, sxx, syy = both.agg(
        F.regr_slope(y, x), F.regr_intercept(y, x), F.regr_r2(y, x), F.count(F.lit(1)),
        F.regr_sxx(y, x), F.regr_syy(y, x),
    ).first()
    # Two points or fewer leave no error, a perfect fit no t: what is undefined is NULL.
    se = ((1 - r2) * syy / (n - 2) / sxx) ** 0.5 if n > 2 and sxx and r2 is not None else None
    t = b / se if se else None
    p = t_two_sided(t, n - 2) if t is not None else None
    adjusted = 1 - (1 - r2) * (n - 1) / (n - 2) if n > 2 and r2 is not None else None
    row = (a, b, se, t, p, r2, adjusted, n)
    schema = "intercept double, slope double, slope_se double, t double, p_value double, r2 double, adj_r2 double, n long"
    return inline_table(df.sparkSession, [row], schema)


def _assembled(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    known = df.dropna(subset=[y, *xs]).withColumn(y, F.col(y).cast("double"))
    return VectorAssembler(inputCols=list(xs), outputCol="features").transform(known)


def fit_ols(df: DataFrame, y: str, xs: Sequence[str]) -> LinearRegressionModel:
    return LinearRegression(labelCol=y, solver="normal", predictionCol="fitted").fit(_assembled(df, y, xs))


def multiple_ols(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Coefficient table: term, coefficient, standard error, t and p (intercept last)."""
    model = fit_ols(df, y, xs)
    s = model.summary
    rows = zip(
        [*xs, "const"], [*map(float, model.coefficients), float(model.intercept)],
        s.coefficientStandardErrors, s.tValues, s.pValues,
    )
    return inline_table(df.sparkSession, 
        [tuple(r) for r in rows], "term string, coefficient double, std_err double, t double, p_value double"
    )


def residuals(df: DataFrame, y: str, xs: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Fitted value and residual of every row."""
    fitted = fit_ols(df, y, xs).transform(_assembled(df, y, xs))
    return fitted.select(*keep, y, "fitted", (F.col(y) - F.col("fitted")).alias("residual"))


def fit_diagnostics(df: DataFrame, y: str, xs: Sequence[str], order: str) -> DataFrame:
    """Fit statistics in long form: R², F, likelihood, information criteria, residual shape,
    Durbin-Watson along ``order`` and the condition number of the design. NULL where a statistic is not
    defined: without degrees of freedom, without variance, or for a perfect fit."""
    res = residuals(df, y, xs, [order, *xs])
    step = F.col("residual") - F.lag("residual").over(Window.orderBy(order))
    n, sse, syy, dw, skew, kurt = res.withColumn("step", step).agg(
        F.count(F.lit(1)), F.sum(F.col("residual") ** 2), F.var_pop(y) * F.count(F.lit(1)),
        F.sum(F.col("step") ** 2), F.skewness("residual"), F.kurtosis("residual") + 3,
    ).first()
    k = len(xs)
    free = n - k - 1
    r2 = 1 - sse / syy if syy else None
    varied = bool(sse) and free > 0  # residuals that estimate a variance
    f = (r2 / k) / ((1 - r2) / free) if varied and r2 is not None and r2 < 1 else None
    loglik = -n / 2 * (log(2 * pi) + log(sse / n) + 1) if sse else None
    jb = n / 6 * (skew ** 2 + (kurt - 3) ** 2 / 4) if sse and skew is not None and kurt is not None else None
    values = {
        "n": n, "r2": r2, "adj_r2": 1 - (1 - r2) * (n - 1) / free if r2 is not None and free > 0 else None, "f": f,
        "f_p_value": f_upper(f, k, free) if f is not None else None, "log_likelihood": loglik,
        "aic": 2 * (k + 1) - 2 * loglik if loglik is not None else None,
        "bic": (k + 1) * log(n) - 2 * loglik if loglik is not None else None,
        "durbin_watson": dw / sse if sse and dw is not None else None, "jarque_bera": jb,
        "jarque_bera_p_value": exp(-jb / 2) if jb is not None else None,
        "skew": skew, "kurtosis": kurt, "condition_number": _condition_number(res, xs),
    }
    rows = [(name, None if v is None else float(v)) for name, v in values.items()]
    return inline_table(df.sparkSession, rows, "statistic string, value double")


def _condition_number(df: DataFrame, xs: Sequence[str]) -> float:
    """From the (k + 1)² sums of products of the design columns."""
    cols = [F.lit(1.0), *[F.col(x).cast("double") for x in xs]]
    sums = df.agg(*[F.sum(a * b) for a in cols for b in cols]).first()
    values = np.linalg.eigvalsh(np.array(sums, dtype=float).reshape(len(cols), len(cols)))
    return float(np.sqrt(values[-1] / max(values[0], 1e-300)))


def lasso_select(df: DataFrame, y: str, xs: Sequence[str], alpha: float = 100.0) -> DataFrame:
    """Lasso on standardised predictors: coefficient (standardised) and whether it survives."""
    data = _assembled(df, y, xs)
    model = LinearRegression(
        labelCol=y, elasticNetParam=1.0, regParam=alpha, standardization=True, maxIter=1000, tol=1e-10
    ).fit(data)
    spread = df.dropna(subset=[y, *xs]).agg(*[F.stddev_pop(x) for x in xs]).first()
    rows = [(x, float(b) * float(s), bool(b != 0)) for x, b, s in zip(xs, model.coefficients, spread)]
    return inline_table(df.sparkSession, rows, "feature string, coefficient double, selected boolean")


def selected_ols(df: DataFrame, y: str, xs: Sequence[str], alpha: float = 100.0) -> DataFrame | None:
    """OLS refit on the predictors that Lasso keeps; None if it keeps none."""
    kept = [r["feature"] for r in lasso_select(df, y, xs, alpha).collect() if r["selected"]]
    return multiple_ols(df, y, kept) if kept else None


def backward_elimination(df: DataFrame, y: str, xs: Sequence[str], level: float = 0.05) -> DataFrame:
    """Refit without the least significant predictor until all are below ``level``."""
    left = list(xs)
    while True:
        table = multiple_ols(df, y, left)
        worst = max((r for r in table.collect() if r["term"] != "const"), key=lambda r: r["p_value"])
        if worst["p_value"] < level or len(left) == 1:
            return table
        left.remove(worst["term"])


def linear_score(intercept: float, weights: Mapping[str, float]) -> Column:
    """The fitted equation as an expression over scenario columns."""
    score = F.lit(intercept)
    for col, weight in weights.items():
        score = score + F.lit(weight) * F.col(col)
    return score


def mean_absolute_error(df: DataFrame, y: str, predicted: str, period: Column) -> DataFrame:
    return df.groupBy(period.alias("period")).agg(
        F.avg(F.abs(F.col(y) - F.col(predicted))).alias("mae"), F.count(F.lit(1)).alias("n")
    )


def rolling_backtest(df: DataFrame, time: str, y: str, x: str, min_train: int, horizon: int) -> DataFrame:
    """Errors of y on x when only earlier periods are known: (origin, ahead, actual, predicted).

    Every row is laid out to the origins that may train on it or that it tests (``horizon`` periods from
    the origin on), and one aggregate per origin fits the line from its training rows. ``df`` has a row
    per ``time``; an origin has at least ``min_train`` of them before it. Origins without a line (one
    value of x) predict nothing.
    """
    known = df.select(time, F.col(y).cast("double").alias("_y"), F.col(x).cast("double").alias("_x")).dropna()
    at = known.groupBy(time).agg(F.first("_y").alias("_y"), F.first("_x").alias("_x"))
    # One row per period, so the global order is as small as the calendar.
    placed = at.withColumn("_n", F.row_number().over(Window.orderBy(time)).cast("long"))
    last = placed.agg(F.max("_n")).first()[0] or 0
    laid = placed.filter(F.col("_n") < last).withColumn(
        "origin", F.explode(F.filter(F.sequence(F.col("_n"), F.lit(last - 1)), lambda o: o >= min_train)))
    fitted = laid.groupBy("origin").agg(F.regr_slope("_y", "_x").alias("_b"), F.regr_intercept("_y", "_x").alias("_a"))
    tested = placed.filter(F.col("_n") > min_train).withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn("origin", F.col("_n") - F.col("ahead"))
    return tested.join(fitted.dropna(), "origin").select(
        "origin", "ahead", F.col(time), F.col("_y").alias("actual"), (F.col("_a") + F.col("_b") * F.col("_x")).alias("predicted"))


def error_drift(errors: DataFrame) -> DataFrame:
    """Mean absolute and mean signed error by how far ahead the prediction is."""
    e = F.col("actual") - F.col("predicted")
    return errors.groupBy("ahead").agg(F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias"), F.count(F.lit(1)).alias("n"))


def prediction_interval(train: DataFrame, df: DataFrame, y: str, xs: Sequence[str], share: float = 0.95) -> DataFrame:
    """``df`` with fitted, leverage, lower and upper of an OLS fit on ``train``.

    One aggregate gives the cross products of (1, xs, y) around the means; the inverse of the k by k part
    becomes an expression, so rows are scored where they are. The bounds hold a new observation with
    probability ``share`` under the normal limit of the t distribution. NULL where the fit leaves no
    degree of freedom or the predictors are collinear.
    """
    cols = [*xs, y]
    known = train.dropna(subset=cols).select(*[F.col(c).cast("double").alias(c) for c in cols])
    means = known.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols]).first()
    n, k = means["n"], len(xs)
    none = {c: F.lit(None).cast("double") for c in ("fitted", "leverage", "lower", "upper")}
    if n <= k + 1:
        return df.withColumns(none)
    apart = {c: F.col(c) - F.lit(means[c]) for c in cols}
    sums = known.agg(*[F.sum(apart[a] * apart[b]).alias(f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j]).first()
    cross = np.array([[sums[f"{min(i, j)}_{max(i, j)}"] for j in range(k + 1)] for i in range(k + 1)])
    xx = cross[:k, :k]
    scale = np.sqrt(np.diag(xx))
    if not scale.all() or np.linalg.matrix_rank(xx / np.outer(scale, scale), tol=1e-9) < k:
        return df.withColumns(none)
    inverse = np.linalg.inv(xx / np.outer(scale, scale)) / np.outer(scale, scale)
    slopes = inverse @ cross[:k, k]
    variance = (cross[k, k] - slopes @ cross[:k, k]) / (n - k - 1)
    moved = [F.col(c).cast("double") - F.lit(means[c]) for c in xs]
    fitted = sum((F.lit(float(b)) * m for b, m in zip(slopes, moved)), F.lit(means[y]))
    leverage = sum((F.lit(float(inverse[i, j])) * moved[i] * moved[j] for i in range(k) for j in range(k)), F.lit(1.0 / n))
    z = NormalDist().inv_cdf((1 + share) / 2)
    width = z * F.sqrt(F.lit(max(float(variance), 0.0)) * (1 + F.col("leverage")))
    return df.withColumns({"fitted": fitted, "leverage": leverage}).withColumns({"lower": F.col("fitted") - width, "upper": F.col("fitted") + width})


def two_stage(df: DataFrame, y: str, drivers: Mapping[str, Sequence[str]], xs: Sequence[str] = ()) -> PipelineModel:
    """Driver models that feed a main model, as one fitted pipeline.

    Every driver is regressed on its own predictors; y is then regressed on the fitted drivers
    (``<driver>_fitted``) and ``xs``. Where only the drivers' predictors are known, as in a plan, the pipeline
    still gives ``fitted``. Rows that lack any input are left out of the fit.
    """
    inputs = sorted({y, *xs, *drivers, *(c for own in drivers.values() for c in own)})
    known = df.dropna(subset=inputs).select("*", *[F.col(c).cast("double").alias(f"_{c}") for c in (y, *drivers)])
    stages = []
    for driver, own in drivers.items():
        stages += [
            VectorAssembler(inputCols=list(own), outputCol=f"_{driver}_features", handleInvalid="skip"),
            LinearRegression(featuresCol=f"_{driver}_features", labelCol=f"_{driver}", predictionCol=f"{driver}_fitted", solver="normal"),
        ]
    stages += [
        VectorAssembler(inputCols=[*(f"{d}_fitted" for d in drivers), *xs], outputCol="_main_features", handleInvalid="skip"),
        LinearRegression(featuresCol="_main_features", labelCol=f"_{y}", predictionCol="fitted", solver="normal"),
    ]
    return Pipeline(stages=stages).fit(known)


def _correlations(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    pairs = list(combinations(range(len(cols)), 2))
    found = df.agg(*[F.corr(cols[i], cols[j]).alias(f"{i}_{j}") for i, j in pairs]).first()
    r = np.eye(len(cols))
    for i, j in pairs:
        r[i, j] = r[j, i] = found[f"{i}_{j}"] if found[f"{i}_{j}"] is not None else 0.0
    return r


def stepwise(df: DataFrame, y: str, xs: Sequence[str], enter: float = 0.05, leave: float = 0.1, both: bool = True) -> DataFrame | None:
    """The regression table after forward (``both``: two-way) selection; None if no predictor enters.

    One aggregate gives all correlations. The next candidate is the predictor with the largest partial
    correlation with y, given those chosen; it enters if its p is below ``enter`` in the fit. With ``both``,
    chosen ones whose p is ``leave`` or more go, the worst first. Ties go to the earlier name.
    """
    if enter > leave:
        raise ValueError("a predictor that may enter must be allowed to stay: enter <= leave")
    cols = [y, *xs]
    known = df.dropna(subset=cols).select(*[F.col(c).cast("double").alias(c) for c in cols])
    r = _correlations(known, cols)
    place = {c: i for i, c in enumerate(cols)}
    chosen: list[str] = []
    table, seen = None, set()

    def partial(c: str) -> float:
        at = [0, place[c], *(place[x] for x in chosen)]
        p = np.linalg.pinv(r[np.ix_(at, at)])
        return abs(p[0, 1]) / (p[0, 0] * p[1, 1]) ** 0.5 if p[0, 0] > 0 and p[1, 1] > 0 else 0.0

    def p_values(t: DataFrame) -> dict[str, float]:
        return {row["term"]: row["p_value"] for row in t.collect() if row["term"] != "const"}

    while len(chosen) < len(xs):
        best = max((c for c in xs if c not in chosen), key=partial)
        trial = multiple_ols(known, y, [*chosen, best])
        p = p_values(trial)
        if not p[best] < enter or frozenset([*chosen, best]) in seen:
            break
        chosen, table = [*chosen, best], trial
        seen.add(frozenset(chosen))
        while both and len(chosen) > 1:
            worst = max(chosen, key=lambda c: p[c])
            if p[worst] < leave:
                break
            chosen = [c for c in chosen if c != worst]
            table = multiple_ols(known, y, chosen)
            p = p_values(table)
    return table
