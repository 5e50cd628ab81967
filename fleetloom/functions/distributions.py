"""Normal quantiles as Columns, and tail probabilities for the one-row results of the statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import exp, inf, isnan, lgamma, log, log1p

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of a published rational approximation of the normal quantile, highest
# power first; its relative error stays below 1.2e-9.
CENTRAL_TOP = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02,
               -3.066479806614716e01, 2.506628277459239e00)
CENTRAL_BOTTOM = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01,
                  -1.328068155288572e01, 1.0)
TAIL_TOP = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00,
            4.374664141464968e00, 2.938163982698783e00)
TAIL_BOTTOM = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)
TAIL_FROM = 0.02425


def normal_quantile(p: Column) -> Column:
    """z with P(Z <= z) = p; NULL outside of (0, 1)."""

    def poly(coefficients: Sequence[float], x: Column) -> Column:
        return reduce(lambda value, c: value * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))

    middle = p - F.lit(0.5)
    central = middle * poly(CENTRAL_TOP, middle * middle) / poly(CENTRAL_BOTTOM, middle * middle)
    q = F.sqrt(F.lit(-2.0) * F.log(F.least(p, 1 - p)))
    tail = poly(TAIL_TOP, q) / poly(TAIL_BOTTOM, q)
    return F.when((p > 0) & (p < 1), F.when(p < TAIL_FROM, tail).when(p > 1 - TAIL_FROM, -tail).otherwise(central))


def beta_share(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_share(1 - x, b, a)
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log1p(-x)) / a
    total, c, d, i = 1.0, 1.0, 0.0, -1
    while True:  # the fraction converges for every x, a and b that reach this line
        i += 1
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / ((1 + term * d) or 1e-300)
        c = (1 + term / c) or 1e-300
        total *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * (total - 1)


def t_two_sided(t: float, df: float) -> float:
    if t is None or isnan(t) or df <= 0:
        return float("nan")
    return 0.0 if abs(t) == inf else beta_share(df / (df + t * t), df / 2, 0.5)


def f_upper(f: float, df1: float, df2: float) -> float:
    if f is None or isnan(f) or df2 <= 0:
        return float("nan")
    return beta_share(df2 / (df2 + df1 * f), df2 / 2, df1 / 2)
