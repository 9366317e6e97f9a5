"""Normal, Student t and chi-square probabilities for result rows.

Spark has no error function or gamma function, so these run in pandas UDFs over the few rows
that hold finished test statistics, never over user or event rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable
from statistics import NormalDist

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Python workers get these functions with the task and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ALTERNATIVES = ("two-sided", "greater", "less")


def check_alternative(alternative: str) -> str:
    if alternative not in ALTERNATIVES:
        raise ValueError(f"alternative must be one of {ALTERNATIVES}, got {alternative!r}")
    return alternative


def z_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def normal_sf(z: float) -> float:
    """P(Z > z)."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _beta_fraction(x: float, a: float, b: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz's method)."""
    floor = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > floor else floor)
    total = d
    for m in range(1, 10000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > floor else floor)
            c = 1.0 + step / c
            c = c if abs(c) > floor else floor
            total *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return total
    raise ArithmeticError(f"the incomplete beta function of {x}, {a}, {b} did not converge")


def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_fraction(x, a, b) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(1.0 - x, b, a) / b


def t_sf(t: float, df: float) -> float:
    """P(T > t) for Student's t."""
    if df > 1e5:
        # Hill's normalising transformation; the gamma functions would cancel here.
        a = df - 0.5
        w = math.sqrt(a * math.log1p(t * t / df))
        z = w + (w**3 + 3 * w) / (48 * a * a)
        return normal_sf(math.copysign(z, t))
    half = 0.5 * beta_cdf(df / (df + t * t), df / 2.0, 0.5)
    return half if t >= 0 else 1.0 - half


def t_quantile(p: float, df: float) -> float:
    """Value with P(T <= value) = p, by bisection."""
    if p < 0.5:
        return -t_quantile(1.0 - p, df)
    low, high = 0.0, 1.0
    while 1.0 - t_sf(high, df) < p:
        high *= 2.0
    for _ in range(200):
        middle = 0.5 * (low + high)
        if middle in (low, high):
            break
        low, high = (middle, high) if 1.0 - t_sf(middle, df) < p else (low, middle)
    return 0.5 * (low + high)


def chi2_sf(x: float, df: float) -> float:
    """P(X > x) for chi-square with `df` degrees of freedom."""
    if x <= 0.0:
        return 1.0
    a, y = df / 2.0, x / 2.0
    log_front = a * math.log(y) - y - math.lgamma(a)
    if y < a + 1.0:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= y / n
            total += term
        return 1.0 - total * math.exp(log_front)
    tiny = 1e-300
    b = y + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    total = d
    for i in range(1, 10000):
        step = -i * (i - a)
        b += 2.0
        d = step * d + b
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = b + step / c
        c = c if abs(c) > tiny else tiny
        total *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return math.exp(log_front) * total
    raise ArithmeticError(f"the chi-square probability of {x}, {df} did not converge")


def two_way(sf: Callable[[float], float], stat: float, alternative: str) -> float:
    """p-value of a symmetric statistic."""
    if alternative == "greater":
        return sf(stat)
    if alternative == "less":
        return sf(-stat)
    return min(1.0, 2.0 * sf(abs(stat)))


def _per_row(fn: Callable[..., float], *cols: pd.Series) -> pd.Series:
    rows = zip(*cols, strict=True)
    return pd.Series([None if any(pd.isna(v) for v in row) else fn(*row) for row in rows], dtype="float64")


def z_pvalue(z: Column, alternative: str = "two-sided") -> Column:
    check_alternative(alternative)

    @F.pandas_udf("double")
    def run(z: pd.Series) -> pd.Series:
        return _per_row(lambda v: two_way(normal_sf, v, alternative), z)

    return run(z)


def t_pvalue(t: Column, df: Column, alternative: str = "two-sided") -> Column:
    check_alternative(alternative)

    @F.pandas_udf("double")
    def run(t: pd.Series, df: pd.Series) -> pd.Series:
        return _per_row(lambda v, d: two_way(lambda s: t_sf(s, d), v, alternative), t, df)

    return run(t, df)


def t_critical(p: float, df: Column) -> Column:
    @F.pandas_udf("double")
    def run(df: pd.Series) -> pd.Series:
        return _per_row(lambda d: t_quantile(p, d), df)

    return run(df)


def chi2_pvalue(x: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def run(x: pd.Series, df: pd.Series) -> pd.Series:
        return _per_row(chi2_sf, x, df)

    return run(x, df)
