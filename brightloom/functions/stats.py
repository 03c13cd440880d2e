"""Tail probabilities for one-row test results (numeric helpers, no data pass)."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz's method)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1), tiny)
    h = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta function."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def f_tail(f: float, d1: float, d2: float) -> float:
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def t_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def chi2_tail(x: float, df: float) -> float:
    """Upper tail by the series of the lower incomplete gamma function."""
    a, half = df / 2.0, x / 2.0
    if half <= 0:
        return 1.0
    term = total = 1.0 / a
    n = a
    while abs(term) > abs(total) * 1e-16:
        n += 1
        term *= half / n
        total += term
    return max(0.0, 1.0 - total * math.exp(-half + a * math.log(half) - math.lgamma(a)))


def _column(fn):
    @F.pandas_udf("double")
    def apply(*cols: pd.Series) -> pd.Series:
        return pd.Series([
            None if any(v is None or v != v for v in row) else fn(*row) for row in zip(*cols)
        ], dtype="float64")

    return apply


def f_test_p(f: Column, d1: Column, d2: Column) -> Column:
    return _column(f_tail)(f, d1.cast("double"), d2.cast("double"))


def correlation_p(r: Column, n: Column) -> Column:
    """Two-sided p of a correlation of n pairs; 0 for a perfect one."""
    df = (n - 2).cast("double")
    t = r * F.sqrt(df / F.nullif(1 - r * r, F.lit(0.0)))
    return F.when(F.abs(r) >= 1, 0.0).otherwise(_column(t_two_sided)(t, df))


def chi2_test_p(x: Column, df: Column) -> Column:
    return _column(chi2_tail)(x, df.cast("double"))
