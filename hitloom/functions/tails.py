"""Two-sided p-values, for tables with one row per feature."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = a * math.log(x) + b * math.log1p(-x) - math.log(a)
    front += math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    c, d, value = 1.0, 0.0, 1.0
    for step in range(1, 1000):
        m = step // 2
        if step % 2:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        c = (1.0 + term / c) or 1e-300
        d = 1.0 / ((1.0 + term * d) or 1e-300)
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return math.exp(front) / value


def student_two_sided(t: float, df: float) -> float:
    return incomplete_beta(df / 2, 0.5, df / (df + t * t))


def _each(function):
    def call(*columns: pd.Series) -> pd.Series:
        rows = zip(*columns)
        found = [function(*r) if all(pd.notna(x) for x in r) else None for r in rows]
        return pd.Series(found, dtype="float64")

    return call


def student_p(t, df):
    """Two-sided p-value of a t statistic."""
    call = _each(student_two_sided)

    @F.pandas_udf("double")
    def p(a: pd.Series, b: pd.Series) -> pd.Series:
        return call(a, b)

    return p(t, df)


def u_distribution(m: int, n: int) -> np.ndarray:
    """P(U = u) for u = 0..m n under the null hypothesis, without ties: by Gauss' product, factor by factor."""
    m, n = min(m, n), max(m, n)
    f = np.zeros(m * n + 1)
    f[0] = 1.0
    for i in range(1, m + 1):
        f[n + i :] -= f[: max(0, len(f) - n - i)].copy()
        for r in range(i):
            f[r::i] = np.cumsum(f[r::i])
        f *= i / (n + i)  # so that the values stay shares
    return np.maximum(f, 0.0)


def u_two_sided(u: float, m: int, n: int) -> float:
    """Exact two-sided p-value of Mann-Whitney's U."""
    tail = u_distribution(m, n)[: math.floor(min(u, m * n - u)) + 1].sum()
    return float(min(1.0, 2 * tail))


def u_p(u, n_pos, n_neg, exact, z):
    """Two-sided p-value of U: by its own law where ``exact``, else from z."""

    @F.pandas_udf("double")
    def p(a: pd.Series, m: pd.Series, n: pd.Series, own: pd.Series, b: pd.Series) -> pd.Series:
        found = [
            None if pd.isna(x) else u_two_sided(x, int(i), int(j)) if e else None if pd.isna(v) else math.erfc(abs(v) / math.sqrt(2.0))
            for x, i, j, e, v in zip(a, m, n, own, b)
        ]
        return pd.Series(found, dtype="float64")

    return p(u, n_pos, n_neg, exact, z)
