"""Distribution tails that Spark has no built-in for.

They run on the tiny per-batch summary rows (one row per batch), as vectorised
pandas UDFs; never on the data rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x) (series below a+1, Lentz
    continued fraction above)."""
    if x is None or a is None or math.isnan(x) or a <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    log_pre = -x + a * math.log(x) - math.lgamma(a)
    if x < a + 1.0:
        term = total = 1.0 / a
        ap = a
        for _ in range(10000):
            ap += 1.0
            term *= x / ap
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        return max(0.0, 1.0 - total * math.exp(log_pre))
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-16:
            break
    return min(1.0, math.exp(log_pre) * h)


def chi2_sf_values(stat: np.ndarray, dof: np.ndarray) -> np.ndarray:
    return np.array([_gamma_q(k / 2.0, s / 2.0) if k > 0 else float("nan")
                     for s, k in zip(stat, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Chi-square survival function P(X >= stat) with ``dof`` degrees of freedom."""
    return pd.Series(chi2_sf_values(stat.to_numpy(dtype="float64"),
                                    dof.to_numpy(dtype="float64")))


#: Most rows of either side for which the two-sample KS tail is counted exactly.
EXACT_ROWS = 10_000


def ks_exact(h: int, n: int, m: int) -> float:
    """P(D >= h / (n*m)) of the two-sample KS statistic under equal distributions: one less the
    chance that a random lattice path from (0, 0) to (n, m) keeps |i*m - j*n| < h.

    Diagonal by diagonal (k = i + j): v is the chance to come to i inside the band, from which
    the next step raises i with the share of its steps among those left. Every number is a chance, so
    none overflows.
    """
    if h <= 0:
        return 1.0
    size = n + m
    v, lo = np.ones(1), 0
    for k in range(size):
        left = size - k
        i = np.arange(lo, lo + len(v))
        up = v * ((n - i) / left)
        step = np.append(v - up, 0.0)
        step[1:] += up
        # the i of the next diagonal inside the band: |i*(n+m) - (k+1)*n| < h
        first = max(lo, ((k + 1) * n - h) // size + 1, k + 1 - m)
        last = min(lo + len(step) - 1, ((k + 1) * n + h - 1) // size, n)
        if last < first:
            return 1.0
        v, lo = step[first - lo:last - lo + 1], first
    return float(min(1.0, max(0.0, 1.0 - v[n - lo])))


@F.pandas_udf(T.DoubleType())
def ks_exact_sf(stat: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """Exact tail of the two-sample KS statistic; null where the statistic is. For summary rows
    of sides up to EXACT_ROWS."""
    return pd.Series([None if s is None or math.isnan(s) else ks_exact(round(s * a * b), int(a), int(b))
                      for s, a, b in zip(stat, n, m)], dtype="float64")
