"""Distribution tails for small result frames."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F, types as T


def upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * scale)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or tiny)
        c = b + an / c or tiny
        step = d * c
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return scale * h


@F.pandas_udf(T.DoubleType())
def chi2_tail(statistic: pd.Series, df: pd.Series) -> pd.Series:
    """P(X ≥ statistic) of a chi-square variable."""
    return pd.Series([
        None if pd.isna(s) or pd.isna(k) or k <= 0 else upper_gamma(k / 2.0, s / 2.0) for s, k in zip(statistic, df)])


# Response-surface coefficients of MacKinnon (1994) for the Dickey-Fuller t-ratio with a
# constant, one variable: polynomial in the t-ratio below and above the split, and the range ends.
DF_SPLIT, DF_MIN, DF_MAX = -1.61, -18.83, 2.74
DF_SMALL = [2.1659, 1.4412, 0.038269]
DF_LARGE = [1.7339, 0.93202, -0.12745, -0.010368]


def dickey_fuller_p(t: float) -> float:
    if t > DF_MAX:
        return 1.0
    if t < DF_MIN:
        return 0.0
    terms = DF_SMALL if t <= DF_SPLIT else DF_LARGE
    z = sum(c * t ** i for i, c in enumerate(terms))
    return 0.5 * math.erfc(-z / math.sqrt(2))
