"""Column expressions shared by the operators."""

from __future__ import annotations

from math import pi
from statistics import NormalDist

from pyspark.sql import Column, functions as F


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def weekday_monday0(date) -> Column:
    return F.weekday(date)


def cyclical_pair(col: str, period: float) -> list[Column]:
    angle = F.col(col) * (2 * pi) / F.lit(float(period))
    return [F.sin(angle).alias(f"{col}_sin"), F.cos(angle).alias(f"{col}_cos")]


def flag_name(prefix: str, value) -> str:
    return f"{prefix}_{str(value).replace(' ', '_')}"


def indicator(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def kolmogorov_p(distance: Column, n: Column, m: Column, terms: int = 20) -> Column:
    """Asymptotic two-sample p-value: the first terms of the Kolmogorov series."""
    lam2 = distance * distance * F.try_divide(n.cast("double") * m, (n + m).cast("double"))
    total = F.lit(0.0)
    for k in range(1, terms + 1):
        total = total + F.lit(2.0 * (-1) ** (k - 1)) * F.exp(-2.0 * k * k * lam2)
    # the alternating series does not converge near zero, where the p-value is 1
    return F.when(lam2 < 0.04, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)))


def jarque_bera(n: Column, skew: Column, excess: Column) -> Column:
    return n / 6.0 * (skew * skew + excess * excess / 4.0)
