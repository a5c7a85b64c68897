"""Autocorrelation and seasonal decomposition of daily series.

The input has one row per key and date, so a series is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def _series(keys: list[str], order: str):
    return Window.partitionBy(*(keys or [F.lit(0)])).orderBy(order)


def acf(daily: DataFrame, col: str, nlags: int = 40, keys: list[str] = (), order: str = "date") -> DataFrame:
    """Autocorrelation at lags 0 … nlags with the full-variance denominator, as ``(keys, lag, acf)``."""
    keys = list(keys)
    w = _series(keys, order)
    mean = F.avg(col).over(Window.partitionBy(*(keys or [F.lit(0)])))
    centred = daily.where(F.col(col).isNotNull()).withColumn("_c", F.col(col) - mean)
    lagged = centred.select(*keys, "_c", *[F.lag("_c", k).over(w).alias(f"_l{k}") for k in range(nlags + 1)])
    power = F.sum(F.col("_c") * F.col("_c"))
    one = lagged.groupBy(*keys).agg(*[
        F.try_divide(F.coalesce(F.sum(F.col("_c") * F.col(f"_l{k}")), F.lit(0.0)), power).alias(str(k))
        for k in range(nlags + 1)])
    names = [str(k) for k in range(nlags + 1)]
    return one.unpivot(keys, names, "lag", "acf").withColumn("lag", F.col("lag").cast("int"))


def _centred_average(col: str, period: int, w):
    half = period // 2
    if period % 2:
        frame = w.rowsBetween(-half, half)
        return F.when(F.count(col).over(frame) == period, F.avg(col).over(frame))
    frame = w.rowsBetween(-half, half)
    inner = F.sum(col).over(w.rowsBetween(-half + 1, half - 1))
    ends = F.lag(col, half).over(w) + F.lead(col, half).over(w)
    return F.when(F.count(col).over(frame) == period + 1, (inner + ends / 2) / period)


def decompose(daily: DataFrame, col: str, period: int = 7, keys: list[str] = (), order: str = "date",
              extrapolate: bool = False) -> DataFrame:
    """Classical additive decomposition: adds ``trend``, ``seasonal`` and ``resid``.

    The trend is a centred moving average, unknown at both ends unless ``extrapolate`` continues it by a
    line through its first and last ``period`` values.
    """
    keys = list(keys)
    w, whole = _series(keys, order), Window.partitionBy(*(keys or [F.lit(0)]))
    df = daily.select("*", F.row_number().over(w).alias("_i"), F.count("*").over(whole).alias("_count"),
                      _centred_average(col, period, w).alias("trend"))
    half = period // 2
    if extrapolate:
        head = F.col("_i").between(half + 1, half + period)
        tail = F.col("_i").between(F.col("_count") - half - period + 1, F.col("_count") - half)

        def line(part):
            y, x = F.when(part, F.col("trend")), F.when(part, F.col("_i").cast("double"))
            return F.regr_slope(y, x).over(whole), F.regr_intercept(y, x).over(whole)
        (s1, c1), (s2, c2) = line(head), line(tail)
        df = df.select("*", s1.alias("_s1"), c1.alias("_c1"), s2.alias("_s2"), c2.alias("_c2"))
        front = F.col("_i") <= half
        df = df.withColumn("trend", F.coalesce(
            "trend", F.when(front, F.col("_c1") + F.col("_s1") * F.col("_i")).otherwise(F.col("_c2") + F.col("_s2") * F.col("_i")))
        ).drop("_s1", "_c1", "_s2", "_c2")
    df = df.withColumn("_phase", (F.col("_i") - 1) % period)
    per_phase = Window.partitionBy(*keys, "_phase")
    df = df.withColumn("_mean", F.avg(F.col(col) - F.col("trend")).over(per_phase))
    # the phase means, each counted once: their rows in the first period
    centre = F.avg(F.when(F.col("_i") <= period, F.col("_mean"))).over(whole)
    df = df.withColumn("seasonal", F.col("_mean") - centre)
    return df.withColumn("resid", F.col(col) - F.col("trend") - F.col("seasonal")).drop("_i", "_count", "_phase", "_mean")


def strengths(decomposed: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Seasonal and trend strength from a decomposition."""
    seasonal = F.try_divide(F.var_pop("seasonal"), F.var_pop(F.col("seasonal") + F.col("resid")))
    trend = 1 - F.try_divide(F.var_pop("resid"), F.var_pop(F.col("trend") + F.col("resid")))
    return decomposed.groupBy(*keys).agg(seasonal.alias("seasonal_strength"), trend.alias("trend_strength"))
