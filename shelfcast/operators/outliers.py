"""Outlier rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import percent
from .clean import attach_stats, beside
from .ordered import quantile_columns

QUARTILES = {"q1": 0.25, "q3": 0.75}


def _summary(df: DataFrame, col: str, outside) -> DataFrame:
    hit = F.when(outside, F.col(col))
    return df.where(F.col(col).isNotNull()).agg(
        F.count(hit).alias("total_outliers"),
        percent(F.count(hit), F.count("*")).alias("outlier_percentage"),
        F.avg(hit).alias("outlier_mean"),
        F.stddev_samp(hit).alias("outlier_std"))


def iqr_bounds(df: DataFrame, col: str) -> DataFrame:
    """One row ``(low, high)``: 1.5 interquartile ranges beyond the quartiles."""
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return quantile_columns(df, col, QUARTILES).select((F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))


def outliers(df: DataFrame, col: str, method: str = "zscore", threshold: float = 3.0) -> DataFrame:
    """Count, share, mean and sample deviation of the outlying values."""
    if method == "zscore":
        spread = attach_stats(df, [], _mean=F.avg(col), _std=F.stddev_pop(col))
        z = F.abs(F.try_divide(F.col(col) - F.col("_mean"), F.col("_std")))
        return _summary(spread, col, z > threshold)
    if method == "iqr":
        return _summary(beside(df.select(col), iqr_bounds(df, col)), col,
                        (F.col(col) < F.col("low")) | (F.col(col) > F.col("high")))
    raise ValueError(f"unknown method {method!r}")


def outlier_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """IQR outliers of several columns, as ``(column, outliers, percentage)``."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    bounds = quantile_columns(long, "value", QUARTILES, ["column"]).select(
        "column", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))
    # one row per column name
    marked = long.join(F.broadcast(bounds), "column")
    hits = F.count_if((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")))
    return marked.groupBy("column").agg(hits.alias("outliers"), percent(hits, F.count("*")).alias("percentage"))


def outlier_rows(df: DataFrame, col: str, keys: list[str], threshold: float = 3.0) -> DataFrame:
    """Rows whose z-score within their key exceeds the threshold."""
    from .windows import zscores
    return zscores(df, col, keys).where(F.col("zscore") > threshold)
