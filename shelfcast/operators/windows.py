"""Lag, rolling, trend and sequence features over ordered series."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from .clean import attach_stats
from .encode import cyclical

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Series:
    """How rows form series and in which order.

    With one row per key and date, a series is bounded by the calendar and one window partition holds it.
    Longer series (finer time stamps, or a key with a large share of all rows) set ``block_rows``: the
    series is then cut into blocks of that many rows which carry copies of their neighbours' edge rows,
    so the results are the same and no task sees more than one block.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...] = ("date",)
    block_rows: int | None = None
    chunk: str = "month"


STORE_FAMILY = Series(("store_nbr", "family"))


def with_positions(df: DataFrame, series: Series) -> DataFrame:
    """0-based ``_pos`` of each row in its series, without sorting a whole series in one task.

    Rows are numbered inside each time chunk and shifted by the sizes of the chunks before it.
    """
    keys = list(series.keys)
    cut = df.withColumn("_chunk", F.date_trunc(series.chunk, series.order[0]))
    sizes = cut.groupBy(*keys, "_chunk").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*series.order)
    return (
        cut.join(offsets, [*keys, "_chunk"])
        .withColumn("_pos", F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_chunk", "_before")
    )


def over_series(df: DataFrame, series: Series, build: Callable[[WindowSpec], list[Column]],
                before: int = 0, after: int = 0) -> DataFrame:
    """Adds the columns ``build`` makes for the series' window. ``before`` and ``after`` say how far, in
    rows, any frame reaches."""
    if series.block_rows is None:
        return df.select("*", *build(Window.partitionBy(*series.keys).orderBy(*series.order)))
    size = series.block_rows
    if max(before, after) > size:
        raise ValueError("block_rows must not be smaller than the reach of the frames")
    placed = with_positions(df, series)
    home, offset = F.floor(F.col("_pos") / size), F.col("_pos") % size
    homes = F.array(home, F.when(offset >= size - before, home + 1), F.when((offset < after) & (home > 0), home - 1))
    copied = placed.withColumn("_block", F.explode(F.array_compact(homes)))
    w = Window.partitionBy(*series.keys, "_block").orderBy("_pos")
    return (
        copied.select("*", *build(w))
        .where(F.col("_block") == F.floor(F.col("_pos") / size))
        .drop("_block", "_pos")
    )


def lag_columns(w: WindowSpec, col: str, periods) -> list[Column]:
    return [F.lag(col, n).over(w).alias(f"{col}_lag_{n}") for n in periods]


def trailing(w: WindowSpec, width: int) -> WindowSpec:
    return w.rowsBetween(-(width - 1), 0)


ROLLING_STATS = {
    "mean": F.avg,
    "std": F.stddev_pop,
    "min": F.min,
    "max": F.max,
    "median": lambda c: F.percentile(c, 0.5),
}


def rolling_columns(w: WindowSpec, col: str, windows, stats) -> list[Column]:
    unknown = [s for s in stats if s not in ROLLING_STATS]
    if unknown:
        log.warning("skipping unknown statistics %s", unknown)
    return [ROLLING_STATS[s](F.col(col)).over(trailing(w, n)).alias(f"{col}_rolling_{s}_{n}")
            for n in windows for s in stats if s in ROLLING_STATS]


def trend_columns(w: WindowSpec, col: str, windows) -> list[Column]:
    return [F.coalesce((F.col(col) > F.avg(col).over(trailing(w, n))).cast("int"), F.lit(0)).alias(f"{col}_trend_{n}")
            for n in windows]


def lags(df: DataFrame, col: str, periods=(1, 7, 14, 30), series: Series = STORE_FAMILY) -> DataFrame:
    return over_series(df, series, lambda w: lag_columns(w, col, periods), before=max(periods))


def rolling(df: DataFrame, col: str, windows=(7, 14, 30), stats=("mean", "std", "min", "max"),
            series: Series = STORE_FAMILY) -> DataFrame:
    """Statistics over the current and the preceding rows; shorter at the start of a series."""
    return over_series(df, series, lambda w: rolling_columns(w, col, windows, stats), before=max(windows) - 1)


def trend_flags(df: DataFrame, col: str, windows=(7, 14, 30), series: Series = STORE_FAMILY) -> DataFrame:
    return over_series(df, series, lambda w: trend_columns(w, col, windows), before=max(windows) - 1)


def trend_strength(df: DataFrame, col: str, windows=(7, 14, 30), series: Series = STORE_FAMILY) -> DataFrame:
    """Relative distance of the value from its rolling mean."""
    def build(w):
        means = {n: F.avg(col).over(trailing(w, n)) for n in windows}
        return [F.try_divide(F.col(col) - m, m).alias(f"{col}_trend_strength_{n}") for n, m in means.items()]
    return over_series(df, series, build, before=max(windows) - 1)


def series_features(df: DataFrame, target: str = "sales", series: Series = STORE_FAMILY) -> DataFrame:
    """Lags, rolling statistics and trend flags; every window shares one partitioning and one sort."""
    windows = (7, 14, 30)
    return over_series(
        df, series,
        lambda w: [*lag_columns(w, target, (1, 7, 14, 30)),
                   *rolling_columns(w, target, windows, ("mean", "std", "min", "max")),
                   *trend_columns(w, target, windows)],
        before=30)


def cycle_features(df: DataFrame) -> DataFrame:
    for col, period in (("day_of_week", 7), ("month", 12), ("day", 31)):
        df = cyclical(df, col, period)
    return df


def all_features(df: DataFrame, target: str = "sales", series: Series = STORE_FAMILY) -> DataFrame:
    """The standard feature set."""
    return cycle_features(series_features(df, target, series))


def full_moving_average(daily: DataFrame, col: str, width: int = 7, date: str = "date") -> DataFrame:
    """Moving average of a date-grain series, unknown until ``width`` values are there."""
    w = Window.partitionBy(F.lit(0)).orderBy(date).rowsBetween(-(width - 1), 0)
    return daily.withColumn(f"{col}_ma_{width}", F.when(F.count(col).over(w) == width, F.avg(col).over(w)))


def time_gaps(dates: DataFrame, date: str = "date", keys: list[str] = ()) -> DataFrame:
    """Steps between consecutive rows that are not one day (of each key). Input at date grain."""
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(date)
    steps = dates.withColumn("_step", F.datediff(date, F.lag(date).over(w)))
    return steps.groupBy(*keys).agg(F.count_if(F.col("_step") != 1).alias("gaps"))


def lag_correlations(daily: DataFrame, x: str, y: str, max_lag: int = 7, date: str = "date") -> DataFrame:
    """Correlation of y with x shifted by 0 … max_lag rows of a date-grain frame."""
    w = Window.partitionBy(F.lit(0)).orderBy(date)
    shifted = daily.select(y, *[F.lag(x, k).over(w).alias(str(k)) for k in range(max_lag + 1)])
    one = shifted.agg(*[F.corr(F.col(str(k)), F.col(y)).alias(str(k)) for k in range(max_lag + 1)])
    return (
        one.unpivot([], [str(k) for k in range(max_lag + 1)], "lag", "correlation")
        .withColumn("lag", F.col("lag").cast("int"))
    )


def sequences(df: DataFrame, features: list[str], target: str, length: int = 30, horizon: int = 1,
              stride: int = 1, series: Series = STORE_FAMILY) -> DataFrame:
    """Per row: the last ``length`` feature rows (``x``) and the next ``horizon`` targets (``y``); only
    full windows, every ``stride``-th one."""
    if series.block_rows is not None and stride != 1:
        raise ValueError("a stride needs whole series")

    def build(w):
        past, ahead = w.rowsBetween(-(length - 1), 0), w.rowsBetween(1, horizon)
        row = F.array(*[F.col(f).cast("double") for f in features])
        columns = [F.collect_list(row).over(past).alias("x"),
                   F.collect_list(F.col(target).cast("double")).over(ahead).alias("y")]
        return columns + ([F.row_number().over(w).alias("_rn")] if stride != 1 else [])

    windows = over_series(df, series, build, before=length - 1, after=horizon)
    full = windows.where((F.size("x") == length) & (F.size("y") == horizon))
    if stride != 1:
        full = full.where((F.col("_rn") - length) % stride == 0).drop("_rn")
    return full


def zscores(df: DataFrame, col: str, keys: list[str] = ()) -> DataFrame:
    """Absolute z-score with the population deviation, over all rows or within each key."""
    spread = attach_stats(df, list(keys), _mean=F.avg(col), _std=F.stddev_pop(col))
    return spread.withColumn("zscore", F.abs(F.try_divide(F.col(col) - F.col("_mean"), F.col("_std")))) \
        .drop("_mean", "_std")


def rolling_apply(df: DataFrame, col: str, width: int, fn: Callable[[pd.Series], float], name: str,
                  series: Series = STORE_FAMILY) -> DataFrame:
    """A user statistic over the trailing rows; frames are built by Spark, the function runs per frame
    inside Arrow batches."""
    @F.pandas_udf("double")
    def apply(frames: pd.Series) -> pd.Series:
        return frames.map(lambda values: float(fn(pd.Series(values))) if len(values) else None)

    framed = over_series(
        df, series, lambda w: [F.collect_list(F.col(col).cast("double")).over(trailing(w, width)).alias("_frame")],
        before=width - 1)
    return framed.withColumn(name, apply("_frame")).drop("_frame")
