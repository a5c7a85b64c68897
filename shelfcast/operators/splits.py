"""Splits by time, folds and their summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ordered import rows_at, segment_by_rank


def split_date(df: DataFrame, test_size: float = 0.2, date: str = "date") -> DataFrame:
    """One row: the date at position ``int(n·(1 − test_size))`` of the rows in date order."""
    return rows_at(df, [date], lambda n: [F.floor(n * F.lit(1 - test_size))]).select(date)


def split_by_date(df: DataFrame, test_size: float = 0.2, date: str = "date") -> tuple[DataFrame, DataFrame]:
    """(rows before the split date, rows from it on). Without a split date (nothing to test) all rows are training rows."""
    cut = split_date(df, test_size, date).scalar()
    is_test = F.coalesce(F.col(date) >= cut, F.lit(False))
    return df.where(~is_test), df.where(is_test)


def label_split(df: DataFrame, order: list[str], test_size: float = 0.2, val_size: float | None = None) -> DataFrame:
    """Adds ``split``: train, val or test by row position in the given order."""
    val_size = test_size if val_size is None else val_size
    cut = segment_by_rank(df, order, lambda n: [
        F.floor(n * F.lit(1 - test_size - val_size)), F.floor(n * F.lit(1 - test_size))], "_s")
    name = F.when(F.col("_s") == 0, "train").when(F.col("_s") == 1, "val").otherwise("test")
    return cut.withColumn("split", name).drop("_s")


def split_three(df: DataFrame, order: list[str], test_size: float = 0.2,
                val_size: float | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    labelled = label_split(df, order, test_size, val_size)
    return tuple(labelled.where(F.col("split") == s).drop("split") for s in ("train", "val", "test"))


def kfold_blocked(df: DataFrame, n_folds: int, order: list[str]) -> DataFrame:
    """Adds ``fold``: equal consecutive blocks 0 … n−1; the remainder rows get n and are never validated.

    Fold k trains on all rows with another id, also later ones.
    """
    return segment_by_rank(
        df, order, lambda n: [F.floor(n / n_folds) * i for i in range(1, n_folds + 1)], "fold")


def fold(df: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(train, validation) of a blocked fold."""
    return df.where(F.col("fold") != k), df.where(F.col("fold") == k)


def time_series_folds(df: DataFrame, n_folds: int, order: list[str]) -> DataFrame:
    """Adds ``block`` 0 … n. Fold k (1 … n) validates on block k and trains on the blocks before it.

    The last n blocks are of equal size; the rows left over belong to block 0.
    """
    return segment_by_rank(
        df, order,
        lambda n: [n - F.floor(n / (n_folds + 1)) * (n_folds + 1 - i) for i in range(1, n_folds + 1)], "block")


def expanding_fold(df: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("block") < k), df.where(F.col("block") == k)


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """``(model, fold, metric, value)`` to the mean and population deviation per model and metric."""
    return fold_metrics.groupBy("model", "metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def origin_span(df: DataFrame, initial: int = 30, period: int = 7, horizon: int = 7, date: str = "date") -> DataFrame:
    """One row: the last cutoff date and how many steps of ``period`` days the earliest one lies before it."""
    span = df.agg(F.min(date).alias("a"), F.max(date).alias("b"))
    last = F.date_sub("b", horizon)
    steps = F.floor(F.datediff(last, F.date_add("a", initial)) / period).cast("int")
    return span.select(last.alias("_last_cutoff"), steps.alias("_steps"))


def rolling_origins(df: DataFrame, initial: int = 30, period: int = 7, horizon: int = 7, date: str = "date") -> DataFrame:
    """Cutoff dates of a rolling-origin backtest: the last one leaves ``horizon`` days, earlier ones are
    ``period`` days apart, and each has ``initial`` days before it."""
    span = origin_span(df, initial, period, horizon, date).where(F.col("_steps") >= 0)
    return span.select(F.explode(F.transform(
        F.sequence(F.lit(0), "_steps"), lambda i: F.date_sub("_last_cutoff", i * period))).alias("cutoff"))
