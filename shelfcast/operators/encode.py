"""Row-wise feature encodings and scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import cyclical_pair, flag_name, indicator
from .clean import beside


def one_hot(df: DataFrame, col: str, values: list, prefix: str | None = None) -> DataFrame:
    """A 0/1 column per listed value; the list is given, so the schema does not depend on the data."""
    return df.select("*", *[
        indicator(F.col(col) == F.lit(v)).alias(flag_name(prefix or col, v)) for v in values])


def cyclical(df: DataFrame, col: str, period: float) -> DataFrame:
    return df.select("*", *cyclical_pair(col, period))


def interactions(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Product of two numbers, or the joined text when either is a string."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}

    def combined(a, b):
        if a in text or b in text:
            return F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.concat_ws("_", a, b))
        return F.col(a) * F.col(b)

    return df.select("*", *[combined(a, b).alias(f"{a}_{b}_interaction") for a, b in pairs])


def fit_scaler(train: DataFrame, cols: list[str]) -> DataFrame:
    """One row: mean and sample standard deviation of each column."""
    return train.agg(*[F.avg(c).alias(f"{c}_mean") for c in cols],
                     *[F.stddev_samp(c).alias(f"{c}_std") for c in cols])


def apply_scaler(df: DataFrame, scaler: DataFrame, cols: list[str]) -> DataFrame:
    """z-scores by the fitted row; a column without spread becomes 0."""
    def z(c):
        scaled = F.try_divide(F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_std"))
        return F.when(F.col(c).isNotNull(), F.coalesce(scaled, F.lit(0.0)))
    return beside(df, scaler).withColumns({c: z(c) for c in cols}).select(*df.columns)


def invert_scaler(df: DataFrame, scaler: DataFrame, cols: list[str]) -> DataFrame:
    back = {c: F.col(c) * F.col(f"{c}_std") + F.col(f"{c}_mean") for c in cols}
    return beside(df, scaler).withColumns(back).select(*df.columns)


def scale(train: DataFrame, test: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames scaled by the training rows only."""
    scaler = fit_scaler(train, cols)
    return apply_scaler(train, scaler, cols), apply_scaler(test, scaler, cols)
