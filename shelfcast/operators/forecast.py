"""Forecast frames, baselines, backtests, ensembles and the model interface."""

from __future__ import annotations

import copy
from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .clean import beside, filter_ids
from .linear import FIT_FIELDS, dot, information, per_series, residual_sum, solve, unpack
from .splits import origin_span


def forecast_frame(history: DataFrame, days: int, keys: list[str], ids: list | None = None, date: str = "date",
                   align: bool = True, within: list[str] = ()) -> DataFrame:
    """One row per series and future day with its ``step``.

    Days follow the last date of all series (of each ``within`` group, some of the keys), or each series' own with ``align``
    off.
    """
    if days < 1:
        raise ValueError("a forecast covers at least one day")
    if ids is not None:
        history = filter_ids(history, keys[0], ids)
    ends = history.groupBy(*keys).agg(F.max(date).alias("_last"))
    if align and within:
        last = history.groupBy(*within).agg(F.max(date).alias("_last"))
        ends = ends.drop("_last").join(last, list(within))
    elif align:
        ends = ends.withColumn("_last", history.agg(F.max(date).alias("m")).scalar())
    steps = F.sequence(F.lit(1), F.lit(days))
    return ends.select(*keys, "_last", F.explode(steps).alias("step")).select(
        *keys, F.date_add("_last", F.col("step")).alias(date), "step")


def known_series(frame: DataFrame, fits: DataFrame, keys: list[str]) -> DataFrame:
    """The frame's rows; an error when a series has no model."""
    marked = fits.select(*keys).distinct().withColumn("_known", F.lit(True))
    name = F.concat(F.lit("no model for series "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))
    checked = F.when(F.col("_known").isNull(), F.raise_error(name).cast("boolean")).otherwise(F.col("_known"))
    return frame.join(marked, keys, "left").where(checked).drop("_known")


def in_sample_baselines(daily: DataFrame, value: str, keys: list[str], season: int = 7, width: int = 28,
                        date: str = "date") -> DataFrame:
    """One-step predictions from the past only: the value a season ago and the mean of the last rows."""
    w = Window.partitionBy(*keys).orderBy(date)
    return daily.select(
        *keys, date, F.col(value).alias("actual"),
        F.lag(value, season).over(w).alias("seasonal_naive"),
        F.avg(value).over(w.rowsBetween(-width, -1)).alias("moving_average"))


def baseline_forecast(daily: DataFrame, value: str, keys: list[str], days: int, season: int = 7, width: int = 28,
                      date: str = "date") -> DataFrame:
    """Future days by the last season's values and by the mean of the last ``width`` days."""
    frame = forecast_frame(daily, days, keys, date=date, align=False)
    last = daily.groupBy(*keys).agg(F.max(date).alias("_last"))
    recent = daily.join(last, keys).where(F.datediff("_last", date) < max(season, width))
    age = F.datediff("_last", date)
    flat = recent.where(age < width).groupBy(*keys).agg(F.avg(value).alias("moving_average"))
    cycle = recent.where(age < season).select(*keys, ((season - age) % season).alias("_phase"), F.col(value).alias("seasonal_naive"))
    return (
        frame.withColumn("_phase", F.col("step") % season)
        .join(cycle, [*keys, "_phase"], "left").join(flat, keys, "left")
        .drop("_phase")
    )


def ensemble(predictions: DataFrame, keys: list[str], weights: DataFrame | None = None) -> DataFrame:
    """Mean over models of ``(keys, model, prediction)``; with ``(model, rmse)`` weighted by 1/rmse."""
    if weights is None:
        return predictions.groupBy(*keys).agg(F.avg("prediction").alias("prediction"))
    share = weights.select("model", F.try_divide(F.lit(1.0), F.col("rmse")).alias("_w"))
    joined = predictions.join(share, "model")
    return joined.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("prediction") * F.col("_w")), F.sum("_w")).alias("prediction"))


def _assigned_cutoffs(rows: DataFrame, origins: DataFrame, period: int, horizon: int, date: str) -> DataFrame:
    """Each row with the cutoffs whose horizon covers it (``_cutoffs``) and the first cutoff that may train
    on it (``_block``, unknown after the last one). Cutoff i lies i periods before the last."""
    age = F.datediff("_last_cutoff", F.col(date))
    first = F.greatest(F.lit(0), F.floor(age / period) + 1).cast("int")
    last = F.least(F.col("_steps"), F.floor((age + horizon) / period)).cast("int")
    covering = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    block = F.least(F.col("_steps"), F.floor(age / period)).cast("int")
    return beside(rows, origins).select(
        *rows.columns,
        F.transform(covering, lambda i: F.date_sub("_last_cutoff", i * period)).alias("_cutoffs"),
        F.when((age >= 0) & (F.col("_steps") >= 0), F.date_sub("_last_cutoff", block * period)).alias("_block"))


def backtest_naive(daily: DataFrame, value: str, keys: list[str], initial: int = 30, period: int = 7,
                   horizon: int = 7, season: int = 7, date: str = "date") -> DataFrame:
    """Rolling-origin predictions of the last season's value, as ``(keys, date, cutoff, prediction, actual)``."""
    if horizon > season:
        raise ValueError("the horizon must not exceed the season")
    w = Window.partitionBy(*keys).orderBy(date)
    lagged = daily.withColumn("prediction", F.lag(value, season).over(w))
    rows = _assigned_cutoffs(lagged, origin_span(daily, initial, period, horizon, date), period, horizon, date)
    return rows.select(*keys, date, F.explode("_cutoffs").alias("cutoff"), "prediction", F.col(value).alias("actual"))


BACKTEST_LAGS = (7, 14, 21, 28)


def backtest_linear(daily: DataFrame, value: str, keys: list[str], initial: int = 60, period: int = 7,
                    horizon: int = 7, date: str = "date", lags: tuple[int, ...] = BACKTEST_LAGS) -> DataFrame:
    """Rolling-origin predictions of a regression on lags of whole weeks, refitted at every cutoff.

    A cutoff's normal equations are the running sum of the blocks before it, so the history is read once
    and no row is copied to the cutoffs that train on it.
    """
    if horizon > min(lags):
        raise ValueError("the horizon must not exceed the shortest lag")
    w = Window.partitionBy(*keys).orderBy(date)
    names = [f"_l{k}" for k in lags]
    lagged = daily.select("*", F.lit(1.0).alias("_one"), *[F.lag(value, k).over(w).alias(n) for k, n in zip(lags, names)])
    origins = origin_span(daily, initial, period, horizon, date)
    rows = _assigned_cutoffs(lagged.na.drop(subset=[value, *names]), origins, period, horizon, date)
    cols = ["_one", *names, value]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    blocks = rows.where(F.col("_block").isNotNull()).groupBy(*keys, F.col("_block").alias("cutoff")).agg(
        F.count("*").alias("n"), *[F.sum(F.col(a) * F.col(b)).alias(f"_m{i}") for i, (a, b) in enumerate(pairs)])
    upto = Window.partitionBy(*keys).orderBy("cutoff").rowsBetween(Window.unboundedPreceding, 0)
    grams = blocks.select(*keys, "cutoff", F.sum("n").over(upto).alias("n"),
                          F.array(*[F.sum(f"_m{i}").over(upto) for i in range(len(pairs))]).alias("moments"))

    def fit(row):
        xtx, xty, yty = unpack(row["moments"])
        n, k = int(row["n"]), len(xty)
        if n <= k:
            return None
        beta, _ = solve(xtx, xty)
        rss = residual_sum(xtx, xty, yty, beta)
        aic, bic = information(n, rss, k)
        return {"n": n, "coef": beta, "se": [], "rss": rss, "sigma2": rss / (n - k), "aic": aic, "bic": bic}
    fits = per_series(grams, [*keys, "cutoff"], FIT_FIELDS, fit)
    tested = rows.select("*", F.explode("_cutoffs").alias("cutoff"))
    return tested.join(fits.select(*keys, "cutoff", "coef"), [*keys, "cutoff"]).select(
        *keys, date, "cutoff", dot("coef", F.array("_one", *names)).alias("prediction"), F.col(value).alias("actual"))


class SeriesModel(Protocol):
    """A model family as two table functions.

    ``keys`` name a series. A model that learns one rule from several series, or gives them a common last date, has
    ``within``: keys whose groups must not learn from each other.
    """

    name: str
    keys: list[str]

    def fit(self, history: DataFrame) -> DataFrame:
        """History ``(keys, date, value, …)`` to one row of parameters per series."""

    def predict(self, fits: DataFrame, history: DataFrame, days: int) -> DataFrame:
        """``(keys, date, step, prediction, lower, upper)`` for the days after the history."""


def per_group(model: SeriesModel, group: str) -> SeriesModel:
    """The model over series that have ``group`` as a further key; groups learn nothing from each other."""
    out = copy.copy(model)
    object.__setattr__(out, "keys", type(model.keys)([*model.keys, group]))  # some models are frozen
    if hasattr(model, "within"):
        object.__setattr__(out, "within", (*model.within, group))
    return out


class GroupedModel:
    """A user's own per-series functions as a ``SeriesModel``.

    ``fit_one`` takes a series' rows and returns its parameters as numbers; ``predict_one`` takes the
    parameters and the number of days. Spark hands each function one series, which has at most one row per
    day and key. ``within`` are keys whose groups have last dates of their own.
    """

    within: tuple[str, ...] = ()

    def __init__(self, name: str, keys: list[str], fit_one: Callable[[pd.DataFrame], list[float]],
                 predict_one: Callable[[list[float], int], list[float]], date: str = "date"):
        self.name, self.keys, self.date = name, list(keys), date
        self.fit_one, self.predict_one = fit_one, predict_one

    def fit(self, history: DataFrame) -> DataFrame:
        keys, date, fit_one = self.keys, self.date, self.fit_one
        schema = T.StructType([*[history.schema[k] for k in keys], T.StructField("params", T.ArrayType(T.DoubleType()))])

        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(date)
            return pdf.iloc[:1][keys].assign(params=[[float(v) for v in fit_one(pdf)]])
        return history.groupBy(*keys).applyInPandas(one, schema)

    def predict(self, fits: DataFrame, history: DataFrame, days: int) -> DataFrame:
        predict_one = self.predict_one

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def path(params: pd.Series) -> pd.Series:
            return params.map(lambda p: [float(v) for v in predict_one(list(p), days)])
        frame = known_series(forecast_frame(history, days, self.keys, date=self.date, within=self.within), fits, self.keys)
        paths = fits.select(*self.keys, path("params").alias("_path"))
        return frame.join(paths, self.keys).withColumn("prediction", F.get("_path", F.col("step") - 1)).drop("_path")


def interval(prediction: Column, sigma: Column, z: float) -> list[Column]:
    return [(prediction - z * sigma).alias("lower"), (prediction + z * sigma).alias("upper")]
