"""One regression over the windows of all series."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import materialize
from .clean import fill_calendar
from .forecast import forecast_frame, known_series
from .linear import moments_of_array, per_series, solve, unpack
from .windows import Series, sequences


def window_vectors(daily: DataFrame, value: str, keys: list[str], length: int = 30, date: str = "date") -> DataFrame:
    """Every full window of the last ``length`` values relative to their mean (``features``) and the next value
    relative to it (``label``). A window whose mean is 0 is taken relative to the series' mean size (``level``)."""
    windows = sequences(daily, [value], value, length, 1, series=Series(tuple(keys), (date,)))
    values = F.transform("x", lambda row: row[0])
    mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / length
    sized = windows.select(*keys, date, values.alias("_v"), mean.alias("_mean"), F.col("y")[0].alias("next")).join(
        series_sizes(daily, value, keys), keys)
    level = F.when(F.col("_mean") != 0, F.col("_mean")).otherwise(F.col("size"))
    return sized.withColumn("level", level).select(
        *keys, date, "level", "next", (F.col("next") / F.col("level")).alias("label"),
        array_to_vector(F.transform("_v", lambda v: v / F.col("level"))).alias("features"))


def series_sizes(daily: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """``size`` of each series: its mean absolute value, or 1 if that is 0 or unknown."""
    mean = F.avg(F.abs(value))
    return daily.groupBy(*keys).agg(F.coalesce(F.when(mean > 0, mean), F.lit(1.0)).alias("size"))


def mark_validation(windows: DataFrame, keys: list[str], share: float = 0.2, date: str = "date") -> DataFrame:
    """``is_val`` for the last part of each series' windows."""
    w = Window.partitionBy(*keys)
    age = F.percent_rank().over(w.orderBy(F.desc(date)))
    return windows.withColumn("is_val", age < share)


def fit_sequence_regressor(daily: DataFrame, value: str, keys: list[str], length: int = 30, method: str = "linear",
                           max_iter: int = 20, share: float = 0.2, seed: int = 42, date: str = "date", ridge: float = 1e-3):
    """(fitted model, ``(train_loss, val_loss)`` row). Boosted trees stop at the best validation round."""
    # read by the fit and by the losses
    marked = materialize(mark_validation(window_vectors(daily, value, keys, length, date), keys, share, date))
    if method == "linear":
        model = LinearRegression(regParam=ridge, maxIter=max_iter).fit(marked.where(~F.col("is_val")))
    elif method == "gbt":
        model = GBTRegressor(maxIter=max_iter, maxDepth=4, seed=seed, validationIndicatorCol="is_val").fit(marked)
    else:
        raise ValueError(f"unknown method {method!r}")
    scored = model.transform(marked)
    error = F.pow(F.col("prediction") - F.col("label"), 2)
    losses = scored.agg(F.avg(F.when(~F.col("is_val"), error)).alias("train_loss"),
                        F.avg(F.when(F.col("is_val"), error)).alias("val_loss"))
    return model, losses


def predict_next(model, daily: DataFrame, value: str, keys: list[str], length: int = 30, date: str = "date") -> DataFrame:
    """One-step predictions in the units of the series, for every full window."""
    scored = model.transform(window_vectors(daily, value, keys, length, date))
    return scored.select(*keys, F.date_add(date, 1).alias(date), (F.col("prediction") * F.col("level")).alias("prediction"),
                         F.col("next").alias("actual"))


def with_rule(sizes: DataFrame, rules: DataFrame, within: list[str]) -> DataFrame:
    """Each series with the rule of its group; an error if there is but one group and it has none."""
    if within:
        return sizes.join(rules, within, "left")
    rule = rules.first()  # one row
    if rule is None:
        raise ValueError("no series has a full window")
    return sizes.withColumns({c: F.lit(v) for c, v in rule.asDict().items()})


class SequenceModel:
    """The window regression as a forecaster: one linear rule for all series (of each ``within`` group), applied step by
    step.

    A missing day in the last window takes the value before it, a shorter series is preceded by its mean, and a
    series without any known value has NULL forecasts.
    """

    name = "sequence"
    within: tuple[str, ...] = ()

    def __init__(self, keys: list[str], value: str = "sales", date: str = "date", length: int = 30, ridge: float = 1e-3):
        self.keys, self.value, self.date, self.length, self.ridge = list(keys), value, date, length, ridge

    def fit(self, history: DataFrame) -> DataFrame:
        """One row per series with the rule's weights: least squares with a ridge on the standardized windows, solved from one
        matrix of sums per group; the newest fifth of each series takes no part, as in ``fit_sequence_regressor``."""
        keys, ridge = self.keys, self.ridge
        marked = mark_validation(window_vectors(history, self.value, keys, self.length, self.date), keys, date=self.date)
        rows = marked.where(~F.col("is_val")).select(
            *self.within, F.concat(F.array(F.lit(1.0)), vector_to_array("features")).alias("_x"), "label")

        def solved(row):
            if row["moments"] is None:
                return None
            xtx, xty, _ = unpack(row["moments"])
            n = int(row["n"])
            penalty = ridge * np.maximum(np.diag(xtx) - xtx[0] ** 2 / n, 0.0)
            penalty[0] = 0.0
            beta, _ = solve(xtx, xty, penalty)
            return {"coef": beta[1:], "intercept": float(beta[0])}
        fields = [T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("intercept", T.DoubleType())]
        rules = per_series(moments_of_array(rows, list(self.within), "_x", "label"), list(self.within), fields, solved)
        return with_rule(series_sizes(history, self.value, keys), rules, list(self.within))

    def predict(self, fits: DataFrame, history: DataFrame, days: int) -> DataFrame:
        keys, length = self.keys, self.length
        wanted = known_series(forecast_frame(history, days, keys, date=self.date, align=False), fits, keys)
        last = history.groupBy(*keys).agg(F.max(self.date).alias("_last"))
        near = history.join(last, keys).where(F.datediff("_last", self.date) < length)
        near = fill_calendar(near, self.value, keys, self.date)
        tails = near.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(self.date, self.value))).alias("_t"))
        ready = tails.select(*keys, F.col("_t").getField(self.value).alias("_tail")).join(fits, keys)

        def ahead(row):
            values = [float(v) for v in row["_tail"] if v is not None and v == v]
            if not values or row["coef"] is None:
                return None
            weights = np.asarray(row["coef"], float)
            values = [float(np.mean(values))] * (length - len(values)) + values
            for _ in range(days):
                window = np.asarray(values[-length:], float)
                level = window.mean() or row["size"]
                values.append(float((weights @ (window / level) + row["intercept"]) * level) if window.any() else 0.0)
            return {"_path": values[-days:]}
        paths = per_series(ready, keys, [T.StructField("_path", T.ArrayType(T.DoubleType()))], ahead)
        return wanted.join(paths, keys, "left").select(*keys, self.date, "step", F.get("_path", F.col("step") - 1).alias("prediction"))


def column_windows(daily: DataFrame, columns: list[str], value: str, keys: list[str], length: int = 30, horizon: int = 1,
                   date: str = "date", relative: bool = True) -> DataFrame:
    """Every full window over several columns: ``x``, the last ``length`` values and then the other columns day by day,
    and ``y``, the next ``horizon`` values. With ``relative`` values are taken relative to ``level`` as in ``window_vectors``,
    else it is 1. Windows with an unknown entry are left out."""
    windows = sequences(daily, [value, *columns], value, length, horizon, series=Series(tuple(keys), (date,)))
    own = windows.select(*keys, date, "y", F.transform("x", lambda row: row[0]).alias("_v"),
                         F.flatten(F.transform("x", lambda row: F.slice(row, 2, len(columns)))).alias("_others"))
    if relative:
        mean = F.aggregate("_v", F.lit(0.0), lambda a, v: a + v) / length
        level = F.when(mean != 0, mean).otherwise(F.col("size"))
        own = own.join(series_sizes(daily, value, keys), keys).withColumn("level", level)
    else:
        own = own.withColumn("level", F.lit(1.0))
    shares = F.transform("_v", lambda v: v / F.col("level"))
    rows = own.select(*keys, date, "level", F.concat(shares, "_others").alias("x"), F.transform("y", lambda v: v / F.col("level")).alias("y"))
    return rows.where(F.forall("x", lambda v: v.isNotNull()))


def _column_sums(windows: DataFrame, keys: list[str], horizon: int) -> DataFrame:
    """One matrix of sums per key: 1, ``x`` and the steps of ``y``."""
    whole = F.concat(F.array(F.lit(1.0)), "x", F.slice("y", 1, horizon - 1)) if horizon > 1 else F.concat(F.array(F.lit(1.0)), "x")
    return moments_of_array(windows.select(*keys, whole.alias("_z"), F.col("y")[horizon - 1].alias("_last")), keys, "_z", "_last")


def _split_sums(triangle, horizon: int):
    """(X'X, X'Y, the squares of Y) of ``_column_sums``."""
    xtx, xty, yty = unpack(triangle)
    gram = np.block([[xtx, xty[:, None]], [xty[None, :], np.array([[yty]])]])
    width = len(gram) - horizon
    return gram[:width, :width], gram[:width, width:], np.diag(gram)[width:]


def _column_rule(triangle, horizon: int, ridge: float) -> np.ndarray:
    """A row of weights per step: the intercept, then the entries of ``x``."""
    xtx, xty, _ = _split_sums(triangle, horizon)
    penalty = ridge * np.diag(xtx)
    penalty[0] = 0.0
    return (solve(xtx, xty[:, 0], penalty)[1] @ xty).T


def fit_column_regressor(daily: DataFrame, columns: list[str], value: str, keys: list[str], length: int = 30, horizon: int = 7,
                         share: float = 0.2, ridge: float = 1e-3, date: str = "date", relative: bool = True):
    """(weights, ``(train_loss, val_loss)`` row): one linear rule per step ahead over the windows of all columns and series.

    Training and validation windows are read once, as two matrices of sums; both losses, mean squared errors over all
    steps, are read off them.
    """
    marked = mark_validation(column_windows(daily, columns, value, keys, length, horizon, date, relative), keys, share, date)
    # two rows
    sums = {r.is_val: (r.n, r.moments) for r in _column_sums(marked, ["is_val"], horizon).collect()}
    if False not in sums:
        raise ValueError("no series has a full window")
    weights = _column_rule(sums[False][1], horizon, ridge)

    def loss(key):
        if key not in sums:
            return None
        n, (gram, cross, squares) = sums[key][0], _split_sums(sums[key][1], horizon)
        errors = squares - 2 * np.einsum("hi,ih->h", weights, cross) + np.einsum("hi,ij,hj->h", weights, gram, weights)
        return float(max(0.0, errors.mean() / n))
    losses = daily.sparkSession.createDataFrame([(loss(False), loss(True))], "train_loss double, val_loss double")
    return weights, losses


class ColumnSequenceModel:
    """The many-column window regression as a forecaster: one rule for all series (of each ``within`` group) gives all days
    ahead at once from the last window of each series.

    A missing day or entry of that window takes the one before it; before the first, the value takes its mean and
    the other columns 0. A series without any known value has NULL forecasts.
    """

    name = "column_sequence"
    within: tuple[str, ...] = ()

    def __init__(self, keys: list[str], columns: list[str], value: str = "sales", date: str = "date", length: int = 30,
                 horizon: int = 14, relative: bool = True, ridge: float = 1e-3):
        self.keys, self.columns, self.value, self.date = list(keys), list(columns), value, date
        self.length, self.horizon, self.relative, self.ridge = length, horizon, relative, ridge

    def fit(self, history: DataFrame) -> DataFrame:
        """One row per series with the rule's weights; the newest fifth of each series takes no part."""
        windows = column_windows(history, self.columns, self.value, self.keys, self.length, self.horizon, self.date, self.relative)
        used = mark_validation(windows, self.keys, date=self.date).where(~F.col("is_val"))
        within, horizon, ridge = list(self.within), self.horizon, self.ridge

        def solved(row):
            return None if row["moments"] is None else {"weights": _column_rule(row["moments"], horizon, ridge).tolist()}
        rules = per_series(_column_sums(used, within, horizon), within,
                           [T.StructField("weights", T.ArrayType(T.ArrayType(T.DoubleType())))], solved)
        return with_rule(series_sizes(history, self.value, self.keys), rules, within)

    def predict(self, fits: DataFrame, history: DataFrame, days: int) -> DataFrame:
        if days > self.horizon:
            raise ValueError(f"the model was fitted for {self.horizon} days ahead")
        keys, length, value, names, relative = self.keys, self.length, self.value, [self.value, *self.columns], self.relative
        wanted = known_series(forecast_frame(history, days, keys, date=self.date, align=False), fits, keys)
        last = history.groupBy(*keys).agg(F.max(self.date).alias("_last"))
        age = F.datediff("_last", self.date)
        near = history.join(last, keys).where(age < length).select(*keys, F.struct(
            age.alias("age"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)]).alias("_day"))
        tails = near.groupBy(*keys).agg(F.collect_list("_day").alias("_days"))
        arrays = tails.select(*keys, *[F.col("_days").getField(c).alias(c) for c in ("age", *[f"c{i}" for i in range(len(names))])])

        def ahead(row):
            window = np.full((length, len(names)), np.nan)
            places = length - 1 - np.asarray(row["age"], int)
            for i in range(len(names)):
                window[places, i] = [np.nan if v is None else v for v in row[f"c{i}"]]
            known = window[~np.isnan(window[:, 0]), 0]
            if not len(known) or row["weights"] is None:
                return None
            before = [known.mean(), *[0.0] * (len(names) - 1)]
            for day in window:
                day[:] = before = np.where(np.isnan(day), before, day)
            level = (window[:, 0].mean() or row["size"]) if relative else 1.0
            x = np.concatenate([[1.0], window[:, 0] / level, window[:, 1:].ravel()])
            return {"_path": np.array([list(w) for w in row["weights"]][:days]) @ x * level}
        paths = per_series(arrays.join(fits, keys), keys, [T.StructField("_path", T.ArrayType(T.DoubleType()))], ahead)
        return wanted.join(paths, keys, "left").select(*keys, self.date, "step", F.get("_path", F.col("step") - 1).alias("prediction"))
