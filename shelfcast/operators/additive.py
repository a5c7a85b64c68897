"""Additive trend, seasonality and regressor models for many series."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field
from math import pi

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.expressions import normal_quantile
from ..session import materialize
from .clean import fill_forward_backward
from .evaluate import error_metrics
from .forecast import forecast_frame, interval, known_series
from .linear import dot, moments_of_array, per_series, residual_sum, solve, unpack

REGRESSORS = ["onpromotion", "dcoilwtico", "transactions", "holiday"]
CHANGEPOINTS = 25
#: Days whose mean stands for a future regressor that is not known.
HELD_DAYS = 28
YEARLY_ORDER, WEEKLY_ORDER = 10, 3
DAYS_PER_YEAR = 365.25


@dataclass(frozen=True)
class AdditiveSettings:
    """Default settings. Seasonalities are True, False or ``auto``: yearly from 730 days of
    history on, weekly from 14."""

    seasonality_mode: str = "multiplicative"
    yearly_seasonality: bool | str = "auto"
    weekly_seasonality: bool | str = "auto"
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    holidays_prior_scale: float = 10.0
    changepoint_range: float = 0.8
    interval_width: float = 0.8
    changepoints: int = CHANGEPOINTS
    yearly_order: int = YEARLY_ORDER
    weekly_order: int = WEEKLY_ORDER
    trend_prior_scale: float = 5.0
    uncertainty_samples: int = 1000

    @property
    def parts(self) -> dict[str, slice]:
        """Position of each part in the design row."""
        sizes = {"trend": 2 + self.changepoints, "yearly": 2 * self.yearly_order, "weekly": 2 * self.weekly_order,
                 "regressors": len(REGRESSORS) - 1, "holidays": 1}
        out, at = {}, 0
        for name, size in sizes.items():
            out[name] = slice(at, at + size)
            at += size
        return out

    @property
    def width(self) -> int:
        return self.parts["holidays"].stop


def additive_features(df: DataFrame, keys: list[str], date: str = "date", target: str = "sales") -> DataFrame:
    """``ds, y`` and the regressors: oil filled along the series, the rest 0 where unknown; an absent
    column becomes 0."""
    have = set(df.columns)
    source = {"onpromotion": "onpromotion", "dcoilwtico": "dcoilwtico", "transactions": "transactions",
              "holiday": "holiday_type_Holiday"}
    columns = {n: F.col(c).cast("double") if c in have else F.lit(0.0) for n, c in source.items()}
    out = df.select(*keys, F.col(date).alias("ds"), F.col(target).cast("double").alias("y"),
                    *[c.alias(n) for n, c in columns.items()])
    if "dcoilwtico" in have:
        out = fill_forward_backward(out, "dcoilwtico", "ds", keys)
    return out.na.fill(0.0, ["onpromotion", "transactions", "holiday"])


def _enabled(setting: bool | str, needed: int) -> Column:
    if setting == "auto":
        return F.when(F.col("_span") >= needed, 1.0).otherwise(0.0)
    return F.lit(1.0 if setting else 0.0)


def _fourier(days: Column, period: float, order: int, on: Column) -> list[Column]:
    return [fn(days * (2 * pi * k / period)) * on for k in range(1, order + 1) for fn in (F.sin, F.cos)]


def design_row(settings: AdditiveSettings) -> Column:
    """The design row as one array; needs ``ds``, the regressors, and the series' ``_start`` and ``_span``."""
    days = F.datediff("ds", F.lit("1970-01-01").cast("date")).cast("double")
    t = F.datediff("ds", "_start") / F.greatest(F.col("_span"), F.lit(1)).cast("double")
    cuts = [settings.changepoint_range * i / settings.changepoints for i in range(1, settings.changepoints + 1)]
    columns = [F.lit(1.0), t, *[F.greatest(t - c, F.lit(0.0)) for c in cuts]]
    columns += _fourier(days, DAYS_PER_YEAR, settings.yearly_order, _enabled(settings.yearly_seasonality, 730))
    columns += _fourier(days, 7.0, settings.weekly_order, _enabled(settings.weekly_seasonality, 14))
    columns += [F.col(r).cast("double") for r in REGRESSORS]
    return F.array(*columns)


def prior_scales(settings: AdditiveSettings) -> np.ndarray:
    """Prior deviation of each coefficient, relative to the size of the series."""
    parts = settings.parts
    scale = np.full(settings.width, settings.trend_prior_scale)
    scale[2:parts["trend"].stop] = settings.changepoint_prior_scale
    scale[parts["trend"].stop:parts["holidays"].start] = settings.seasonality_prior_scale
    scale[parts["holidays"]] = settings.holidays_prior_scale
    return scale


def sparse_solve(gram, rhs, limits, rounds: int = 1000):
    """Minimum of ½ b'Gb - r'b + Σ limits·|b|: coefficients enter one at a time, the one that violates its threshold most
    first, and those in use are solved exactly for their signs; where a sign would flip, the coefficient stops at 0."""
    size = np.sqrt(np.maximum(np.diag(gram), 0.0))
    live = size > 1e-9 * max(size.max(initial=0.0), 1e-300)
    unit = np.where(live, size, 1.0)
    g, r, cut = gram / np.outer(unit, unit), rhs / unit, np.asarray(limits, float) / unit
    beta, signs = np.zeros(len(rhs)), np.zeros(len(rhs))
    tolerance = 1e-10 * max(1e-300, np.abs(r).max(initial=0.0))

    def cost(b):
        return 0.5 * b @ g @ b - r @ b + cut @ np.abs(b)

    for _ in range(rounds):
        pull = r - g @ beta
        over = np.where(live & (signs == 0), np.abs(pull) - cut, -np.inf)
        enters = int(over.argmax()) if len(over) else 0
        if not len(over) or over[enters] <= tolerance:
            break
        signs[enters] = np.sign(pull[enters])
        while True:
            used = np.flatnonzero(signs)
            wanted = np.zeros_like(beta)
            wanted[used] = np.linalg.pinv(g[np.ix_(used, used)], rcond=1e-13, hermitian=True) @ (r[used] - cut[used] * signs[used])
            if (wanted[used] * signs[used] >= 0).all():
                better = wanted
                break
            # the lowest point on the way there: the end, or where a coefficient reaches 0
            flips = used[(wanted[used] * beta[used] < 0)]
            stops = [beta + (wanted - beta) * (beta[j] / (beta[j] - wanted[j])) for j in flips]
            for j, stop in zip(flips, stops):
                stop[j] = 0.0
            better = min([wanted, *stops], key=cost)
            if cost(better) >= cost(beta) - 1e-300:
                better = None
                break
            beta, signs = better, np.sign(better)
        if better is None or cost(better) >= cost(beta):
            break
        beta, signs = better, np.sign(better)
    # columns that are copies of others can stop this short; coordinate descent goes on from there
    left = r - g @ beta
    for _ in range(rounds):
        moved = 0.0
        for j in np.flatnonzero(live):
            pull = left[j] + beta[j]
            new = np.sign(pull) * max(abs(pull) - cut[j], 0.0)
            step = new - beta[j]
            if abs(step) > tolerance:
                left -= g[:, j] * step
                beta[j] = new
                moved = max(moved, abs(step))
        if moved <= 100 * tolerance:
            break
    return beta / unit


def prior_solve(xtx, xty, yty, n, scale, slopes: int = 0):
    """(coefficients, residual variance) under the priors; the noise level comes from a first fit without them. The
    ``slopes`` columns after the first two are changes of slope over the whole span and have Laplace priors, which set most of
    them to 0; the others have normal ones."""
    free, _ = solve(xtx, xty)
    sigma2 = residual_sum(xtx, xty, yty, free) / max(1, n - min(n - 1, len(xty)))
    size2 = yty / n if yty > 0 else 1.0
    # columns keep their own units: a prior of the series' size over the column's root mean square
    penalty = sigma2 / (scale ** 2 * size2) * np.maximum(np.diag(xtx) / n, 1e-12)
    if not slopes:
        beta, _ = solve(xtx, xty, penalty)
        return beta, residual_sum(xtx, xty, yty, beta) / n
    bent = np.arange(2, 2 + slopes)
    others = np.setdiff1d(np.arange(len(xty)), bent)
    # given the changes of slope, the others are a ridge regression; what it leaves is a small problem of the changes alone
    _, inverse = solve(xtx[np.ix_(others, others)], xty[others], penalty[others])
    across = xtx[np.ix_(bent, others)] @ inverse
    gram = xtx[np.ix_(bent, bent)] - across @ xtx[np.ix_(others, bent)]
    beta = np.zeros(len(xty))
    beta[bent] = sparse_solve(gram, xty[bent] - across @ xty[others], sigma2 / (scale[bent] * np.sqrt(size2)))
    beta[others] = inverse @ (xty[others] - xtx[np.ix_(others, bent)] @ beta[bent])
    return beta, residual_sum(xtx, xty, yty, beta) / n


FIT_FIELDS = [T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("sigma2", T.DoubleType()),
              T.StructField("n", T.LongType())]


def _part(coef: str, x: str, part: slice) -> Column:
    start, length = part.start + 1, part.stop - part.start
    return dot(F.slice(coef, start, length), F.slice(x, start, length))


def trend_paths(step: np.ndarray, span: float, changes: int, size: float, samples: int, rng: np.random.Generator,
                sigma: float) -> tuple[np.ndarray, np.ndarray]:
    """(changes of the trend, noise), one row per sampled path and one column per day ahead. ``changes`` changes of slope
    over ``span`` days were ``size`` large on average; they go on as a Poisson process of Laplace changes."""
    t = step / span
    counts = rng.poisson(changes * t.max(), samples)
    when, slope = rng.uniform(0, t.max(), counts.sum()), rng.laplace(0, size, counts.sum())
    # a path is t times the sum of the changes before t, less the sum of changes times their own time
    cell = np.repeat(np.arange(samples), counts) * len(t) + np.searchsorted(t, when)
    rise, offset = (np.bincount(cell, w, samples * len(t)).reshape(samples, len(t)).cumsum(axis=1) for w in (slope, slope * when))
    return t * rise - offset, rng.normal(0, sigma, (samples, len(t)))


@dataclass(frozen=True)
class Additive:
    """Piecewise-linear trend with fixed changepoints, weekly and yearly Fourier terms, and regressors,
    fitted by least squares under priors: normal ones, and Laplace ones on the changes of slope.

    In multiplicative mode the trend comes from the additive fit and the other parts are then fitted to the
    relative deviation from it.
    """

    keys: tuple[str, ...] = ("store_nbr",)
    settings: AdditiveSettings = field(default_factory=AdditiveSettings)
    name = "additive"

    @property
    def multiplicative(self) -> bool:
        return self.settings.seasonality_mode == "multiplicative"

    def _spans(self, features: DataFrame) -> DataFrame:
        return features.groupBy(*self.keys).agg(
            F.min("ds").alias("_start"), F.datediff(F.max("ds"), F.min("ds")).alias("_span"))

    def _designed(self, features: DataFrame, spans: DataFrame) -> DataFrame:
        return features.join(spans, list(self.keys)).withColumn("_x", design_row(self.settings))

    def _solve(self, rows: DataFrame, target: str, scale: np.ndarray, slopes: int = 0) -> DataFrame:
        def fit(row):
            xtx, xty, yty = unpack(row["moments"])
            beta, sigma2 = prior_solve(xtx, xty, yty, int(row["n"]), scale, slopes)
            return {"coef": beta, "sigma2": sigma2, "n": int(row["n"])}
        keys = list(self.keys)
        return per_series(moments_of_array(rows, keys, "_x", target), keys, FIT_FIELDS, fit)

    def fit(self, features: DataFrame) -> DataFrame:
        """One row per series: start, span, coefficients, residual variance."""
        keys, scale = list(self.keys), prior_scales(self.settings)
        trend_part, width = self.settings.parts["trend"], self.settings.width
        spans = self._spans(features)
        rows = self._designed(features, spans)
        slopes = self.settings.changepoints
        fits = materialize(self._solve(rows, "y", scale, slopes)).withColumn("n_left_out", F.lit(0).cast("bigint"))
        if self.multiplicative:
            sizes = rows.groupBy(*keys).agg(F.sqrt(F.avg(F.col("y") * F.col("y"))).alias("_size"))
            fits = self._relative(rows, fits, sizes, scale)
            # the trend again without the seasons now known, and the seasons relative to it
            seasons = _part("_c", "_x", slice(trend_part.stop, width))
            joined = rows.join(fits.select(*keys, F.col("coef").alias("_c")), keys)
            level = F.when(1 + seasons > 0.1, F.col("y") / (1 + seasons))
            bare = joined.select(*keys, level.alias("_r"), F.slice("_x", 1, trend_part.stop).alias("_x"))
            trend = materialize(self._solve(bare.where(F.col("_r").isNotNull()), "_r", scale[:trend_part.stop], slopes))
            both = fits.drop("coef").join(fits.select(*keys, F.col("coef").alias("_c")), keys).join(
                trend.select(*keys, F.col("coef").alias("_t")), keys, "left")
            kept = F.coalesce("_t", F.slice("_c", 1, trend_part.stop))
            fits = both.withColumn("coef", F.concat(kept, F.slice("_c", trend_part.stop + 1, width - trend_part.stop))).drop("_c", "_t")
            fits = self._relative(rows, fits, sizes, scale)
        fits = materialize(fits.join(spans, keys))
        errors = self._scored(features, fits.drop("sigma2")).groupBy(*keys).agg(
            F.avg((F.col("y") - F.col("prediction")) * (F.col("y") - F.col("prediction"))).alias("sigma2"))
        return materialize(fits.drop("sigma2").join(errors, keys))

    def _relative(self, rows: DataFrame, fits: DataFrame, sizes: DataFrame, scale: np.ndarray) -> DataFrame:
        """The fits with all parts but the trend fitted to the relative deviation from it. Rows whose trend is below
        a thousandth of the series' size cannot be divided by it; they take no part and are counted."""
        keys, trend_part, width = list(self.keys), self.settings.parts["trend"], self.settings.width
        rest_size = width - trend_part.stop
        joined = rows.join(fits.select(*keys, F.col("coef").alias("_c")), keys).join(sizes, keys)
        trend = _part("_c", "_x", trend_part)
        ratio = F.when(trend > F.col("_size") / 1000, F.col("y") / trend - 1)
        rest = joined.select(*keys, ratio.alias("_r"), F.slice("_x", trend_part.stop + 1, rest_size).alias("_x"))
        relative = self._solve(rest.where(F.col("_r").isNotNull()), "_r", scale[trend_part.stop:])
        found = fits.join(relative.select(*keys, F.col("coef").alias("_rest"), F.col("n").alias("_n")), keys, "left")
        zeros = F.array_repeat(F.lit(0.0), rest_size)
        return materialize(found.withColumn("coef", F.concat(F.slice("coef", 1, trend_part.stop), F.coalesce("_rest", zeros)))
                           .withColumn("n_left_out", F.col("n") - F.coalesce("_n", F.lit(0))).drop("_rest", "_n"))

    def _scored(self, features: DataFrame, fits: DataFrame) -> DataFrame:
        """Rows with the parts of the fit and their sum."""
        keys = list(self.keys)
        rows = features.join(fits, keys).withColumn("_x", design_row(self.settings))
        rows = rows.withColumns({n: _part("coef", "_x", p) for n, p in self.settings.parts.items()}).drop("_x", "coef")
        rest = F.col("yearly") + F.col("weekly") + F.col("regressors") + F.col("holidays")
        total = F.col("trend") * (1 + rest) if self.multiplicative else F.col("trend") + rest
        return rows.withColumn("prediction", total)

    def components(self, features: DataFrame, fits: DataFrame) -> DataFrame:
        return self._scored(features, fits).select(
            *self.keys, "ds", "trend", "yearly", "weekly", "holidays", "regressors", "prediction")

    def in_sample_metrics(self, features: DataFrame, fits: DataFrame) -> DataFrame:
        return error_metrics(self._scored(features, fits), list(self.keys), actual="y")

    def future(self, features: DataFrame, days: int, known: DataFrame | None = None) -> DataFrame:
        """The days after each series with their regressors: as ``known`` (keys, ds, some regressors) has them,
        else the oil price of the last day and the mean of the last ``HELD_DAYS`` days of the others. A daily
        count jumps too much for its last value to stand for the days ahead."""
        keys = list(self.keys)
        recent = F.datediff(F.col("_last"), "ds") < HELD_DAYS
        ends = features.groupBy(*keys).agg(F.max("ds").alias("_last"))
        held = features.join(ends, keys).where(recent).groupBy(*keys).agg(
            F.max_by("dcoilwtico", "ds").alias("dcoilwtico"), *[F.avg(r).alias(r) for r in ("onpromotion", "transactions")])
        frame = forecast_frame(features, days, keys, date="ds", align=False).join(held, keys).withColumn("holiday", F.lit(0.0))
        if known is None:
            return frame
        given = [r for r in REGRESSORS if r in known.columns]
        told = known.groupBy(*keys, "ds").agg(*[F.max(F.col(r).cast("double")).alias(f"_{r}") for r in given])
        return frame.join(told, [*keys, "ds"], "left").withColumns(
            {r: F.coalesce(f"_{r}", r) for r in given}).drop(*[f"_{r}" for r in given])

    def predict(self, fits: DataFrame, features: DataFrame, days: int, known: DataFrame | None = None) -> DataFrame:
        """Point forecast with an interval.

        The trend may go on changing as it did: changes of slope are simulated at the rate of the history's
        changepoints and with the mean size of its changes (Laplace), seeded by series, and the interval holds the quantiles
        of those paths with normal noise. A trend without changes has the exact ± z residual deviations.
        """
        frame = known_series(self.future(features, days, known), fits, list(self.keys))
        scored = self._scored(frame, fits).withColumnRenamed("ds", "date").drop("_start", "_span")
        z = normal_quantile(0.5 + self.settings.interval_width / 2)
        plain = dict(zip(("lower", "upper"), interval(F.col("prediction"), F.sqrt("sigma2"), z)))
        columns = [*self.keys, "date", "step", "prediction"]
        if not (self.settings.changepoints and self.settings.uncertainty_samples):
            return scored.select(*columns, *plain.values())
        bands = self._bands(scored, fits).withColumnsRenamed({"lower": "_lower", "upper": "_upper"})
        at = F.col("step") - 1
        return scored.join(bands, list(self.keys), "left").select(
            *columns, *[F.coalesce(F.get(f"_{c}", at), plain[c]).alias(c) for c in ("lower", "upper")])

    def _bands(self, scored: DataFrame, fits: DataFrame, seed: int = 42) -> DataFrame:
        """``lower`` and ``upper`` of the days ahead as arrays, for series whose trend has changed before."""
        keys, settings, multiplicative = list(self.keys), self.settings, self.multiplicative
        rest = F.col("yearly") + F.col("weekly") + F.col("regressors") + F.col("holidays")
        ahead = scored.select(*keys, "step", "trend", rest.alias("rest")).groupBy(*keys).agg(
            F.array_sort(F.collect_list(F.struct("step", "trend", "rest"))).alias("_days"))
        arrays = ahead.select(*keys, *[F.col("_days").getField(c).alias(c) for c in ("step", "trend", "rest")])
        slopes = F.slice("coef", 3, settings.changepoints).alias("slopes")
        edges = [0.5 - settings.interval_width / 2, 0.5 + settings.interval_width / 2]

        def simulate(row):
            step, trend, rest = (np.asarray(row[c], float) for c in ("step", "trend", "rest"))
            size, span = float(np.abs(np.asarray(row["slopes"], float)).mean()), max(1.0, float(row["_span"]))
            if not size > 0:
                return None
            paths = trend_paths(step, span, settings.changepoints, size, settings.uncertainty_samples,
                                np.random.default_rng([seed, zlib.crc32(repr([str(row[k]) for k in keys]).encode())]),
                                math.sqrt(max(float(row["sigma2"]), 0.0)))
            level, noise = trend + paths[0], paths[1]
            low, high = np.quantile((level * (1 + rest) if multiplicative else level + rest) + noise, edges, axis=0)
            return {"lower": low, "upper": high}
        fields = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("lower", "upper")]
        return per_series(arrays.join(fits.select(*keys, "_span", "sigma2", slopes), keys), keys, fields, simulate)


def fit_additive_by_series(df: DataFrame, keys: list[str], settings: AdditiveSettings = AdditiveSettings()):
    """(model, features, fits) from a prepared fact at one row per series and day."""
    model = Additive(tuple(keys), settings)
    features = materialize(additive_features(df, list(keys)))
    return model, features, model.fit(features)
