"""Seasonal ARIMA models for many series by two rounds of least squares (Hannan–Rissanen)."""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.expressions import normal_quantile
from ..functions.special import dickey_fuller_p
from ..session import materialize
from .clean import fill_forward_backward
from .evaluate import error_metrics
from .forecast import forecast_frame, interval, known_series
from .linear import dot, information, moments, per_series, residual_sum, solve, unpack

SEASON = 7
LONG_AR = 14
#: Days of the longest history that lag limits are planned for: a century.
LONGEST_DAYS = 36525
ADF_FIELDS = [T.StructField("n", T.LongType()), T.StructField("lags", T.IntegerType()),
              T.StructField("statistic", T.DoubleType()), T.StructField("p_value", T.DoubleType()),
              T.StructField("is_stationary", T.BooleanType())]


def _window(keys, date):
    return Window.partitionBy(*keys).orderBy(date)


def lag_limit(n: int) -> int:
    return math.ceil(12 * (n / 100) ** 0.25)


def adf_by_series(daily: DataFrame, value: str, keys: list[str], date: str = "date", max_lag: int | None = None,
                  alpha: float = 0.05, longest: int | None = None) -> DataFrame:
    """Augmented Dickey–Fuller test with a constant; the number of lags is the one with the best AIC.

    All lag orders are read off one matrix per series. Without ``max_lag`` the limit follows each series' own
    length: lags beyond it are columns of zeros, which take no rows from the series and are never chosen. ``longest`` is the
    number of days of the longest series, where it is known; else the history is counted first.
    """
    w = _window(keys, date)
    own_limit = F.lit(max_lag)
    if max_lag is None:
        if longest is None:
            longest = daily.groupBy(*keys).agg(F.count(value).alias("n")).agg(F.max("n")).first()[0] or 0
        max_lag = max(1, lag_limit(longest))
        known = F.count(value).over(Window.partitionBy(*keys))
        own_limit = F.greatest(F.lit(1), F.ceil(12 * F.pow(known / 100, 0.25)))
    steps = daily.select(*keys, date, (F.col(value) - F.lag(value).over(w)).alias("_dy"), F.lag(value).over(w).alias("_y1"),
                         own_limit.alias("_limit"))
    names = [f"_d{i}" for i in range(1, max_lag + 1)]
    rows = steps.select(*keys, "_dy", "_y1", F.lit(1.0).alias("_one"), *[
        F.when(F.col("_limit") >= i, F.lag("_dy", i).over(w)).otherwise(0.0).alias(n) for i, n in enumerate(names, 1)])
    grams = moments(rows, keys, ["_one", "_y1", *names], "_dy")

    def fit(row):
        xtx, xty, yty = unpack(row["moments"])
        n = int(row["n"])
        best = None
        for lags in range(0, max_lag + 1):
            k = lags + 2
            if n <= k + 1 or (lags and not xtx[k - 1, k - 1] > 0):
                break
            beta, inverse = solve(xtx[:k, :k], xty[:k])
            rss = residual_sum(xtx[:k, :k], xty[:k], yty, beta)
            aic, _ = information(n, rss, k)
            if best is None or aic < best[0]:
                error = math.sqrt(max(inverse[1, 1] * rss / (n - k), 0.0))
                best = (aic, lags, beta[1] / error if error > 0 else float("-inf"))
        if best is None:
            return None
        p = dickey_fuller_p(best[2])
        return {"n": n, "lags": best[1], "statistic": best[2], "p_value": p, "is_stationary": p < alpha}
    return per_series(grams, keys, ADF_FIELDS, fit)


def kpss_lag_limit(n: int) -> int:
    return int(4 * (n / 100) ** 0.25)


def _kpss(df: DataFrame, cols: list[str], keys: list[str], date: str, longest: int) -> DataFrame:
    """Per series and column c: ``n_c``, ``lags_c`` and the KPSS ``statistic_c`` for a constant level.

    The long-run variance comes from lagged sums with weights that fall to 0 (Bartlett) after
    4 (n / 100)^(1/4) lags. Residuals, partial sums and lags share one window; days without a value are left
    out of every sum they would enter.
    """
    whole, w = Window.partitionBy(*keys), _window(keys, date)
    upto, most = w.rowsBetween(Window.unboundedPreceding, 0), kpss_lag_limit(longest)
    centred = df.select(*keys, date, *[(F.col(c) - F.avg(c).over(whole)).alias(f"_e_{c}") for c in cols])
    rows = centred.select(*keys, *[x for c in cols for x in (
        F.col(f"_e_{c}"), F.when(F.col(f"_e_{c}").isNotNull(), F.sum(f"_e_{c}").over(upto)).alias(f"_s_{c}"),
        *[(F.col(f"_e_{c}") * F.lag(f"_e_{c}", j).over(w)).alias(f"_p_{c}_{j}") for j in range(1, most + 1)])])
    sums = rows.groupBy(*keys).agg(*[x for c in cols for x in (
        F.count(f"_e_{c}").alias(f"n_{c}"), F.sum(F.col(f"_s_{c}") * F.col(f"_s_{c}")).alias(f"_ss_{c}"),
        F.sum(F.col(f"_e_{c}") * F.col(f"_e_{c}")).alias(f"_ee_{c}"),
        *[F.coalesce(F.sum(f"_p_{c}_{j}"), F.lit(0.0)).alias(f"_pp_{c}_{j}") for j in range(1, most + 1)])])
    sums = sums.withColumns({f"lags_{c}": F.least(F.lit(most), F.floor(4 * F.pow(F.col(f"n_{c}") / 100, 0.25))).cast("int") for c in cols})
    out = []
    for c in cols:
        spread = F.col(f"_ee_{c}")
        for j in range(1, most + 1):
            weight = F.greatest(F.lit(0.0), 1 - j / (F.col(f"lags_{c}") + 1))
            spread = spread + 2 * weight * F.col(f"_pp_{c}_{j}")
        n = F.col(f"n_{c}").cast("double")
        # a constant has no variance and no statistic
        statistic = F.when((F.col(f"_ee_{c}") > 0) & (spread > 0), F.col(f"_ss_{c}") / (n * spread))
        out += [F.col(f"n_{c}"), F.col(f"lags_{c}"), statistic.alias(f"statistic_{c}")]
    return sums.select(*keys, *out)


# Upper tail of the KPSS statistic for a constant level (Kwiatkowski and others, 1992).
KPSS_LIMITS = [0.347, 0.463, 0.574, 0.739]
KPSS_TAILS = [0.10, 0.05, 0.025, 0.01]


def _kpss_p(statistic):
    """Interpolated in the table and held at its ends."""
    p = F.lit(KPSS_TAILS[-1])
    rows = list(zip(KPSS_LIMITS, KPSS_LIMITS[1:], KPSS_TAILS, KPSS_TAILS[1:]))
    for a, b, upper, lower in reversed(rows):
        p = F.when(statistic < b, upper + (statistic - a) / (b - a) * (lower - upper)).otherwise(p)
    return F.when(statistic.isNotNull(), F.when(statistic < KPSS_LIMITS[0], KPSS_TAILS[0]).otherwise(p))


def kpss_by_series(daily: DataFrame, value: str, keys: list[str], date: str = "date", alpha: float = 0.05,
                   longest: int = LONGEST_DAYS) -> DataFrame:
    """KPSS test of a constant level: n, lags, statistic, p_value (between 0.01 and 0.1), is_stationary.

    The history has one row per key and day. ``longest`` bounds the lags that are summed: a series of more days is
    tested with the lags of that many.
    """
    tested = _kpss(daily.select(*keys, date, F.col(value).cast("double").alias("y")), ["y"], keys, date, longest)
    p = _kpss_p(F.col("statistic_y"))
    return tested.select(*keys, F.col("n_y").alias("n"), F.col("lags_y").alias("lags"), F.col("statistic_y").alias("statistic"),
                         p.alias("p_value"), F.coalesce(p >= alpha, F.lit(True)).alias("is_stationary"))


SEASONAL_FIELDS = [T.StructField("n", T.LongType()), T.StructField("lags", T.IntegerType()),
                   T.StructField("statistic", T.DoubleType()), T.StructField("needs_difference", T.BooleanType())]


def seasonal_critical_value(season: int) -> float:
    """5 % point of the seasonal t-ratio. The response surface used for this test in public software."""
    x = math.log(season) - 0.7656451
    return -0.2937411 * math.exp(-0.2850853 * x - 0.05983644 * x * x) - 1.652202


def seasonal_root_by_series(daily: DataFrame, value: str, keys: list[str], date: str = "date", season: int = SEASON,
                            max_lag: int = 3) -> DataFrame:
    """Seasonal unit-root test of Osborn, Chui, Smith and Birchenhall: n, lags, statistic, needs_difference.

    The doubly differenced series is regressed on its lags, on the filtered seasonal difference of the day before and on
    the filtered daily difference a season before; the t-ratio of the latter is far below 0 unless the season drifts.
    The filter is an autoregression of the doubly differenced series, and its order the one with the best AIC. All of it is
    read off one matrix per series of plain lags. A series too short for the regression gives no row.
    """
    w = _window(keys, date)
    df = daily.select(*keys, date, F.col(value).cast("double").alias("_y"))
    df = df.select(*keys, date, (F.col("_y") - F.lag("_y").over(w)).alias("_d"), (F.col("_y") - F.lag("_y", season).over(w)).alias("_m"))
    df = df.withColumn("_w", F.col("_m") - F.lag("_m").over(w))
    lags = {"_w": range(1, max_lag + 1), "_m": range(1, max_lag + 2), "_d": range(season, season + max_lag + 1)}
    names = [f"{c}{k}" for c, ks in lags.items() for k in ks]
    rows = df.select(*keys, "_w", *[F.lag(c, k).over(w).alias(f"{c}{k}") for c, ks in lags.items() for k in ks])
    limit, width = seasonal_critical_value(season), len(names)

    def fit(row):
        xtx, xty, yty = unpack(row["moments"])
        n, best = int(row["n"]), None
        for p in range(max_lag + 1):
            k = p + 2
            if n <= k + 1:
                break
            phi = solve(xtx[:p, :p], xty[:p])[0] if p else np.zeros(0)
            used = np.zeros((width, k))
            used[np.arange(p), np.arange(p)] = 1.0
            used[max_lag:max_lag + p + 1, p] = used[2 * max_lag + 1:2 * max_lag + p + 2, p + 1] = [1.0, *-phi]
            gram, rhs = used.T @ xtx @ used, used.T @ xty
            beta, inverse = solve(gram, rhs)
            rss = residual_sum(gram, rhs, yty, beta)
            aic, _ = information(n, rss, k)
            if best is None or aic < best[0]:
                error = math.sqrt(max(inverse[-1, -1] * rss / (n - k), 0.0))
                best = (aic, p, float(beta[-1] / error) if error > 0 else None)
        if best is None:
            return None
        return {"n": n, "lags": best[1], "statistic": best[2], "needs_difference": best[2] is not None and best[2] > limit}
    return per_series(moments(rows, keys, names, "_w"), keys, SEASONAL_FIELDS, fit)


def differencing_by_series(daily: DataFrame, value: str, keys: list[str], date: str = "date", max_d: int = 2,
                           seasonal: bool = True, alpha: float = 0.05) -> DataFrame:
    """``d`` and ``seasonal_d`` per series: a seasonal difference where the seasonal unit-root test does not reject one,
    then the fewest differences whose level the KPSS test accepts. A series of less than four weeks has no seasonal
    difference; one that is constant or has no value needs none at all."""
    history = daily.select(*keys, date, F.col(value).cast("double").alias("_y"))
    sizes = history.groupBy(*keys).agg(F.count("_y").alias("_n"))
    if seasonal:
        tests = seasonal_root_by_series(history, "_y", keys, date).select(*keys, "needs_difference")
        drifts = F.coalesce(F.col("needs_difference") & (F.col("_n") >= 4 * SEASON), F.lit(False))
        orders = materialize(sizes.join(tests, keys, "left").select(*keys, drifts.cast("int").alias("seasonal_d")))
    else:
        orders = sizes.select(*keys, F.lit(0).alias("seasonal_d"))
    current = _differenced(history, "_y", keys, date, orders.withColumn("d", F.lit(0))).select(*keys, date, F.col("_z").alias("_d0"))
    w = _window(keys, date)
    for d in range(1, max_d):
        current = current.withColumn(f"_d{d}", F.col(f"_d{d - 1}") - F.lag(f"_d{d - 1}").over(w))
    needed = F.lit(max_d)
    if not max_d:
        return orders.select(*keys, needed.alias("d"), "seasonal_d")
    cols = [f"_d{d}" for d in range(max_d)]
    tests = _kpss(current, cols, keys, date, LONGEST_DAYS)
    for d in reversed(range(max_d)):
        accepted = F.coalesce(_kpss_p(F.col(f"statistic__d{d}")) >= alpha, F.lit(True))
        needed = F.when(accepted, d).otherwise(needed)
    return orders.join(tests, keys, "left").select(*keys, needed.cast("int").alias("d"), "seasonal_d")


def every_day(history: DataFrame, value: str, keys: list[str], date: str = "date") -> DataFrame:
    """The keys, date and value of the history with a row of NULL for each day missing inside a series, so that rows next to
    each other are days next to each other."""
    gap = F.coalesce(F.datediff(F.lead(date).over(_window(keys, date)), F.col(date)), F.lit(1))
    dated = history.select(*keys, date, F.col(value).cast("double").alias(value), gap.alias("_gap"))
    days = F.sequence(F.lit(0), F.greatest(F.col("_gap") - 1, F.lit(0)))
    return dated.select(*keys, date, value, F.explode(days).alias("_day")).select(
        *keys, F.date_add(date, F.col("_day")).alias(date), F.when(F.col("_day") == 0, F.col(value)).alias(value))


def _differenced(daily, value, keys, date, orders):
    w = _window(keys, date)
    df = daily.select(*keys, date, F.col(value).alias("_y")).join(orders, keys)
    df = df.withColumn("_s", F.when(F.col("seasonal_d") == 1, F.col("_y") - F.lag("_y", SEASON).over(w)).otherwise(F.col("_y")))
    z = F.when(F.col("d") == 0, F.col("_s")).when(F.col("d") == 1, F.col("_s") - F.lag("_s").over(w)) \
        .otherwise(F.col("_s") - 2 * F.lag("_s").over(w) + F.lag("_s", 2).over(w))
    return df.withColumn("_z", z).drop("_s")


LONG_FIELDS = [T.StructField("long_ar", T.ArrayType(T.DoubleType()))]


def _lagged(df, col, lags, keys, date, prefix):
    """Lag columns; lags beyond the series' ``lag_cap`` are zero."""
    w = _window(keys, date)
    return df.select("*", *[F.when(F.col("lag_cap") >= k, F.lag(col, k).over(w)).otherwise(0.0).alias(f"{prefix}{k}") for k in lags])


def _with_shocks(df, keys, date, fits):
    """Adds the residual of the long autoregression."""
    lags = list(range(1, LONG_AR + 1))
    lagged = _lagged(df, "_z", lags, keys, date, "_a").withColumn("_one", F.lit(1.0))
    joined = lagged.join(fits, keys)
    return joined.withColumn("_e", F.col("_z") - dot("long_ar", F.array("_one", *[f"_a{k}" for k in lags]))) \
        .drop(*[f"_a{k}" for k in lags])


def _design(max_p, max_q, max_sp, max_sq):
    """Lags of the series and of the shocks; the column order of every fit."""
    ar = [*range(1, max_p + 1), *[SEASON * i for i in range(1, max_sp + 1)]]
    ma = [*range(1, max_q + 1), *[SEASON * i for i in range(1, max_sq + 1)]]
    return ar, ma


def psi_weights(coef: np.ndarray, ar: list[int], ma: list[int], d: int, seasonal_d: int, days: int) -> np.ndarray:
    """Weights of the shocks of the last ``days`` days in the undifferenced series: the moving-average form of the model
    with its differences multiplied into the autoregression."""
    past = np.zeros(max(ar, default=0) + 1)
    past[0] = 1.0
    past[ar] -= coef[1:1 + len(ar)]
    for step in [1] * d + [SEASON] * seasonal_d:
        past = np.convolve(past, [1.0, *[0.0] * (step - 1), -1.0])
    psi = np.zeros(max(days, max(ma, default=0) + 1))
    psi[0] = 1.0
    psi[ma] += coef[1 + len(ar):]
    for j in range(1, len(psi)):
        k = min(j, len(past) - 1)
        psi[j] -= past[1:k + 1] @ psi[j - k:j][::-1]
    return psi[:days]


MODEL_FIELDS = [
    T.StructField("p", T.IntegerType()), T.StructField("q", T.IntegerType()),
    T.StructField("seasonal_p", T.IntegerType()), T.StructField("seasonal_q", T.IntegerType()),
    T.StructField("n", T.LongType()), T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("sigma2", T.DoubleType()), T.StructField("aic", T.DoubleType()), T.StructField("bic", T.DoubleType()),
]


class Arima:
    """Order search, fit, diagnostics and forecast per series.

    The history has one row per key and day; missing days count as unknown. Candidates are all lag orders up to the limits;
    each is a sub-block of one matrix per series and the best AIC wins. No lag reaches further back than a
    quarter of the series, so short series get smaller models, down to a constant; a series without any known
    value gets a row without coefficients and NULL forecasts.
    """

    name = "arima"

    def __init__(self, keys: list[str], value: str = "sales", date: str = "date", max_p: int = 5, max_d: int = 2,
                 max_q: int = 5, max_seasonal: int = 2, seasonal: bool = True, d: int | None = None, seasonal_d: int | None = None):
        """``d`` (0 to 2) and ``seasonal_d`` (0 or 1) fix the differences instead of testing for them."""
        self.keys, self.value, self.date, self.max_d, self.seasonal = list(keys), value, date, max_d, seasonal
        self.fixed = {k: v for k, v in (("d", d), ("seasonal_d", seasonal_d)) if v is not None}
        cap = max_seasonal if seasonal else 0
        self.limits = (max_p, max_q, cap, cap)
        self.ar, self.ma = _design(*self.limits)

    def _rows(self, history: DataFrame, orders: DataFrame, long_fits: DataFrame) -> DataFrame:
        df = _differenced(history, self.value, self.keys, self.date, orders)
        df = _with_shocks(df, self.keys, self.date, long_fits)
        df = _lagged(df, "_z", self.ar, self.keys, self.date, "_z")
        return _lagged(df, "_e", self.ma, self.keys, self.date, "_e")

    @property
    def _columns(self) -> list[str]:
        return ["_one", *[f"_z{k}" for k in self.ar], *[f"_e{k}" for k in self.ma]]

    def fit(self, history: DataFrame) -> DataFrame:
        """Orders, coefficients, residual variance and information criteria, one row per series."""
        keys, date = self.keys, self.date
        # the three columns that several rounds of sums read, and each round's small result, are stored
        history = materialize(every_day(history, self.value, keys, date))
        orders = history.groupBy(*keys).agg(F.floor(F.count(self.value) / 4).cast("int").alias("lag_cap"))
        if len(self.fixed) < 2:
            tested = differencing_by_series(history, self.value, keys, date, self.max_d, self.seasonal and "seasonal_d" not in self.fixed)
            orders = orders.join(tested, keys)
        orders = materialize(orders.withColumns({k: F.lit(v) for k, v in self.fixed.items()}))
        lags = list(range(1, LONG_AR + 1))
        base = _lagged(_differenced(history, self.value, keys, date, orders), "_z", lags, keys, date, "_a").withColumn("_one", F.lit(1.0))
        long_moments = moments(base, keys, ["_one", *[f"_a{k}" for k in lags]], "_z")
        long_fits = materialize(per_series(
            long_moments, keys, LONG_FIELDS,
            lambda row: {"long_ar": solve(*unpack(row["moments"])[:2])[0]}))
        grams = moments(self._rows(history, orders, long_fits), keys, self._columns, "_z")
        ar, ma, (max_p, max_q, max_sp, max_sq) = self.ar, self.ma, self.limits

        def columns(p, q, sp, sq):
            kept_ar = [i for i, k in enumerate(ar) if (i < max_p and k <= p) or (i >= max_p and k <= sp * SEASON)]
            kept_ma = [i for i, k in enumerate(ma) if (i < max_q and k <= q) or (i >= max_q and k <= sq * SEASON)]
            return [0, *[1 + i for i in kept_ar], *[1 + len(ar) + i for i in kept_ma]]

        def choose(row):
            xtx, xty, yty = unpack(row["moments"])
            n, best = int(row["n"]), None
            for p, q, sp, sq in product(range(max_p + 1), range(max_q + 1), range(max_sp + 1), range(max_sq + 1)):
                cols = columns(p, q, sp, sq)
                k = len(cols)
                if n <= k + 1:
                    continue
                sub, rhs = xtx[np.ix_(cols, cols)], xty[cols]
                beta, _ = solve(sub, rhs)
                rss = residual_sum(sub, rhs, yty, beta)
                aic, bic = information(n, rss, k)
                if best is None or aic < best[0]:
                    best = (aic, bic, (p, q, sp, sq), cols, beta, rss / (n - k))
            coef = np.zeros(len(xty))
            if best is None:  # too few rows for any candidate: their mean
                coef[0] = xty[0] / n
                best = (None, None, (0, 0, 0, 0), [0], coef[:1], max(0.0, yty / n - coef[0] ** 2))
            coef[best[3]] = best[4]
            p, q, sp, sq = best[2]
            return {"p": p, "q": q, "seasonal_p": sp, "seasonal_q": sq, "n": n, "coef": coef, "sigma2": best[5],
                    "aic": best[0], "bic": best[1]}
        chosen = per_series(grams, keys, MODEL_FIELDS, choose)
        return materialize(orders.join(chosen, keys, "left").join(long_fits, keys, "left"))

    def diagnostics(self, fits: DataFrame, history: DataFrame, level: float = 0.95) -> DataFrame:
        """Actual and fitted values, residuals and the interval of each day that has all its lags."""
        z = normal_quantile(0.5 + level / 2)
        orders = fits.select(*self.keys, "d", "seasonal_d", "lag_cap")
        rows = self._rows(history, orders, fits.select(*self.keys, "long_ar"))
        # only the terms the model has are asked for; the others may lie before the series
        terms = F.zip_with("coef", F.array(*self._columns), lambda c, x: F.when(c == 0, 0.0).otherwise(c * x))
        joined = rows.join(fits.select(*self.keys, "coef", "sigma2"), self.keys).withColumn(
            "residual", F.col("_z") - F.aggregate(terms, F.lit(0.0), lambda a, v: a + v)).where("residual IS NOT NULL")
        fitted = F.col("_y") - F.col("residual")
        return joined.select(*self.keys, self.date, F.col("_y").alias("actual"), fitted.alias("prediction"),
                             "residual", *interval(fitted, F.sqrt("sigma2"), z))

    def in_sample_metrics(self, fits: DataFrame, history: DataFrame) -> DataFrame:
        errors = error_metrics(self.diagnostics(fits, history), self.keys)
        return errors.join(fits.select(*self.keys, "aic", "bic"), self.keys)

    def predict(self, fits: DataFrame, history: DataFrame, days: int, level: float = 0.95) -> DataFrame:
        """Recursive forecast of the days after the history; an error for a series without a row in ``fits``.

        Intervals widen with the step as the shocks of the days in between add up (``psi_weights``). Only the last rows of each series leave the window: enough for the longest lag and the differences. An
        unknown value among them takes the last known one before it.
        """
        keys, date, ar, ma = self.keys, self.date, self.ar, self.ma
        wanted = known_series(forecast_frame(history, days, keys, date=date, align=False), fits, keys)
        depth = max([LONG_AR, *ar, *ma]) + SEASON + self.max_d + 1
        last = history.groupBy(*keys).agg(F.max(date).alias("_last"))
        near = history.join(last, keys).where(F.datediff("_last", date) < 2 * depth + LONG_AR).drop("_last")
        near = fill_forward_backward(every_day(near, self.value, keys, date), self.value, date, keys)
        rows = _with_shocks(_differenced(near, self.value, keys, date, fits.select(*keys, "d", "seasonal_d", "lag_cap")),
                            keys, date, fits.select(*keys, "long_ar"))
        tail = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(date, "_y", "_z", "_e"))).alias("t"))
        arrays = tail.select(*keys, *[F.col("t").getField(c).alias(c) for c in ("_y", "_z", "_e")])
        ready = arrays.join(fits.select(*keys, "d", "seasonal_d", "coef", "sigma2"), keys)

        def ahead(row):
            if row["coef"] is None or row["sigma2"] is None:
                return None
            # the first differences and shocks of a series are unknown, and no term with a coefficient reaches them
            y, z, e = ([0.0] * depth + list(np.nan_to_num(np.asarray(row[c], float))) for c in ("_y", "_z", "_e"))
            d, sd, coef = int(row["d"]), int(row["seasonal_d"]), np.asarray(row["coef"], float)
            path = []
            for _ in range(days):
                value = coef @ np.array([1.0, *[z[-k] for k in ar], *[e[-k] for k in ma]])
                z.append(value)
                e.append(0.0)
                season = y[-SEASON] if sd else 0.0
                s1 = y[-1] - (y[-1 - SEASON] if sd else 0.0)
                s2 = y[-2] - (y[-2 - SEASON] if sd else 0.0)
                s = value + (s1 if d == 1 else 2 * s1 - s2 if d == 2 else 0.0)
                y.append(s + season)
                path.append(float(y[-1]))
            psi = psi_weights(coef, ar, ma, d, sd, days)
            return {"_path": path, "_spread": np.sqrt(max(row["sigma2"], 0.0) * np.cumsum(psi ** 2))}
        fields = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("_path", "_spread")]
        paths = per_series(ready, keys, fields, ahead)
        point = F.get("_path", F.col("step") - 1)
        z = normal_quantile(0.5 + level / 2)
        return wanted.join(paths, keys, "left").select(
            *keys, date, "step", point.alias("prediction"), *interval(point, F.get("_spread", F.col("step") - 1), z))
