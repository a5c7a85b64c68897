"""Orders, bands and sparse trends of the series models on planted series."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import days, rows_of
from shelfcast.operators.additive import (
    Additive, AdditiveSettings, additive_features, prior_scales, prior_solve, sparse_solve, trend_paths)
from shelfcast.operators.arima import (
    Arima, differencing_by_series, every_day, kpss_by_series, psi_weights, seasonal_critical_value, seasonal_root_by_series)

KEYS = ["store_nbr"]


def frame(spark, series, start=0):
    rows = [(d, s, None if v is None else float(v)) for s, values in series.items() for d, v in zip(days(len(values)), values)]
    return spark.createDataFrame(rows, "date date, store_nbr int, sales double")


def test_psi_weights_of_known_models():
    assert psi_weights(np.array([1.0, 0.5]), [1], [], 0, 0, 4) == pytest.approx([1, 0.5, 0.25, 0.125])
    assert psi_weights(np.array([1.0, 0.4]), [], [1], 0, 0, 4) == pytest.approx([1, 0.4, 0, 0])
    assert psi_weights(np.array([0.0]), [], [], 1, 0, 4) == pytest.approx([1, 1, 1, 1])
    assert psi_weights(np.array([0.0]), [], [], 2, 0, 4) == pytest.approx([1, 2, 3, 4])
    assert psi_weights(np.array([0.0]), [], [], 0, 1, 15) == pytest.approx([float(j % 7 == 0) for j in range(15)])
    # (1 - 0.5 B)(1 - B) y = (1 + 0.3 B) e
    both = psi_weights(np.array([0.0, 0.5, 0.3]), [1], [1], 1, 0, 3)
    assert both == pytest.approx([1, 0.5 + 1 + 0.3, (0.5 + 1) * 1.8 - 0.5])


def test_arima_band_covers_simulated_paths(spark):
    """The band of an AR(1) on differences against the spread of its own simulated futures."""
    rng = np.random.default_rng(3)
    z = [0.0]
    for _ in range(1500):
        z.append(0.6 * z[-1] + rng.normal())
    df = frame(spark, {1: np.cumsum(z)})
    model = Arima(KEYS, max_p=1, max_q=0, max_seasonal=0, seasonal=False, d=1, seasonal_d=0)
    out = rows_of(model.predict(model.fit(df), df, 20), "step")
    half = [(r["upper"] - r["lower"]) / 2 / 1.959964 for r in out]
    shocks = rng.normal(size=(20_000, 20))
    steps, paths = np.zeros(20_000), np.zeros((20_000, 20))
    for h in range(20):
        steps = 0.6 * steps + shocks[:, h]
        paths[:, h] = (paths[:, h - 1] if h else 0) + steps
    assert half == pytest.approx(list(paths.std(axis=0)), rel=0.2)
    assert all(b > a for a, b in zip(half, half[1:]))


def test_missing_days_become_unknown_ones(spark):
    values = [float(i % 7) for i in range(100)]
    df = frame(spark, {1: values, 2: values}).where("not (store_nbr = 1 and day(date) = 20)")
    full = every_day(df, "sales", KEYS)
    assert full.count() == 200 and full.where("sales is null").count() == df.where("store_nbr = 2 and day(date) = 20").count()
    # a perfect week stays one, though days are missing
    model = Arima(KEYS, max_p=0, max_q=0, max_seasonal=0, d=0, seasonal_d=1)
    out = rows_of(model.predict(model.fit(df), df, 7), "store_nbr", "step")
    assert [r["prediction"] for r in out[:7]] == pytest.approx([r["prediction"] for r in out[7:]])
    assert [round(r["prediction"]) for r in out[:7]] == [(100 + i) % 7 for i in range(7)]


@pytest.fixture(scope="module")
def kinds(spark):
    rng = np.random.default_rng(8)
    n = 700
    noise, walk = rng.normal(size=n), np.cumsum(rng.normal(size=n))
    drifting = np.zeros(n)
    for i in range(n):
        drifting[i] = (drifting[i - 7] if i >= 7 else rng.normal()) + rng.normal()
    return {1: noise, 2: walk, 3: np.cumsum(walk), 4: drifting, 5: [5.0] * n, 6: [None] * n, 7: [1.0, 2.0, 3.0]}


def test_kpss(spark, kinds):
    got = {r.store_nbr: r for r in kpss_by_series(frame(spark, kinds), "sales", KEYS).collect()}
    assert got[1].is_stationary and not got[2].is_stationary and not got[3].is_stationary
    e = kinds[1] - kinds[1].mean()
    lags = int(4 * 7 ** 0.25)
    spread = e @ e + 2 * sum((1 - j / (lags + 1)) * (e[j:] @ e[:-j]) for j in range(1, lags + 1))
    assert got[1].statistic == pytest.approx((np.cumsum(e) ** 2).sum() / len(e) / spread) and got[1].lags == lags
    assert got[5].statistic is None and got[5].is_stationary and got[6].n == 0 and got[6].is_stationary


def test_seasonal_root(spark, kinds):
    got = {r.store_nbr: r for r in seasonal_root_by_series(frame(spark, kinds), "sales", KEYS).collect()}
    assert got[4].needs_difference and not got[1].needs_difference and 7 not in got
    assert seasonal_critical_value(7) == pytest.approx(-1.8452, abs=1e-4)


def test_differences_by_the_tests(spark, kinds):
    got = {r.store_nbr: (r.d, r.seasonal_d) for r in differencing_by_series(frame(spark, kinds), "sales", KEYS).collect()}
    assert got[1] == (0, 0) and got[2][0] == 1 and got[3][0] == 2 and got[4] == (0, 1) and got[5] == (0, 0) and got[6] == (0, 0)


# ---- sparse trend ----

def hinges(n, settings):
    t = np.arange(n) / (n - 1)
    cuts = [settings.changepoint_range * i / settings.changepoints for i in range(1, settings.changepoints + 1)]
    return t, cuts, np.column_stack([np.ones(n), t, *[np.maximum(t - c, 0) for c in cuts]])


def test_sparse_solve_meets_its_conditions():
    rng = np.random.default_rng(1)
    for k in range(60):
        m = int(rng.integers(1, 26))
        x = rng.normal(size=(60, m))
        if k % 3 == 0:
            x = np.cumsum(x, axis=1)
        if k % 5 == 0 and m > 1:
            x[:, -1] = x[:, 0]
        y, limit = rng.normal(size=60) + 2 * x[:, 0], float(rng.uniform(0, 20))
        beta = sparse_solve(x.T @ x, x.T @ y, np.full(m, limit))
        slope, size = x.T @ (y - x @ beta), np.abs(x.T @ y).max()
        assert np.all(np.abs(slope) <= limit + 1e-6 * size)
        assert np.abs(slope - limit * np.sign(beta))[beta != 0].max(initial=0) <= 1e-6 * size
    assert list(sparse_solve(np.array([[2.0]]), np.array([5.0]), np.array([1.0]))) == [2.0]  # (5 - 1) / 2
    assert list(sparse_solve(np.zeros((2, 2)), np.zeros(2), np.ones(2))) == [0, 0]


def test_one_break_gives_one_change(spark):
    settings = AdditiveSettings(seasonality_mode="additive", yearly_seasonality=False, weekly_seasonality=False,
                                changepoint_prior_scale=0.005)
    t, cuts, _ = hinges(1000, settings)
    y = 20 + 10 * t + 60 * np.maximum(t - cuts[12], 0) + np.random.default_rng(0).normal(0, 2, 1000)
    df = frame(spark, {1: y})
    fit = Additive(("store_nbr",), settings).fit(additive_features(df, KEYS)).first()
    changes = np.array(fit["coef"][2:27])
    assert list(np.flatnonzero(changes)) == [12] and changes[12] == pytest.approx(60, rel=0.1)


def test_default_prior_keeps_the_break(spark):
    settings = AdditiveSettings()
    t, cuts, x = hinges(1000, settings)
    y = 20 + 10 * t + 60 * np.maximum(t - cuts[5], 0) + np.random.default_rng(0).normal(0, 0.5, 1000)
    beta, _ = prior_solve(x.T @ x, x.T @ y, y @ y, 1000, prior_scales(settings)[:27], 25)
    changes = np.abs(beta[2:])
    assert changes.argmax() == 5 and changes[5] > 0.9 * changes.sum() and (changes == 0).sum() > 15


# ---- bands of the additive model ----

def test_trend_paths_have_the_variance_of_their_process():
    step = np.arange(1.0, 61)
    paths, noise = trend_paths(step, 300, 25, 2.0, 20_000, np.random.default_rng(4), 3.0)
    t = step / 300
    assert paths.std(axis=0)[[9, 29, 59]] == pytest.approx(np.sqrt(2 * 2.0 ** 2 * 25 * t ** 3 / 3)[[9, 29, 59]], rel=0.05)
    assert noise.std() == pytest.approx(3, rel=0.02)


def bent_series(rng, n):
    """A line whose slope changes every now and then, with a week and noise."""
    slope, level, out = 0.05, 100.0, []
    for i in range(n):
        if rng.random() < 0.02:
            slope += rng.gauss(0, 0.15)
        level += slope
        out.append(level + 3 * math.sin(2 * math.pi * i / 7) + rng.gauss(0, 1))
    return out


def test_bands_widen_repeat_and_cover(spark):
    rng = random.Random(6)
    horizon = 60
    whole = {s: bent_series(rng, 500 + horizon) for s in range(40)}
    df = frame(spark, {s: v[:500] for s, v in whole.items()})
    settings = AdditiveSettings(seasonality_mode="additive", yearly_seasonality=False, changepoint_range=0.95, changepoint_prior_scale=0.5)
    model = Additive(("store_nbr",), settings)
    features = additive_features(df, KEYS)
    fits = model.fit(features)
    first = rows_of(model.predict(fits, features, horizon), "store_nbr", "step")
    again = rows_of(model.predict(fits, features.repartition(5), horizon), "store_nbr", "step")
    assert [(r["lower"], r["upper"]) for r in first] == [(r["lower"], r["upper"]) for r in again]
    width = np.array([r["upper"] - r["lower"] for r in first]).reshape(40, horizon)
    assert (width[:, -10:].mean(axis=1) > 1.5 * width[:, :5].mean(axis=1)).mean() > 0.9
    covered = [r["lower"] <= whole[r["store_nbr"]][499 + r["step"]] <= r["upper"] for r in first]
    plain = Additive(("store_nbr",), AdditiveSettings(**{**settings.__dict__, "uncertainty_samples": 0}))
    flat = rows_of(plain.predict(fits, features, horizon), "store_nbr", "step")
    assert {round(r["upper"] - r["lower"], 6) for r in flat if r["store_nbr"] == 3} == {round(flat[180]["upper"] - flat[180]["lower"], 6)}
    flat_covered = [r["lower"] <= whole[r["store_nbr"]][499 + r["step"]] <= r["upper"] for r in flat]
    # 80 % is asked for; the flat band misses far more of the later days
    assert 0.6 < np.mean(covered) < 0.97 and np.mean(covered) > np.mean(flat_covered) + 0.1


def test_multiplicative_band_and_a_trend_without_changes(spark):
    df = frame(spark, {1: [(50 + 0.1 * i) * (1 + 0.2 * math.sin(2 * math.pi * i / 7)) for i in range(300)], 2: [5.0] * 300})
    model = Additive(("store_nbr",), AdditiveSettings(yearly_seasonality=False))
    features = additive_features(df, KEYS)
    out = rows_of(model.predict(model.fit(features), features, 14), "store_nbr", "step")
    assert all(r["lower"] <= r["prediction"] + 1e-6 and r["prediction"] <= r["upper"] + 1e-6 for r in out)
    assert all(abs(r["prediction"] - 5) < 1e-6 for r in out if r["store_nbr"] == 2)
