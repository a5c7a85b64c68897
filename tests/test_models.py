import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import days, rows_of, wave
from shelfcast.operators import evaluate, forecast, learner, linear, search
from shelfcast.operators.additive import Additive, AdditiveSettings, additive_features
from shelfcast.operators.arima import Arima, adf_by_series, differencing_by_series
from shelfcast.plans import jobs

KEYS = ["store_nbr"]


def test_wide_and_narrow_sums_agree(spark):
    rng = random.Random(0)
    cols = [f"x{i}" for i in range(4)]
    rows = [(k, *[rng.gauss(5, 2) for _ in cols], rng.gauss(0, 1)) for k in ("a", "b", "b") for _ in range(300)]
    df = spark.createDataFrame(rows, f"k string, {', '.join(c + ' double' for c in cols)}, y double").repartition(7)
    narrow = {r.k: (r.n, r.moments) for r in linear.moments(df, ["k"], cols, "y").collect()}
    wide_rows = df.select("k", F.array(*cols).alias("x"), "y")
    for r in linear.moments_of_array(wide_rows, ["k"], "x", "y").collect():
        assert r.n == narrow[r.k][0] and r.moments == pytest.approx(narrow[r.k][1], rel=1e-9)


def test_grouped_ols(spark):
    rng = random.Random(5)
    rows = [(k, 1.0, float(i), (2.0 if k == "a" else -1.0) * i + 3 + rng.gauss(0, 0.1)) for k in "ab" for i in range(200)]
    df = spark.createDataFrame(rows, "k string, one double, t double, y double")
    fits = {r.k: r for r in linear.grouped_ols(df, ["k"], ["one", "t"], "y").collect()}
    x = np.array([[1.0, i] for i in range(200)])
    want = np.linalg.lstsq(x, np.array([r[3] for r in rows[:200]]), rcond=None)[0]
    assert fits["a"].coef == pytest.approx(list(want)) and fits["b"].coef[1] == pytest.approx(-1, abs=0.01)
    assert fits["a"].sigma2 == pytest.approx(0.01, rel=0.4)
    terms = {(r.series, r.term): r.value for r in linear.coefficient_rows(linear.grouped_ols(df, ["k"], ["one", "t"], "y"), ["k"], ["one", "t"]).collect()}
    assert terms[("b", "t")] == pytest.approx(-1, abs=0.01)


@pytest.fixture(scope="module")
def walks(spark):
    rng = random.Random(42)
    rows, level = [], 0.0
    for i, d in enumerate(days(600)):
        level += rng.gauss(0, 1)
        rows += [(d, 1, level), (d, 2, rng.gauss(0, 1))]
    return spark.createDataFrame(rows, "date date, store_nbr int, sales double").cache()


def test_unit_root(walks):
    tests = {r.store_nbr: r for r in adf_by_series(walks, "sales", KEYS).collect()}
    assert all(0 <= r.p_value <= 1 for r in tests.values())
    assert not tests[1].is_stationary and tests[2].is_stationary
    orders = {r.store_nbr: r for r in differencing_by_series(walks, "sales", KEYS).collect()}
    assert (orders[1].d, orders[2].d) == (1, 0) and orders[2].seasonal_d == 0


def test_arima_on_a_planted_week(weekly_series):
    model = Arima(KEYS)
    fits = model.fit(weekly_series)
    metrics = model.in_sample_metrics(fits, weekly_series).collect()
    assert len(metrics) == 2 and all(r.rmse < 1.6 and r.aic is not None for r in metrics)
    future = rows_of(model.predict(fits, weekly_series, 14), "store_nbr", "date")
    assert len(future) == 28 and future[0]["date"] == days(401)[-1]
    for r in future:
        assert r["prediction"] == pytest.approx(wave(399 + r["step"]), abs=4)
        assert r["lower"] < r["prediction"] < r["upper"]


def test_arima_refuses_unknown_series(weekly_series):
    model = Arima(KEYS, max_p=1, max_q=0, max_seasonal=1)
    fits = model.fit(weekly_series.where("store_nbr = 1"))
    with pytest.raises(Exception, match="no model for series"):
        model.predict(fits, weekly_series, 7).collect()


def test_autoregression_coefficient(spark):
    rng = random.Random(2)
    rows, y = [], 0.0
    for d in days(2000):
        y = 0.7 * y + rng.gauss(0, 1)
        rows.append((d, 1, y))
    df = spark.createDataFrame(rows, "date date, store_nbr int, sales double")
    row = Arima(KEYS, max_q=0, max_seasonal=0, max_p=1).fit(df).first()
    assert row["d"] == 0 and row["p"] == 1 and row["coef"][1] == pytest.approx(0.7, abs=0.06)
    assert row["sigma2"] == pytest.approx(1, abs=0.15)


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_additive_model(spark, mode):
    rng = random.Random(42)

    def planted(i):
        if mode == "additive":
            return wave(i, yearly=True)
        return (50 + 0.1 * i) * (1 + 0.15 * np.sin(2 * np.pi * i / 7) + 0.05 * np.sin(2 * np.pi * i / 365))
    rows = [(d, s, float(planted(i) + rng.gauss(0, 1)), i % 2, 50.0 + i % 5, 0) for s in (1, 2) for i, d in enumerate(days(800))]
    df = spark.createDataFrame(rows, "date date, store_nbr int, sales double, onpromotion int, dcoilwtico double, holiday_type_Holiday int")
    model = Additive(("store_nbr",), AdditiveSettings(seasonality_mode=mode))
    features = additive_features(df, KEYS)
    fits = model.fit(features)
    metrics = evaluate.macro_average(model.in_sample_metrics(features, fits)).first()
    assert metrics["avg_rmse"] < 3
    future = rows_of(model.predict(fits, features, 28), "store_nbr", "date")
    assert len(future) == 56
    def rmse(pairs):
        return np.sqrt(np.mean([(a - b) ** 2 for a, b in pairs]))
    truth = {r["step"]: planted(799 + r["step"]) for r in future}
    own = rmse((r["prediction"], truth[r["step"]]) for r in future)
    naive = rmse((r["seasonal_naive"], truth[r["step"]]) for r in forecast.baseline_forecast(df, "sales", KEYS, 28).collect())
    assert own < naive and own < 3, (own, naive)
    if mode == "additive":
        parts = model.components(features, fits)
        off = parts.where(F.abs(F.col("prediction") - F.col("trend") - F.col("yearly") - F.col("weekly") - F.col("holidays") - F.col("regressors")) > 1e-6)
        assert off.count() == 0
        # the planted week has amplitude ten
        assert parts.agg(F.max("weekly")).first()[0] == pytest.approx(9.75, abs=1.5)


def test_additive_features_defaults(spark):
    df = spark.createDataFrame([(days(1)[0], 1, 5.0)], "date date, store_nbr int, sales double")
    row = additive_features(df, KEYS).first()
    assert (row["onpromotion"], row["dcoilwtico"], row["transactions"], row["holiday"]) == (0.0, 0.0, 0.0, 0.0)


def test_sequence_regressor(weekly_series):
    model, losses = learner.fit_sequence_regressor(weekly_series, "sales", KEYS)
    row = losses.first()
    assert 0 <= row["train_loss"] < 0.01 and 0 <= row["val_loss"] < 0.01
    predicted = learner.predict_next(model, weekly_series, "sales", KEYS)
    assert evaluate.error_metrics(predicted).first()["rmse"] < 3
    with pytest.raises(ValueError):
        learner.fit_sequence_regressor(weekly_series, "sales", KEYS, method="other")


def test_forecast_frame(weekly_series):
    frame = forecast.forecast_frame(weekly_series, 7, KEYS, [1])
    assert [r.date for r in frame.orderBy("date").collect()] == days(407)[400:]
    with pytest.raises(ValueError):
        forecast.forecast_frame(weekly_series, 0, KEYS)
    assert forecast.forecast_frame(weekly_series, 400, KEYS, [1]).count() == 400


def test_linear_backtest_matches_refits(clean_series, weekly_series):
    got = forecast.backtest_linear(weekly_series.where("store_nbr = 1"), "sales", KEYS, 60, 28, 7).toPandas()
    y = np.array([r.sales for r in weekly_series.where("store_nbr = 1").orderBy("date").collect()])
    start = days(1)[0]
    for cutoff, part in got.groupby("cutoff"):
        c = (cutoff - start).days
        t = np.arange(28, c + 1)
        x = np.column_stack([np.ones(len(t)), y[t - 7], y[t - 14], y[t - 21], y[t - 28]])
        beta = np.linalg.lstsq(x, y[t], rcond=None)[0]
        for _, r in part.iterrows():
            i = (r["date"] - start).days
            assert r["prediction"] == pytest.approx(beta @ [1, y[i - 7], y[i - 14], y[i - 21], y[i - 28]], rel=1e-6)
    assert got.groupby("cutoff").size().eq(7).all()


def test_search_picks_the_better_prior(spark):
    rng = random.Random(9)
    rows = [(d, 1, 100 + 20 * np.sin(2 * np.pi * i / 7) + rng.gauss(0, 1)) for i, d in enumerate(days(300))]
    rows = [(d, s, float(v)) for d, s, v in rows]
    features = additive_features(spark.createDataFrame(rows, "date date, store_nbr int, sales double"), KEYS)
    cut = days(250)[-1]
    grid = search.full_grid({"seasonality_prior_scale": [1e-4, 10.0]})
    trials = search.search_additive(features.where(F.col("ds") <= cut), features.where(F.col("ds") > cut), KEYS, grid)
    best = search.best_candidate(trials).first()
    assert best["candidate"] == 1 and best["rmse"] < 3
    with pytest.raises(ValueError):
        search.search_additive(features, features, KEYS, [{"seasonality_mode": "additive"}])


def test_draw_stays_in_range():
    space = {"a": [1, 5], "b": [0.1, 0.9], "c": ["x", "y"]}
    drawn = search.draw(space, 20)
    assert drawn == search.draw(space, 20) and len(drawn) == 20
    assert all(1 <= d["a"] <= 5 and 0.1 <= d["b"] <= 0.9 and d["c"] in "xy" for d in drawn)


def test_failed_candidates_sort_last(spark):
    trials = spark.createDataFrame([(0, None), (1, 2.0), (2, 3.0)], "candidate int, rmse double")
    assert search.best_candidate(trials).first()["candidate"] == 1


def test_user_model(clean_series):
    model = forecast.GroupedModel("mean", KEYS, lambda pdf: [pdf["sales"].mean()], lambda p, n: [p[0]] * n)
    out = model.predict(model.fit(clean_series), clean_series, 3).collect()
    mean = clean_series.agg(F.avg("sales")).first()[0]
    assert len(out) == 3 and all(r["prediction"] == pytest.approx(mean) for r in out)


def test_train_select_predict(weekly_series):
    models = [jobs.SeasonalNaive(("store_nbr",)), learner.SequenceModel(KEYS)]
    metrics, best = jobs.train_and_select(weekly_series, models, KEYS, 14)
    assert metrics.count() == 10 and metrics.where("metric = 'unscored' and value = 0").count() == 2
    rmse = {r.model: r.value for r in metrics.where("metric = 'rmse'").collect()}
    assert best.first()["model"] == min(rmse, key=rmse.get) and max(rmse.values()) < 4
    out = jobs.generate_predictions(weekly_series, models, best, KEYS, 10, [2])
    assert out.count() == 10 and out.where("store_nbr = 2 and prediction is not null").count() == 10
    assert out.agg(F.min("date")).first()[0] == days(401)[-1] and isinstance(out.first()["date"], dt.date)


def rows_for(store, n, value):
    return [(d, store, float(value(i))) for i, d in enumerate(days(2500)[2500 - n:])]


@pytest.fixture(scope="module")
def uneven(spark):
    """Series of very different lengths, with a gap, zeros and unknown values."""
    rng = random.Random(4)
    noise = {(s, i): rng.gauss(0, 1) for s in range(1, 7) for i in range(2500)}
    rows = rows_for(1, 40, lambda i: noise[1, i]) + rows_for(2, 28, lambda i: noise[2, i]) + rows_for(3, 12, lambda i: 5 + noise[3, i])
    rows += [r for i, r in enumerate(rows_for(4, 60, lambda i: 10 + noise[4, i])) if i != 50]
    rows += rows_for(5, 60, lambda i: 0.0) + rows_for(6, 1, lambda i: 7.0) + [(d, 8, None) for d in days(2500)[-5:]]
    long = rows_for(7, 2500, lambda i: 100 + 0.1 * noise[1 + i % 6, i])
    schema = "date date, store_nbr int, sales double"
    return spark.createDataFrame(rows, schema).cache(), spark.createDataFrame(rows + long, schema).cache()


def same(a, b):
    return all((x is None and y is None) or x == y or (isinstance(x, float) and x == pytest.approx(y, rel=1e-6, abs=1e-6))
               for x, y in zip(a, b)) and len(a) == len(b)


def test_a_long_neighbour_changes_nothing(uneven):
    short, both = uneven
    for make in (lambda df: adf_by_series(df, "sales", KEYS), lambda df: differencing_by_series(df, "sales", KEYS),
                 lambda df: Arima(KEYS).fit(df).select(*KEYS, "p", "d", "q", "seasonal_p", "seasonal_d", "seasonal_q", "n", "aic")):
        alone, beside = rows_of(make(short), *KEYS), rows_of(make(both).where("store_nbr <> 7"), *KEYS)
        assert [r["store_nbr"] for r in alone] == [r["store_nbr"] for r in beside]
        assert all(same(list(a.values()), list(b.values())) for a, b in zip(alone, beside))
    orders = {r.store_nbr: r.d for r in differencing_by_series(both, "sales", KEYS).collect()}
    assert orders[2] == orders[3] == orders[6] == 0


def test_every_series_gets_a_forecast(uneven):
    _, both = uneven
    for model in (Arima(KEYS), learner.SequenceModel(KEYS), jobs.SeasonalNaive(tuple(KEYS))):
        future = model.predict(model.fit(both), both, 7)
        assert future.count() == 8 * 7
        missing = {r.store_nbr for r in future.where("prediction IS NULL").collect()}
        assert 8 in missing and (missing <= {8} or model.name == "seasonal_naive")
    zero = learner.SequenceModel(KEYS)
    assert zero.predict(zero.fit(both), both, 7).where("store_nbr = 5 and prediction <> 0").count() == 0


def test_zero_windows_stay(spark):
    daily = spark.createDataFrame([(d, 1, 0.0) for d in days(60)], "date date, store_nbr int, sales double")
    assert learner.window_vectors(daily, "sales", KEYS, 30).count() == 30


def test_models_are_scored_on_the_same_rows(uneven):
    _, both = uneven
    metrics, best = jobs.train_and_select(both, [jobs.SeasonalNaive(("store_nbr",)), learner.SequenceModel(KEYS)], KEYS, 7)
    missing = {r.model: r.value for r in metrics.where("metric = 'unscored'").collect()}
    assert missing["seasonal_naive"] >= missing["sequence"] and best.first()["model"] in missing


def test_unknown_last_values_are_carried(spark):
    rows = [(d, 1, None if i >= 98 else 50.0 + i % 2) for i, d in enumerate(days(100))]
    df = spark.createDataFrame(rows, "date date, store_nbr int, sales double")
    model = Arima(KEYS, max_p=1, max_q=0, max_seasonal=0)
    assert all(40 < r.prediction < 60 for r in model.predict(model.fit(df), df, 3).collect())


def test_known_regressors_are_used(spark):
    rng = random.Random(1)
    rows = [(d, 1, 100.0 + 40 * (i % 3 == 0) + rng.gauss(0, 1), int(i % 3 == 0)) for i, d in enumerate(days(400))]
    df = spark.createDataFrame(rows, "date date, store_nbr int, sales double, onpromotion int")
    model = Additive(("store_nbr",), AdditiveSettings(seasonality_mode="additive"))
    features = additive_features(df, KEYS)
    fits = model.fit(features)
    known = spark.createDataFrame([(1, d, 1.0) for d in days(410)[400:405]], "store_nbr int, ds date, onpromotion double")
    future = {r.date: r.prediction for r in model.predict(fits, features, 10, known).collect()}
    assert all(v == pytest.approx(140, abs=5) for d, v in future.items() if d in days(410)[400:405])
    assert all(v == pytest.approx(113, abs=8) for d, v in future.items() if d in days(410)[405:])
