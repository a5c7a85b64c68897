"""Folds in one plan, many-column windows, selection with models that fail, run tables and snapshots."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import days, rows_of
from shelfcast.operators import forecast, learner
from shelfcast.operators.arima import Arima
from shelfcast.plans import jobs
from shelfcast.session import scratch_path
from shelfcast.sources import schemas, tables
from shelfcast.sources.snapshots import SnapshotTable

KEYS = ["store_nbr"]


def plan_size(df):
    return len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())


@pytest.mark.parametrize("model", [
    jobs.SeasonalNaive(("store_nbr",)), Arima(KEYS, max_p=1, max_q=0, max_seasonal=0, d=0, seasonal_d=1),
    jobs.AdditiveModel(("store_nbr",)), learner.SequenceModel(KEYS, length=14),
    learner.ColumnSequenceModel(KEYS, ["promo"], length=7, horizon=7),
    forecast.GroupedModel("mean", KEYS, lambda pdf: [pdf["sales"].mean()], lambda p, n: [p[0]] * n)], ids=lambda m: m.name)
def test_folds_in_one_plan_equal_separate_fits(weekly_series, model):
    history = weekly_series.withColumn("promo", (F.dayofmonth("date") % 3).cast("double"))
    cuts = [days(250)[-1], days(330)[-1]]
    got = rows_of(jobs._fold_forecasts(history, [model], KEYS, cuts, 7), "fold", "store_nbr", "date")
    want = []
    for i, cut in enumerate(cuts, 1):
        train = history.where(F.col("date") <= cut)
        predicted = model.predict(model.fit(train), train, 7)
        want += [(i, r["store_nbr"], r["date"], r["prediction"]) for r in rows_of(predicted, "store_nbr", "date")]
    assert [(r["fold"], r["store_nbr"], r["date"]) for r in got] == [w[:3] for w in want]
    assert [r["prediction"] for r in got] == pytest.approx([w[3] for w in want], rel=1e-6)
    assert all(r["actual"] is not None for r in got)


def test_plan_does_not_grow_with_folds(weekly_series):
    models = [jobs.SeasonalNaive(("store_nbr",)), jobs.RecentMean(("store_nbr",))]
    sizes = [plan_size(jobs._fold_forecasts(weekly_series, models, KEYS, days(400)[200:200 + n * 10:10], 7)) for n in (2, 12)]
    assert sizes[0] == sizes[1]
    folds = jobs.cross_validate(weekly_series, models, KEYS, days(400)[200:320:10], 7)
    assert folds.select("model", "fold").distinct().count() == 24


def test_column_regression_finds_the_planted_rule(spark):
    rng = random.Random(4)
    rows = []
    for s in (1, 2):
        x, p = 50.0, 0.0
        for d in days(400):
            rows.append((d, s, x, p))
            x, p = 10 + 0.6 * x + 4 * p + rng.gauss(0, 0.01), rng.random()
    df = spark.createDataFrame(rows, "date date, store_nbr int, sales double, promo double")
    weights, losses = learner.fit_column_regressor(df, ["promo"], "sales", KEYS, length=1, horizon=2, ridge=0.0, relative=False)
    assert weights[0] == pytest.approx([10, 0.6, 4], abs=0.05)
    # two days ahead the promotion of the day between is unknown: half of it on average
    assert weights[1] == pytest.approx([10 + 0.6 * 10 + 4 * 0.5, 0.36, 2.4], abs=1.5)
    row = losses.first()
    assert 0.3 < row["train_loss"] < 1.2 and 0.3 < row["val_loss"] < 1.2
    model = learner.ColumnSequenceModel(KEYS, ["promo"], length=1, horizon=2, ridge=0.0, relative=False)
    out = rows_of(model.predict(model.fit(df), df, 2), "store_nbr", "step")
    last = {r["store_nbr"]: r for r in rows_of(df.where(F.col("date") == days(400)[-1]))}
    for r in out[::2]:
        assert r["prediction"] == pytest.approx(10 + 0.6 * last[r["store_nbr"]]["sales"] + 4 * last[r["store_nbr"]]["promo"], abs=0.2)
    with pytest.raises(ValueError):
        model.predict(model.fit(df), df, 3)


def test_column_windows_and_gaps(spark):
    rows = [(d, 1, None if i == 20 else float(i + 1), float(i)) for i, d in enumerate(days(40))] + [(d, 2, None, 1.0) for d in days(40)]
    rows += [(d, 3, 7.0, None) for d in days(3)]
    df = spark.createDataFrame(rows, "date date, store_nbr int, sales double, promo double")
    windows = learner.column_windows(df, ["promo"], "sales", KEYS, 3, 2)
    first = rows_of(windows.where("store_nbr = 1"), "date")[0]
    assert first["level"] == 2 and first["x"] == [0.5, 1.0, 1.5, 0.0, 1.0, 2.0] and first["y"] == [2.0, 2.5]
    assert windows.where("store_nbr <> 1").count() == 0 and windows.where("exists(x, v -> v is null)").count() == 0
    model = learner.ColumnSequenceModel(KEYS, ["promo"], length=3, horizon=2)
    out = {(r["store_nbr"], r["step"]): r["prediction"] for r in model.predict(model.fit(df), df, 2).collect()}
    assert out[1, 1] == pytest.approx(41, abs=1.5) and out[2, 1] is None and out[3, 2] is not None


class Silent:
    """A model that has parameters and no forecasts."""

    name, keys = "silent", ("store_nbr",)

    def fit(self, history):
        return history.select("store_nbr").distinct()

    def predict(self, fits, history, days):
        frame = forecast.forecast_frame(history, days, KEYS, align=False)
        return frame.withColumn("prediction", F.lit(None).cast("double"))


def test_a_model_without_forecasts_does_not_end_the_selection(weekly_series):
    metrics, best = jobs.train_and_select(weekly_series, [Silent(), jobs.SeasonalNaive(("store_nbr",))], KEYS, 14)
    assert best.first()["model"] == "seasonal_naive"
    unscored = {r.model: r.value for r in metrics.where("metric = 'unscored'").collect()}
    assert unscored == {"silent": 28, "seasonal_naive": 0}
    assert metrics.where("model = 'silent' and metric = 'rmse' and value is not null").count() == 0


def test_a_new_store_is_reported_and_the_others_forecast(spark, weekly_series):
    folder, model = scratch_path(spark, "new-store"), jobs.SeasonalNaive(("store_nbr",))
    tables.write_fits(model.fit(weekly_series.where("store_nbr = 1")), f"{folder}/fits", "r")
    out = jobs.forecast_and_monitor(spark, folder, "r", model, weekly_series, KEYS, 7, dt.datetime(2022, 3, 1))
    assert {r.store_nbr for r in out.collect()} == {1}
    logged = {(r.series, r.metric): r.value for r in spark.read.parquet(f"{folder}/prediction_metrics").collect()}
    assert logged["2", "unknown_series"] == 1 and logged["1", "predictions"] == 7


def test_a_run_logged_again_is_one_run(spark):
    folder, start = scratch_path(spark, "run-log"), dt.datetime(2024, 1, 1)
    for value in (2.0, 1.0):
        tables.log_run(spark, folder, "a/b c", "m", start, {"p": value}, [("test", "rmse", 0, value)])
    tables.log_run(spark, folder, "7", "m", start)
    runs, metrics = tables.read_runs(spark, folder)
    assert sorted(r.run_id for r in runs.collect()) == ["7", "a/b c"] and runs.columns == schemas.RUNS.names
    assert [(r.run_id, r.value) for r in metrics.collect()] == [("a/b c", 1.0)]


def log_rows(spark, n, value, first=0):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=first + i), "t", "m", "s", "x", value) for i in range(n)]
    return spark.createDataFrame(rows, schemas.METRIC_LOG)


def test_snapshots(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), schemas.METRIC_LOG)
    assert table.read().count() == 0 and table.versions() == []
    assert table.append(log_rows(spark, 20, 1.0)) == 1
    reader = table.read()
    assert table.append(log_rows(spark, 10, 2.0, 15)) == 2
    # a reader keeps what it began with, a new one sees the whole of the new write
    assert reader.count() == 20 and table.read().count() == 30
    files = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t" / "data").rglob("*.parquet")}
    assert table.retain(9) == 3
    assert table.read().agg(F.min("ts"), F.count("*")).first()[:] == (dt.datetime(2024, 1, 16), 4 + 1 + 10)
    assert reader.count() == 20 and table.read(2).count() == 30
    assert files == {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t" / "data").rglob("*.parquet")}  # nothing rewritten
    assert table.vacuum() == 15 and table.versions() == [3] and table.read().count() == 15
    assert table.retain(9) == 4 and table.read().count() == 15


def test_snapshot_writers_do_not_lose_each_other(spark, tmp_path):
    one, two = (SnapshotTable(spark, str(tmp_path / "t"), schemas.METRIC_LOG) for _ in range(2))
    one.append(log_rows(spark, 3, 1.0))
    seen = one.versions()
    calls = []

    def late(entries):
        # another writer publishes between the reading and the publishing of this one, once
        if not calls:
            calls.append(1)
            two.append(log_rows(spark, 4, 2.0, 3))
        return entries + [{"day": "2024-01-01", "write": one.entries(1)[0]["write"]}]
    assert one._publish(late) == seen[-1] + 2
    assert len(one.entries()) == 3 + 4 + 1


def test_snapshot_of_rows_without_time(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), schemas.METRIC_LOG)
    table.append(log_rows(spark, 2, 1.0).unionByName(log_rows(spark, 1, 5.0).withColumn("ts", F.lit(None).cast("timestamp"))))
    table.retain(0)
    assert sorted(r.value for r in table.read().collect()) == [1.0, 5.0]
