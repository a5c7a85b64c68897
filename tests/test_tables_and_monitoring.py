import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import days, rows_of
from shelfcast.operators import evaluate, learner, monitor
from shelfcast.plans import jobs
from shelfcast.sources import bundle, schemas, tables

T0 = dt.datetime(2024, 1, 1)


def test_csv_bundle_round_trip(spark, small_bundle, tmp_path):
    for name, df in small_bundle.tables().items():
        tables.write_processed(df, f"{tmp_path}/{bundle.FILE_NAMES[name]}.csv", "csv")
    read = bundle.read_sales_bundle(spark, str(tmp_path))
    assert read.sales.schema == schemas.SALES and read.sales.count() == 10
    assert read.oil.where("dcoilwtico is null").count() == 3
    paths = {n: f"{tmp_path}/{f}.csv" for n, f in bundle.FILE_NAMES.items() if n != "future"}
    assert bundle.read_sales_bundle(spark, paths=paths).holidays.count() == 10
    with pytest.raises(ValueError):
        bundle.read_sales_bundle(spark)
    with pytest.raises(ValueError):
        bundle.read_sales_bundle(spark, paths={"sales": "x"})


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert bundle.nan_to_null(df).where("x is null").count() == 1


def test_quarantine(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("date,store_nbr,family,sales,onpromotion\n2021-01-01,1,A,5.5,0\n2021-01-02,x,A,5.5,0\nnot a date,1,A,1,0\n")
    good, bad = bundle.read_with_quarantine(spark, str(path), schemas.SALES)
    assert good.count() == 1 and bad.count() == 2
    kept, rest = bundle.split_valid(good, F.col("sales") > 10)
    assert (kept.count(), rest.count()) == (0, 1)


def test_metrics_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert tables.read_metrics_log(spark, path).count() == 0
    rows = [(T0 + dt.timedelta(days=i), "drift_metrics", "m", "s", m, v) for i, (m, v) in enumerate([("a", .5), ("a", .6), ("b", .7)])]
    tables.append_metrics(spark.createDataFrame(rows, schemas.METRIC_LOG), path)
    tables.append_metrics(spark.createDataFrame([(T0, "system_metrics", None, None, "cpu", 95.0)], schemas.METRIC_LOG), path)
    assert tables.read_metrics_log(spark, path).count() == 4
    found = tables.read_metrics_log(spark, path, "drift_metrics", T0 + dt.timedelta(days=1), T0 + dt.timedelta(days=2))
    assert [r.value for r in found.orderBy("ts").collect()] == [.6, .7]
    tables.rewrite_retained(spark, path, 1, str(tmp_path / "kept"))
    assert tables.read_metrics_log(spark, str(tmp_path / "kept")).count() == 2


def test_metric_lines_of_both_shapes(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text(json.dumps({"timestamp": "2024-01-01T00:00:00", "rmse": 0.5, "note": "x"}) + "\n"
                    + json.dumps({"timestamp": "2024-01-02T00:00:00", "metrics": {"rmse": 0.6, "mae": 0.1}}) + "\n")
    rows = rows_of(tables.read_metric_lines(spark, str(path)), "ts", "metric")
    assert [(r["metric"], r["value"]) for r in rows] == [("rmse", 0.5), ("mae", 0.1), ("rmse", 0.6)]


def test_long_metrics(spark):
    df = spark.createDataFrame([("m", 1, None)], "model string, a int, b double")
    assert rows_of(tables.to_long_metrics(df, ["model"], ["a", "b"])) == [{"model": "m", "metric": "a", "value": 1.0}]


def test_predictions_and_model_tables(spark, tmp_path):
    rows = spark.createDataFrame([("1", days(1)[0], 2.0, 3.0)], "series string, date date, prediction double, actual double")
    tables.write_predictions(rows, str(tmp_path / "p"), "r1")
    assert spark.read.parquet(str(tmp_path / "p")).first()["run_id"] == "r1"
    coef = spark.createDataFrame([("1", "one", 0.25)], "series string, term string, value double")
    tables.write_model_table(coef, str(tmp_path / "m"), "r1")
    tables.write_model_table(coef, str(tmp_path / "m"), "r2")
    assert rows_of(tables.read_model_table(spark, str(tmp_path / "m"), "r2")) == [
        {"run_id": "r2", "series": "1", "term": "one", "value": 0.25}]


def test_runs(spark, tmp_path):
    folder = str(tmp_path)
    for i, value in enumerate([.5, .3, .4]):
        tables.log_run(spark, folder, f"r{i}", "arima", T0 + dt.timedelta(hours=i), {"p": i},
                       [("test", "rmse", 0, value + 1), ("test", "rmse", 1, value), ("val", "rmse", 1, 0.1)])
    runs, metrics = tables.read_runs(spark, folder)
    assert evaluate.best_run(metrics, "rmse").first()["run_id"] == "r1"
    assert evaluate.best_run(metrics, "rmse", ascending=False).first()["run_id"] == "r0"
    assert evaluate.best_run(metrics, "other").first() is None
    newest = rows_of(evaluate.compare_runs(runs, metrics.where("split = 'test'"), ["rmse", "mae"], max_runs=2), F.desc("start_time"))
    assert [(r["run_id"], r["rmse"], r["mae"]) for r in newest] == [("r2", .4, None), ("r1", .3, None)]
    assert evaluate.compare_runs(runs, metrics, ["rmse"], "none yet").count() == 0
    with pytest.raises(ValueError):
        evaluate.compare_runs(runs, metrics, ["rmse"], "wrong", experiments=["default"])


def test_best_model(spark):
    rows = [("arima", "rmse", .5), ("prophet", "rmse", .3), ("lstm", "rmse", .4), ("lstm", "mae", .1)]
    df = spark.createDataFrame(rows, "model string, metric string, value double")
    names = ["arima", "prophet", "lstm", "none"]
    assert evaluate.best_model(df, names).first()["model"] == "prophet"
    assert evaluate.best_model(df, names, "mae").first()["model"] == "lstm"
    with pytest.raises(Exception, match="no candidate"):
        evaluate.best_model(df, names, "aic").collect()


def test_zero_actuals_are_counted(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 2.0)], "prediction double, actual double")
    row = evaluate.error_metrics(df).first()
    assert (row["mse"], row["mape"], row["n_zero_actual"], row["n"]) == (1.0, 50.0, 1, 2)


def test_promotion(spark):
    old = spark.createDataFrame([("a", .5), ("b", .5)], "model string, rmse double")
    new = spark.createDataFrame([("a", .4), ("b", .6), ("c", .9)], "model string, rmse double")
    got = {r.model: r.decision for r in evaluate.promote_or_keep(old, new, ["model"]).collect()}
    assert got == {"a": "promote", "b": "keep", "c": "promote"}


def test_thresholds(spark):
    metrics = spark.createDataFrame([("m1", .8), ("m2", .6), ("m3", .4), ("other", 9.0)], "metric string, value double")
    table = monitor.threshold_table(spark, {"m1": .7, "m2": .8, "m3": .3})
    assert {r.metric: r.exceeded for r in monitor.check_thresholds(metrics, table).collect()} == {"m1": True, "m2": False, "m3": True}
    low = spark.createDataFrame([("drift_p", 0.01)], "metric string, value double")
    assert monitor.check_thresholds(low, monitor.threshold_table(spark, monitor.Thresholds())).first()["exceeded"]
    with pytest.raises(ValueError):
        monitor.Thresholds.from_dict({"rmse_limit": 1.0})
    assert monitor.Thresholds.from_dict({"rmse": 2.0}).rmse == 2.0


def test_retrain_reasons(spark):
    rows = [("old", T0.date(), 1.0, 0.5), ("worse", days(1, dt.date(2024, 2, 1))[0], 1.5, 0.01), ("fine", dt.date(2024, 2, 1), None, None)]
    status = spark.createDataFrame(rows, "model string, trained_on date, error_ratio double, p_value double")
    got = {r.model: (r.decision, r.reason) for r in monitor.retrain_decision(status, dt.date(2024, 2, 10)).collect()}
    assert got == {"old": ("retrain", "age"), "worse": ("retrain", "performance,drift"), "fine": ("skip", "")}


def test_monitoring_without_truth(spark):
    df = spark.createDataFrame([("m", 1.0), ("m", 3.0)], "model string, prediction double")
    rows = monitor.monitor_predictions(df, monitor.threshold_table(spark, {"max": 2.0}), actual=None).collect()
    got = {r.metric: (r.value, r.exceeded) for r in rows}
    assert got == {"mean": (2.0, None), "std": (1.0, None), "min": (1.0, None), "max": (3.0, True)}


def test_anomalies_per_series(spark):
    rows = [("a", 1.0)] * 30 + [("a", 100.0)] + [("b", 100.0)] * 5
    found = monitor.prediction_anomalies(spark.createDataFrame(rows, "model string, prediction double"), ["model"])
    assert [(r.model, r.prediction) for r in found.collect()] == [("a", 100.0)]


def test_retraining_job(spark, weekly_series, tmp_path):
    models = [jobs.SeasonalNaive(("store_nbr",)), learner.SequenceModel(["store_nbr"])]
    folder = str(tmp_path)
    tables.log_run(spark, folder, "a", "seasonal_naive", T0, metrics=[("test", "rmse", 0, .3)])
    tables.log_run(spark, folder, "b", "sequence", T0, metrics=[("test", "rmse", 0, .5)])
    run_id, metrics = jobs.retrain_best_model(spark, folder, weekly_series, models, ["store_nbr"], T0)
    runs, logged = tables.read_runs(spark, folder)
    new = runs.where(F.col("run_id") == run_id).first()
    assert new["model"] == "seasonal_naive" and new["parent_id"] == "a" and metrics.count() == 5
    assert logged.where(F.col("run_id") == run_id).count() == 5


def test_drift_job_logs(spark, tmp_path):
    base = spark.range(500).select(F.col("id").cast("double").alias("x"))
    path = str(tmp_path / "log")
    checked = jobs.check_drift(base, base.select((F.col("x") + 250).alias("x")), ["x"], log_path=path, ts=T0)
    assert checked.where("metric = 'drift_p' and exceeded").count() == 1
    assert tables.read_metrics_log(spark, path, "drift_metrics").count() == 2
