"""Queries that run whole jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.monitor import Thresholds
from ..plans import jobs
from ..session import scratch_path
from ..sources import retail_views as views, tables
from .forecasting import KEYS, daily_features, daily_sales
from .registry import SQL, query, rounded
from . import monitoring, preparation, profiling  # noqa: F401  their SQL is reused below


def _wide(dataset, name):
    return f"""SELECT '{dataset}' AS dataset, 'profile' AS section, metric, '' AS key, value FROM (
      UNPIVOT (SELECT CAST(COLUMNS(* EXCLUDE ({EXCLUDED[dataset]})) AS DOUBLE) FROM ({SQL[name]})) ON COLUMNS(*)
      INTO NAME metric VALUE value)"""


EXCLUDED = {"sales": "records", "oil": "first_date, last_date"}


def _part(dataset, name):
    return f"SELECT '{dataset}' AS dataset, section, metric, key, value FROM ({SQL[name]})"


REPORT_SQL = " UNION ALL ".join([
    _wide("sales", "agg1_sales_profile"),
    f"SELECT 'sales', 'profile', 'records', '', CAST(records AS DOUBLE) FROM ({SQL['agg1_sales_profile']})",
    _part("stores", "agg2_store_profile"),
    _wide("oil", "agg3_oil_profile"),
    _part("holidays", "agg4_holiday_profile"),
    _part("transactions", "agg5_transaction_profile"),
    f"""SELECT 'cross', CASE effect WHEN 'holiday' THEN 'holiday_impact' ELSE 'promo_impact' END, 'lift', '',
        lift FROM ({SQL['agg24_lift']})""",
    f"""SELECT 'cross', 'oil_impact', 'lag_correlation', CAST(lag AS VARCHAR), correlation
        FROM ({SQL['win9_lag_correlations']})""",
])


@query("mon14_report", None, REPORT_SQL)
def mon14(spark, sf):
    places = F.when(F.col("metric") == "avg_daily_sales", F.round("value", 4)).otherwise(F.round("value", 6))
    return jobs.report(views.bundle(spark, sf)).withColumn("value", places)


@query("job_prepare_features", None, f"""
SELECT * FROM ({SQL['jon5_build_fact']}) JOIN (SELECT * EXCLUDE (sales, onpromotion, year, month, day, day_of_week, week_of_year)
FROM ({SQL['win7_all_features']})) USING (date, store_nbr, family)""")
def job_prepare(spark, sf):
    df = preparation.round_all_features(jobs.prepare_features(views.bundle(spark, sf)))
    return rounded(df, 5, "transactions", "transactions_rolling_mean")


@query("job_train_and_select")
def job_train(spark, sf):
    return jobs.train_and_select(daily_features(spark, sf), jobs.default_models(KEYS), KEYS)[0]


@query("job_generate_predictions")
def job_predict(spark, sf):
    models = jobs.default_models(KEYS)
    history = daily_features(spark, sf)
    _, best = jobs.train_and_select(history, models, KEYS)
    return jobs.generate_predictions(history, models, best, KEYS, 30).select(*KEYS, "date", "step", "prediction", "model")


_NAIVE = """
, last AS (SELECT max(date) AS m FROM dense_daily), test AS (SELECT d.* FROM dense_daily d, last WHERE date > m - 14),
scored AS (SELECT t.sales AS actual, p.sales AS prediction FROM last, test t
  JOIN dense_daily p ON p.store_nbr = t.store_nbr AND p.date = m - 14 - 7 + (CAST(date_diff('day', m - 14, t.date) AS INT) - 1) % 7 + 1),
errors AS (SELECT avg(pow(prediction - actual, 2)) AS mse, sqrt(avg(pow(prediction - actual, 2))) AS rmse,
  avg(abs(prediction - actual)) AS mae, avg(abs((prediction - actual) / nullif(actual, 0))) * 100 AS mape, 0e0 AS unscored FROM scored),
metrics AS (SELECT 'seasonal_naive' AS model, metric, round(value, 4) AS value FROM (UNPIVOT errors ON COLUMNS(*) INTO NAME metric VALUE value))"""


def _naive():
    return [jobs.SeasonalNaive(tuple(KEYS))]


@query("job_select_naive", "dense_daily", _NAIVE + " SELECT * FROM metrics")
def job_naive(spark, sf):
    return rounded(jobs.train_and_select(daily_sales(spark, sf), _naive(), KEYS)[0], 4, "value")


@query("mon12_retrain_naive", "dense_daily", _NAIVE + " SELECT * FROM metrics")
def mon12_naive(spark, sf):
    folder, start = scratch_path(spark, "runs"), dt.datetime(2002, 1, 1)
    tables.log_run(spark, folder, "run-1", "seasonal_naive", start, metrics=[("test", "rmse", 0, 1.0)])
    return rounded(jobs.retrain_best_model(spark, folder, daily_sales(spark, sf), _naive(), KEYS, start)[1], 4, "value")


@query("job_predict_naive", "dense_daily", """
, last AS (SELECT store_nbr, max(date) AS m FROM dense_daily GROUP BY store_nbr)
SELECT l.store_nbr, CAST(l.m + step AS DATE) AS date, step, d.sales AS prediction, 'seasonal_naive' AS model
FROM last l, (SELECT CAST(unnest(generate_series(1, 100)) AS INT) AS step)
JOIN dense_daily d ON d.store_nbr = l.store_nbr AND d.date = l.m - 7 + (step - 1) % 7 + 1""")
def job_predict_naive(spark, sf):
    history = daily_sales(spark, sf)
    best = spark.createDataFrame([("seasonal_naive", 1.0)], "model string, value double")
    return jobs.generate_predictions(history, _naive(), best, KEYS, 100).select(*KEYS, "date", "step", "prediction", "model")


@query("job_predict_some", "dense_daily", """
, last AS (SELECT store_nbr, max(date) AS m FROM dense_daily WHERE store_nbr IN (0, 1, 2) GROUP BY store_nbr)
SELECT l.store_nbr, CAST(l.m + step AS DATE) AS date, step, d.sales AS prediction, 'seasonal_naive' AS model
FROM last l, (SELECT CAST(unnest(generate_series(1, 30)) AS INT) AS step)
JOIN dense_daily d ON d.store_nbr = l.store_nbr AND d.date = l.m - 7 + (step - 1) % 7 + 1""")
def job_predict_some(spark, sf):
    """The setting that forecasts some series only."""
    history = daily_sales(spark, sf)
    best = spark.createDataFrame([("seasonal_naive", 1.0)], "model string, value double")
    return jobs.generate_predictions(history, _naive(), best, KEYS, 30, [0, 1, 2]).select(*KEYS, "date", "step", "prediction", "model")


@query("job_stored_model", "dense_daily", """
, last AS (SELECT store_nbr, max(date) AS m FROM dense_daily GROUP BY store_nbr),
future AS (SELECT l.store_nbr, d.sales AS prediction FROM last l, (SELECT CAST(unnest(generate_series(1, 14)) AS INT) AS step)
JOIN dense_daily d ON d.store_nbr = l.store_nbr AND d.date = l.m - 7 + (step - 1) % 7 + 1)
SELECT CAST(store_nbr AS VARCHAR) AS series, metric, round(value, 4) AS value FROM (
  UNPIVOT (SELECT store_nbr, CAST(count(*) AS DOUBLE) AS predictions, avg(prediction) AS prediction_mean,
           stddev_pop(prediction) AS prediction_std FROM future GROUP BY store_nbr)
  ON predictions, prediction_mean, prediction_std INTO NAME metric VALUE value)""")
def job_stored(spark, sf):
    """Fit, store, read, predict and monitor, twice under one run: the second write replaces the first."""
    folder, history, model = scratch_path(spark, "store"), daily_sales(spark, sf), _naive()[0]
    tables.write_fits(model.fit(history), f"{folder}/fits", "run-1")
    for _ in range(2):
        jobs.forecast_and_monitor(spark, folder, "run-1", model, history, KEYS, 14, dt.datetime(2002, 1, 1))
    return rounded(spark.read.parquet(f"{folder}/prediction_metrics").select("series", "metric", "value"), 4, "value")


@query("spl5_cross_validate_naive", "dense_daily", """
, cuts(fold, cut) AS (VALUES (1, DATE '1999-06-01'), (2, DATE '2000-06-01'), (3, DATE '2001-06-01')),
scored AS (SELECT fold, t.sales AS actual, p.sales AS prediction FROM cuts
  JOIN dense_daily t ON t.date > cut AND t.date <= cut + 14
  JOIN dense_daily p ON p.store_nbr = t.store_nbr AND p.date = cut - 7 + (CAST(date_diff('day', cut, t.date) AS INT) - 1) % 7 + 1)
SELECT 'seasonal_naive' AS model, fold, round(sqrt(avg(pow(prediction - actual, 2))), 4) AS rmse FROM scored GROUP BY fold""")
def cross_validate(spark, sf):
    cuts = [dt.date(y, 6, 1) for y in (1999, 2000, 2001)]
    rows = jobs.cross_validate(daily_sales(spark, sf), _naive(), KEYS, cuts, 14).where("metric = 'rmse'")
    return rounded(rows.select("model", "fold", F.col("value").alias("rmse")), 4, "rmse")


@query("udf4_search_objective", "dense_daily", """
, cuts(fold, cut) AS (VALUES (1, DATE '1999-06-01'), (2, DATE '2000-06-01'), (3, DATE '2001-06-01')),
means AS (SELECT fold, store_nbr, avg(sales) FILTER (date > cut - 28) AS m28, avg(sales) FILTER (date > cut - 7) AS m7
          FROM dense_daily JOIN cuts ON date > cut - 28 AND date <= cut GROUP BY fold, store_nbr),
paths AS (SELECT fold, t.sales AS actual, p.sales AS naive, m28, m7 FROM cuts
  JOIN dense_daily t ON t.date > cut AND t.date <= cut + 14
  JOIN dense_daily p ON p.store_nbr = t.store_nbr AND p.date = cut - 7 + (CAST(date_diff('day', cut, t.date) AS INT) - 1) % 7 + 1
  JOIN means USING (fold) WHERE means.store_nbr = t.store_nbr),
long AS (SELECT fold, 0 AS candidate, 'seasonal_naive' AS model, naive AS prediction, actual FROM paths
  UNION ALL SELECT fold, 1, 'recent_mean', m28, actual FROM paths UNION ALL SELECT fold, 2, 'recent_mean', m7, actual FROM paths),
folds AS (SELECT candidate, model, fold, avg(CASE WHEN prediction < actual THEN 3 * (actual - prediction) ELSE prediction - actual END) AS v
          FROM long GROUP BY ALL)
SELECT candidate, model, round(avg(v), 4) AS value FROM folds GROUP BY candidate, model""")
def udf4(spark, sf):
    """Three candidates under an objective that weighs a forecast below the sale three times."""
    def short_costs_more(prediction, actual):
        return F.avg(F.when(prediction < actual, 3 * (actual - prediction)).otherwise(prediction - actual))
    candidates = [*_naive(), jobs.RecentMean(tuple(KEYS)), jobs.RecentMean(tuple(KEYS), 7)]
    cuts = [dt.date(y, 6, 1) for y in (1999, 2000, 2001)]
    return rounded(jobs.search_models(daily_sales(spark, sf), candidates, KEYS, cuts, 14, short_costs_more), 4, "value")


@query("job_check_drift", None, f"""
WITH scored AS (SELECT * FROM ({SQL['mon3_ks_drift']}) WHERE "column" IN ('sales', 'onpromotion'))
SELECT TIMESTAMP '2002-01-01' AS ts, 'drift_metrics' AS metric_type, "column" AS series, 'ks_stat' AS metric, ks_stat AS value FROM scored
UNION ALL SELECT TIMESTAMP '2002-01-01', 'drift_metrics', "column", 'drift_p', p_value FROM scored""")
def job_drift(spark, sf):
    fact = views.sales_fact(spark, sf)
    cut = dt.date(1998, 7, 1)
    log = scratch_path(spark, "drift-log")
    jobs.check_drift(fact.where(F.col("date") < cut), fact.where(F.col("date") >= cut), ["sales", "onpromotion"],
                     Thresholds(), log, dt.datetime(2002, 1, 1))
    found = tables.read_metrics_log(spark, log, "drift_metrics").drop("model")
    return rounded(found, 8, "value").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("mon12_retrain_best_model")
def mon12(spark, sf):
    folder, start = scratch_path(spark, "runs"), dt.datetime(2002, 1, 1)
    history, models = daily_features(spark, sf), jobs.default_models(KEYS)
    earlier, _ = jobs.train_and_select(history.where(F.col("date") < dt.date(2001, 6, 1)), models, KEYS)
    run = F.concat(F.lit("run-"), "model").alias("run_id")
    headers = spark.createDataFrame([(m.name,) for m in models], "model string").select(
        run, F.lit(None).cast("string").alias("parent_id"), F.lit("default").alias("experiment"), "model", F.lit(start).alias("start_time"))
    tables.log_runs(headers, earlier.select(run, F.lit("test").alias("split"), "metric", F.lit(0).alias("step"), "value"), folder)
    return jobs.retrain_best_model(spark, folder, history, models, KEYS, start)[1]
