"""Queries on evaluation, runs, drift, alerts and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import drift, evaluate, monitor, splits
from ..session import scratch_path
from ..sources import retail_views as views, tables
from ..streaming import streams
from .registry import query, r, rounded

ERRORS = ["mse", "rmse", "mae", "mape"]
ERROR_SQL = """count(prediction - actual) AS n, round(avg(pow(prediction - actual, 2)), 4) AS mse,
  round(sqrt(avg(pow(prediction - actual, 2))), 4) AS rmse, round(avg(abs(prediction - actual)), 4) AS mae,
  round(avg(abs((prediction - actual) / nullif(actual, 0))) * 100, 4) AS mape,
  count(*) FILTER (actual = 0) AS n_zero_actual"""
CUT = dt.date(2024, 1, 16)


def _log(spark, sf):
    return views.prediction_log(spark, sf)


# ---- evaluation ----

@query("evl1_error_metrics", "prediction_log", f"SELECT {ERROR_SQL} FROM prediction_log")
def evl1(spark, sf):
    return rounded(evaluate.error_metrics(_log(spark, sf)), 4, *ERRORS)


@query("evl1_error_metrics_by_model", "prediction_log", f"SELECT model, {ERROR_SQL} FROM prediction_log GROUP BY model")
def evl1_model(spark, sf):
    return rounded(evaluate.error_metrics(_log(spark, sf), ["model"]), 4, *ERRORS)


PER_RUN = f""", per_run AS (SELECT model, run_id, avg(pow(prediction - actual, 2)) AS mse,
  sqrt(avg(pow(prediction - actual, 2))) AS rmse, avg(abs(prediction - actual)) AS mae,
  avg(abs((prediction - actual) / nullif(actual, 0))) * 100 AS mape FROM prediction_log GROUP BY model, run_id)"""


@query("evl2_macro_average", "prediction_log", PER_RUN + "SELECT model, " + ", ".join(
    f"round(avg({m}), 4) AS avg_{m}" for m in ERRORS) + " FROM per_run GROUP BY model")
def evl2(spark, sf):
    per_run = evaluate.error_metrics(_log(spark, sf), ["model", "run_id"])
    return rounded(evaluate.macro_average(per_run, ERRORS, ["model"]), 4, *[f"avg_{m}" for m in ERRORS])


def _long_errors(spark, sf, keys):
    return evaluate.error_metrics(_log(spark, sf), keys).select(*keys, *ERRORS).unpivot(keys, ERRORS, "metric", "value")


@query("evl3_compare_models", "prediction_log", PER_RUN + "SELECT model, " + ", ".join(
    f"round(avg({m}), 4) AS {m}" for m in ERRORS) + " FROM per_run GROUP BY model")
def evl3(spark, sf):
    long = _long_errors(spark, sf, ["model", "run_id"])
    return rounded(evaluate.compare_models(long, ERRORS), 4, *ERRORS)


@query("evl4_best_model", "prediction_log", """
SELECT model, round(sqrt(avg(pow(prediction - actual, 2))), 4) AS value FROM prediction_log GROUP BY model
ORDER BY value, model LIMIT 1""")
def evl4(spark, sf):
    names = ["none", "click", "error", "purchase", "signup", "view"]
    return rounded(evaluate.best_model(_long_errors(spark, sf, ["model"]), names), 4, "value")


RUN_SQL = """, run_metrics AS (SELECT run_id, avg(abs(prediction - actual)) AS mae, sqrt(avg(pow(prediction - actual, 2))) AS rmse,
  min(ts) AS start_time FROM prediction_log GROUP BY run_id)"""


def _runs(spark, sf):
    log = _log(spark, sf)
    runs = log.groupBy("run_id").agg(F.min("ts").alias("start_time")).withColumn("experiment", F.lit("default"))
    long = evaluate.error_metrics(log, ["run_id"]).unpivot(["run_id"], ["mae", "rmse"], "metric", "value")
    return runs, long.withColumns({"split": F.lit("test"), "step": F.lit(0)})


@query("evl5_best_run", "prediction_log", RUN_SQL + """
SELECT run_id, round(rmse, 4) AS value FROM run_metrics ORDER BY rmse, run_id LIMIT 1""")
def evl5(spark, sf):
    return rounded(evaluate.best_run(_runs(spark, sf)[1], "rmse"), 4, "value")


@query("evl5_worst_run", "prediction_log", RUN_SQL + """
SELECT run_id, round(mae, 4) AS value FROM run_metrics ORDER BY mae DESC, run_id LIMIT 1""")
def evl5_worst(spark, sf):
    return rounded(evaluate.best_run(_runs(spark, sf)[1], "mae", ascending=False), 4, "value")


@query("evl6_compare_runs", "prediction_log", RUN_SQL + """
SELECT run_id, start_time, round(mae, 4) AS mae, round(rmse, 4) AS rmse FROM run_metrics
ORDER BY start_time DESC, run_id LIMIT 5""")
def evl6(spark, sf):
    runs, metrics = _runs(spark, sf)
    out = evaluate.compare_runs(runs, metrics, ["mae", "rmse"])
    return rounded(out, 4, "mae", "rmse").withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query("evl7_log_runs", "prediction_log", """
SELECT 'run-' || model AS run_id, model, 'test' AS split, 'mae' AS metric, CAST(0 AS INT) AS step,
       round(avg(abs(prediction - actual)), 4) AS value FROM prediction_log GROUP BY model""")
def evl7(spark, sf):
    folder = scratch_path(spark, "runs")
    scored = evaluate.error_metrics(_log(spark, sf), ["model"]).withColumn("run_id", F.concat(F.lit("run-"), "model"))
    headers = scored.select("run_id", F.lit(None).cast("string").alias("parent_id"), F.lit("default").alias("experiment"), "model",
                            F.lit(dt.datetime(2024, 2, 1)).alias("start_time"))
    values = scored.select("run_id", F.lit("test").alias("split"), F.lit("mae").alias("metric"), F.lit(0).alias("step"),
                           F.col("mae").alias("value"))
    tables.log_runs(headers, values, folder)
    runs, metrics = tables.read_runs(spark, folder)
    return rounded(metrics.join(runs.select("run_id", "model"), "run_id"), 4, "value")


@query("evl7_log_again", "prediction_log", """
SELECT 'run-' || model AS run_id, model, 'mae' AS metric, round(avg(abs(prediction - actual)), 4) AS value
FROM prediction_log WHERE date < DATE '2024-01-16' GROUP BY model""")
def evl7_again(spark, sf):
    """Runs logged over all days, and again under their ids over the first: one run each, the later one."""
    folder = scratch_path(spark, "runs-again")
    for rows in (_log(spark, sf), _log(spark, sf).where(F.col("date") < CUT)):
        scored = evaluate.error_metrics(rows, ["model"]).withColumn("run_id", F.concat(F.lit("run-"), "model"))
        headers = scored.select("run_id", F.lit(None).cast("string").alias("parent_id"), F.lit("default").alias("experiment"),
                                "model", F.lit(dt.datetime(2024, 2, 1)).alias("start_time"))
        values = scored.select("run_id", F.lit("test").alias("split"), F.lit("mae").alias("metric"), F.lit(0).alias("step"),
                               F.col("mae").alias("value"))
        tables.log_runs(headers, values, folder)
    runs, metrics = tables.read_runs(spark, folder)
    return rounded(runs.select("run_id", "model").join(metrics.select("run_id", "metric", "value"), "run_id"), 4, "value")


@query("evl8_promote_or_keep", "prediction_log", """
, per AS (SELECT model, date < DATE '2024-01-16' AS old, sqrt(avg(pow(prediction - actual, 2))) AS rmse
          FROM prediction_log GROUP BY 1, 2)
SELECT model, round(o.rmse, 4) AS current_value, round(n.rmse, 4) AS candidate_value,
       CASE WHEN n.rmse < o.rmse THEN 'promote' ELSE 'keep' END AS decision
FROM (SELECT * FROM per WHERE old) o JOIN (SELECT * FROM per WHERE NOT old) n USING (model)""")
def evl8(spark, sf):
    log = _log(spark, sf)
    old = evaluate.error_metrics(log.where(F.col("date") < CUT), ["model"])
    new = evaluate.error_metrics(log.where(F.col("date") >= CUT), ["model"])
    return rounded(evaluate.promote_or_keep(old, new, ["model"]), 4, "current_value", "candidate_value")


@query("spl6_cv_summary", "prediction_log", """
, folds AS (SELECT model, date_trunc('week', date) AS fold, sqrt(avg(pow(prediction - actual, 2))) AS rmse,
            avg(abs(prediction - actual)) AS mae FROM prediction_log GROUP BY 1, 2)
SELECT model, 'rmse' AS metric, round(avg(rmse), 4) AS mean, round(stddev_pop(rmse), 4) AS std FROM folds GROUP BY model
UNION ALL SELECT model, 'mae', round(avg(mae), 4), round(stddev_pop(mae), 4) FROM folds GROUP BY model""")
def spl6(spark, sf):
    folded = _log(spark, sf).withColumn("fold", F.trunc("date", "week"))
    long = evaluate.error_metrics(folded, ["model", "fold"]).unpivot(["model", "fold"], ["rmse", "mae"], "metric", "value")
    return rounded(splits.cv_summary(long), 4, "mean", "std")


# ---- drift ----

def _halves(spark, sf):
    fact = views.sales_fact(spark, sf)
    cut = dt.date(1998, 7, 1)
    return fact.where(F.col("date") < cut), fact.where(F.col("date") >= cut)


def _p_sql(terms=20):
    series = " + ".join(f"({2 * (-1) ** (k - 1)}) * exp(-2 * {k * k} * l2)" for k in range(1, terms + 1))
    return f"CASE WHEN l2 < 0.04 THEN 1.0 ELSE least(1.0, greatest(0.0, {series})) END"


@query("mon3_ks_drift", "sales_fact", ", " + ", ".join(f"""
k_{c} AS (SELECT '{c}' AS "column", max(abs(a / n - b / m)) AS ks_stat, CAST(max(n) AS BIGINT) AS n, CAST(max(m) AS BIGINT) AS m FROM (
  SELECT sum(x) OVER w AS a, sum(y) OVER w AS b, sum(x) OVER () AS n, sum(y) OVER () AS m FROM (
    SELECT {c} AS v, count(*) FILTER (date < DATE '1998-07-01')::DOUBLE AS x,
           count(*) FILTER (date >= DATE '1998-07-01')::DOUBLE AS y FROM sales_fact GROUP BY {c})
  WINDOW w AS (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))""" for c in ("sales", "onpromotion", "store_nbr"))
    + """, ks AS (SELECT * FROM k_sales UNION ALL SELECT * FROM k_onpromotion UNION ALL SELECT * FROM k_store_nbr),
scored AS (SELECT *, ks_stat * ks_stat * n * m / (n + m) AS l2 FROM ks),
valued AS (SELECT *, CAST(""" + _p_sql() + """ AS DOUBLE) AS p FROM scored)
SELECT "column", round(ks_stat, 8) AS ks_stat, n, m, round(p, 8) AS p_value, p < 0.05 AS is_drift FROM valued""")
def mon3(spark, sf):
    old, new = _halves(spark, sf)
    return rounded(drift.ks_drift(old, new, ["sales", "onpromotion", "store_nbr"]), 8, "ks_stat", "p_value")


@query("mon4_moment_drift", "sales_fact", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", round(avg({c}) FILTER (date >= DATE '1998-07-01') - avg({c}) FILTER (date < DATE '1998-07-01'), 4) AS mean_diff,
  round(stddev_samp({c}) FILTER (date >= DATE '1998-07-01') - stddev_samp({c}) FILTER (date < DATE '1998-07-01'), 4) AS std_diff
FROM sales_fact""" for c in ("sales", "onpromotion")))
def mon4(spark, sf):
    return rounded(drift.moment_drift(*_halves(spark, sf), ["sales", "onpromotion"]), 4, "mean_diff", "std_diff")


@query("mon5_chi2_drift", "sales_fact", """
, cells AS (SELECT family, count(*) FILTER (date < DATE '1998-07-01')::DOUBLE AS a,
            count(*) FILTER (date >= DATE '1998-07-01')::DOUBLE AS b FROM sales_fact GROUP BY family),
t AS (SELECT sum(a) AS n, sum(b) AS m FROM cells)
SELECT 'family' AS "column", count(*) - 1 AS df, round(sum(pow(a - (a + b) * n / (n + m), 2) / ((a + b) * n / (n + m))
   + pow(b - (a + b) * m / (n + m), 2) / ((a + b) * m / (n + m))), 6) AS statistic FROM cells, t""")
def mon5(spark, sf):
    df = drift.chi2_drift(*_halves(spark, sf), ["family"])
    return rounded(df.drop("p_value", "is_drift"), 6, "statistic")


@query("mon5_chi2_p_values")
def mon5_p(spark, sf):
    return drift.chi2_drift(*_halves(spark, sf), ["family", "store_nbr"])


@query("mon8_concept_drift", "prediction_log", """
, per AS (SELECT model, date < DATE '2024-01-16' AS old, avg(pow(prediction - actual, 2)) AS mse,
   sqrt(avg(pow(prediction - actual, 2))) AS rmse, avg(abs(prediction - actual)) AS mae,
   avg(abs((prediction - actual) / nullif(actual, 0))) * 100 AS mape FROM prediction_log GROUP BY 1, 2),
long AS (UNPIVOT per ON mse, rmse, mae, mape INTO NAME metric VALUE v)
SELECT model, metric, round(o.v, 4) AS reference, round(n.v, 4) AS current, """ + r("n.v - o.v", 4) + """ AS diff,
       round(n.v / o.v, 6) AS ratio
FROM (SELECT * FROM long WHERE old) o JOIN (SELECT * FROM long WHERE NOT old) n USING (model, metric)""")
def mon8(spark, sf):
    log = _log(spark, sf)
    df = drift.concept_drift(log.where(F.col("date") < CUT), log.where(F.col("date") >= CUT))
    return rounded(rounded(df, 4, "reference", "current", "diff"), 6, "ratio")


# ---- monitoring ----

@query("mon1_prediction_stats", "prediction_log", """
SELECT model, round(avg(prediction), 4) AS mean, round(stddev_pop(prediction), 4) AS std, min(prediction) AS min,
       max(prediction) AS max FROM prediction_log GROUP BY model""")
def mon1(spark, sf):
    return rounded(monitor.prediction_stats(_log(spark, sf), ["model"]), 4, "mean", "std")


LIMITS = {"rmse": 60.0, "mape": 500.0}


@query("mon2_monitor_predictions", "prediction_log", """
, wide AS (SELECT model, avg(prediction) AS mean, stddev_pop(prediction) AS std, min(prediction) AS min, max(prediction) AS max,
   avg(pow(prediction - actual, 2)) AS mse, sqrt(avg(pow(prediction - actual, 2))) AS rmse,
   avg(abs(prediction - actual)) AS mae, avg(abs((prediction - actual) / nullif(actual, 0))) * 100 AS mape
   FROM prediction_log GROUP BY model),
long AS (UNPIVOT wide ON mean, std, min, max, mse, rmse, mae, mape INTO NAME metric VALUE value)
SELECT model, metric, round(value, 4) AS value,
       CASE metric WHEN 'rmse' THEN value > 60 WHEN 'mape' THEN value > 500 END AS exceeded FROM long""")
def mon2(spark, sf):
    limits = monitor.threshold_table(spark, LIMITS)
    return rounded(monitor.monitor_predictions(_log(spark, sf), limits), 4, "value")


THRESHOLD_SQL = """, limits(metric, threshold, direction) AS (VALUES ('rmse', 50e0, 'above'), ('mape', 10e0, 'above'),
  ('drift_p', 0.5e0, 'below')),
checked AS (SELECT ts, model, series, metric, value, threshold, direction,
  CASE WHEN direction = 'below' THEN value < threshold ELSE value > threshold END AS exceeded
  FROM metric_log JOIN limits USING (metric))"""
CHECKED = {"rmse": 50.0, "mape": 10.0, "drift_p": 0.5}


@query("mon6_check_thresholds", "metric_log", THRESHOLD_SQL + """
SELECT metric, threshold, direction, count(*) AS n, count(*) FILTER (exceeded) AS alerts FROM checked GROUP BY ALL""")
def mon6(spark, sf):
    checked = monitor.check_thresholds(views.metric_log(spark, sf), monitor.threshold_table(spark, CHECKED))
    return checked.groupBy("metric", "threshold", "direction").agg(
        F.count("*").alias("n"), F.count_if("exceeded").alias("alerts"))


@query("mon7_performance_history", "metric_log", """
SELECT model, date_trunc('day', ts)::TIMESTAMP AS period, """ + ", ".join(
    f"round(avg(value) FILTER (metric = '{m}'), 6) AS {m}" for m in ("rmse", "mae", "mape")) + """
FROM metric_log WHERE metric IN ('rmse', 'mae', 'mape') GROUP BY 1, 2""")
def mon7(spark, sf):
    history = monitor.performance_history(views.metric_log(spark, sf))
    return rounded(history, 6, "rmse", "mae", "mape").withColumn("period", F.col("period").cast("timestamp_ntz"))


@query("mon9_resource_alerts", "metric_log", """
SELECT ts, series, metric, value, 90e0 AS threshold FROM metric_log WHERE metric = 'cpu' AND value > 90""")
def mon9(spark, sf):
    log = views.metric_log(spark, sf).where(F.col("metric_type") == "system_metrics")
    return monitor.resource_alerts(log, spark).select(
        F.col("ts").cast("timestamp_ntz").alias("ts"), "series", "metric", "value", "threshold")


@query("mon10_freshness", "sales_fact transactions", """
SELECT store_nbr, max(date) AS last_date, CAST(date_diff('day', max(date), DATE '2001-12-31') AS INT) AS age_days
FROM sales_fact GROUP BY store_nbr""")
def mon10(spark, sf):
    return monitor.freshness(views.sales_fact(spark, sf), dt.date(2001, 12, 31), ["store_nbr"])


@query("mon11_retrain_decision", "prediction_log", """
, status AS (SELECT model, min(date) AS trained_on, round(sqrt(avg(pow(prediction - actual, 2)) FILTER (date >= DATE '2024-01-16'))
   / sqrt(avg(pow(prediction - actual, 2)) FILTER (date < DATE '2024-01-16')), 6) AS error_ratio
   FROM prediction_log GROUP BY model),
acc AS (SELECT model, sum(x) OVER w AS a, sum(y) OVER w AS b, sum(x) OVER (PARTITION BY model) AS n,
   sum(y) OVER (PARTITION BY model) AS m FROM (
     SELECT model, prediction AS v, count(*) FILTER (date < DATE '2024-01-16')::DOUBLE AS x,
            count(*) FILTER (date >= DATE '2024-01-16')::DOUBLE AS y FROM prediction_log GROUP BY model, prediction)
   WINDOW w AS (PARTITION BY model ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT model, pow(max(abs(a / n - b / m)), 2) * max(n) * max(m) / (max(n) + max(m)) AS l2 FROM acc GROUP BY model),
joined AS (SELECT status.*, round(CAST(""" + _p_sql() + """ AS DOUBLE), 6) AS p_value FROM status JOIN ks USING (model)),
reasoned AS (SELECT *, concat_ws(',', CASE WHEN date_diff('day', trained_on, DATE '2024-02-05') > 30 THEN 'age' END,
       CASE WHEN error_ratio > 1.0 THEN 'performance' END, CASE WHEN p_value < 0.6 THEN 'drift' END) AS reason FROM joined)
SELECT *, CASE WHEN reason = '' THEN 'skip' ELSE 'retrain' END AS decision FROM reasoned""")
def mon11(spark, sf):
    log = _log(spark, sf)
    ratio = drift.concept_drift(log.where(F.col("date") < CUT), log.where(F.col("date") >= CUT)) \
        .where(F.col("metric") == "rmse").select("model", F.round("ratio", 6).alias("error_ratio"))
    trained = log.groupBy("model").agg(F.min("date").alias("trained_on"))
    # a column per model, so that the drift test judges each model's predictions
    names = sorted(views.METRIC_OF_EVENT)
    wide = log.select("date", *[F.when(F.col("model") == n, F.col("prediction")).alias(n) for n in names])
    drifted = drift.ks_drift(wide.where(F.col("date") < CUT), wide.where(F.col("date") >= CUT), names).select(
        F.col("column").alias("model"), F.round("p_value", 6).alias("p_value"))
    status = trained.join(ratio, "model").join(drifted, "model")
    return monitor.retrain_decision(status, dt.date(2024, 2, 5), 30, 1.0, 0.6)


@query("mon13_prediction_anomalies", "prediction_log", """
, s AS (SELECT model, avg(prediction) AS m, stddev_pop(prediction) AS d FROM prediction_log GROUP BY model)
SELECT row_id, model, prediction, round(abs(prediction - m) / d, 6) AS zscore FROM prediction_log JOIN s USING (model)
WHERE abs(prediction - m) / d > 3""")
def mon13(spark, sf):
    found = monitor.prediction_anomalies(_log(spark, sf), ["model"])
    return rounded(found.select("row_id", "model", "prediction", "zscore"), 6, "zscore")


# ---- streams ----

def _event_stream(spark, sf):
    schema = views.table(spark, sf, "events").schema
    return streams.read_stream(spark, sf, schema, pattern="events.parquet")


def _prediction_stream(spark, sf):
    return _event_stream(spark, sf).select(
        F.col("event_id").alias("row_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("model"),
        F.col("value").alias("prediction"), F.get_json_object("props", "$.k").cast("double").alias("actual"))


def _run(spark, stream, name):
    return streams.run_available(stream, scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint"))


@query("str1_metrics_log_stream", "metric_log", """
SELECT metric, count(*) AS n, round(sum(value), 4) AS total FROM metric_log GROUP BY metric""")
def str1(spark, sf):
    metric = F.lit(None).cast("string")
    for event, name in views.METRIC_OF_EVENT.items():
        metric = F.when(F.col("event_type") == event, name).otherwise(metric)
    rows = _event_stream(spark, sf).select(F.col("ts").cast("timestamp").alias("ts"), metric.alias("metric"), "value")
    written = _run(spark, rows, "metrics-log")
    return written.groupBy("metric").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def _round_stats(df):
    return rounded(rounded(df, 6, "mean", "mae"), 4, "std", "rmse")


@query("str2_windowed_stats", "prediction_log", """
, closed AS (SELECT *, date_trunc('day', ts) AS window_start FROM prediction_log
  WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM prediction_log) - INTERVAL 1 HOUR)
SELECT window_start::TIMESTAMP AS window_start, (window_start + INTERVAL 1 DAY)::TIMESTAMP AS window_end, model, count(*) AS n,
  round(avg(prediction), 6) AS mean, round(stddev_pop(prediction), 4) AS std, min(prediction) AS min, max(prediction) AS max,
  round(sqrt(avg(pow(prediction - actual, 2))), 4) AS rmse, round(avg(abs(prediction - actual)), 6) AS mae
FROM closed GROUP BY window_start, model""")
def str2(spark, sf):
    stats = streams.windowed_prediction_stats(_prediction_stream(spark, sf), "1 day")
    written = _round_stats(_run(spark, stats, "stats"))
    return written.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("str2_sliding_stats", "prediction_log", """
, slots AS (SELECT p.*, date_trunc('day', ts) + o * INTERVAL 12 HOUR AS window_start
            FROM prediction_log p, (VALUES (-1), (0), (1)) AS t(o)),
inside AS (SELECT * FROM slots WHERE ts >= window_start AND ts < window_start + INTERVAL 24 HOUR
  AND window_start + INTERVAL 24 HOUR <= (SELECT max(ts) FROM prediction_log) - INTERVAL 1 HOUR)
SELECT window_start::TIMESTAMP AS window_start, (window_start + INTERVAL 24 HOUR)::TIMESTAMP AS window_end, model, count(*) AS n,
  round(avg(prediction), 6) AS mean, round(stddev_pop(prediction), 4) AS std, min(prediction) AS min, max(prediction) AS max,
  round(sqrt(avg(pow(prediction - actual, 2))), 4) AS rmse, round(avg(abs(prediction - actual)), 6) AS mae
FROM inside GROUP BY window_start, model""")
def str2_sliding(spark, sf):
    stats = streams.windowed_prediction_stats(_prediction_stream(spark, sf), "24 hours", "12 hours")
    written = _round_stats(_run(spark, stats, "sliding"))
    return written.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


_LATE = """
, told AS (SELECT row_id, unnest(CASE WHEN row_id % 3 = 0 THEN [0, 1] ELSE [0] END) AS again, ts, actual FROM prediction_log WHERE row_id % 7 <> 0),
known AS (SELECT row_id, ts + (row_id % 5 * 10 + again) * INTERVAL 1 HOUR AS known_at, actual + again AS actual FROM told),
ends AS (SELECT least((SELECT max(ts) FROM prediction_log), (SELECT max(known_at) FROM known)) - INTERVAL 1 HOUR AS mark),
matched AS (SELECT p.row_id, p.ts, p.model, p.prediction, min({actual_ts: k.known_at, actual: k.actual}) FILTER (k.row_id IS NOT NULL) AS a
            FROM prediction_log p LEFT JOIN known k ON k.row_id = p.row_id AND k.known_at <= p.ts + INTERVAL 24 HOUR
            GROUP BY ALL),
closed AS (SELECT row_id, ts, model, prediction, a.actual AS actual, a.actual_ts AS actual_ts FROM matched, ends
           WHERE ts < mark - INTERVAL 24 HOUR)
"""


def _late_actuals(spark, sf, batch=False):
    """Every event as a prediction whose value is told 0 to 40 hours later, to some never and to some twice."""
    events = (lambda: _log(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))) if batch else (lambda: _prediction_stream(spark, sf))
    predictions = events().select("row_id", "ts", "model", "prediction")
    told = events().where(F.col("row_id") % 7 != 0).withColumn(
        "_again", F.explode(F.when(F.col("row_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    hours = F.col("row_id") % 5 * 10 + F.col("_again")
    later = F.timestamp_seconds(F.unix_micros("ts") / 1e6 + hours * 3600)
    actuals = told.select("row_id", (F.col("actual") + F.col("_again")).alias("actual"), later.alias("ts"))
    return streams.predictions_with_late_actuals(predictions, actuals, ["row_id"], "24 hours")


@query("str2_late_actuals", "prediction_log", _LATE + "SELECT row_id, ts, model, prediction, actual, actual_ts FROM closed")
def str2_late(spark, sf):
    written = _run(spark, _late_actuals(spark, sf), "late")
    return written.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ts", "actual_ts")})


@query("str2_late_errors", "prediction_log", _LATE + """
SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, model, count(*) AS n, count(actual) AS known,
       round(sqrt(avg(pow(prediction - actual, 2))), 4) AS rmse, round(avg(abs(prediction - actual)), 4) AS mae
FROM closed GROUP BY 1, 2""")
def str2_late_errors(spark, sf):
    rows = _run(spark, _late_actuals(spark, sf), "late-errors")
    error = F.col("prediction") - F.col("actual")
    stats = rows.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"), "model").agg(
        F.count("*").alias("n"), F.count("actual").alias("known"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))
    return rounded(stats, 4, "rmse", "mae")


@query("jon10_late_actuals", "prediction_log", _LATE + """
SELECT row_id, ts, model, prediction, a.actual AS actual, a.actual_ts AS actual_ts FROM matched""")
def jon10_late(spark, sf):
    rows = _late_actuals(spark, sf, batch=True)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ts", "actual_ts")})


@query("str3_threshold_alerts", "metric_log", THRESHOLD_SQL + """
SELECT ts, metric, value, threshold, direction FROM checked WHERE exceeded""")
def str3(spark, sf):
    metric = F.lit(None).cast("string")
    for event, name in views.METRIC_OF_EVENT.items():
        metric = F.when(F.col("event_type") == event, name).otherwise(metric)
    rows = _event_stream(spark, sf).select(F.col("ts").cast("timestamp").alias("ts"), metric.alias("metric"), "value")
    alerts = streams.threshold_alerts(rows, monitor.threshold_table(spark, CHECKED))
    return _run(spark, alerts.drop("exceeded"), "alerts").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("str4_drift_per_batch", "prediction_log", """
, side AS (SELECT prediction AS v, 1e0 AS x, 0e0 AS y FROM prediction_log WHERE date < DATE '2024-01-16'
  UNION ALL SELECT prediction, 0, 1 FROM prediction_log),
acc AS (SELECT sum(x) OVER w AS a, sum(y) OVER w AS b, sum(x) OVER () AS n, sum(y) OVER () AS m FROM (
  SELECT v, sum(x) AS x, sum(y) AS y FROM side GROUP BY v)
  WINDOW w AS (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT 'prediction' AS "column", round(max(abs(a / n - b / m)), 8) AS ks_stat, CAST(max(n) AS BIGINT) AS n,
       CAST(max(m) AS BIGINT) AS m FROM acc""")
def str4(spark, sf):
    reference = _log(spark, sf).where(F.col("date") < CUT)
    out = scratch_path(spark, "drift")
    streams.drift_alerts(_prediction_stream(spark, sf), reference, ["prediction"], out, scratch_path(spark, "drift-checkpoint"))
    return rounded(spark.read.parquet(out), 8, "ks_stat").select("column", "ks_stat", "n", "m")


@query("str4_windowed_drift", "prediction_log", """
, ref AS (SELECT prediction AS v, count(*) AS x FROM prediction_log WHERE date < DATE '2024-01-16' GROUP BY 1),
closed AS (SELECT date_trunc('day', ts) AS w, prediction AS v, count(*) AS y FROM prediction_log
  WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM prediction_log) - INTERVAL 1 HOUR GROUP BY 1, 2),
side AS (SELECT w, v, 0 AS x, y FROM closed UNION ALL SELECT w, v, x, 0 FROM (SELECT DISTINCT w FROM closed), ref),
acc AS (SELECT w, v, sum(sum(x)) OVER o AS a, sum(sum(y)) OVER o AS b, sum(sum(x)) OVER (PARTITION BY w) AS n,
        sum(sum(y)) OVER (PARTITION BY w) AS m FROM side GROUP BY w, v WINDOW o AS (PARTITION BY w ORDER BY v))
SELECT w::TIMESTAMP AS window_start, 'prediction' AS "column", round(max(abs(a / n - b / m)), 8) AS ks_stat,
       CAST(max(n) AS BIGINT) AS n, CAST(max(m) AS BIGINT) AS m FROM acc GROUP BY w""")
def str4_windowed(spark, sf):
    reference = _log(spark, sf).where(F.col("date") < CUT)
    out = scratch_path(spark, "window-drift")
    streams.windowed_drift(_prediction_stream(spark, sf), reference, ["prediction"], out, scratch_path(spark, "window-drift-checkpoint"))
    scored = rounded(spark.read.parquet(out), 8, "ks_stat").select("window_start", "column", "ks_stat", "n", "m")
    return scored.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("str5_score_stream", "prediction_log", """
, fit AS (SELECT model, regr_slope(actual, prediction) AS s, regr_intercept(actual, prediction) AS c FROM prediction_log GROUP BY model)
SELECT row_id, model, round(c + s * prediction, 6) AS score FROM prediction_log
LEFT JOIN (SELECT * FROM fit WHERE model <> 'error') USING (model)""")
def str5(spark, sf):
    fit = _log(spark, sf).where("model <> 'error'").groupBy("model").agg(
        F.regr_intercept("actual", "prediction").alias("intercept"), F.regr_slope("actual", "prediction").alias("prediction_coef"))
    scored = streams.score(_prediction_stream(spark, sf), fit, "model", ["prediction"])
    return rounded(_run(spark, scored.select("row_id", "model", "score"), "scores"), 6, "score")


@query("str6_suppress_duplicates", "prediction_log", "SELECT row_id, model, prediction FROM prediction_log")
def str6(spark, sf):
    rows = _prediction_stream(spark, sf)
    resent = rows.withColumn("_copy", F.explode(F.when(F.col("row_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    kept = streams.suppress_duplicates(resent.drop("_copy"), ["row_id"])
    return _run(spark, kept.select("row_id", "model", "prediction"), "deduplicated")


@query("str6_resent_lines", "prediction_log", """
, resent AS (SELECT row_id % 50 AS line, ts FROM prediction_log),
spaced AS (SELECT line, ts, lag(ts) OVER (PARTITION BY line ORDER BY ts) AS before FROM resent)
SELECT line, ts FROM spaced WHERE before IS NULL OR ts > before + INTERVAL 12 HOUR""")
def str6_resent(spark, sf):
    """Lines that come again at any distance."""
    rows = _prediction_stream(spark, sf).select((F.col("row_id") % 50).alias("line"), "ts")
    kept = _run(spark, streams.suppress_duplicates(rows, ["line"], "12 hours"), "resent-kept")
    return kept.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
