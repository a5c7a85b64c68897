"""Queries on preparing the fact: projections, filters, fills, joins and window features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import calendar as cal, clean, encode, joins, linear, windows
from ..session import scratch_path
from ..sources import retail_views as views, tables as sinks
from ..sources.bundle import FILE_NAMES, read_sales_bundle, read_with_quarantine
from ..sources.schemas import HOLIDAY_LOCALES, HOLIDAY_TYPES, METRIC_LOG, PREDICTIONS, SALES
from ..sources.snapshots import SnapshotTable
from ..functions.expressions import flag_name
from .registry import query, r, rounded

KEYS = ["date", "store_nbr", "family"]
TYPE_FLAGS = [flag_name("holiday_type", t) for t in HOLIDAY_TYPES]
LOCALE_FLAGS = [flag_name("locale", t) for t in HOLIDAY_LOCALES]
FLAGS = TYPE_FLAGS + LOCALE_FLAGS


def _flag_sql(wrap="{}"):
    typed = [(f, "type", t) for f, t in zip(TYPE_FLAGS, HOLIDAY_TYPES)]
    local = [(f, "locale", t) for f, t in zip(LOCALE_FLAGS, HOLIDAY_LOCALES)]
    return ", ".join(wrap.format(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END") + f" AS {f}" for f, c, v in typed + local)


# ---- sources and sinks ----

@query("src1_read_sales_tables", "sales_fact stores oil holidays transactions", """
SELECT 'sales' AS name, count(*) AS n, count(DISTINCT date) AS n_dates FROM sales_fact
UNION ALL SELECT 'stores', count(*), 0 FROM stores
UNION ALL SELECT 'oil', count(*), count(DISTINCT date) FROM oil
UNION ALL SELECT 'holidays', count(*), count(DISTINCT date) FROM holidays
UNION ALL SELECT 'transactions', count(*), count(DISTINCT date) FROM transactions""")
def src1(spark, sf):
    folder, out = scratch_path(spark, "source"), None
    written = views.bundle(spark, sf).tables()
    for name, df in written.items():  # as Parquet in a folder, and as CSV under a path of its own each
        sinks.write_processed(df, f"{folder}/{FILE_NAMES[name]}.parquet")
        sinks.write_processed(df, f"{folder}/csv/{name}", "csv")
    by_folder = read_sales_bundle(spark, folder, "parquet").tables()
    by_path = read_sales_bundle(spark, paths={name: f"{folder}/csv/{name}" for name in written}).tables()
    for name, df in by_folder.items():
        if name in ("sales", "transactions"):
            df = by_path[name]
        dates = F.count_distinct("date") if "date" in df.columns else F.lit(0).cast("bigint")
        row = df.agg(F.lit(name).alias("name"), F.count("*").alias("n"), dates.alias("n_dates"))
        out = row if out is None else out.unionByName(row)
    return out


@query("src3_metrics_between", "metric_log", """
SELECT ts, model, series, metric, value FROM metric_log
WHERE metric_type = 'performance_metrics' AND ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'""")
def src3(spark, sf):
    found = sinks.metrics_between(views.metric_log(spark, sf), "performance_metrics",
                                  dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20))
    return found.select(F.col("ts").cast("timestamp_ntz").alias("ts"), "model", "series", "metric", "value")


@query("src4_quarantine", "dense_sales", """
SELECT 'valid' AS kind, count(*) AS n, CAST(sum(sales) AS DOUBLE) AS total FROM dense_sales WHERE day(date) <> 7
UNION ALL SELECT 'rejected', count(*), NULL FROM dense_sales WHERE day(date) = 7""")
def src4(spark, sf):
    """Sales lines as text, those of every seventh day of a month with a word where the amount belongs."""
    amount = F.when(F.dayofmonth("date") == 7, "many").otherwise(F.col("sales").cast("string"))
    lines = views.dense_sales(spark, sf).select(F.concat_ws(",", "date", "store_nbr", F.lit("ALL"), amount, "onpromotion"))
    path = scratch_path(spark, "lines")
    lines.write.text(path)
    valid, rejected = read_with_quarantine(spark, path, SALES)
    return valid.agg(F.lit("valid").alias("kind"), F.count("*").alias("n"), F.sum("sales").alias("total")).unionByName(
        rejected.agg(F.lit("rejected").alias("kind"), F.count("*").alias("n"), F.lit(None).cast("double").alias("total")))


@query("src4_split_valid", "metric_log", """
SELECT metric, count(*) AS n, sum(CASE WHEN value BETWEEN 1 AND 100 THEN 0 ELSE 1 END)::BIGINT AS rejected
FROM metric_log GROUP BY metric""")
def src4_rule(spark, sf):
    from ..sources.bundle import split_valid
    good, bad = split_valid(views.metric_log(spark, sf), F.col("value").between(1, 100))
    both = good.withColumn("bad", F.lit(0)).unionByName(bad.withColumn("bad", F.lit(1)))
    return both.groupBy("metric").agg(F.count("*").alias("n"), F.sum("bad").alias("rejected"))


@query("snk1_write_processed", "sales_fact", """
SELECT date, store_nbr, family, sales, onpromotion, CAST(year(date) AS INT) AS year FROM sales_fact""")
def snk1(spark, sf):
    path = scratch_path(spark, "processed")
    sinks.write_processed(views.sales_fact(spark, sf).withColumn("year", F.year("date")), path, partition_by=["year"])
    return spark.read.parquet(path)


@query("snk3_write_predictions", "prediction_log", """
SELECT 'run-1' AS run_id, model AS series, date, prediction, actual FROM prediction_log""")
def snk3(spark, sf):
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(views.prediction_log(spark, sf).withColumnRenamed("model", "series"), path, "run-1")
    return spark.read.schema(PREDICTIONS).parquet(path)


@query("snk4_model_table", "dense_daily", """
, lagged AS (SELECT store_nbr, sales, lag(sales, 7) OVER (PARTITION BY store_nbr ORDER BY date) AS x FROM dense_daily)
SELECT 'run-1' AS run_id, CAST(store_nbr AS VARCHAR) AS series, 'one' AS term, round(regr_intercept(sales, x), 4) AS value
FROM lagged GROUP BY store_nbr
UNION ALL SELECT 'run-1', CAST(store_nbr AS VARCHAR), 'lag_7', round(regr_slope(sales, x), 4) FROM lagged GROUP BY store_nbr""")
def snk4(spark, sf):
    daily = clean.resample_daily(views.dense_sales(spark, sf), "sales", ["store_nbr"])
    rows = windows.lags(daily, "sales", (7,), windows.Series(("store_nbr",))).withColumn("one", F.lit(1.0))
    fits = linear.grouped_ols(rows, ["store_nbr"], ["one", "sales_lag_7"], "sales")
    path = scratch_path(spark, "models")
    sinks.write_model_table(linear.coefficient_rows(fits, ["store_nbr"], ["one", "lag_7"]), path, "run-1")
    return rounded(sinks.read_model_table(spark, path, "run-1"), 4, "value")


@query("snk2_long_metrics", "prediction_log", """
SELECT model, run_id, metric, value FROM (
  SELECT model, run_id, 'mae' AS metric, round(avg(abs(prediction - actual)), 6) AS value FROM prediction_log GROUP BY ALL
  UNION ALL SELECT model, run_id, 'bias', round(avg(prediction - actual), 6) FROM prediction_log GROUP BY ALL)""")
def snk2(spark, sf):
    error = F.col("prediction") - F.col("actual")
    wide = views.prediction_log(spark, sf).groupBy("model", "run_id").agg(
        F.round(F.avg(F.abs(error)), 6).alias("mae"), F.round(F.avg(error), 6).alias("bias"))
    return sinks.to_long_metrics(wide, ["model", "run_id"], ["mae", "bias"])


@query("snk5_retention", "metric_log", """
SELECT metric, count(*) AS n, min(ts) AS first_ts FROM metric_log
WHERE ts >= (SELECT max(ts) FROM metric_log) - INTERVAL 10 DAY GROUP BY metric""")
def snk5(spark, sf):
    return sinks.retain_days(views.metric_log(spark, sf), 10).groupBy("metric").agg(
        F.count("*").alias("n"), F.min(F.col("ts").cast("timestamp_ntz")).alias("first_ts"))


@query("snk5_snapshot_table", "metric_log", """
, days AS (SELECT metric, CAST(ts AS DATE) AS d FROM metric_log)
SELECT 'before' AS state, metric, count(*) AS n FROM days GROUP BY metric
UNION ALL SELECT 'after', metric, count(*) FROM days WHERE d >= (SELECT max(d) FROM days) - 10 GROUP BY metric""")
def snk5_snapshots(spark, sf):
    """Two writes, then old days dropped while a reader of the version before goes on."""
    log = views.metric_log(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    kept = SnapshotTable(spark, scratch_path(spark, "snapshots"), METRIC_LOG)
    kept.append(log.where("metric IN ('rmse', 'mae')"))
    kept.append(log.where("metric NOT IN ('rmse', 'mae')"))
    before = kept.read()
    kept.retain(10)
    states = before.withColumn("state", F.lit("before")).unionByName(kept.read().withColumn("state", F.lit("after")))
    return states.groupBy("state", "metric").agg(F.count("*").alias("n"))


# ---- projections ----

@query("prj1_calendar_features", "calendar_sales", """
SELECT date, store_nbr, family, sales, onpromotion, year, month, day, day_of_week, week_of_year FROM calendar_sales""")
def prj1(spark, sf):
    return cal.calendar_features(views.sales_fact(spark, sf))


@query("prj2_weekend_holiday", "sales_fact holidays", """
SELECT date, store_nbr, family, CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN date IN (SELECT date FROM holidays) THEN 1 ELSE 0 END AS is_holiday
FROM sales_fact""")
def prj2(spark, sf):
    flagged = cal.weekend_holiday_flags(views.sales_fact(spark, sf), views.holidays(spark, sf))
    return flagged.select(*KEYS, "is_weekend", "is_holiday")


@query("prj3_one_hot", "holidays", f"""
SELECT date, type, locale, locale_name, description, transferred, {_flag_sql()} FROM holidays""")
def prj3(spark, sf):
    return cal.holiday_flags(views.holidays(spark, sf))


@query("prj4_cyclical", "calendar_sales", f"""
SELECT date, store_nbr, family,
  {r('sin(month * (2 * pi()) / 12)', 9)} AS month_sin, {r('cos(month * (2 * pi()) / 12)', 9)} AS month_cos,
  {r('sin(day_of_week * (2 * pi()) / 7)', 9)} AS day_of_week_sin,
  {r('cos(day_of_week * (2 * pi()) / 7)', 9)} AS day_of_week_cos
FROM calendar_sales""")
def prj4(spark, sf):
    df = cal.calendar_features(views.sales_fact(spark, sf))
    df = encode.cyclical(encode.cyclical(df, "month", 12), "day_of_week", 7)
    names = ["month_sin", "month_cos", "day_of_week_sin", "day_of_week_cos"]
    return rounded(df.select(*KEYS, *names), 9, *names)


@query("prj5_interactions", "calendar_sales stores", """
SELECT date, store_nbr, family, sales * onpromotion AS sales_onpromotion_interaction,
       type || '_' || family AS type_family_interaction
FROM calendar_sales JOIN stores USING (store_nbr)""")
def prj5(spark, sf):
    df = joins.join_stores(views.sales_fact(spark, sf), views.stores(spark, sf))
    df = encode.interactions(df, [("sales", "onpromotion"), ("type", "family")])
    return df.select(*KEYS, "sales_onpromotion_interaction", "type_family_interaction")


CUT = dt.date(2000, 7, 1)


@query("prj6_scale", "sales_fact", """
, fitted AS (SELECT avg(sales) AS m, stddev_samp(sales) AS s, avg(onpromotion) AS pm, stddev_samp(onpromotion) AS ps
             FROM sales_fact WHERE date < DATE '2000-07-01')
SELECT date, store_nbr, family, CASE WHEN date < DATE '2000-07-01' THEN 'train' ELSE 'test' END AS part,
       round((sales - m) / s, 6) AS sales, round((onpromotion - pm) / ps, 6) AS onpromotion
FROM sales_fact, fitted""")
def prj6(spark, sf):
    fact = views.sales_fact(spark, sf)
    train, test = encode.scale(fact.where(F.col("date") < CUT), fact.where(F.col("date") >= CUT),
                               ["sales", "onpromotion"])
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return rounded(both, 6, "sales", "onpromotion")


@query("prj6_unscale", "sales_fact", "SELECT date, store_nbr, family, sales FROM sales_fact")
def prj6_inverse(spark, sf):
    fact = views.sales_fact(spark, sf).select(*KEYS, "sales")
    scaler = encode.fit_scaler(fact, ["sales"])
    back = encode.invert_scaler(encode.apply_scaler(fact, scaler, ["sales"]), scaler, ["sales"])
    return rounded(back, 4, "sales")


# ---- filters and checks ----

@query("flt1_by_ids", "sales_fact", """
SELECT date, store_nbr, family, sales FROM sales_fact WHERE store_nbr IN (1, 3, 5)""")
def flt1(spark, sf):
    return clean.filter_ids(views.sales_fact(spark, sf), "store_nbr", [1, 3, 5]).select(*KEYS, "sales")


@query("flt1_by_id_table", "sales_fact stores", """
SELECT date, store_nbr, family, sales FROM sales_fact
WHERE store_nbr IN (SELECT store_nbr FROM stores WHERE type = 'A')""")
def flt1_table(spark, sf):
    ids = views.stores(spark, sf).where(F.col("type") == "A").select("store_nbr")
    return clean.filter_ids(views.sales_fact(spark, sf), "store_nbr", ids).select(*KEYS, "sales")


@query("flt2_by_dates", "sales_fact", """
SELECT date, store_nbr, family, sales FROM sales_fact WHERE date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30'""")
def flt2(spark, sf):
    found = clean.filter_dates(views.sales_fact(spark, sf), dt.date(1997, 1, 1), dt.date(1998, 6, 30))
    return found.select(*KEYS, "sales")


@query("flt4_validate_values", "sales_fact transactions", """
, joined AS (SELECT date, store_nbr, transactions, sales FROM sales_fact LEFT JOIN transactions USING (date, store_nbr))
SELECT 'null_date' AS "check", count(*) FILTER (date IS NULL) AS violations FROM joined
UNION ALL SELECT 'null_store_nbr', count(*) FILTER (store_nbr IS NULL) FROM joined
UNION ALL SELECT 'null_transactions', count(*) FILTER (transactions IS NULL) FROM joined
UNION ALL SELECT 'negative_sales', count(*) FILTER (sales < 0) FROM joined""")
def flt4(spark, sf):
    df = joins.join_transactions(views.sales_fact(spark, sf), views.transactions(spark, sf))
    clean.validate_schema(df, ["date", "store_nbr", "sales"], numeric=["store_nbr", "sales"])
    return clean.validate_values(df, ["date", "store_nbr", "transactions"])


@query("flt5_validate_ranges", "sales_fact", """
SELECT 'range_sales' AS "check", count(*) FILTER (sales < 0 OR sales > 50000) AS violations FROM sales_fact
UNION ALL SELECT 'range_onpromotion', count(*) FILTER (onpromotion < 0 OR onpromotion > 1) FROM sales_fact""")
def flt5(spark, sf):
    return clean.validate_ranges(views.sales_fact(spark, sf), {"sales": (0, 50000), "onpromotion": (0, 1)})


@query("flt6_quality_gate", "days transactions", """
, limits(measure, "limit", side) AS (VALUES ('completeness_pct', 95e0, 'min'), ('missing_pct', 5e0, 'max'),
   ('duplicates_pct', 0.1e0, 'max'), ('daily_sales_min', 1000e0, 'min'), ('daily_sales_max', 1000000e0, 'max'),
   ('transactions_min', 10e0, 'min'), ('promotion_lift', 1.1e0, 'min'), ('max_gap_days', 1e0, 'max')),
measures AS (
  SELECT 'completeness_pct' AS measure, count(*) * 100e0 / ((date_diff('day', min(date), max(date)) + 1)
         * count(DISTINCT store_nbr) * count(DISTINCT family)) AS value FROM sales_fact
  UNION ALL SELECT 'missing_pct', (count(*) FILTER (date IS NULL) + count(*) FILTER (store_nbr IS NULL)
         + count(*) FILTER (family IS NULL) + count(*) FILTER (sales IS NULL)
         + count(*) FILTER (onpromotion IS NULL)) * 100e0 / (count(*) * 5) FROM sales_fact
  UNION ALL SELECT 'duplicates_pct', sum(n - 1) * 100e0 / sum(n) FROM (SELECT count(*) AS n FROM sales_fact GROUP BY date, store_nbr, family, sales, onpromotion)
  UNION ALL SELECT 'promotion_lift', avg(sales) FILTER (onpromotion > 0) / avg(sales) FILTER (onpromotion = 0) FROM sales_fact
  UNION ALL SELECT 'daily_sales_min', min(sales) FROM days
  UNION ALL SELECT 'daily_sales_max', max(sales) FROM days
  UNION ALL SELECT 'max_gap_days', max(g) FROM (SELECT date_diff('day', lag(date) OVER (ORDER BY date), date) AS g FROM days)
  UNION ALL SELECT 'transactions_min', min(transactions) FROM transactions)
SELECT measure, round(value, 4) AS value, "limit", side,
       CASE WHEN side = 'min' THEN value >= "limit" ELSE value <= "limit" END AS passed
FROM measures JOIN limits USING (measure)""")
def flt6(spark, sf):
    measures = clean.quality_measures(views.sales_fact(spark, sf), views.transactions(spark, sf))
    return rounded(clean.quality_gate(measures), 4, "value")


# ---- fills ----

@query("fil1_forward_backward", "oil_filled", "SELECT date, dcoilwtico FROM oil_filled")
def fil1(spark, sf):
    return joins.daily_prices(views.oil(spark, sf))


@query("fil2_const", "transactions", """
SELECT date, store_nbr, coalesce(transactions, 0) AS transactions FROM transactions""")
def fil2(spark, sf):
    return clean.fill_const(views.transactions(spark, sf), ["transactions"], 0)


@query("fil3_mean", "transactions", """
SELECT date, store_nbr, round(coalesce(transactions, (SELECT avg(transactions) FROM transactions)), 6) AS transactions
FROM transactions""")
def fil3(spark, sf):
    return rounded(clean.fill_mean(views.transactions(spark, sf), "transactions"), 6, "transactions")


@query("fil4_group_mean", "transactions", """
, means AS (SELECT store_nbr, avg(transactions) AS m FROM transactions GROUP BY store_nbr)
SELECT date, store_nbr, round(coalesce(transactions, m), 6) AS transactions
FROM transactions JOIN means USING (store_nbr)""")
def fil4(spark, sf):
    filled = clean.fill_group_mean(views.transactions(spark, sf), "transactions", ["store_nbr"])
    return rounded(filled.select("date", "store_nbr", "transactions"), 6, "transactions")


@query("fil5_resample_daily", "dense_daily", "SELECT store_nbr, date, sales FROM dense_daily")
def fil5(spark, sf):
    return clean.resample_daily(views.dense_sales(spark, sf), "sales", ["store_nbr"])


# ---- joins ----

@query("jon1_oil", "sales_fact oil_filled", """
, edge AS (SELECT min(date) AS a, max(date) AS b FROM oil_filled)
SELECT s.date, store_nbr, family, sales, dcoilwtico FROM sales_fact s, edge
JOIN oil_filled o ON o.date = least(greatest(s.date, a), b)""")
def jon1(spark, sf):
    joined = joins.join_oil(views.sales_fact(spark, sf), views.oil(spark, sf))
    return joined.select(*KEYS, "sales", "dcoilwtico")


@query("jon2_holidays", "sales_fact holidays", f"""
, flags AS (SELECT date, {_flag_sql('max({})')} FROM holidays GROUP BY date)
SELECT date, store_nbr, family, sales, {', '.join(f'coalesce({f}, 0) AS {f}' for f in FLAGS)}
FROM sales_fact LEFT JOIN flags USING (date)""")
def jon2(spark, sf):
    joined = joins.join_holidays(views.sales_fact(spark, sf), views.holidays(spark, sf))
    return joined.select(*KEYS, "sales", *FLAGS)


@query("jon2_holidays_fanout", "sales_fact holidays", f"""
, flags AS (SELECT date, {_flag_sql()} FROM holidays)
SELECT date, store_nbr, family, sales, {', '.join(f'coalesce({f}, 0) AS {f}' for f in FLAGS)}
FROM sales_fact LEFT JOIN flags USING (date)""")
def jon2_fanout(spark, sf):
    joined = joins.join_holidays(views.sales_fact(spark, sf), views.holidays(spark, sf), "fanout")
    return joined.select(*KEYS, "sales", *FLAGS)


@query("jon3_transactions", "sales_fact transactions", """
SELECT date, store_nbr, family, sales, transactions FROM sales_fact LEFT JOIN transactions USING (date, store_nbr)""")
def jon3(spark, sf):
    joined = joins.join_transactions(views.sales_fact(spark, sf), views.transactions(spark, sf))
    return joined.select(*KEYS, "sales", "transactions")


@query("jon4_stores", "sales_fact stores", """
SELECT date, store_nbr, family, sales, city, state, type, cluster FROM sales_fact LEFT JOIN stores USING (store_nbr)""")
def jon4(spark, sf):
    joined = joins.join_stores(views.sales_fact(spark, sf), views.stores(spark, sf))
    return joined.select(*KEYS, "sales", "city", "state", "type", "cluster")


@query("jon5_build_fact", "calendar_sales oil_filled holidays transactions", f"""
, edge AS (SELECT min(date) AS a, max(date) AS b FROM oil_filled),
flags AS (SELECT date, {_flag_sql('max({})')} FROM holidays GROUP BY date),
counted AS (SELECT date, store_nbr, coalesce(transactions, (SELECT avg(transactions) FROM transactions)) AS transactions
            FROM transactions),
rolled AS (SELECT *, avg(transactions) OVER (PARTITION BY store_nbr ORDER BY date
             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rm FROM counted),
joined AS (SELECT c.*, o.dcoilwtico, {', '.join(f'coalesce({f}, 0) AS {f}' for f in FLAGS)}, r.transactions, r.rm
  FROM calendar_sales c CROSS JOIN edge JOIN oil_filled o ON o.date = least(greatest(c.date, a), b)
  LEFT JOIN flags f ON f.date = c.date LEFT JOIN rolled r ON r.date = c.date AND r.store_nbr = c.store_nbr),
means AS (SELECT store_nbr, avg(transactions) AS m FROM joined GROUP BY store_nbr)
SELECT j.date, j.store_nbr, family, sales, onpromotion, year, month, day, day_of_week, week_of_year, dcoilwtico,
       {', '.join(FLAGS)}, round(coalesce(transactions, m), 5) AS transactions,
       round(coalesce(rm, transactions, m), 5) AS transactions_rolling_mean
FROM joined j JOIN means USING (store_nbr)""")
def jon5(spark, sf):
    return rounded(joins.build_fact(views.bundle(spark, sf)), 5, "transactions", "transactions_rolling_mean")


@query("jon6_daily_oil", "days oil", "SELECT date, sales, dcoilwtico FROM days LEFT JOIN oil USING (date)")
def jon6(spark, sf):
    return joins.daily_sales_with_oil(views.sales_fact(spark, sf), views.oil(spark, sf))


@query("jon7_holiday_members", "sales_fact holidays", """
SELECT date, store_nbr, family, sales FROM sales_fact WHERE date IN (SELECT date FROM holidays)""")
def jon7(spark, sf):
    fact = views.sales_fact(spark, sf)
    marked = cal.mark_members(fact, cal.holiday_dates(views.holidays(spark, sf)), "date", "is_holiday")
    return marked.where(F.col("is_holiday") == 1).select(*KEYS, "sales")


@query("jon7_holiday_non_members", "sales_fact holidays", """
SELECT date, store_nbr, family, sales FROM sales_fact WHERE date NOT IN (SELECT date FROM holidays)""")
def jon7_anti(spark, sf):
    dates = cal.holiday_dates(views.holidays(spark, sf))
    return views.sales_fact(spark, sf).join(F.broadcast(dates), "date", "left_anti").select(*KEYS, "sales")


@query("jon8_effective_holidays", "holidays", """
SELECT date, CASE WHEN max(CASE WHEN type = 'Work Day' THEN 1 ELSE 0 END) = 1 THEN 0
       ELSE max(CASE WHEN type IN ('Holiday', 'Transfer', 'Additional', 'Bridge') THEN 1 ELSE 0 END) END AS is_day_off,
       max(CASE WHEN type = 'Work Day' THEN 1 ELSE 0 END) AS is_work_day,
       max(CASE WHEN type = 'Event' THEN 1 ELSE 0 END) AS is_event
FROM holidays WHERE NOT transferred GROUP BY date""")
def jon8(spark, sf):
    return cal.effective_holidays(views.holidays(spark, sf))


@query("jon9_local_holidays", "sales_fact stores holidays", """
, h AS (SELECT * FROM holidays WHERE NOT transferred),
flagged AS (SELECT s.date, s.store_nbr, family,
  CASE WHEN EXISTS (SELECT 1 FROM h WHERE locale = 'National' AND h.date = s.date) THEN 1 ELSE 0 END AS is_national,
  CASE WHEN EXISTS (SELECT 1 FROM h WHERE locale = 'Regional' AND h.date = s.date AND locale_name = t.state) THEN 1 ELSE 0 END AS is_regional,
  CASE WHEN EXISTS (SELECT 1 FROM h WHERE locale = 'Local' AND h.date = s.date AND locale_name = t.city) THEN 1 ELSE 0 END AS is_local
  FROM sales_fact s LEFT JOIN stores t ON s.store_nbr = t.store_nbr)
SELECT *, greatest(is_national, is_regional, is_local) AS is_store_holiday FROM flagged""")
def jon9(spark, sf):
    flagged = cal.local_holidays(views.sales_fact(spark, sf), views.stores(spark, sf), views.holidays(spark, sf))
    return flagged.select(*KEYS, "is_national", "is_regional", "is_local", "is_store_holiday")


@query("jon10_predictions_actuals", "dense_daily", """
, naive AS (SELECT store_nbr, date, lag(sales, 7) OVER (PARTITION BY store_nbr ORDER BY date) AS prediction FROM dense_daily)
SELECT store_nbr, date, prediction, sales AS actual FROM naive JOIN dense_daily USING (store_nbr, date)
WHERE prediction IS NOT NULL""")
def jon10(spark, sf):
    daily = clean.resample_daily(views.dense_sales(spark, sf), "sales", ["store_nbr"])
    series = windows.Series(("store_nbr",))
    naive = windows.lags(daily, "sales", (7,), series).select("store_nbr", "date", F.col("sales_lag_7").alias("prediction"))
    actual = daily.withColumnRenamed("sales", "actual")
    return joins.predictions_with_actuals(naive.where(F.col("prediction").isNotNull()), actual, ["store_nbr", "date"])


# ---- window features ----

W = "OVER (PARTITION BY store_nbr, family ORDER BY date)"


def _frame(n):
    return f"OVER (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _lag_sql(periods):
    return ", ".join(f"lag(sales, {n}) {W} AS sales_lag_{n}" for n in periods)


def _rolling_sql(widths, stats):
    fn = {"mean": "avg(sales)", "std": "stddev_pop(sales)", "min": "min(sales)", "max": "max(sales)",
          "median": "quantile_cont(sales, 0.5)"}
    place = {"mean": 4, "std": 2, "min": 2, "max": 2, "median": 4}
    return ", ".join(f"round({fn[s]} {_frame(n)}, {place[s]}) AS sales_rolling_{s}_{n}" for n in widths for s in stats)


def _trend_sql(widths):
    return ", ".join(f"CASE WHEN sales > avg(sales) {_frame(n)} THEN 1 ELSE 0 END AS sales_trend_{n}" for n in widths)


def _round_features(df):
    rolled = [c for c in df.columns if c.startswith("sales_rolling_")]
    means = [c for c in rolled if "_mean_" in c or "_median_" in c]
    return rounded(rounded(df, 4, *means), 2, *[c for c in rolled if c not in means])


PERIODS = (1, 7, 14, 30)
WIDTHS = (7, 14, 30)


@query("win1_lags", "sales_fact", f"SELECT date, store_nbr, family, sales, {_lag_sql(PERIODS)} FROM sales_fact")
def win1(spark, sf):
    return windows.lags(views.sales_fact(spark, sf), "sales").drop("onpromotion")


@query("win1_lags_store_only", "sales_fact", """
SELECT date, store_nbr, family, sales, lag(sales, 1) OVER (PARTITION BY store_nbr ORDER BY date, family) AS sales_lag_1
FROM sales_fact""")
def win1_store(spark, sf):
    blocked = windows.Series(("store_nbr",), ("date", "family"), block_rows=1000)
    return windows.lags(views.sales_fact(spark, sf), "sales", (1,), blocked).drop("onpromotion")


@query("win2_rolling", "sales_fact", f"""
SELECT date, store_nbr, family, sales, {_rolling_sql(WIDTHS, ('mean', 'std', 'min', 'max'))} FROM sales_fact""")
def win2(spark, sf):
    return _round_features(windows.rolling(views.sales_fact(spark, sf), "sales").drop("onpromotion"))


@query("win2_rolling_median", "sales_fact", f"""
SELECT date, store_nbr, family, sales, {_rolling_sql(WIDTHS, ('median',))} FROM sales_fact""")
def win2_median(spark, sf):
    fact = views.sales_fact(spark, sf).drop("onpromotion")
    return _round_features(windows.rolling(fact, "sales", WIDTHS, ("median",)))


@query("win2_rolling_blocked", "sales_fact", f"""
SELECT date, store_nbr, family, sales, {_rolling_sql(WIDTHS, ('mean', 'std', 'min', 'max'))} FROM sales_fact""")
def win2_blocked(spark, sf):
    series = windows.Series(("store_nbr", "family"), block_rows=40, chunk="year")
    fact = views.sales_fact(spark, sf).drop("onpromotion")
    return _round_features(windows.rolling(fact, "sales", series=series))


@query("win3_trend_flags", "sales_fact", f"SELECT date, store_nbr, family, sales, {_trend_sql(WIDTHS)} FROM sales_fact")
def win3(spark, sf):
    return windows.trend_flags(views.sales_fact(spark, sf), "sales").drop("onpromotion")


@query("win4_trend_strength", "sales_fact", "SELECT date, store_nbr, family, sales, " + ", ".join(
    r(f"(sales - avg(sales) {_frame(n)}) / nullif(avg(sales) {_frame(n)}, 0)", 6) + f" AS sales_trend_strength_{n}"
    for n in WIDTHS) + " FROM sales_fact")
def win4(spark, sf):
    df = windows.trend_strength(views.sales_fact(spark, sf), "sales").drop("onpromotion")
    return rounded(df, 6, *[f"sales_trend_strength_{n}" for n in WIDTHS])


@query("win5_transactions_rolling_mean", "transactions", """
, counted AS (SELECT date, store_nbr, coalesce(transactions, (SELECT avg(transactions) FROM transactions)) AS transactions
            FROM transactions)
SELECT date, store_nbr, round(transactions, 5) AS transactions,
       round(avg(transactions) OVER (PARTITION BY store_nbr ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 5)
         AS transactions_rolling_mean
FROM counted""")
def win5(spark, sf):
    return rounded(joins.process_transactions(views.transactions(spark, sf)), 5, "transactions", "transactions_rolling_mean")


@query("win6_daily_moving_average", "days", """
SELECT date, sales, CASE WHEN count(sales) OVER w = 7 THEN round(avg(sales) OVER w, 4) END AS sales_ma_7
FROM days WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def win6(spark, sf):
    daily = views.sales_fact(spark, sf).groupBy("date").agg(F.sum("sales").alias("sales"))
    return rounded(windows.full_moving_average(daily, "sales", 7), 4, "sales_ma_7")


CYCLES = [("day_of_week", 7), ("month", 12), ("day", 31)]


@query("win7_all_features", "calendar_sales", "SELECT *, " + ", ".join([
    _lag_sql(PERIODS), _rolling_sql(WIDTHS, ("mean", "std", "min", "max")), _trend_sql(WIDTHS),
    *[f"{r(f'{fn}({c} * (2 * pi()) / {p})', 9)} AS {c}_{fn}" for c, p in CYCLES for fn in ("sin", "cos")],
]) + " FROM calendar_sales")
def win7(spark, sf):
    return round_all_features(windows.all_features(cal.calendar_features(views.sales_fact(spark, sf))))


def round_all_features(df):
    return rounded(_round_features(df), 9, *[f"{c}_{fn}" for c, _ in CYCLES for fn in ("sin", "cos")])


@query("win8_time_gaps", "oil sales_fact", """
SELECT 'oil' AS name, count(*) FILTER (g <> 1) AS gaps
FROM (SELECT date_diff('day', lag(date) OVER (ORDER BY date), date) AS g FROM oil)
UNION ALL SELECT 'sales', count(*) FILTER (g <> 1)
FROM (SELECT date_diff('day', lag(date) OVER (ORDER BY date), date) AS g FROM (SELECT DISTINCT date FROM sales_fact))""")
def win8(spark, sf):
    def gaps(name, df):
        return windows.time_gaps(df.select("date").distinct()).select(F.lit(name).alias("name"), "gaps")
    return gaps("oil", views.oil(spark, sf)).unionByName(gaps("sales", views.sales_fact(spark, sf)))


@query("win8_time_gaps_by_store", "sales_fact", """
SELECT store_nbr, count(*) FILTER (g <> 1) AS gaps FROM (
  SELECT store_nbr, date_diff('day', lag(date) OVER (PARTITION BY store_nbr ORDER BY date), date) AS g
  FROM (SELECT DISTINCT store_nbr, date FROM sales_fact)) GROUP BY store_nbr""")
def win8_store(spark, sf):
    return windows.time_gaps(views.sales_fact(spark, sf).select("store_nbr", "date").distinct(), keys=["store_nbr"])


@query("win9_lag_correlations", "days oil", """
, joined AS (SELECT date, sales, dcoilwtico FROM days LEFT JOIN oil USING (date)), shifted AS (
  SELECT sales, """ + ", ".join(f"lag(dcoilwtico, {k}) OVER (ORDER BY date) AS l{k}" for k in range(8)) + """ FROM joined)
""" + " UNION ALL ".join(f"SELECT {k} AS lag, {r(f'corr(l{k}, sales)', 6)} AS correlation FROM shifted" for k in range(8)))
def win9(spark, sf):
    daily = joins.daily_sales_with_oil(views.sales_fact(spark, sf), views.oil(spark, sf))
    return rounded(windows.lag_correlations(daily, "dcoilwtico", "sales", 7), 6, "correlation")


@query("win13_sequences", "dense_daily", """
, framed AS (SELECT store_nbr, date, count(*) OVER past AS n, sum(sales) OVER past AS x_sum,
    first_value(sales) OVER past AS x_first, count(*) OVER ahead AS m, sum(sales) OVER ahead AS y_sum FROM dense_daily
  WINDOW past AS (PARTITION BY store_nbr ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY store_nbr ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING))
SELECT store_nbr, date, 30 AS x_len, 7 AS y_len, x_sum, x_first, y_sum FROM framed WHERE n = 30 AND m = 7""")
def win13(spark, sf):
    daily = clean.resample_daily(views.dense_sales(spark, sf), "sales", ["store_nbr"])
    return _summed(windows.sequences(daily, ["sales"], "sales", 30, 7, series=windows.Series(("store_nbr",))))


def _summed(seq):
    values = F.transform("x", lambda row: row[0])
    return seq.select(
        "store_nbr", "date", F.size("x").alias("x_len"), F.size("y").alias("y_len"),
        F.aggregate(values, F.lit(0.0), lambda a, v: a + v).alias("x_sum"), values[0].alias("x_first"),
        F.aggregate("y", F.lit(0.0), lambda a, v: a + v).alias("y_sum"))


@query("win13_sequences_stride", "dense_daily", """
, framed AS (SELECT store_nbr, date, row_number() OVER (PARTITION BY store_nbr ORDER BY date) AS rn,
    count(*) OVER past AS n, sum(sales) OVER past AS x_sum,
    first_value(sales) OVER past AS x_first, count(*) OVER ahead AS m, sum(sales) OVER ahead AS y_sum FROM dense_daily
  WINDOW past AS (PARTITION BY store_nbr ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY store_nbr ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING))
SELECT store_nbr, date, 14 AS x_len, 2 AS y_len, x_sum, x_first, y_sum FROM framed
WHERE n = 14 AND m = 2 AND (rn - 14) % 5 = 0""")
def win13_stride(spark, sf):
    daily = clean.resample_daily(views.dense_sales(spark, sf), "sales", ["store_nbr"])
    series = windows.Series(("store_nbr",))
    return _summed(windows.sequences(daily, ["sales"], "sales", 14, 2, stride=5, series=series))


@query("win14_seq_dataset", "dense_daily", """
, framed AS (SELECT store_nbr, date, count(*) OVER past AS n, sum(sales) OVER past AS x_sum,
    first_value(sales) OVER past AS x_first,
    lead(sales) OVER (PARTITION BY store_nbr ORDER BY date) AS y_sum FROM dense_daily
  WINDOW past AS (PARTITION BY store_nbr ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT store_nbr, date, 10 AS x_len, 1 AS y_len, x_sum, x_first, y_sum FROM framed WHERE n = 10 AND y_sum IS NOT NULL""")
def win14(spark, sf):
    daily = clean.resample_daily(views.dense_sales(spark, sf), "sales", ["store_nbr"])
    return _summed(windows.sequences(daily, ["sales"], "sales", 10, 1, series=windows.Series(("store_nbr",))))


@query("win15_zscores", "sales_fact", """
SELECT date, store_nbr, family, sales,
       round(abs(sales - (SELECT avg(sales) FROM sales_fact)) / (SELECT stddev_pop(sales) FROM sales_fact), 6) AS zscore
FROM sales_fact""")
def win15(spark, sf):
    return rounded(windows.zscores(views.sales_fact(spark, sf).drop("onpromotion"), "sales"), 6, "zscore")


@query("win15_zscores_by_store", "sales_fact", """
, s AS (SELECT store_nbr, avg(sales) AS m, stddev_pop(sales) AS d FROM sales_fact GROUP BY store_nbr)
SELECT date, store_nbr, family, sales, round(abs(sales - m) / nullif(d, 0), 6) AS zscore
FROM sales_fact JOIN s USING (store_nbr)""")
def win15_store(spark, sf):
    scored = windows.zscores(views.sales_fact(spark, sf).drop("onpromotion"), "sales", ["store_nbr"])
    return rounded(scored, 6, "zscore")


@query("udf2_rolling_apply", "dense_daily", """
, ranged AS (SELECT store_nbr, date, sales, max(sales) OVER w - min(sales) OVER w AS sales_range FROM dense_daily
  WINDOW w AS (PARTITION BY store_nbr ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT * FROM ranged""")
def udf2(spark, sf):
    daily = clean.resample_daily(views.dense_sales(spark, sf), "sales", ["store_nbr"])
    return windows.rolling_apply(daily, "sales", 7, lambda s: s.max() - s.min(), "sales_range",
                                 windows.Series(("store_nbr",)))


# ---- items that need no operator of their own ----

@query("flt3_validate_schema", "sales_fact transactions", """
SELECT 'sales' AS name, true AS valid, count(*) AS n FROM sales_fact
UNION ALL SELECT 'transactions', false, count(*) FROM transactions""")
def flt3(spark, sf):
    """The fact has the columns a model needs; the transactions have no sales."""
    out = None
    for name, df in (("sales", views.sales_fact(spark, sf)), ("transactions", views.transactions(spark, sf))):
        try:
            clean.validate_schema(df, ["date", "store_nbr", "sales"], numeric=["store_nbr", "sales"])
            valid = True
        except ValueError:
            valid = False
        row = df.agg(F.lit(name).alias("name"), F.lit(valid).alias("valid"), F.count("*").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


@query("srt1_positions", "dense_daily", """
SELECT store_nbr, date, row_number() OVER (PARTITION BY store_nbr ORDER BY date) - 1 AS position FROM dense_daily""")
def srt1(spark, sf):
    """The place of each day in its series, without a sort of the table."""
    daily = clean.resample_daily(views.dense_sales(spark, sf), "sales", ["store_nbr"])
    placed = windows.with_positions(daily, windows.Series(("store_nbr",)))
    return placed.select("store_nbr", "date", F.col("_pos").alias("position"))


@query("udf1_group_transform", "dense_daily", """
SELECT store_nbr, date, round(avg(sales) OVER w, 4) AS sales_rolling_mean_7, round(sales - avg(sales) OVER (PARTITION BY store_nbr), 4) AS centred
FROM dense_daily WINDOW w AS (PARTITION BY store_nbr ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def udf1(spark, sf):
    """A transform of each group's rows, as windows."""
    daily = clean.resample_daily(views.dense_sales(spark, sf), "sales", ["store_nbr"])
    rolled = windows.rolling(daily, "sales", (7,), ("mean",), windows.Series(("store_nbr",)))
    centred = clean.attach_stats(rolled, ["store_nbr"], _mean=F.avg("sales"))
    return rounded(centred.select("store_nbr", "date", "sales_rolling_mean_7", (F.col("sales") - F.col("_mean")).alias("centred")),
                   4, "sales_rolling_mean_7", "centred")
