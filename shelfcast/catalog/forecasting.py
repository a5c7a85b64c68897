"""Queries on forecasting models, baselines, backtests and search."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import clean, evaluate, forecast, joins, learner, linear, search
from ..operators.additive import AdditiveSettings, additive_features, fit_additive_by_series
from ..operators.arima import Arima, adf_by_series, kpss_by_series, seasonal_root_by_series
from ..session import materialize
from ..sources import retail_views as views
from .registry import query, r, rounded

KEYS = ["store_nbr"]


def daily_sales(spark, sf):
    """Daily series per region without gaps."""
    return clean.resample_daily(views.dense_sales(spark, sf), "sales", KEYS)


def daily_features(spark, sf):
    """The same series with oil prices, promotions and holiday flags."""
    dense = views.dense_sales(spark, sf)
    df = daily_sales(spark, sf).join(dense.select("date", "store_nbr", "onpromotion"), ["store_nbr", "date"], "left")
    return joins.join_holidays(joins.join_oil(df, views.oil(spark, sf)), views.holidays(spark, sf))


@query("fct1_adf")
def fct1(spark, sf):
    return adf_by_series(materialize(daily_sales(spark, sf)), "sales", KEYS)


@query("fct1_dickey_fuller_no_lags", "dense_daily", """
, steps AS (SELECT store_nbr, sales - lag(sales) OVER w AS dy, lag(sales) OVER w AS y1 FROM dense_daily
            WINDOW w AS (PARTITION BY store_nbr ORDER BY date)),
fit AS (SELECT store_nbr, count(*) AS n, regr_slope(dy, y1) AS b,
        (regr_syy(dy, y1) - pow(regr_sxy(dy, y1), 2) / regr_sxx(dy, y1)) / (count(*) - 2) / regr_sxx(dy, y1) AS v
        FROM steps WHERE dy IS NOT NULL GROUP BY store_nbr)
SELECT store_nbr, n, round(b / sqrt(v), 6) AS statistic, b / sqrt(v) < -2.863 AS is_stationary FROM fit""")
def fct1_plain(spark, sf):
    df = adf_by_series(daily_sales(spark, sf), "sales", KEYS, max_lag=0)
    return rounded(df.select(*KEYS, "n", "statistic", "is_stationary"), 6, "statistic")


@query("fct2_kpss", "dense_daily", """
, sized AS (SELECT store_nbr, date, row_number() OVER (PARTITION BY store_nbr ORDER BY date) AS i,
            sales - avg(sales) OVER (PARTITION BY store_nbr) AS e, count(*) OVER (PARTITION BY store_nbr) AS n FROM dense_daily),
summed AS (SELECT *, CAST(floor(4 * pow(n / 100, 0.25)) AS INT) AS lags,
           sum(e) OVER (PARTITION BY store_nbr ORDER BY i ROWS UNBOUNDED PRECEDING) AS s FROM sized),
level AS (SELECT store_nbr, n, lags, sum(s * s) AS ss, sum(e * e) AS ee FROM summed GROUP BY store_nbr, n, lags),
lagged AS (SELECT a.store_nbr, sum((1 - (a.i - b.i) / (a.lags + 1)) * a.e * b.e) AS pp FROM summed a JOIN summed b
           ON a.store_nbr = b.store_nbr AND b.i < a.i AND b.i >= a.i - a.lags GROUP BY a.store_nbr),
tested AS (SELECT store_nbr, n, lags, ss / n / (ee + 2 * pp) AS t FROM level JOIN lagged USING (store_nbr))
SELECT store_nbr, n, lags, round(t, 6) AS statistic,
       round(CASE WHEN t < 0.347 THEN 0.1 WHEN t < 0.463 THEN 0.1 - (t - 0.347) / 0.116 * 0.05
             WHEN t < 0.574 THEN 0.05 - (t - 0.463) / 0.111 * 0.025
             WHEN t < 0.739 THEN 0.025 - (t - 0.574) / 0.165 * 0.015 ELSE 0.01 END, 6) AS p_value, t < 0.463 AS is_stationary
FROM tested""")
def fct2_kpss(spark, sf):
    return rounded(kpss_by_series(daily_sales(spark, sf), "sales", KEYS), 6, "statistic", "p_value")


@query("fct2_seasonal_root_no_lags", "dense_daily", """
, diffs AS (SELECT store_nbr, date, sales - lag(sales) OVER w AS d, sales - lag(sales, 7) OVER w AS m FROM dense_daily
            WINDOW w AS (PARTITION BY store_nbr ORDER BY date)),
rows AS (SELECT store_nbr, m - lag(m) OVER w AS y, lag(m) OVER w AS a, lag(d, 7) OVER w AS b FROM diffs
         WINDOW w AS (PARTITION BY store_nbr ORDER BY date)),
sums AS (SELECT store_nbr, count(*) AS n, sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS by_,
         sum(y * y) AS yy FROM rows WHERE y IS NOT NULL AND b IS NOT NULL GROUP BY store_nbr),
fit AS (SELECT *, (aa * by_ - ab * ay) / (aa * bb - ab * ab) AS cb, (bb * ay - ab * by_) / (aa * bb - ab * ab) AS ca FROM sums),
tested AS (SELECT store_nbr, n, cb / sqrt((yy - ca * ay - cb * by_) / (n - 2) * aa / (aa * bb - ab * ab)) AS t FROM fit)
SELECT store_nbr, n, 0 AS lags, round(t, 5) AS statistic, t > -1.8452369 AS needs_difference FROM tested""")
def fct2_seasonal_root(spark, sf):
    return rounded(seasonal_root_by_series(daily_sales(spark, sf), "sales", KEYS, max_lag=0), 5, "statistic")


@query("fct2_auto_order")
def fct2(spark, sf):
    fits = Arima(KEYS).fit(materialize(daily_sales(spark, sf)))
    return fits.select(*KEYS, "p", "d", "q", "seasonal_p", "seasonal_d", "seasonal_q", "aic")


@query("fct3_fit_arima")
def fct3(spark, sf):
    model, daily = Arima(KEYS), materialize(daily_sales(spark, sf))
    return model.in_sample_metrics(model.fit(daily), daily)


@query("fct4_predict_arima")
def fct4(spark, sf):
    model, daily = Arima(KEYS), materialize(daily_sales(spark, sf))
    return model.predict(model.fit(daily), daily, 14)


@query("fct5_diagnostics")
def fct5(spark, sf):
    model, daily = Arima(KEYS), materialize(daily_sales(spark, sf))
    return model.diagnostics(model.fit(daily), daily)


# The closed form of an ARIMA limited to one autoregressive term: a constant and the value before, or the constant
# alone if that has the better AIC.
_AR1 = """
, lagged AS (SELECT *, lag(sales) OVER (PARTITION BY store_nbr ORDER BY date) AS l1 FROM dense_daily),
sums AS (SELECT store_nbr, CAST(count(*) AS DOUBLE) AS n, regr_slope(sales, l1) AS b1, regr_intercept(sales, l1) AS a1,
         avg(sales) AS a0, regr_syy(sales, l1) AS rss0,
         regr_syy(sales, l1) - pow(regr_sxy(sales, l1), 2) / regr_sxx(sales, l1) AS rss1
         FROM lagged WHERE l1 IS NOT NULL GROUP BY store_nbr),
picked AS (SELECT *, CASE WHEN n * ln(rss1 / n) + 4 < n * ln(rss0 / n) + 2 THEN 1 ELSE 0 END AS p FROM sums),
fit AS (SELECT store_nbr, n, p, CASE WHEN p = 1 THEN a1 ELSE a0 END AS a, CASE WHEN p = 1 THEN b1 ELSE 0 END AS b,
        CASE WHEN p = 1 THEN rss1 ELSE rss0 END AS rss,
        n * ln(CASE WHEN p = 1 THEN rss1 ELSE rss0 END / n) + 2 * (p + 1) AS aic,
        n * ln(CASE WHEN p = 1 THEN rss1 ELSE rss0 END / n) + (p + 1) * ln(n) AS bic,
        sqrt(CASE WHEN p = 1 THEN rss1 / (n - 2) ELSE rss0 / (n - 1) END) AS sigma FROM picked),
fitted AS (SELECT f.*, l.date, l.sales AS actual, a + CASE WHEN p = 1 THEN b * l1 ELSE 0 END AS prediction
           FROM lagged l JOIN fit f ON f.store_nbr = l.store_nbr WHERE p = 0 OR l1 IS NOT NULL)"""
Z95 = 1.959963984540054


def ar1():
    return Arima(KEYS, max_p=1, max_q=0, max_seasonal=0, max_d=0, seasonal=False)


@query("fct2_order_ar1", "dense_daily", _AR1 + """
SELECT store_nbr, CAST(p AS INT) AS p, 0 AS d, 0 AS q, CAST(n AS BIGINT) AS n, round(aic, 4) AS aic FROM fit""")
def fct2_ar1(spark, sf):
    return rounded(ar1().fit(materialize(daily_sales(spark, sf))).select(*KEYS, "p", "d", "q", "n", "aic"), 4, "aic")


@query("fct3_fit_ar1", "dense_daily", _AR1 + """
SELECT store_nbr, count(*) AS n, round(sqrt(avg(pow(prediction - actual, 2))), 4) AS rmse,
       round(avg(abs(prediction - actual)), 4) AS mae, round(max(aic), 4) AS aic, round(max(bic), 4) AS bic
FROM fitted GROUP BY store_nbr""")
def fct3_ar1(spark, sf):
    model, daily = ar1(), materialize(daily_sales(spark, sf))
    scored = model.in_sample_metrics(model.fit(daily), daily)
    return rounded(scored.select(*KEYS, "n", "rmse", "mae", "aic", "bic"), 4, "rmse", "mae", "aic", "bic")


@query("fct4_predict_ar1", "dense_daily", _AR1 + f"""
, last AS (SELECT store_nbr, max(date) AS m, arg_max(sales, date) AS y FROM dense_daily GROUP BY store_nbr),
steps AS (SELECT CAST(unnest(generate_series(1, 14)) AS INT) AS step),
ahead AS (SELECT f.store_nbr, CAST(m + step AS DATE) AS date, step,
          sigma * CASE WHEN p = 0 THEN 1 ELSE sqrt((1 - pow(b, 2 * step)) / (1 - b * b)) END AS spread,
          CASE WHEN p = 0 THEN a ELSE a * (1 - pow(b, step)) / (1 - b) + pow(b, step) * y END AS prediction
          FROM fit f JOIN last USING (store_nbr), steps)
SELECT store_nbr, date, step, round(prediction, 4) AS prediction, round(prediction - {Z95} * spread, 4) AS lower,
       round(prediction + {Z95} * spread, 4) AS upper FROM ahead""")
def fct4_ar1(spark, sf):
    model, daily = ar1(), materialize(daily_sales(spark, sf))
    return rounded(model.predict(model.fit(daily), daily, 14), 4, "prediction", "lower", "upper")


# A model of one difference and no terms is a walk with drift; its band grows with the root of the step, or of the
# number of weeks if the difference is seasonal.
_WALK = """
, steps AS (SELECT CAST(unnest(generate_series(1, 30)) AS INT) AS step),
diffs AS (SELECT store_nbr, date, sales, sales - lag(sales, {lag}) OVER (PARTITION BY store_nbr ORDER BY date) AS z FROM dense_daily),
fit AS (SELECT store_nbr, avg(z) AS c, stddev_samp(z) AS sigma, max(date) AS m FROM diffs GROUP BY store_nbr),
ahead AS (SELECT f.store_nbr, CAST(f.m + step AS DATE) AS date, step, d.sales + c * k AS prediction, {z} * sigma * sqrt(k) AS half
          FROM (SELECT *, CAST(ceil(step / {lag}) AS INT) AS k, CAST((step - 1) % {lag} + 1 - {lag} AS INT) AS back FROM fit, steps) f
          JOIN dense_daily d ON d.store_nbr = f.store_nbr AND d.date = f.m + f.back)
SELECT store_nbr, date, step, round(prediction, 4) AS prediction, round(prediction - half, 4) AS lower,
       round(prediction + half, 4) AS upper FROM ahead"""


def _walk(spark, sf, **fixed):
    model = Arima(KEYS, max_p=0, max_q=0, max_seasonal=0, seasonal=False, **fixed)
    daily = materialize(daily_sales(spark, sf))
    return rounded(model.predict(model.fit(daily), daily, 30), 4, "prediction", "lower", "upper")


@query("fct4_predict_random_walk", "dense_daily", _WALK.format(lag=1, z=Z95))
def fct4_walk(spark, sf):
    return _walk(spark, sf, d=1, seasonal_d=0)


@query("fct4_predict_seasonal_walk", "dense_daily", _WALK.format(lag=7, z=Z95))
def fct4_seasonal_walk(spark, sf):
    return _walk(spark, sf, d=0, seasonal_d=1)


@query("fct5_diagnostics_ar1", "dense_daily", _AR1 + f"""
SELECT store_nbr, date, actual, round(prediction, 4) AS prediction, """ + r("actual - prediction", 4) + f""" AS residual,
       round(prediction - {Z95} * sigma, 4) AS lower, round(prediction + {Z95} * sigma, 4) AS upper FROM fitted""")
def fct5_ar1(spark, sf):
    model, daily = ar1(), materialize(daily_sales(spark, sf))
    return rounded(model.diagnostics(model.fit(daily), daily), 4, "prediction", "residual", "lower", "upper")


@query("fct6_additive_features", "dense_daily dense_sales oil_filled holidays", """
, edge AS (SELECT min(date) AS a, max(date) AS b FROM oil_filled),
flags AS (SELECT date, max(CASE WHEN type = 'Holiday' THEN 1 ELSE 0 END) AS h FROM holidays GROUP BY date)
SELECT d.store_nbr, d.date AS ds, d.sales AS y, CAST(coalesce(s.onpromotion, 0) AS DOUBLE) AS onpromotion,
       o.dcoilwtico, 0e0 AS transactions, CAST(coalesce(f.h, 0) AS DOUBLE) AS holiday
FROM dense_daily d CROSS JOIN edge LEFT JOIN dense_sales s ON s.store_nbr = d.store_nbr AND s.date = d.date
JOIN oil_filled o ON o.date = least(greatest(d.date, a), b) LEFT JOIN flags f ON f.date = d.date""")
def fct6(spark, sf):
    return additive_features(daily_features(spark, sf), KEYS)


@query("fct7_fit_additive")
def fct7(spark, sf):
    model, features, fits = fit_additive_by_series(daily_features(spark, sf), KEYS)
    return model.in_sample_metrics(features, fits)


@query("fct7_fit_additive_plain")
def fct7_additive(spark, sf):
    settings = AdditiveSettings(seasonality_mode="additive")
    model, features, fits = fit_additive_by_series(daily_features(spark, sf), KEYS, settings)
    return model.in_sample_metrics(features, fits)


# The closed form of an additive model that is a line: no changepoint, no season, no regressor, a free prior.
LINE = AdditiveSettings(seasonality_mode="additive", yearly_seasonality=False, weekly_seasonality=False, changepoints=0,
                        trend_prior_scale=1e9)
_LINE = """
, rows AS (SELECT store_nbr, date, sales, CAST(date_diff('day', min(date) OVER (PARTITION BY store_nbr), date) AS DOUBLE) AS t FROM dense_daily),
fit AS (SELECT store_nbr, regr_slope(sales, t) AS s, regr_intercept(sales, t) AS c, max(t) AS last_t, max(date) AS last_date,
        sqrt(regr_syy(sales, t) / count(*) - pow(regr_sxy(sales, t), 2) / regr_sxx(sales, t) / count(*)) AS sigma
        FROM rows GROUP BY store_nbr),
fitted AS (SELECT store_nbr, date, sales, c + s * t AS prediction FROM rows JOIN fit USING (store_nbr)),
steps AS (SELECT CAST(unnest(generate_series(1, 30)) AS INT) AS step),
ahead AS (SELECT store_nbr, CAST(last_date + step AS DATE) AS date, step, c + s * (last_t + step) AS prediction, sigma FROM fit, steps)"""
Z80 = 1.2815515655446004


def _line(spark, sf):
    return fit_additive_by_series(daily_sales(spark, sf), KEYS, LINE)


@query("fct7_fit_line", "dense_daily", _LINE + """
SELECT store_nbr, count(*) AS n, round(sqrt(avg(pow(prediction - sales, 2))), 3) AS rmse,
       round(avg(abs(prediction - sales)), 3) AS mae FROM fitted GROUP BY store_nbr""")
def fct7_line(spark, sf):
    model, features, fits = _line(spark, sf)
    return rounded(model.in_sample_metrics(features, fits).select(*KEYS, "n", "rmse", "mae"), 3, "rmse", "mae")


# One possible change of slope beside a free line: after the line is taken out of the hinge and of the sales, the change
# is their product less the threshold sigma^2 / (prior * size), over the hinge's square.
BENT = replace(LINE, changepoints=1, changepoint_range=0.5, changepoint_prior_scale=0.0001)


@query("fct7_soft_threshold", "dense_daily", """
, rows AS (SELECT store_nbr, sales, date_diff('day', min(date) OVER w, date) / date_diff('day', min(date) OVER w, max(date) OVER w) AS t
           FROM dense_daily WINDOW w AS (PARTITION BY store_nbr)),
hinged AS (SELECT *, greatest(t - 0.5, 0) AS h FROM rows),
sums AS (SELECT store_nbr, count(*) AS n, avg(sales * sales) AS size2, regr_sxx(sales, t) AS tt, regr_sxy(sales, t) AS ty,
         regr_syy(sales, t) AS yy, regr_sxx(sales, h) AS hh, regr_sxy(sales, h) AS hy, regr_sxy(h, t) AS th, avg(sales) AS my,
         avg(t) AS mt, avg(h) AS mh FROM hinged GROUP BY store_nbr),
bare AS (SELECT *, hh - th * th / tt AS g, hy - th * ty / tt AS r FROM sums),
cut AS (SELECT *, (yy - ty * ty / tt - r * r / g) / (n - 3) / (0.0001 * sqrt(size2)) AS threshold FROM bare),
bent AS (SELECT *, sign(r) * greatest(abs(r) - threshold, 0) / g AS change FROM cut)
SELECT store_nbr, n, round(my - (ty - th * change) / tt * mt - change * mh, 3) AS start, round((ty - th * change) / tt, 3) AS slope,
       round(change, 3) + 0 AS change FROM bent""")
def fct7_soft_threshold(spark, sf):
    _, _, fits = fit_additive_by_series(daily_sales(spark, sf), KEYS, BENT)
    named = fits.select(*KEYS, "n", *[F.col("coef")[i].alias(c) for i, c in enumerate(("start", "slope", "change"))])
    return rounded(named, 3, "start", "slope", "change").withColumn("change", F.col("change") + 0)


@query("fct8_predict_line", "dense_daily", _LINE + "SELECT store_nbr, date, step, round(prediction, 3) AS prediction FROM ahead")
def fct8_line(spark, sf):
    model, features, fits = _line(spark, sf)
    return rounded(model.predict(fits, features, 30).drop("lower", "upper"), 3, "prediction")


@query("fct9_components_line", "dense_daily", _LINE + """
SELECT store_nbr, date AS ds, round(prediction, 3) AS trend, 0e0 AS yearly, 0e0 AS weekly, 0e0 AS holidays, 0e0 AS regressors,
       round(prediction, 3) AS prediction FROM fitted""")
def fct9_line(spark, sf):
    model, features, fits = _line(spark, sf)
    return rounded(model.components(features, fits), 3, "trend", "prediction")


@query("fct10_intervals_line", "dense_daily", _LINE + f"""
SELECT store_nbr, date, round(prediction - {Z80} * sigma, 3) AS lower, round(prediction + {Z80} * sigma, 3) AS upper FROM ahead""")
def fct10_line(spark, sf):
    model, features, fits = _line(spark, sf)
    return rounded(model.predict(fits, features, 30).select(*KEYS, "date", "lower", "upper"), 3, "lower", "upper")


@query("fct8_predict_additive")
def fct8(spark, sf):
    model, features, fits = fit_additive_by_series(daily_features(spark, sf), KEYS)
    return model.predict(fits, features, 30).drop("lower", "upper")


@query("fct9_components")
def fct9(spark, sf):
    model, features, fits = fit_additive_by_series(daily_features(spark, sf), KEYS)
    return model.components(features, fits)


@query("fct10_intervals")
def fct10(spark, sf):
    model, features, fits = fit_additive_by_series(daily_features(spark, sf), KEYS)
    return model.predict(fits, features, 30).select(*KEYS, "date", "lower", "upper")


@query("fct11_sequence_regressor")
def fct11(spark, sf):
    return learner.fit_sequence_regressor(daily_sales(spark, sf), "sales", KEYS)[1]


@query("fct11_sequence_next", "dense_daily", """
, framed AS (SELECT store_nbr, date, sales AS v2, lag(sales) OVER w AS v1, lead(sales) OVER w AS nxt FROM dense_daily
             WINDOW w AS (PARTITION BY store_nbr ORDER BY date)),
marked AS (SELECT *, (v1 + v2) / 2 AS level, percent_rank() OVER (PARTITION BY store_nbr ORDER BY date DESC) < 0.2 AS is_val
           FROM framed WHERE v1 IS NOT NULL AND nxt IS NOT NULL),
fit AS (SELECT regr_slope(nxt / level, v1 / level) AS s, regr_intercept(nxt / level, v1 / level) AS c FROM marked WHERE NOT is_val)
SELECT round(avg(pow(c + s * v1 / level - nxt / level, 2)) FILTER (NOT is_val), 6) AS train_loss,
       round(avg(pow(c + s * v1 / level - nxt / level, 2)) FILTER (is_val), 6) AS val_loss FROM marked, fit""")
def fct11_next(spark, sf):
    losses = learner.fit_sequence_regressor(daily_sales(spark, sf), "sales", KEYS, length=2, ridge=0.0, max_iter=200)[1]
    return rounded(losses, 6, "train_loss", "val_loss")


_COLUMNS = """
, framed AS (SELECT d.store_nbr, d.date, d.sales AS x, CAST(coalesce(s.onpromotion, 0) AS DOUBLE) AS p,
             lead(d.sales) OVER w AS y1, lead(d.sales, 2) OVER w AS y2, max(d.date) OVER (PARTITION BY d.store_nbr) AS m
             FROM dense_daily d LEFT JOIN dense_sales s ON s.store_nbr = d.store_nbr AND s.date = d.date
             WINDOW w AS (PARTITION BY d.store_nbr ORDER BY d.date)),
marked AS (SELECT *, percent_rank() OVER (PARTITION BY store_nbr ORDER BY date DESC) < 0.2 AS is_val FROM framed WHERE y2 IS NOT NULL),
long AS (SELECT store_nbr, date, x, p, is_val, unnest([1, 2]) AS step, unnest([y1, y2]) AS y FROM marked),
sums AS (SELECT step, regr_sxx(y, x) AS xx, regr_sxx(y, p) AS pp, regr_sxy(x, p) AS xp, regr_sxy(y, x) AS xy, regr_sxy(y, p) AS py,
         avg(x) AS mx, avg(p) AS mp, avg(y) AS my FROM long WHERE NOT is_val GROUP BY step),
slopes AS (SELECT *, (pp * xy - xp * py) / (xx * pp - xp * xp) AS b, (xx * py - xp * xy) / (xx * pp - xp * xp) AS c FROM sums),
fit AS (SELECT step, b, c, my - b * mx - c * mp AS a FROM slopes)
"""


def promoted_sales(spark, sf):
    """The daily series with the promotions of each day, 0 where there were none."""
    promotions = views.dense_sales(spark, sf).select(*KEYS, "date", F.col("onpromotion").cast("double").alias("onpromotion"))
    return daily_sales(spark, sf).join(promotions, [*KEYS, "date"], "left").na.fill(0.0, ["onpromotion"])


@query("fct11_columns_losses", "dense_daily dense_sales", _COLUMNS + """
SELECT round(avg(pow(a + b * x + c * p - y, 2)) FILTER (NOT is_val), 2) AS train_loss,
       round(avg(pow(a + b * x + c * p - y, 2)) FILTER (is_val), 2) AS val_loss FROM long JOIN fit USING (step)""")
def fct11_columns(spark, sf):
    _, losses = learner.fit_column_regressor(promoted_sales(spark, sf), ["onpromotion"], "sales", KEYS, length=1, horizon=2,
                                             ridge=0.0, relative=False)
    return rounded(losses, 2, "train_loss", "val_loss")


@query("fct11_columns_predict", "dense_daily dense_sales", _COLUMNS + """
SELECT store_nbr, CAST(m + CAST(step AS INT) AS DATE) AS date, CAST(step AS INT) AS step, round(a + b * x + c * p, 4) AS prediction
FROM framed, fit WHERE date = m""")
def fct11_columns_predict(spark, sf):
    daily = materialize(promoted_sales(spark, sf))
    model = learner.ColumnSequenceModel(KEYS, ["onpromotion"], length=1, horizon=2, ridge=0.0, relative=False)
    return rounded(model.predict(model.fit(daily), daily, 2), 4, "prediction")


@query("fct11_columns_full")
def fct11_columns_full(spark, sf):
    """A month of sales, promotions, oil prices and holidays, two weeks ahead."""
    daily = materialize(daily_features(spark, sf).na.fill(0.0))
    names = [c for c in ("onpromotion", "dcoilwtico", "holiday_type_Holiday") if c in daily.columns]
    return learner.fit_column_regressor(daily, names, "sales", KEYS, horizon=14)[1]


@query("fct11_sequence_boosted")
def fct11_gbt(spark, sf):
    return learner.fit_sequence_regressor(daily_sales(spark, sf), "sales", KEYS, method="gbt")[1]


@query("fct12_baselines_in_sample", "dense_daily", """
SELECT store_nbr, date, sales AS actual, lag(sales, 7) OVER w AS seasonal_naive,
       round(avg(sales) OVER (PARTITION BY store_nbr ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 4) AS moving_average
FROM dense_daily WINDOW w AS (PARTITION BY store_nbr ORDER BY date)""")
def fct12(spark, sf):
    return rounded(forecast.in_sample_baselines(daily_sales(spark, sf), "sales", KEYS), 4, "moving_average")


_BASELINES = """
, last AS (SELECT store_nbr, max(date) AS m FROM dense_daily GROUP BY store_nbr),
means AS (SELECT d.store_nbr, avg(sales) AS moving_average FROM dense_daily d JOIN last l ON l.store_nbr = d.store_nbr
          WHERE date_diff('day', date, m) < 28 GROUP BY d.store_nbr),
steps AS (SELECT store_nbr, m, CAST(unnest(generate_series(1, 14)) AS INT) AS step FROM last),
future AS (SELECT s.store_nbr, CAST(s.m + s.step AS DATE) AS date, s.step, d.sales AS seasonal_naive, moving_average
  FROM steps s JOIN dense_daily d ON d.store_nbr = s.store_nbr AND d.date = s.m - 7 + ((s.step - 1) % 7 + 1)
  JOIN means ON means.store_nbr = s.store_nbr)"""


@query("fct12_baseline_forecast", "dense_daily", _BASELINES + """
SELECT store_nbr, date, step, seasonal_naive, round(moving_average, 4) AS moving_average FROM future""")
def fct12_future(spark, sf):
    return rounded(forecast.baseline_forecast(daily_sales(spark, sf), "sales", KEYS, 14), 4, "moving_average")


@query("fct13_forecast_frame", "dense_daily", """
SELECT store_nbr, CAST((SELECT max(date) FROM dense_daily WHERE store_nbr IN (0, 2)) + step AS DATE) AS date, step
FROM (SELECT DISTINCT store_nbr FROM dense_daily WHERE store_nbr IN (0, 2)),
     (SELECT CAST(unnest(generate_series(1, 30)) AS INT) AS step)""")
def fct13(spark, sf):
    return forecast.forecast_frame(daily_sales(spark, sf), 30, KEYS, [0, 2])


@query("fct14_ensemble", "dense_daily", _BASELINES + """
SELECT store_nbr, date, round((seasonal_naive + moving_average) / 2, 4) AS prediction FROM future""")
def fct14(spark, sf):
    both = forecast.baseline_forecast(daily_sales(spark, sf), "sales", KEYS, 14)
    long = both.unpivot([*KEYS, "date"], ["seasonal_naive", "moving_average"], "model", "prediction")
    return rounded(forecast.ensemble(long, [*KEYS, "date"]), 4, "prediction")


@query("fct14_ensemble_weighted", "dense_daily", _BASELINES + """,
scored AS (SELECT sales, lag(sales, 7) OVER (PARTITION BY store_nbr ORDER BY date) AS a,
  avg(sales) OVER (PARTITION BY store_nbr ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS b FROM dense_daily),
w AS (SELECT 1 / sqrt(avg(pow(a - sales, 2))) AS wa, 1 / sqrt(avg(pow(b - sales, 2))) AS wb FROM scored)
SELECT store_nbr, date, round((seasonal_naive * wa + moving_average * wb) / (wa + wb), 4) AS prediction FROM future, w""")
def fct14_weighted(spark, sf):
    daily = daily_sales(spark, sf)
    names = ["seasonal_naive", "moving_average"]
    past = forecast.in_sample_baselines(daily, "sales", KEYS).unpivot([*KEYS, "date", "actual"], names, "model", "prediction")
    weights = evaluate.error_metrics(past, ["model"]).select("model", "rmse")
    long = forecast.baseline_forecast(daily, "sales", KEYS, 14).unpivot([*KEYS, "date"], names, "model", "prediction")
    return rounded(forecast.ensemble(long, [*KEYS, "date"], weights), 4, "prediction")


@query("spl5_backtest_naive", "dense_daily", """
, lagged AS (SELECT store_nbr, date, sales, lag(sales, 7) OVER (PARTITION BY store_nbr ORDER BY date) AS prediction FROM dense_daily),
span AS (SELECT min(date) AS a, max(date) AS b FROM dense_daily),
cutoffs AS (SELECT CAST(b - CAST(7 + 7 * k AS INT) AS DATE) AS cutoff FROM span, (SELECT unnest(generate_series(0, 1000)) AS k)
            WHERE b - CAST(7 + 7 * k AS INT) >= a + 30)
SELECT cutoff, count(prediction) AS n, round(sqrt(avg(pow(prediction - sales, 2))), 4) AS rmse
FROM lagged JOIN cutoffs ON date > cutoff AND date <= cutoff + 7 GROUP BY cutoff""")
def spl5_naive(spark, sf):
    rows = forecast.backtest_naive(daily_sales(spark, sf), "sales", KEYS)
    return rounded(evaluate.error_metrics(rows, ["cutoff"]).select("cutoff", "n", "rmse"), 4, "rmse")


@query("spl5_backtest_linear")
def spl5_linear(spark, sf):
    rows = forecast.backtest_linear(daily_sales(spark, sf), "sales", KEYS)
    return evaluate.error_metrics(rows, ["cutoff"])


@query("spl5_backtest_lag7", "dense_daily", """
, lagged AS (SELECT store_nbr, date, sales, lag(sales, 7) OVER (PARTITION BY store_nbr ORDER BY date) AS x FROM dense_daily),
span AS (SELECT min(date) AS a, max(date) AS b FROM dense_daily),
cutoffs AS (SELECT CAST(b - CAST(7 + 7 * k AS INT) AS DATE) AS cutoff FROM span, (SELECT unnest(generate_series(0, 1000)) AS k)
            WHERE b - CAST(7 + 7 * k AS INT) >= a + 60),
fit AS (SELECT store_nbr, cutoff, regr_slope(sales, x) AS s, regr_intercept(sales, x) AS c
        FROM lagged JOIN cutoffs ON date <= cutoff GROUP BY store_nbr, cutoff)
SELECT l.store_nbr, l.date, f.cutoff, round(c + s * x, 4) AS prediction, sales AS actual
FROM lagged l JOIN fit f ON f.store_nbr = l.store_nbr AND l.date > f.cutoff AND l.date <= f.cutoff + 7""")
def spl5_lag7(spark, sf):
    return rounded(forecast.backtest_linear(daily_sales(spark, sf), "sales", KEYS, lags=(7,)), 4, "prediction")


@query("spl7_search")
def spl7(spark, sf):
    features = additive_features(daily_features(spark, sf), KEYS)
    cut = dt.date(2001, 1, 1)
    grid = search.full_grid({"changepoint_prior_scale": [0.005, 0.05, 0.5], "seasonality_prior_scale": [0.1, 10.0]})
    return search.search_additive(features.where(F.col("ds") < cut), features.where(F.col("ds") >= cut), KEYS, grid)


@query("spl7_search_line", "dense_daily", """
, rows AS (SELECT store_nbr, date, sales, CAST(date_diff('day', DATE '1992-01-01', date) AS DOUBLE) AS t FROM dense_daily),
fit AS (SELECT store_nbr, regr_slope(sales, t) AS s, regr_intercept(sales, t) AS c FROM rows
        WHERE date < DATE '2001-01-01' GROUP BY store_nbr)
SELECT store_nbr, CAST(unnest([0, 1]) AS INT) AS candidate, rmse FROM (
  SELECT store_nbr, round(sqrt(avg(pow(c + s * t - sales, 2))), 3) AS rmse FROM rows JOIN fit USING (store_nbr)
  WHERE date >= DATE '2001-01-01' GROUP BY store_nbr)""")
def spl7_line(spark, sf):
    """Two candidates that differ in the prior of a season the model does not have: equal lines."""
    features = additive_features(daily_sales(spark, sf), KEYS)
    cut = dt.date(2001, 1, 1)
    grid = search.full_grid({"seasonality_prior_scale": [0.1, 10.0]})
    trials = search.search_additive(features.where(F.col("ds") < cut), features.where(F.col("ds") >= cut), KEYS, grid, LINE)
    return rounded(trials, 3, "rmse")


@query("spl7_best_settings")
def spl7_best(spark, sf):
    features = additive_features(daily_features(spark, sf), KEYS)
    cut = dt.date(2001, 1, 1)
    drawn = search.draw({"changepoint_prior_scale": [0.001, 0.5], "seasonality_prior_scale": [0.01, 10.0]}, 10)
    trials = search.search_additive(features.where(F.col("ds") < cut), features.where(F.col("ds") >= cut), KEYS, drawn)
    return search.best_candidate(trials, KEYS)


@query("udf3_user_model", "dense_daily", """
, rows AS (SELECT store_nbr, sales, row_number() OVER (PARTITION BY store_nbr ORDER BY date) - 1 AS t FROM dense_daily),
fit AS (SELECT store_nbr, regr_slope(sales, t) AS s, regr_intercept(sales, t) AS c, count(*) AS n FROM rows GROUP BY store_nbr)
SELECT store_nbr, CAST((SELECT max(date) FROM dense_daily) + step AS DATE) AS date, step,
       round(c + s * (n + step - 1), 4) AS prediction FROM fit, (SELECT CAST(unnest(generate_series(1, 7)) AS INT) AS step)""")
def udf3(spark, sf):
    import numpy as np

    def line(pdf):
        t = np.arange(len(pdf))
        slope, level = np.polyfit(t, pdf["sales"].to_numpy(), 1)
        return [level + slope * len(pdf), slope]
    model = forecast.GroupedModel("line", KEYS, line, lambda p, days: [p[0] + p[1] * i for i in range(days)])
    daily = daily_sales(spark, sf)
    return rounded(model.predict(model.fit(daily), daily, 7), 4, "prediction")
