"""Queries on profiles, statistics, outliers, coverage and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import normal_quantile
from ..operators import calendar as cal, clean, coverage, decompose, joins, outliers, profile, splits
from ..sources import retail_views as views
from .preparation import KEYS
from .registry import query, r, rounded


def _long(section, metric, key, value, tail):
    return (f"SELECT '{section}' AS section, '{metric}' AS metric, CAST({key} AS VARCHAR) AS key, "
            f"CAST({value} AS DOUBLE) AS value {tail}")


def _describe_sql(col, tail, where_key=""):
    return (f"SELECT {where_key}count({col}) AS count, round(avg({col}), 4) AS mean, round(stddev_samp({col}), 4) AS std, "
            f"CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max, "
            f"round(quantile_cont({col}, 0.25), 4) AS p25, round(quantile_cont({col}, 0.5), 4) AS p50, "
            f"round(quantile_cont({col}, 0.75), 4) AS p75 {tail}")


DESCRIBED = ["mean", "std", "p25", "p50", "p75"]


@query("agg1_sales_profile", "days", """
SELECT count(*) AS records, count(DISTINCT store_nbr) AS unique_stores, count(DISTINCT family) AS product_families,
  sum(sales) AS total_sales, min(sales) AS min_sales, max(sales) AS max_sales,
  round(avg(CASE WHEN onpromotion > 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS promotion_freq,
  count(*) FILTER (date IS NULL) AS missing_date, count(*) FILTER (store_nbr IS NULL) AS missing_store_nbr,
  count(*) FILTER (family IS NULL) AS missing_family, count(*) FILTER (sales IS NULL) AS missing_sales,
  count(*) FILTER (onpromotion IS NULL) AS missing_onpromotion,
  count(*) FILTER (sales = 0) AS zero_sales, count(*) FILTER (sales < 0) AS negative_sales,
  (SELECT round(avg(sales), 4) FROM days) AS avg_daily_sales,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM sales_fact
     GROUP BY date, store_nbr, family, sales, onpromotion)) AS duplicates
FROM sales_fact""")
def agg1(spark, sf):
    df = profile.sales_profile(views.sales_fact(spark, sf))
    return rounded(rounded(df, 6, "promotion_freq"), 4, "avg_daily_sales")


def _described_rows(section, metric, source):
    parts = {"count": "count(n)", "mean": "avg(n)", "std": "stddev_samp(n)", "min": "min(n)", "max": "max(n)",
             "p25": "quantile_cont(n, 0.25)", "p50": "quantile_cont(n, 0.5)", "p75": "quantile_cont(n, 0.75)"}
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{metric}' AS metric, '{k}' AS key, CAST({e} AS DOUBLE) AS value FROM {source}"
        for k, e in parts.items())


@query("agg2_store_profile", "stores", f"""
, state_n AS (SELECT count(DISTINCT city) AS n FROM stores GROUP BY state),
city_n AS (SELECT count(store_nbr) AS n FROM stores GROUP BY city), long AS (
{_long('structure', 'total_stores', "''", 'count(*)', 'FROM stores')}
UNION ALL {_long('structure', 'cities', "''", 'count(DISTINCT city)', 'FROM stores')}
UNION ALL {_long('structure', 'states', "''", 'count(DISTINCT state)', 'FROM stores')}
UNION ALL {_long('structure', 'types', "''", 'count(DISTINCT type)', 'FROM stores')}
UNION ALL {_long('distribution', 'store_types', 'type', 'count(*)', 'FROM stores GROUP BY type')}
UNION ALL {_long('distribution', 'clusters', 'cluster', 'count(*)', 'FROM stores GROUP BY cluster')}
UNION ALL {_described_rows('geographic', 'cities_per_state', 'state_n')}
UNION ALL {_described_rows('geographic', 'stores_per_city', 'city_n')})
SELECT section, metric, key, round(value, 6) AS value FROM long""")
def agg2(spark, sf):
    return rounded(profile.store_profile(views.stores(spark, sf)), 6, "value")


@query("agg3_oil_profile", "oil", """
SELECT count(*) AS records, min(date) AS first_date, max(date) AS last_date, min(dcoilwtico) AS min_price,
  max(dcoilwtico) AS max_price, round(avg(dcoilwtico), 6) AS avg_price, round(stddev_samp(dcoilwtico), 6) AS volatility,
  count(*) FILTER (dcoilwtico IS NULL) AS missing_values,
  (SELECT count(*) FILTER (g <> 1) FROM (SELECT date_diff('day', lag(date) OVER (ORDER BY date), date) AS g FROM oil)) AS gaps
FROM oil""")
def agg3(spark, sf):
    return rounded(profile.oil_profile(views.oil(spark, sf)), 6, "avg_price", "volatility")


@query("agg4_holiday_profile", "holidays", f"""
{_long('structure', 'records', "''", 'count(*)', 'FROM holidays')}
UNION ALL {_long('structure', 'transferred', "''", 'count(*)', 'FROM holidays WHERE transferred')}
UNION ALL {_long('structure', 'span_days', "''", "date_diff('day', min(date), max(date))", 'FROM holidays')}
UNION ALL {_long('distribution', 'types', 'type', 'count(*)', 'FROM holidays GROUP BY type')}
UNION ALL {_long('distribution', 'locale', 'locale', 'count(*)', 'FROM holidays GROUP BY locale')}
UNION ALL {_long('temporal', 'monthly_density', 'month(date)', 'count(*)', 'FROM holidays GROUP BY month(date)')}
UNION ALL (SELECT 'temporal', 'top_types', type, CAST(count(*) AS DOUBLE) FROM holidays GROUP BY type
           ORDER BY count(*) DESC, type LIMIT 5)""")
def agg4(spark, sf):
    return profile.holiday_profile(views.holidays(spark, sf))


@query("agg5_transaction_profile", "transactions", f"""
, daily AS (SELECT date, sum(transactions) AS total FROM transactions GROUP BY date), long AS (
{_long('structure', 'records', "''", 'count(*)', 'FROM transactions')}
UNION ALL {_long('structure', 'total_transactions', "''", 'sum(transactions)', 'FROM transactions')}
UNION ALL {_long('statistics', 'avg_daily', "''", 'avg(total)', 'FROM daily')}
UNION ALL {_long('patterns', 'weekly', 'isodow(date) - 1', 'avg(transactions)', 'FROM transactions GROUP BY isodow(date)')}
UNION ALL {_long('patterns', 'monthly', 'month(date)', 'avg(transactions)', 'FROM transactions GROUP BY month(date)')})
SELECT section, metric, key, round(value, 6) AS value FROM long""")
def agg5(spark, sf):
    return rounded(profile.transaction_profile(views.transactions(spark, sf)), 6, "value")


@query("agg5_transactions_per_store", "transactions",
       _describe_sql("transactions", "FROM transactions GROUP BY store_nbr", "store_nbr, "))
def agg5_store(spark, sf):
    return rounded(profile.describe(views.transactions(spark, sf), "transactions", ["store_nbr"], "grouped"), 4, *DESCRIBED)


@query("agg6_business_metrics", "days stores", f"""
, long AS (
{_long('sales', 'total_sales', "''", 'sum(sales)', 'FROM sales_fact')}
UNION ALL {_long('sales', 'total_families', "''", 'count(DISTINCT family)', 'FROM sales_fact')}
UNION ALL {_long('sales', 'promo_items', "''", 'sum(onpromotion)', 'FROM sales_fact')}
UNION ALL {_long('sales', 'avg_daily_sales', "''", 'avg(sales)', 'FROM days')}
UNION ALL {_long('stores', 'total_stores', "''", 'count(*)', 'FROM stores')}
UNION ALL {_long('stores', 'stores_by_type', 'type', 'count(*)', 'FROM stores GROUP BY type')}
UNION ALL {_long('products', 'sales_by_family', 'family', 'sum(sales)', 'FROM sales_fact GROUP BY family')}
UNION ALL {_long('promotions', 'promo_effect', 'onpromotion', 'avg(sales)', 'FROM sales_fact GROUP BY onpromotion')})
SELECT section, metric, key, round(value, 4) AS value FROM long""")
def agg6(spark, sf):
    return rounded(profile.business_metrics(views.sales_fact(spark, sf), views.stores(spark, sf)), 4, "value")


@query("agg7_seasonality", "sales_fact", """
SELECT 'monthly' AS pattern, month(date)::INT AS period, round(avg(sales), 4) AS mean FROM sales_fact GROUP BY month(date)
UNION ALL SELECT 'daily', (isodow(date) - 1)::INT, round(avg(sales), 4) FROM sales_fact GROUP BY isodow(date)
UNION ALL SELECT 'yearly_trend', year(date)::INT, round(avg(sales), 4) FROM sales_fact GROUP BY year(date)""")
def agg7(spark, sf):
    return rounded(profile.seasonality(views.sales_fact(spark, sf), "sales"), 4, "mean")


@query("agg7_seasonality_hourly", "prediction_log", """
SELECT 'monthly' AS pattern, month(ts)::INT AS period, round(avg(prediction), 4) AS mean FROM prediction_log GROUP BY month(ts)
UNION ALL SELECT 'daily', (isodow(ts) - 1)::INT, round(avg(prediction), 4) FROM prediction_log GROUP BY isodow(ts)
UNION ALL SELECT 'yearly_trend', year(ts)::INT, round(avg(prediction), 4) FROM prediction_log GROUP BY year(ts)
UNION ALL SELECT 'hourly', hour(ts)::INT, round(avg(prediction), 4) FROM prediction_log GROUP BY hour(ts)""")
def agg7_hourly(spark, sf):
    return rounded(profile.seasonality(views.prediction_log(spark, sf), "prediction", "ts"), 4, "mean")


@query("agg8_totals", "sales_fact", """
SELECT date, store_nbr, family, sum(sales) AS total, count(*) AS n,
       GROUPING(date, store_nbr, family) AS level
FROM sales_fact GROUP BY GROUPING SETS ((date), (store_nbr), (family))""")
def agg8(spark, sf):
    return profile.grouped_totals(views.sales_fact(spark, sf), [["date"], ["store_nbr"], ["family"]], "sales")


@query("agg9_describe", "sales_fact", _describe_sql("sales", "FROM sales_fact"))
def agg9(spark, sf):
    return rounded(profile.describe(views.sales_fact(spark, sf), "sales"), 4, *DESCRIBED)


@query("agg9_describe_by_family", "sales_fact", _describe_sql("sales", "FROM sales_fact GROUP BY family", "family, "))
def agg9_family(spark, sf):
    return rounded(profile.describe(views.sales_fact(spark, sf), "sales", ["family"]), 4, *DESCRIBED)


PROFILED = {"date": "date", "store_nbr": "bigint", "family": "string", "sales": "double", "onpromotion": "bigint"}


@query("agg10_column_profile", "sales_fact", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_values, count(*) FILTER ({c} IS NULL) AS missing, "
    f"round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 4)::DOUBLE AS missing_pct, '{t}' AS type, "
    + (f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 4) AS mean"
       if t in ("bigint", "double") else "NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean")
    + " FROM sales_fact" for c, t in PROFILED.items()))
def agg10(spark, sf):
    return rounded(profile.column_profile(views.sales_fact(spark, sf))[0], 4, "missing_pct", "mean")


@query("top5_column_values", "stores", """
, v AS (SELECT 'type' AS "column", type AS value, count(*) AS n FROM stores GROUP BY type
  UNION ALL SELECT 'state', state, count(*) FROM stores GROUP BY state),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM v)
SELECT "column", value, n, rank FROM ranked WHERE rank <= 5""")
def top5(spark, sf):
    return profile.column_profile(views.stores(spark, sf))[1].select("column", "value", "n", F.col("rank").cast("bigint").alias("rank"))


@query("prj7_type_advice", "sales_fact", """
, found AS (SELECT 'sales' AS "column", 'integer' AS advice, bool_and(sales = round(sales)) AS holds FROM sales_fact
UNION ALL SELECT 'family', 'categorical', count(DISTINCT family) < 0.5 * count(*) FROM sales_fact)
SELECT "column", advice FROM found WHERE holds""")
def prj7(spark, sf):
    return profile.type_advice(views.sales_fact(spark, sf))


@query("agg11_time_range", "sales_fact oil transactions", " UNION ALL ".join(
    f"SELECT '{t}' AS name, min(date) AS start_date, max(date) AS end_date, "
    f"CAST(date_diff('day', min(date), max(date)) AS INT) AS total_days FROM {t}" for t in ("sales_fact", "oil", "transactions")))
def agg11(spark, sf):
    frames = {"sales_fact": views.sales_fact, "oil": views.oil, "transactions": views.transactions}
    out = None
    for name, view in frames.items():
        row = profile.time_range(view(spark, sf)).withColumn("name", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@query("agg12_grid_completeness", "sales_fact", """
, one AS (SELECT count(*) AS actual_records, (date_diff('day', min(date), max(date)) + 1)
   * count(DISTINCT store_nbr) * count(DISTINCT family) AS expected_records FROM sales_fact)
SELECT *, round(actual_records * 100e0 / expected_records, 6) AS completeness FROM one""")
def agg12(spark, sf):
    return rounded(profile.grid_completeness(views.sales_fact(spark, sf)), 6, "completeness")


@query("agg13_daily_completeness", "sales_fact stores", """
SELECT date, count(*) AS n, round(count(*) * 100e0 / ((SELECT count(*) FROM stores)
       * (SELECT count(DISTINCT family) FROM sales_fact)), 6) AS completeness
FROM sales_fact GROUP BY date""")
def agg13(spark, sf):
    return rounded(profile.daily_completeness(views.sales_fact(spark, sf), views.stores(spark, sf)), 6, "completeness")


@query("agg14_duplicates", "sale_lines", """
, sizes AS (SELECT count(*) AS n FROM sale_lines GROUP BY date, store_nbr, promoted)
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates, round(sum(n - 1) * 100e0 / sum(n), 6) AS percentage FROM sizes""")
def agg14(spark, sf):
    lines = views.sale_lines(spark, sf).select("date", "store_nbr", "promoted")
    return rounded(profile.duplicate_rows(lines), 6, "percentage")


@query("agg15_missing_by_column", "transactions", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing FROM transactions"
    for c in ("date", "store_nbr", "transactions")))
def agg15(spark, sf):
    return profile.missing_by_column(views.transactions(spark, sf))


@query("agg15_only_missing", "transactions", """
SELECT 'transactions' AS "column", count(*) FILTER (transactions IS NULL) AS missing FROM transactions""")
def agg15_only(spark, sf):
    return profile.missing_by_column(views.transactions(spark, sf), only_missing=True)


@query("agg16_negatives", None, """
SELECT 's_suppkey' AS "column", count(*) FILTER (s_suppkey < 0) AS negatives FROM supplier
UNION ALL SELECT 's_nationkey', count(*) FILTER (s_nationkey < 0) FROM supplier
UNION ALL SELECT 's_acctbal', count(*) FILTER (s_acctbal < 0) FROM supplier""")
def agg16(spark, sf):
    return profile.negatives_by_column(views.table(spark, sf, "supplier"))


SKEW = """(sum(pow(sales - m, 3)) / count(*)) / pow(sum(pow(sales - m, 2)) / count(*), 1.5)"""


@query("agg17_distribution_stats", "sales_fact", f"""
, centred AS (SELECT sales, (SELECT avg(sales) FROM sales_fact) AS m FROM sales_fact)
SELECT round(avg(sales), 4) AS mean, round(stddev_samp(sales), 4) AS std, round({SKEW}, 6) AS skewness,
  round(kurtosis_pop(sales), 6) AS kurtosis, round(quantile_cont(sales, 0.5), 4) AS median,
  round(quantile_cont(sales, 0.75) - quantile_cont(sales, 0.25), 4) AS iqr
FROM centred""")
def agg17(spark, sf):
    df = profile.distribution_stats(views.sales_fact(spark, sf), "sales")
    return rounded(rounded(df, 6, "skewness", "kurtosis"), 4, "mean", "std", "median", "iqr")


@query("agg18_normality", "days", f"""
, centred AS (SELECT sales, (SELECT avg(sales) FROM days) AS m FROM days),
jb AS (SELECT count(*) AS n, count(*) / 6e0 * (pow({SKEW}, 2) + pow(kurtosis_pop(sales), 2) / 4) AS statistic FROM centred)
SELECT n, round(statistic, 6) AS statistic, round(exp(-statistic / 2), 8) AS p_value, exp(-statistic / 2) >= 0.05 AS is_normal
FROM jb""")
def agg18(spark, sf):
    daily = views.sales_fact(spark, sf).groupBy("date").agg(F.sum("sales").alias("sales"))
    return rounded(rounded(profile.normality_test(daily, "sales"), 6, "statistic"), 8, "p_value")


@query("agg19_histogram", "sales_fact", """
, span AS (SELECT min(sales) AS a, max(sales) AS b FROM sales_fact)
SELECT CAST(least(floor((sales - a) * 50 / (b - a)) + 1, 50) AS INT) AS bin, count(*) AS n
FROM sales_fact, span GROUP BY 1""")
def agg19(spark, sf):
    return profile.histogram(views.sales_fact(spark, sf), "sales", 50)


@query("agg20_qq_points", "sales_fact", """
, theory(prob, theoretical) AS (VALUES """ + ", ".join(f"({i / 100}e0, {normal_quantile(i / 100)!r}e0)" for i in range(1, 100)) + """),
cut AS (SELECT quantile_cont(sales, [""" + ", ".join(str(i / 100) for i in range(1, 100)) + """]) AS q FROM sales_fact)
SELECT prob, round(q[CAST(round(prob * 100) AS INT)], 4) AS sample, round(theoretical, 8) AS theoretical FROM theory, cut""")
def agg20(spark, sf):
    return rounded(rounded(profile.qq_points(views.sales_fact(spark, sf), "sales"), 4, "sample"), 8, "theoretical")


MEASURED = ["sales", "onpromotion", "transactions"]


@query("agg21_correlations", "sales_fact transactions", """
, joined AS (SELECT * FROM sales_fact LEFT JOIN transactions USING (date, store_nbr)) """ + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS correlation FROM joined"
    for a in MEASURED for b in MEASURED if a != b))
def agg21(spark, sf):
    joined = joins.join_transactions(views.sales_fact(spark, sf), views.transactions(spark, sf))
    return rounded(profile.correlation_matrix(joined, MEASURED), 6, "correlation")


FAMILIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
NUMBERS = ["onpromotion", "store_nbr", "month", "day_of_week"]


@query("agg22_importance_correlation", "calendar_sales", """
, scored AS (""" + " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, abs(corr({c}, sales)) AS importance FROM calendar_sales" for c in NUMBERS]
    + [f"SELECT 'family_{v}', abs(corr(CASE WHEN family = '{v}' THEN 1 ELSE 0 END, sales)) FROM calendar_sales"
       for v in FAMILIES]) + ") SELECT feature, round(importance, 6) AS importance FROM scored")
def agg22(spark, sf):
    df = cal.calendar_features(views.sales_fact(spark, sf))
    return rounded(profile.feature_importance(df, "sales", NUMBERS, {"family": FAMILIES}), 6, "importance")


def _mi_sql(features, target, source, bins=10):
    probs = ", ".join(str(i / bins) for i in range(1, bins))
    cuts = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), [{probs}]) AS q_{c}" for c in [*features, target])

    def slot(c):
        return f"len(list_filter(q_{c}, lambda e: e < {c}))"
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, sum(n / t * ln(n * t / (nx * ny))) AS importance FROM (
        SELECT n, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny, sum(n) OVER () AS t FROM (
        SELECT {slot(c)} AS x, {slot(target)} AS y, CAST(count(*) AS DOUBLE) AS n FROM {source}, cuts GROUP BY 1, 2))"""
        for c in features)
    return f", cuts AS (SELECT {cuts} FROM {source}), scored AS ({parts}) " \
           "SELECT feature, round(greatest(importance, 0), 8) AS importance FROM scored"


@query("agg23_importance_mutual_info", "calendar_sales", _mi_sql(NUMBERS, "sales", "calendar_sales"))
def agg23(spark, sf):
    df = cal.calendar_features(views.sales_fact(spark, sf))
    return rounded(profile.feature_importance(df, "sales", NUMBERS, method="mutual_info"), 8, "importance")


@query("top4_features", "calendar_sales", """
, scored AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, sales)) AS importance FROM calendar_sales" for c in NUMBERS)
    + ") SELECT feature, round(importance, 6) AS importance FROM scored ORDER BY importance DESC, feature LIMIT 2")
def top4(spark, sf):
    df = cal.calendar_features(views.sales_fact(spark, sf))
    return rounded(profile.feature_importance(df, "sales", NUMBERS).limit(2), 6, "importance")


@query("agg24_lift", "sales_fact holidays", """
, marked AS (SELECT sales, onpromotion, date IN (SELECT date FROM holidays) AS h FROM sales_fact)
SELECT 'holiday' AS effect, round((avg(sales) FILTER (h) / avg(sales) FILTER (NOT h) - 1) * 100, 6) AS lift FROM marked
UNION ALL SELECT 'promotion', round((avg(sales) FILTER (onpromotion > 0) / avg(sales) FILTER (onpromotion = 0) - 1) * 100, 6) FROM marked""")
def agg24(spark, sf):
    fact = views.sales_fact(spark, sf)
    marked = cal.mark_members(fact, cal.holiday_dates(views.holidays(spark, sf)), "date", "h")
    holiday = profile.lift(marked, F.col("h") == 1).withColumn("effect", F.lit("holiday"))
    promo = profile.lift(fact, F.col("onpromotion") > 0).withColumn("effect", F.lit("promotion"))
    return rounded(holiday.unionByName(promo), 6, "lift")


@query("agg24_lift_by_family", "sales_fact", """
SELECT family, round((avg(sales) FILTER (onpromotion > 0) / avg(sales) FILTER (onpromotion = 0) - 1) * 100, 6) AS lift
FROM sales_fact GROUP BY family""")
def agg24_family(spark, sf):
    return rounded(profile.lift(views.sales_fact(spark, sf), F.col("onpromotion") > 0, keys=["family"]), 6, "lift")


@query("agg25_sales_per_transaction", "sales_fact transactions", """
, daily AS (SELECT date, store_nbr, sum(sales) AS sales FROM sales_fact GROUP BY date, store_nbr),
ratio AS (SELECT store_nbr, sales / transactions AS r FROM daily JOIN transactions USING (date, store_nbr))
SELECT store_nbr, round(min(r), 6) AS min, round(max(r), 6) AS max, round(avg(r), 6) AS avg FROM ratio GROUP BY store_nbr""")
def agg25(spark, sf):
    df = profile.sales_per_transaction(views.sales_fact(spark, sf), views.transactions(spark, sf))
    return rounded(df, 6, "min", "max", "avg")


@query("agg26_location_rollup", "sales_fact stores", """
SELECT state, city, store_nbr, sum(sales) AS total, count(*) AS n, GROUPING(state, city, store_nbr) AS level
FROM sales_fact JOIN stores USING (store_nbr) GROUP BY ROLLUP (state, city, store_nbr)""")
def agg26(spark, sf):
    return profile.location_rollup(joins.join_stores(views.sales_fact(spark, sf), views.stores(spark, sf)))


@query("agg27_pivot", "dense_sales", "SELECT date, " + ", ".join(
    f'max(sales) FILTER (store_nbr = {i}) AS "{i}"' for i in range(5)) + " FROM dense_sales GROUP BY date")
def agg27(spark, sf):
    return profile.pivot_series(views.dense_sales(spark, sf), list(range(5)))


# ---- top-k, sets and coverage ----

@query("top1_stores", "sales_fact", """
SELECT store_nbr, sum(sales) AS total FROM sales_fact GROUP BY store_nbr ORDER BY total DESC, store_nbr LIMIT 10""")
def top1(spark, sf):
    return profile.top_groups(views.sales_fact(spark, sf), "store_nbr")


@query("top2_families", "sales_fact", """
SELECT family, sum(sales) AS total FROM sales_fact GROUP BY family ORDER BY total DESC, family LIMIT 10""")
def top2(spark, sf):
    return profile.top_groups(views.sales_fact(spark, sf), "family")


@query("top3_holiday_types", "holidays", """
SELECT type, count(*) AS n FROM holidays GROUP BY type ORDER BY n DESC, type LIMIT 5""")
def top3(spark, sf):
    return profile.top_counts(views.holidays(spark, sf), "type", 5)


@query("top6_first_missing_dates", "oil_calendar", """
SELECT date FROM oil_calendar WHERE date NOT IN (SELECT date FROM oil) ORDER BY date LIMIT 5""")
def top6(spark, sf):
    return coverage.first_missing_dates(views.oil(spark, sf))


@query("set2_missing_dates", "oil_calendar", "SELECT date FROM oil_calendar WHERE date NOT IN (SELECT date FROM oil)")
def set2(spark, sf):
    return coverage.missing_dates(views.oil(spark, sf))


@query("set2_missing_dates_by_store", "sales_fact", """
, span AS (SELECT store_nbr, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d FROM sales_fact GROUP BY store_nbr)
SELECT store_nbr, CAST(d AS DATE) AS date FROM span EXCEPT SELECT store_nbr, date FROM sales_fact""")
def set2_store(spark, sf):
    return coverage.missing_dates(views.sales_fact(spark, sf), ["store_nbr"])


@query("set3_continuity", "dense_sales", """
SELECT store_nbr, count(DISTINCT date) = date_diff('day', min(date), max(date)) + 1 AS continuous
FROM dense_sales GROUP BY store_nbr""")
def set3(spark, sf):
    return coverage.is_continuous(views.dense_sales(spark, sf), ["store_nbr"])


@query("set4_distinct_keys", "sales_fact", "SELECT DISTINCT store_nbr, family FROM sales_fact")
def set4(spark, sf):
    return views.sales_fact(spark, sf).select("store_nbr", "family").distinct()


# ---- outliers ----

_SUMMARY = """SELECT count(*) FILTER (hit) AS total_outliers, round(count(*) FILTER (hit) * 100e0 / count(*), 6) AS outlier_percentage,
  round(avg(sales) FILTER (hit), 4) AS outlier_mean, round(stddev_samp(sales) FILTER (hit), 4) AS outlier_std FROM marked"""


def _round_summary(df):
    return rounded(rounded(df, 6, "outlier_percentage"), 4, "outlier_mean", "outlier_std")


@query("out1_zscore", "sales_fact", """
, s AS (SELECT avg(sales) AS m, stddev_pop(sales) AS d FROM sales_fact),
marked AS (SELECT sales, abs(sales - m) / d > 2 AS hit FROM sales_fact, s) """ + _SUMMARY)
def out1(spark, sf):
    return _round_summary(outliers.outliers(views.sales_fact(spark, sf), "sales", "zscore", 2.0))


@query("out2_iqr", "sales_fact", """
, s AS (SELECT quantile_cont(sales, 0.25) AS q1, quantile_cont(sales, 0.75) AS q3 FROM sales_fact),
marked AS (SELECT sales, sales < q1 - 1.5 * (q3 - q1) OR sales > q3 + 1.5 * (q3 - q1) AS hit FROM sales_fact, s) """ + _SUMMARY)
def out2(spark, sf):
    return _round_summary(outliers.outliers(views.sales_fact(spark, sf), "sales", "iqr"))


@query("out3_iqr_all_columns", "sales_fact", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers,
    round(count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) * 100e0 / count(*), 6) AS percentage
    FROM (SELECT CAST({c} AS DOUBLE) AS v FROM sales_fact), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
    quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM sales_fact)""" for c in ("store_nbr", "sales", "onpromotion")))
def out3(spark, sf):
    fact = views.sales_fact(spark, sf)
    return rounded(outliers.outlier_counts(fact, profile.numeric_columns(fact)), 6, "percentage")


# ---- autocorrelation and decomposition ----

def _daily(spark, sf):
    return clean.resample_daily(views.dense_sales(spark, sf), "sales", ["store_nbr"])


@query("win10_acf", "dense_daily", """
, centred AS (SELECT store_nbr, date, sales - avg(sales) OVER (PARTITION BY store_nbr) AS c FROM dense_daily),
lagged AS (SELECT store_nbr, c, """ + ", ".join(
    f"lag(c, {k}) OVER (PARTITION BY store_nbr ORDER BY date) AS l{k}" for k in range(41)) + " FROM centred) " + " UNION ALL ".join(
    f"SELECT store_nbr, {k} AS lag, {r(f'sum(c * l{k}) / sum(c * c)', 6)} AS acf FROM lagged GROUP BY store_nbr" for k in range(41)))
def win10(spark, sf):
    return rounded(decompose.acf(_daily(spark, sf), "sales", 40, ["store_nbr"]), 6, "acf")


def _decompose_sql(period):
    half = period // 2
    w = "PARTITION BY store_nbr ORDER BY date"
    if period % 2:
        trend = f"""CASE WHEN count(sales) OVER ({w} ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING) = {period}
          THEN avg(sales) OVER ({w} ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING) END"""
    else:
        trend = f"""CASE WHEN count(sales) OVER ({w} ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING) = {period + 1}
          THEN (sum(sales) OVER ({w} ROWS BETWEEN {half - 1} PRECEDING AND {half - 1} FOLLOWING)
            + (lag(sales, {half}) OVER ({w}) + lead(sales, {half}) OVER ({w})) / 2) / {period} END"""
    return f"""
, smoothed AS (SELECT store_nbr, date, sales, (row_number() OVER ({w}) - 1) % {period} AS phase, {trend} AS trend FROM dense_daily),
phases AS (SELECT store_nbr, phase, avg(sales - trend) AS m FROM smoothed GROUP BY store_nbr, phase),
parts AS (SELECT s.store_nbr, date, sales, trend, m - avg(m2) AS seasonal FROM smoothed s
  JOIN phases p ON s.store_nbr = p.store_nbr AND s.phase = p.phase
  JOIN (SELECT store_nbr AS k, avg(m) AS m2 FROM phases GROUP BY store_nbr) c ON c.k = s.store_nbr
  GROUP BY s.store_nbr, date, sales, trend, m)"""


@query("win11_decompose", "dense_daily", _decompose_sql(7) + f"""
SELECT store_nbr, date, sales, round(trend, 4) AS trend, {r('seasonal', 4)} AS seasonal,
       {r('sales - trend - seasonal', 4)} AS resid FROM parts""")
def win11(spark, sf):
    return rounded(decompose.decompose(_daily(spark, sf), "sales", 7, ["store_nbr"]), 4, "trend", "seasonal", "resid")


@query("win11_decompose_even", "dense_daily", _decompose_sql(30) + f"""
SELECT store_nbr, date, sales, round(trend, 4) AS trend, {r('seasonal', 4)} AS seasonal,
       {r('sales - trend - seasonal', 4)} AS resid FROM parts""")
def win11_even(spark, sf):
    return rounded(decompose.decompose(_daily(spark, sf), "sales", 30, ["store_nbr"]), 4, "trend", "seasonal", "resid")


@query("win11_decompose_extrapolated", "dense_daily", """
, smoothed AS (SELECT store_nbr, date, sales, row_number() OVER w AS i, count(*) OVER (PARTITION BY store_nbr) AS n,
  CASE WHEN count(sales) OVER f = 7 THEN avg(sales) OVER f END AS t FROM dense_daily
  WINDOW w AS (PARTITION BY store_nbr ORDER BY date),
         f AS (PARTITION BY store_nbr ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
ends AS (SELECT store_nbr AS k, regr_slope(t, i) FILTER (i BETWEEN 4 AND 10) AS s1,
  regr_intercept(t, i) FILTER (i BETWEEN 4 AND 10) AS c1, regr_slope(t, i) FILTER (i BETWEEN n - 9 AND n - 3) AS s2,
  regr_intercept(t, i) FILTER (i BETWEEN n - 9 AND n - 3) AS c2 FROM smoothed GROUP BY store_nbr)
SELECT store_nbr, date, sales, round(coalesce(t, CASE WHEN i <= 3 THEN c1 + s1 * i ELSE c2 + s2 * i END), 4) AS trend
FROM smoothed JOIN ends ON k = store_nbr""")
def win11_extrapolated(spark, sf):
    df = decompose.decompose(_daily(spark, sf), "sales", 7, ["store_nbr"], extrapolate=True)
    return rounded(df.select("store_nbr", "date", "sales", "trend"), 4, "trend")


@query("win12_strengths", "dense_daily", _decompose_sql(7) + """
SELECT store_nbr, round(var_pop(seasonal) / var_pop(seasonal + (sales - trend - seasonal)), 6) AS seasonal_strength,
  round(1 - var_pop(sales - trend - seasonal) / var_pop(trend + (sales - trend - seasonal)), 6) AS trend_strength
FROM parts GROUP BY store_nbr""")
def win12(spark, sf):
    parts = decompose.decompose(_daily(spark, sf), "sales", 7, ["store_nbr"])
    return rounded(decompose.strengths(parts, ["store_nbr"]), 6, "seasonal_strength", "trend_strength")


# ---- splits ----

_INDEXED = ", ix AS (SELECT *, row_number() OVER (ORDER BY date, store_nbr, family) - 1 AS i, count(*) OVER () AS n FROM sales_fact)"


@query("spl1_split_by_date", "sales_fact", _INDEXED + """,
cut AS (SELECT date AS d FROM ix WHERE i = floor(n * CAST(0.8 AS DOUBLE)))
SELECT date, store_nbr, family, CASE WHEN date < d THEN 'train' ELSE 'test' END AS part FROM sales_fact, cut""")
def spl1(spark, sf):
    train, test = splits.split_by_date(views.sales_fact(spark, sf), 0.2)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).select(*KEYS, "part")


@query("spl2_split_three", "sales_fact", _INDEXED + """
SELECT date, store_nbr, family, CASE WHEN i < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
  WHEN i < floor(n * CAST(0.85 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM ix""")
def spl2(spark, sf):
    return splits.label_split(views.sales_fact(spark, sf), KEYS, 0.15, 0.15).select(*KEYS, "split")


@query("spl1_split_no_test", "sales_fact", "SELECT 'train' AS part, count(*) AS n FROM sales_fact UNION ALL SELECT 'test', 0")
def spl1_none(spark, sf):
    train, test = splits.split_by_date(views.sales_fact(spark, sf), 0.0)
    return train.agg(F.lit("train").alias("part"), F.count("*").alias("n")).unionByName(
        test.agg(F.lit("test").alias("part"), F.count("*").alias("n")))


@query("spl2_split_no_validation", "sales_fact", _INDEXED + """
SELECT date, store_nbr, family, CASE WHEN i < floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM ix""")
def spl2_none(spark, sf):
    return splits.label_split(views.sales_fact(spark, sf), KEYS, 0.2, 0.0).select(*KEYS, "split")


@query("spl3_fewer_rows_than_folds", "dense_sales", """
, few AS (SELECT DISTINCT date_trunc('year', date)::DATE AS date FROM dense_sales)
SELECT date, 5 AS fold FROM few WHERE (SELECT count(*) FROM few) < 30
UNION ALL SELECT date, NULL FROM few WHERE (SELECT count(*) FROM few) >= 30""")
def spl3_few(spark, sf):
    """More folds than rows: blocks have no rows, so every row is a remainder row."""
    years = views.dense_sales(spark, sf).select(F.trunc("date", "year").alias("date")).distinct()
    return splits.kfold_blocked(years, 30, ["date"]).select("date", (F.col("fold") / 6).cast("int").alias("fold"))


@query("spl3_kfold_blocked", "sales_fact", _INDEXED + """
SELECT date, store_nbr, family, CAST(least(i // (n // 5), 5) AS INT) AS fold FROM ix""")
def spl3(spark, sf):
    return splits.kfold_blocked(views.sales_fact(spark, sf), 5, KEYS).select(*KEYS, "fold")


@query("set1_folds_around", "sales_fact", _INDEXED + """
SELECT date, store_nbr, family FROM ix WHERE i // (n // 5) <> 2""")
def set1(spark, sf):
    return splits.fold(splits.kfold_blocked(views.sales_fact(spark, sf), 5, KEYS), 2)[0].select(*KEYS)


@query("spl4_time_series_folds", "sales_fact", _INDEXED + """
SELECT date, store_nbr, family, CAST(greatest(0, (i - (n - 6 * (n // 6))) // (n // 6)) AS INT) AS block FROM ix""")
def spl4(spark, sf):
    return splits.time_series_folds(views.sales_fact(spark, sf), 5, KEYS).select(*KEYS, "block")


@query("spl5_rolling_origins", "dense_sales", """
, span AS (SELECT min(date) AS a, max(date) AS b FROM dense_sales)
SELECT CAST(b - CAST(7 + 7 * k AS INT) AS DATE) AS cutoff
FROM span, (SELECT unnest(generate_series(0, 1000)) AS k) WHERE b - CAST(7 + 7 * k AS INT) >= a + 30""")
def spl5_cutoffs(spark, sf):
    return splits.rolling_origins(views.dense_sales(spark, sf))
