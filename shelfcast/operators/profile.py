"""Profiles and statistics of the input tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.expressions import jarque_bera, normal_quantile, percent, weekday_monday0
from .clean import beside
from .encode import one_hot
from .ordered import exact_quantiles, quantile_columns


def long_row(df: DataFrame, section: str) -> DataFrame:
    """The columns of a one-row frame as ``(section, metric, key, value)`` rows."""
    names = df.columns
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    return wide.unpivot([], names, "metric", "value").select(
        F.lit(section).alias("section"), "metric", F.lit("").alias("key"), "value")


def long_counts(df: DataFrame, section: str, metric: str, key: str, value: str) -> DataFrame:
    return df.select(F.lit(section).alias("section"), F.lit(metric).alias("metric"),
                     F.col(key).cast("string").alias("key"), F.col(value).cast("double").alias("value"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# ---- tables of the sales domain ----

def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows: count and share."""
    sizes = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
                     percent(F.sum(F.col("n") - 1), F.sum("n")).alias("percentage"))


def sales_profile(sales: DataFrame) -> DataFrame:
    """One row of structure, statistics and quality measures."""
    daily = sales.groupBy("date").agg(F.sum("sales").alias("total"))
    over_rows = sales.agg(
        F.count("*").alias("records"),
        F.count_distinct("store_nbr").alias("unique_stores"),
        F.count_distinct("family").alias("product_families"),
        F.sum("sales").alias("total_sales"),
        F.min("sales").alias("min_sales"),
        F.max("sales").alias("max_sales"),
        (F.avg((F.col("onpromotion") > 0).cast("double")) * 100).alias("promotion_freq"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in sales.columns],
        F.count_if(F.col("sales") == 0).alias("zero_sales"),
        F.count_if(F.col("sales") < 0).alias("negative_sales"),
    )
    mean_daily = daily.agg(F.avg("total").alias("v")).scalar()
    copies = duplicate_rows(sales).select("duplicates").scalar()
    return over_rows.withColumns({"avg_daily_sales": mean_daily, "duplicates": copies})


def describe(df: DataFrame, col: str, keys: list[str] = (), quantiles: str = "exact") -> DataFrame:
    """count, mean, std, min, quartiles and max, per key.

    ``exact`` spreads each key's values over tasks; ``grouped`` keeps a key's distinct values in one
    aggregation buffer and suits keys with few rows; ``approx`` is bounded in memory but not exact.
    """
    keys, parts = list(keys), {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    basic = [F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
             F.min(col).cast("double").alias("min"), F.max(col).cast("double").alias("max")]
    if quantiles != "exact":
        fn = {"grouped": F.percentile, "approx": F.percentile_approx}[quantiles]
        return df.groupBy(*keys).agg(*basic, *[fn(col, p).cast("double").alias(n) for n, p in parts.items()])
    summary, cuts = df.groupBy(*keys).agg(*basic), quantile_columns(df, col, parts, keys)
    if keys:
        return summary.join(cuts, keys, "left")
    return beside(summary, cuts)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def top_counts(df: DataFrame, col: str, n: int = 5) -> DataFrame:
    """The most frequent values, ties by value."""
    return value_counts(df.where(F.col(col).isNotNull()), col).orderBy(F.desc("n"), F.asc(col)).limit(n)


def describe_long(df: DataFrame, col: str, section: str, metric: str) -> DataFrame:
    """``describe`` of a small grouped frame as long rows keyed by statistic."""
    one = describe(df, col, quantiles="grouped")
    names = one.columns
    return one.select(*[F.col(c).cast("double").alias(c) for c in names]).unpivot([], names, "key", "value").select(
        F.lit(section).alias("section"), F.lit(metric).alias("metric"), "key", "value")


def store_profile(stores: DataFrame) -> DataFrame:
    counts = stores.agg(F.count("*").alias("total_stores"), F.count_distinct("city").alias("cities"),
                        F.count_distinct("state").alias("states"), F.count_distinct("type").alias("types"))
    cities = stores.groupBy("state").agg(F.count_distinct("city").alias("n"))
    per_city = stores.groupBy("city").agg(F.count("store_nbr").alias("n"))
    return (
        long_row(counts, "structure")
        .unionByName(long_counts(value_counts(stores, "type"), "distribution", "store_types", "type", "n"))
        .unionByName(long_counts(value_counts(stores, "cluster"), "distribution", "clusters", "cluster", "n"))
        .unionByName(describe_long(cities, "n", "geographic", "cities_per_state"))
        .unionByName(describe_long(per_city, "n", "geographic", "stores_per_city"))
    )


def oil_profile(oil: DataFrame, col: str = "dcoilwtico") -> DataFrame:
    """One row; the table has one row per date."""
    from .windows import time_gaps
    one = oil.agg(
        F.count("*").alias("records"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.min(col).alias("min_price"), F.max(col).alias("max_price"), F.avg(col).alias("avg_price"),
        F.stddev_samp(col).alias("volatility"), F.count_if(F.col(col).isNull()).alias("missing_values"))
    return one.withColumn("gaps", time_gaps(oil.select("date").distinct()).scalar())


def holiday_profile(holidays: DataFrame) -> DataFrame:
    counts = holidays.agg(F.count("*").alias("records"), F.count_if("transferred").alias("transferred"),
                          F.datediff(F.max("date"), F.min("date")).alias("span_days"))
    monthly = holidays.groupBy(F.month("date").alias("month")).agg(F.count("*").alias("n"))
    return (
        long_row(counts, "structure")
        .unionByName(long_counts(value_counts(holidays, "type"), "distribution", "types", "type", "n"))
        .unionByName(long_counts(value_counts(holidays, "locale"), "distribution", "locale", "locale", "n"))
        .unionByName(long_counts(monthly, "temporal", "monthly_density", "month", "n"))
        .unionByName(long_counts(top_counts(holidays, "type", 5), "temporal", "top_types", "type", "n"))
    )


def transaction_profile(transactions: DataFrame, col: str = "transactions") -> DataFrame:
    counts = transactions.agg(F.count("*").alias("records"), F.sum(col).alias("total_transactions"))
    daily = transactions.groupBy("date").agg(F.sum(col).alias("total"))
    mean_daily = daily.agg(F.avg("total").alias("avg_daily"))
    weekly = transactions.groupBy(weekday_monday0("date").alias("day")).agg(F.avg(col).alias("mean"))
    monthly = transactions.groupBy(F.month("date").alias("month")).agg(F.avg(col).alias("mean"))
    return (
        long_row(counts, "structure").unionByName(long_row(mean_daily, "statistics"))
        .unionByName(long_counts(weekly, "patterns", "weekly", "day", "mean"))
        .unionByName(long_counts(monthly, "patterns", "monthly", "month", "mean"))
    )


def business_metrics(sales: DataFrame, stores: DataFrame) -> DataFrame:
    daily = sales.groupBy("date").agg(F.sum("sales").alias("total"))
    totals = sales.agg(F.sum("sales").alias("total_sales"), F.count_distinct("family").alias("total_families"),
                       F.sum("onpromotion").alias("promo_items"))
    families = sales.groupBy("family").agg(F.sum("sales").alias("total"))
    effect = sales.groupBy("onpromotion").agg(F.avg("sales").alias("mean"))
    return (
        long_row(totals, "sales")
        .unionByName(long_row(daily.agg(F.avg("total").alias("avg_daily_sales")), "sales"))
        .unionByName(long_row(stores.agg(F.count("*").alias("total_stores")), "stores"))
        .unionByName(long_counts(value_counts(stores, "type"), "stores", "stores_by_type", "type", "n"))
        .unionByName(long_counts(families, "products", "sales_by_family", "family", "total"))
        .unionByName(long_counts(effect, "promotions", "promo_effect", "onpromotion", "mean"))
    )


# ---- general profiles ----

def grouped_totals(df: DataFrame, sets: list[list[str]], value: str) -> DataFrame:
    """Sum and count over several groupings in one pass; absent keys are NULL."""
    keys = sorted({k for s in sets for k in s}, key=[c for s in sets for c in s].index)
    grouped = df.groupingSets([[F.col(k) for k in s] for s in sets], *keys)
    return grouped.agg(F.sum(value).alias("total"), F.count("*").alias("n"), F.grouping_id().alias("level"))


def seasonality(df: DataFrame, value: str, date: str = "date") -> DataFrame:
    """Mean by month, weekday and year, and by hour when the dates carry hours, as ``(pattern, period, mean)``."""
    parts = {"monthly": F.month(date), "daily": weekday_monday0(date), "yearly_trend": F.year(date)}
    timed = dict((f.name, f.dataType) for f in df.schema.fields)[date].typeName() != "date"
    if timed:
        parts["hourly"] = F.hour(date)
    names = list(parts)
    wide = df.select(F.col(value).alias("_y"), *[e.cast("int").alias(n) for n, e in parts.items()])
    grouped = wide.groupingSets([[F.col(n)] for n in names], *names).agg(
        F.avg("_y").alias("mean"), F.grouping_id().alias("_g"))
    # the grouping id has one bit per column, first column highest, 0 where the column is grouped
    full = (1 << len(names)) - 1
    pattern = F.lit(None).cast("string")
    for i, n in enumerate(names):
        pattern = F.when(F.col("_g") == full - (1 << (len(names) - 1 - i)), n).otherwise(pattern)
    out = grouped.select(pattern.alias("pattern"), F.coalesce(*names).alias("period"), "mean")
    if not timed:
        return out
    hours = df.agg(F.count_distinct(F.hour(date)).alias("n")).scalar()
    return out.where((F.col("pattern") != "hourly") | (hours > 1))


def column_profile(df: DataFrame, max_values: int = 10, top: int = 5) -> tuple[DataFrame, DataFrame]:
    """(per column: type, distinct, nulls, and min/max/mean of numbers; the top values of text columns
    with few distinct values)."""
    numeric, kinds = set(numeric_columns(df)), {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = df.columns
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    counts = texts.groupBy("column", "value").agg(F.count("*").alias("n"))
    missing = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    summary = counts.groupBy("column").agg(
        F.count("value").alias("unique_values"), missing.alias("missing"), percent(missing, F.sum("n")).alias("missing_pct"))
    numbers = [c for c in cols if c in numeric]
    if numbers:
        long = df.select(*[F.col(c).cast("double").alias(c) for c in numbers]).unpivot([], numbers, "column", "value")
        ranges = long.groupBy("column").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"))
        summary = summary.join(F.broadcast(ranges), "column", "left")
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair]), F.col("column"))
    few = summary.where(~F.col("column").isin(*numeric) & (F.col("unique_values") < max_values)).select("column")
    # fewer than ``max_values`` rows per column are ranked
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    kept = counts.where(F.col("value").isNotNull()).join(F.broadcast(few), "column", "left_semi")
    ranked = kept.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return summary.withColumn("type", kind), ranked


def type_advice(df: DataFrame) -> DataFrame:
    """Columns that could be stored smaller, as ``(column, advice)``: whole-number doubles and repetitive text."""
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    whole = [F.bool_and(F.coalesce(F.col(c) == F.round(c), F.lit(False))).alias(c) for c in doubles]
    ratio = [F.coalesce(F.try_divide(F.count_distinct(c), F.count("*")) < 0.5, F.lit(False)).alias(c) for c in texts]
    if not whole + ratio:
        raise ValueError("no double or string column")
    one = df.agg(*whole, *ratio).unpivot([], doubles + texts, "column", "holds")
    advice = F.when(F.col("column").isin(*doubles), "integer").otherwise("categorical") if doubles else F.lit("categorical")
    return one.where("holds").select("column", advice.alias("advice"))


def time_range(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(F.min(date).alias("start_date"), F.max(date).alias("end_date"),
                  F.datediff(F.max(date), F.min(date)).alias("total_days"))


def grid_completeness(sales: DataFrame) -> DataFrame:
    """Rows against days × stores × families."""
    days = (F.datediff(F.max("date"), F.min("date")) + 1).cast("bigint")
    one = sales.agg(F.count("*").alias("actual_records"), days.alias("days"),
                    F.count_distinct("store_nbr").alias("stores"), F.count_distinct("family").alias("families"))
    expected = F.col("days") * F.col("stores") * F.col("families")
    return one.select("actual_records", expected.alias("expected_records"),
                      percent(F.col("actual_records"), expected).alias("completeness"))


def daily_completeness(sales: DataFrame, stores: DataFrame) -> DataFrame:
    expected = stores.agg(F.count("*").alias("n")).scalar() * \
        sales.agg(F.count_distinct("family").alias("n")).scalar()
    daily = sales.groupBy("date").agg(F.count("*").alias("n"))
    return daily.withColumn("completeness", percent(F.col("n"), expected))


def per_column(df: DataFrame, cols: list[str], aggregate, name: str) -> DataFrame:
    """The same aggregate of every column in one pass, as ``(column, <name>)``."""
    return df.agg(*[aggregate(F.col(c)).alias(c) for c in cols]).unpivot([], cols, "column", name)


def missing_by_column(df: DataFrame, only_missing: bool = False) -> DataFrame:
    out = per_column(df, df.columns, lambda c: F.count_if(c.isNull()), "missing")
    return out.where(F.col("missing") > 0) if only_missing else out


def negatives_by_column(df: DataFrame) -> DataFrame:
    return per_column(df, numeric_columns(df), lambda c: F.count_if(c < 0), "negatives")


def distribution_stats(df: DataFrame, col: str) -> DataFrame:
    """Mean, median, deviation, skewness, excess kurtosis and interquartile range, one row."""
    moments = df.agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                     F.skewness(col).alias("skewness"), F.kurtosis(col).alias("kurtosis"))
    cuts = quantile_columns(df, col, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    return beside(moments, cuts.select(F.col("q2").alias("median"), (F.col("q3") - F.col("q1")).alias("iqr")))


def normality_test(df: DataFrame, col: str, alpha: float = 0.05) -> DataFrame:
    """Jarque–Bera statistic and p-value over all rows."""
    one = df.agg(F.count(col).alias("n"), F.skewness(col).alias("s"), F.kurtosis(col).alias("k"))
    scored = one.select("n", jarque_bera(F.col("n").cast("double"), F.col("s"), F.col("k")).alias("statistic"))
    return scored.withColumn("p_value", F.exp(-F.col("statistic") / 2)) \
        .withColumn("is_normal", F.col("p_value") >= alpha)


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width counts over the column's range, as ``(bin, n)``; the last bin takes the maximum."""
    span = df.agg(F.min(col).cast("double").alias("low"), F.max(col).cast("double").alias("high"))
    ranged = beside(df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("_v")), span)
    slot = F.when(F.col("low") == F.col("high"), 1).otherwise(
        F.least(F.expr(f"width_bucket(_v, low, high, {int(bins)})"), F.lit(bins)))
    return ranged.groupBy(slot.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def qq_points(df: DataFrame, col: str, points: int = 99) -> DataFrame:
    """Sample quantiles beside those of the standard normal."""
    probs = [i / (points + 1) for i in range(1, points + 1)]
    theory = df.sparkSession.createDataFrame([(p, normal_quantile(p)) for p in probs], "prob double, theoretical double")
    return exact_quantiles(df, col, probs).join(F.broadcast(theory), "prob").withColumnRenamed("quantile", "sample")


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every pair once per direction, as ``(a, b, correlation)``, all in one pass over the rows."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{i}").alias("correlation"))
                     for i, (a, b) in enumerate(pairs)])
    half = one.select(F.inline(rows))
    mirrored = half.select(F.col("b").alias("a"), F.col("a").alias("b"), "correlation")
    return half.unionByName(mirrored)


def _rank_features(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.desc_nulls_last("importance"), F.asc("feature"))


def feature_importance(df: DataFrame, target: str, features: list[str], categories: dict[str, list] | None = None,
                       method: str = "correlation", bins: int = 10) -> DataFrame:
    """Features by strength of their relation with the target, strongest first."""
    categories = categories or {}
    names = list(features)
    for col, values in categories.items():
        before = set(df.columns)
        df = one_hot(df, col, values)
        names += [c for c in df.columns if c not in before]
    if method == "correlation":
        return _rank_features(per_column(
            df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys([*names, target])]).withColumnRenamed(target, "_y"),
            names, lambda c: F.abs(F.corr(c, F.col("_y"))), "importance").withColumnRenamed("column", "feature"))
    if method == "mutual_info":
        return _rank_features(mutual_information(df, target, names, bins))
    raise ValueError(f"unknown method {method!r}")


def mutual_information(df: DataFrame, target: str, features: list[str], bins: int = 10) -> DataFrame:
    """Mutual information (nats) of equal-frequency bins of each feature and the target.

    The table shrinks to counts per (feature, feature bin, target bin) before anything else is joined.
    """
    probs = [i / bins for i in range(1, bins)]
    cols = [*features, target]
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).na.drop()
    long = numbers.unpivot([], cols, "column", "value")
    cuts = exact_quantiles(long, "value", probs, ["column"])
    edges = cuts.groupBy("column").agg(F.array_sort(F.collect_list("quantile")).alias("edges"))
    lookup = edges.agg(F.map_from_entries(F.collect_list(F.struct("column", "edges"))).alias("m")).scalar()

    def slot(c: str) -> Column:
        below = [F.when(F.get(f"_{c}", F.lit(i)) < F.col(c), 1).otherwise(0) for i in range(bins - 1)]
        return sum(below[1:], below[0])

    edged = numbers.withColumn("_edges", lookup)
    edged = edged.select(*cols, *[F.element_at("_edges", F.lit(c)).alias(f"_{c}") for c in cols])
    binned = edged.select(*[slot(c).alias(c) for c in features], slot(target).alias("_y"))
    long_bins = binned.unpivot(["_y"], features, "feature", "_x")
    joint = long_bins.groupBy("feature", "_x", "_y").agg(F.count("*").alias("n"))
    # at most bins × bins cells per feature from here on
    by_x = F.sum("n").over(Window.partitionBy("feature", "_x"))
    by_y = F.sum("n").over(Window.partitionBy("feature", "_y"))
    total = F.sum("n").over(Window.partitionBy("feature"))
    terms = joint.select("feature", (F.col("n") / total * F.log(F.col("n") * total / (by_x * by_y))).alias("t"))
    return terms.groupBy("feature").agg(F.greatest(F.sum("t"), F.lit(0.0)).alias("importance"))


def lift(df: DataFrame, flag: Column, value: str = "sales", keys: list[str] = ()) -> DataFrame:
    """Percent by which the mean with the flag exceeds the mean without it."""
    ratio = F.try_divide(F.avg(F.when(flag, F.col(value))), F.avg(F.when(~flag, F.col(value))))
    return df.groupBy(*keys).agg(((ratio - 1) * 100).alias("lift"))


def sales_per_transaction(sales: DataFrame, transactions: DataFrame) -> DataFrame:
    """Lowest, highest and mean daily sales per ticket of each store."""
    daily = sales.groupBy("date", "store_nbr").agg(F.sum("sales").alias("sales"))
    ratio = F.try_divide(F.col("sales"), F.col("transactions"))
    return daily.join(transactions, ["date", "store_nbr"]).withColumn("r", ratio).groupBy("store_nbr").agg(
        F.min("r").alias("min"), F.max("r").alias("max"), F.avg("r").alias("avg"))


def location_rollup(sales_with_stores: DataFrame) -> DataFrame:
    """Totals by state, city and store with subtotals."""
    return sales_with_stores.rollup("state", "city", "store_nbr").agg(
        F.sum("sales").alias("total"), F.count("*").alias("n"), F.grouping_id().alias("level"))


def pivot_series(df: DataFrame, ids: list, date: str = "date", key: str = "store_nbr", value: str = "sales") -> DataFrame:
    """One row per date and one column per listed series; a repeated (date, series) is an error."""
    unique = df.groupBy(date, key).agg(
        F.when(F.count("*") > 1, F.raise_error(F.lit("more than one value per date and series")).cast("double"))
        .otherwise(F.first(value)).alias(value))
    return unique.groupBy(date).pivot(key, ids).agg(F.first(value))


def top_groups(df: DataFrame, key: str, value: str = "sales", n: int = 10) -> DataFrame:
    """Groups with the largest totals, ties by key."""
    return df.groupBy(key).agg(F.sum(value).alias("total")).orderBy(F.desc("total"), F.asc(key)).limit(n)
