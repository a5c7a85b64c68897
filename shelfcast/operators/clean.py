"""Filters, validation and filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.expressions import percent


def filter_ids(df: DataFrame, col: str, ids) -> DataFrame:
    """Rows whose id is listed; a frame of ids becomes a semi join."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(col)), col, "left_semi")
    return df.where(F.col(col).isin(*ids))


def filter_dates(df: DataFrame, start=None, end=None, date: str = "date") -> DataFrame:
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(date) <= F.lit(end))
    return df


def validate_schema(df: DataFrame, required: list[str], date: str = "date", numeric: list[str] = ()) -> None:
    """Raise when a column is missing or has the wrong type; reads the schema only."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if not isinstance(df.schema[date].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{date} is not a date")
    wrong = [c for c in numeric if not isinstance(df.schema[c].dataType, T.NumericType)]
    if wrong:
        raise ValueError(f"not numeric: {wrong}")


def validate_values(df: DataFrame, required: list[str], target: str = "sales") -> DataFrame:
    """Null count of each required column and the number of negative targets, as ``(check, violations)``."""
    checks = {f"null_{c}": F.col(c).isNull() for c in required}
    checks[f"negative_{target}"] = F.col(target) < 0
    return count_checks(df, checks)


def validate_ranges(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Number of values outside their inclusive range; an open end is ``None``."""
    def outside(col, low, high):
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(col) < low)
        if high is not None:
            bad = bad | (F.col(col) > high)
        return bad
    return count_checks(df, {f"range_{c}": outside(c, lo, hi) for c, (lo, hi) in ranges.items()})


def count_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Every condition counted in one pass, one row each."""
    one = df.agg(*[F.count_if(cond).alias(name) for name, cond in checks.items()])
    return one.unpivot([], list(checks), "check", "violations")


# Default quality limits, and whether the value must stay above or below each.
QUALITY_LIMITS = [
    ("completeness_pct", 95.0, "min"),
    ("missing_pct", 5.0, "max"),
    ("duplicates_pct", 0.1, "max"),
    ("daily_sales_min", 1000.0, "min"),
    ("daily_sales_max", 1000000.0, "max"),
    ("transactions_min", 10.0, "min"),
    ("promotion_lift", 1.1, "min"),
    ("max_gap_days", 1.0, "max"),
]


def quality_measures(sales: DataFrame, transactions: DataFrame) -> DataFrame:
    """The measures the quality gate looks at, as ``(measure, value)``. The distinct rows with their number of
    copies are made once; all measures of the fact are sums over them."""
    columns = sales.columns
    distinct = sales.groupBy(*columns).agg(F.count("*").alias("_n"))

    def mean(rows):
        known = rows & F.col("sales").isNotNull()
        return F.try_divide(F.sum(F.when(known, F.col("sales") * F.col("_n"))), F.sum(F.when(known, F.col("_n"))))
    cells = F.sum(sum((F.col(c).isNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNull().cast("int")) * F.col("_n"))
    span = F.datediff(F.max("date"), F.min("date")) + 1
    grid = span.cast("double") * F.count_distinct("store_nbr") * F.count_distinct("family")
    over_fact = distinct.agg(
        percent(F.sum("_n"), grid).alias("completeness_pct"),
        percent(cells, F.sum("_n") * len(columns)).alias("missing_pct"),
        F.try_divide(mean(F.col("onpromotion") > 0), mean(F.col("onpromotion") == 0)).alias("promotion_lift"),
        percent(F.sum(F.col("_n") - 1), F.sum("_n")).alias("duplicates_pct"))
    daily = distinct.groupBy("date").agg(F.sum(F.col("sales") * F.col("_n")).alias("sales"))
    # one row per calendar date: a single window partition is small
    gap = F.datediff("date", F.lag("date").over(Window.partitionBy(F.lit(0)).orderBy("date")))
    over_days = daily.withColumn("gap", gap).agg(
        F.min("sales").alias("daily_sales_min"), F.max("sales").alias("daily_sales_max"),
        F.max("gap").cast("double").alias("max_gap_days"))
    tickets = transactions.agg(F.min("transactions").cast("double").alias("transactions_min"))

    def long(df):
        return df.unpivot([], df.columns, "measure", "value")
    return long(over_fact).unionByName(long(over_days)).unionByName(long(tickets))


def quality_gate(measures: DataFrame, limits=None) -> DataFrame:
    """Each measure against its limit; a measure that could not be computed fails."""
    spark = measures.sparkSession
    table = spark.createDataFrame(limits or QUALITY_LIMITS, "measure string, limit double, side string")
    ok = F.when(F.col("side") == "min", F.col("value") >= F.col("limit")).otherwise(F.col("value") <= F.col("limit"))
    return (
        measures.join(F.broadcast(table), "measure")
        .withColumn("passed", F.coalesce(ok, F.lit(False)))
    )


def fill_forward_backward(df: DataFrame, col: str, order: str = "date", keys: list[str] = (),
                          backward: bool = True) -> DataFrame:
    """Last known value, then the next known one. For frames at date grain: a group holds one row per
    date and key, so it is bounded by the calendar."""
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(order)
    filled = F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    if backward:
        following = F.first(col, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
        filled = F.coalesce(filled, following)
    return df.withColumn(col, filled)


def fill_const(df: DataFrame, cols: list[str], value) -> DataFrame:
    return df.na.fill(value, cols)


def fill_mean(df: DataFrame, col: str) -> DataFrame:
    mean = df.agg(F.avg(col).alias("mean")).scalar()
    return df.withColumn(col, F.coalesce(F.col(col).cast("double"), mean))


def beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """The columns of a one-row frame beside every row, as one scalar subquery."""
    names = one_row.columns
    value = one_row.select(F.struct(*names).alias("_beside")).scalar()
    return df.select("*", value.alias("_beside")).select(*df.columns, *[F.col("_beside").getField(n).alias(n) for n in names])


def attach_stats(df: DataFrame, keys: list[str], **stats: Column) -> DataFrame:
    """Group statistics beside every row.

    Aggregates first (partial sums before the shuffle) and joins the one row per group back, so a hot
    group is never gathered into one task as a window over it would be.
    """
    if not keys:
        return beside(df, df.agg(*[c.alias(n) for n, c in stats.items()]))
    return df.join(df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()]), keys, "left")


def fill_group_mean(df: DataFrame, col: str, keys: list[str]) -> DataFrame:
    filled = attach_stats(df, keys, _mean=F.avg(col))
    return filled.withColumn(col, F.coalesce(F.col(col).cast("double"), "_mean")).drop("_mean")


def fill_calendar(df: DataFrame, col: str, keys: list[str] = (), date: str = "date", backward: bool = True) -> DataFrame:
    """One row for every day between the first and the last date (of each key), the column filled.

    Each row repeats itself up to the day before its successor, so no calendar is joined. Repeated dates of a key
    are averaged first.
    """
    keys = list(keys)
    once = df.where(F.col(date).isNotNull()).groupBy(*keys, date).agg(F.avg(col).alias(col))
    filled = fill_forward_backward(once, col, date, keys, backward)
    following = F.lead(date).over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy(date))
    until = F.coalesce(F.date_sub(following, 1), F.col(date))
    return filled.withColumn("_until", until).select(*keys, F.explode(F.sequence(date, "_until")).alias(date), col)


def resample_daily(df: DataFrame, value: str, keys: list[str] = (), date: str = "date") -> DataFrame:
    """Daily mean over the full date range of each key, absent days carried forward."""
    return fill_calendar(df, value, keys, date, backward=False)
