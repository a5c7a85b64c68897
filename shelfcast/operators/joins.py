"""Joining the sales fact to its exogenous tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize
from ..sources.bundle import SalesBundle
from .calendar import calendar_features, collapse_holidays, holiday_flags
from .clean import beside, fill_calendar, fill_mean

# Days of the rolling mean of the transactions.
ROLLING_DAYS = 7


def daily_prices(oil: DataFrame, col: str = "dcoilwtico") -> DataFrame:
    """One filled price for each day of the table's span."""
    return fill_calendar(oil, col)


def join_oil(sales: DataFrame, oil: DataFrame, col: str = "dcoilwtico") -> DataFrame:
    """Price of the day, else the last one before it, else the first one after it.

    A sales date outside the price table's span takes the nearest end. The right side has one row per
    calendar day, whatever the size of the fact.
    """
    span = oil.agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    nearest = F.least(F.greatest("date", "_first"), F.col("_last"))
    prices = daily_prices(oil, col).withColumnRenamed("date", "_price_date")
    dated = beside(sales, span).select(*sales.columns, nearest.alias("_price_date"))
    return dated.join(F.broadcast(prices), "_price_date", "left").drop("_price_date")


def join_holidays(sales: DataFrame, holidays: DataFrame, mode: str = "collapse") -> DataFrame:
    """0/1 columns per holiday type and locale. ``fanout`` keeps one output row per holiday row of the date."""
    if mode == "collapse":
        flags = collapse_holidays(holidays)
        joined = sales.join(F.broadcast(flags), "date", "left")
    elif mode == "fanout":
        flags = holiday_flags(holidays).drop("type", "locale", "locale_name", "description", "transferred")
        joined = sales.join(flags, "date", "left")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return joined.na.fill(0, [c for c in flags.columns if c != "date"])


def process_transactions(transactions: DataFrame, window: int = ROLLING_DAYS) -> DataFrame:
    """Unknown counts become the global mean; the rolling mean of each store's last days is added."""
    filled = fill_mean(transactions, "transactions")
    w = Window.partitionBy("store_nbr").orderBy("date").rowsBetween(-(window - 1), 0)
    return filled.withColumn("transactions_rolling_mean", F.avg("transactions").over(w))


def join_transactions(sales: DataFrame, transactions: DataFrame) -> DataFrame:
    return sales.join(transactions, ["date", "store_nbr"], "left")


def filled_transactions(sales: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row per date and store of the sales with the finished transaction columns.

    Where a day has no count it takes the store's mean over its sales rows, which is the mean over days weighted
    by their number of sales rows; the rolling mean falls back on the count. All of this happens at the small
    date and store grain, where a store is bounded by the calendar: the counts are stored once, days and counts meet once,
    and both windows share one shuffle by store.
    """
    counts = materialize(transactions.select("date", "store_nbr", "transactions"))
    days = sales.groupBy("date", "store_nbr").agg(F.count("*").alias("_rows"))
    known = days.join(fill_mean(counts, "transactions").withColumn("_counted", F.lit(True)), ["date", "store_nbr"], "full")
    store = Window.partitionBy("store_nbr")
    weight = F.when(F.col("transactions").isNotNull(), F.col("_rows"))
    known = known.withColumn(
        "_mean", F.sum(F.col("transactions") * F.col("_rows")).over(store) / F.sum(weight).over(store))
    # the rolling mean looks at days with a row in the table only
    w = Window.partitionBy("store_nbr", "_counted").orderBy("date").rowsBetween(-(ROLLING_DAYS - 1), 0)
    rolled = known.withColumn("_rolling", F.when(F.col("_counted"), F.avg("transactions").over(w)))
    count = F.coalesce("transactions", "_mean")
    return rolled.where(F.col("_rows").isNotNull()).select(
        "date", "store_nbr", count.alias("transactions"), F.coalesce("_rolling", count).alias("transactions_rolling_mean"))


def join_stores(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Spark broadcasts the stores while their size in bytes allows it; beyond that both sides are shuffled and
    adaptive execution splits hot keys."""
    return sales.join(stores, "store_nbr", "left")


def sales_with_transactions(tables: SalesBundle) -> DataFrame:
    """The sales with the finished transaction columns of their date and store, and nothing that the date alone decides."""
    return join_transactions(tables.sales, filled_transactions(tables.sales, tables.transactions))


def beside_dates(df: DataFrame, tables: SalesBundle, holiday_mode: str = "collapse") -> DataFrame:
    """Calendar, oil and holidays behind the sales' own columns. They follow from the date without a shuffle, so they are
    added when the shuffles are done."""
    wide = join_holidays(join_oil(calendar_features(df), tables.oil), tables.holidays, holiday_mode)
    own = [c for c in df.columns if c in tables.sales.columns]
    dated = [c for c in wide.columns if c not in df.columns]
    return wide.select(*own, *dated, *[c for c in df.columns if c not in own])


def build_fact(tables: SalesBundle, holiday_mode: str = "collapse") -> DataFrame:
    """The prepared fact: calendar, oil, holidays and transactions beside every sale."""
    return beside_dates(sales_with_transactions(tables), tables, holiday_mode)


def daily_sales_with_oil(sales: DataFrame, oil: DataFrame) -> DataFrame:
    """Daily totals first, then the raw price of the day (unknown stays unknown)."""
    daily = sales.groupBy("date").agg(F.sum("sales").alias("sales"))
    return daily.join(oil, "date", "left")


def predictions_with_actuals(predictions: DataFrame, actuals: DataFrame, keys: list[str]) -> DataFrame:
    return predictions.join(actuals, keys, "inner")
