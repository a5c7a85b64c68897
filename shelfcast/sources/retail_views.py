"""The retail tables derived from the star-schema test tables.

Amounts are floored to whole units per line, so every sum is exact and does not depend on the order
of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import dealt, spread
from .bundle import SalesBundle

# How the test tables' codes stand for holiday types and locales.
TYPE_OF_PRIORITY = {
    "1-URGENT": "Holiday",
    "2-HIGH": "Event",
    "3-MEDIUM": "Additional",
    "4-NOT SPECIFIED": "Transfer",
}
STATES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
# Parts beyond which both sides of the join are dealt by part, since Spark would not broadcast so many.
BROADCAST_ROWS = 4_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sale_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").alias("store_nbr"),
        F.col("l_partkey").alias("part"),
        F.col("l_orderkey").alias("ticket"),
        F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
        (F.col("l_discount") >= 0.05).cast("int").alias("promoted"),
    )


def sales_fact(spark: SparkSession, folder: str) -> DataFrame:
    """One row per date, store and family. Nearly every line is a row of its own, so lines are dealt at once, by date and
    store: what is counted and joined by these needs no further shuffle."""
    families = table(spark, folder, "part").select(F.col("p_partkey").alias("part"), F.col("p_type").alias("family"))
    lines = sale_lines(spark, folder)
    n = lines.count()
    if families.count() > BROADCAST_ROWS:
        families, lines = spread(families, n, "part"), spread(lines, n, "part")
    return (
        dealt(lines.join(families, "part").drop("part", "ticket"), n, "date", "store_nbr")
        .groupBy("date", "store_nbr", "family")
        .agg(F.sum("amount").cast("double").alias("sales"), F.sum("promoted").alias("onpromotion"))
    )


def stores(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    bands = F.when(F.col("s_acctbal") < 1000, "A").when(F.col("s_acctbal") < 3000, "B") \
        .when(F.col("s_acctbal") < 5000, "C").when(F.col("s_acctbal") < 8000, "D").otherwise("E")
    return (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("store_nbr"), F.col("n_name").alias("city"), F.col("r_name").alias("state"),
                bands.alias("type"), (F.col("s_suppkey") % 17).alias("cluster"))
    )


def dense_sales(spark: SparkSession, folder: str) -> DataFrame:
    """One row per date and region: few long series with hardly a missing day. Lines are added by region at once, without sums by store."""
    places = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(F.col("s_suppkey").alias("store_nbr"), F.col("n_regionkey").cast("long").alias("region"))
    return (
        sale_lines(spark, folder).join(places, "store_nbr")
        .groupBy("date", F.col("region").alias("store_nbr"))
        .agg(F.sum("amount").cast("double").alias("sales"), F.sum("promoted").alias("onpromotion"))
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Tickets per date and store; some rows are absent and some values unknown, by rule."""
    day = F.dayofmonth("date")
    lines = sale_lines(spark, folder).select("date", "store_nbr", "ticket")
    counted = (
        dealt(lines.where(~((F.col("store_nbr") % 7 == 0) & (day == 13))), lines.count(), "date", "store_nbr")
        .distinct()
        .groupBy("date", "store_nbr").agg(F.count("*").alias("n"))
    )
    unknown = (F.col("store_nbr") % 5 == 0) & (day == 21)
    return counted.select("date", "store_nbr", F.when(~unknown, F.col("n")).alias("transactions"))


def oil(spark: SparkSession, folder: str) -> DataFrame:
    """One price per order date, to the cent, unknown on days 3, 13 and 23."""
    daily = table(spark, folder, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.sum(F.floor("o_totalprice")).alias("total"), F.count("*").alias("n"))
    price = F.floor(F.col("total") / F.col("n") / 10) / 100
    return daily.select("date", F.when(F.dayofmonth("date") % 10 != 3, price).alias("dcoilwtico"))


def holidays(spark: SparkSession, folder: str) -> DataFrame:
    """Holiday rows on days 1 and 15, several per date."""
    customer = F.col("o_custkey")
    kind = F.when(customer % 2 == 0, "Work Day").otherwise("Bridge")
    for code, name in TYPE_OF_PRIORITY.items():
        kind = F.when(F.col("o_orderpriority") == code, name).otherwise(kind)
    state = F.element_at(F.array(*[F.lit(s) for s in STATES]), (customer % 5 + 1).cast("int"))
    status = F.col("o_orderstatus")
    return (
        table(spark, folder, "orders")
        .where(F.dayofmonth("o_orderdate").isin(1, 15))
        .select(
            F.col("o_orderdate").cast("date").alias("date"),
            kind.alias("type"),
            F.when(status == "F", "National").when(status == "O", "Local").otherwise("Regional").alias("locale"),
            F.when(status == "F", "Ecuador")
             .when(status == "O", F.concat(F.lit("NATION_"), (customer % 25).cast("string")))
             .otherwise(state).alias("locale_name"),
            ((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 4 == 0)).alias("transferred"),
        )
        .distinct()
        .withColumn("description", F.concat_ws(" ", "type", "locale_name"))
        .select("date", "type", "locale", "locale_name", "description", "transferred")
    )


def bundle(spark: SparkSession, folder: str) -> SalesBundle:
    return SalesBundle(
        sales=sales_fact(spark, folder),
        stores=stores(spark, folder),
        oil=oil(spark, folder),
        holidays=holidays(spark, folder),
        transactions=transactions(spark, folder),
    )


def prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    """Logged predictions with their truth: the event value against the event's ``k``."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("row_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("ts").cast("date").alias("date"),
        F.col("event_type").alias("model"),
        F.col("user_id").cast("string").alias("run_id"),
        F.col("value").alias("prediction"),
        F.get_json_object("props", "$.k").cast("double").alias("actual"),
    )


# Metric that each event type stands for.
METRIC_OF_EVENT = {"click": "rmse", "view": "mae", "purchase": "mape", "signup": "cpu", "error": "drift_p"}


def metric_log(spark: SparkSession, folder: str) -> DataFrame:
    """Long metric rows with a timestamp."""
    metric = F.lit(None).cast("string")
    for event, name in METRIC_OF_EVENT.items():
        metric = F.when(F.col("event_type") == event, name).otherwise(metric)
    model = F.element_at(F.array(F.lit("arima"), F.lit("prophet"), F.lit("lstm")),
                         (F.col("user_id") % 3 + 1).cast("int"))
    system = F.col("event_type") == "signup"
    return table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(system, "system_metrics").otherwise("performance_metrics").alias("metric_type"),
        model.alias("model"),
        F.col("user_id").cast("string").alias("series"),
        metric.alias("metric"),
        F.col("value"),
    )
