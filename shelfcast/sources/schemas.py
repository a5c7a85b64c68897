"""Schemas of the input and derived tables."""

from pyspark.sql import types as T

SALES = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("store_nbr", T.IntegerType()),
    T.StructField("family", T.StringType()),
    T.StructField("sales", T.DoubleType()),
    T.StructField("onpromotion", T.IntegerType()),
])

FUTURE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("store_nbr", T.IntegerType()),
    T.StructField("family", T.StringType()),
    T.StructField("onpromotion", T.IntegerType()),
])

STORES = T.StructType([
    T.StructField("store_nbr", T.IntegerType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("cluster", T.IntegerType()),
])

OIL = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("dcoilwtico", T.DoubleType()),
])

HOLIDAYS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("type", T.StringType()),
    T.StructField("locale", T.StringType()),
    T.StructField("locale_name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("transferred", T.BooleanType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("store_nbr", T.IntegerType()),
    T.StructField("transactions", T.LongType()),
])

METRIC_LOG = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("metric_type", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("series", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

PREDICTIONS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("series", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("actual", T.DoubleType()),
])

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("experiment", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
])

RUN_PARAMS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("param", T.StringType()),
    T.StructField("value", T.StringType()),
])

RUN_METRICS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("split", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
])

MODEL_TABLE = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("series", T.StringType()),
    T.StructField("term", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

# Category lists of the holiday table.
HOLIDAY_TYPES = ["Holiday", "Event", "Additional", "Transfer", "Work Day", "Bridge"]
HOLIDAY_LOCALES = ["National", "Local", "Regional"]
