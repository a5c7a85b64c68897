"""Watching predictions, thresholds, freshness and retraining."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields

from pyspark.sql import DataFrame, SparkSession, functions as F

from .evaluate import METRICS, error_metrics
from .outliers import outlier_rows


@dataclass(frozen=True)
class Thresholds:
    """Default alert limits."""

    rmse: float = 1.0
    mape: float = 10.0
    drift_p: float = 0.05
    cpu: float = 90.0
    memory: float = 90.0
    disk: float = 90.0

    @classmethod
    def from_dict(cls, values: dict) -> "Thresholds":
        unknown = set(values) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown thresholds: {sorted(unknown)}")
        return cls(**values)


# Metrics that alert when they fall below their limit.
ALERT_BELOW = {"drift_p"}


def threshold_table(spark: SparkSession, thresholds: Thresholds | dict[str, float]) -> DataFrame:
    """A handful of rows ``(metric, threshold, direction)``."""
    values = asdict(thresholds) if isinstance(thresholds, Thresholds) else thresholds
    rows = [(m, float(t), "below" if m in ALERT_BELOW else "above") for m, t in values.items()]
    return spark.createDataFrame(rows, "metric string, threshold double, direction string")


def check_thresholds(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Adds ``exceeded`` to the rows whose metric has a threshold; others are left out. Works on streams."""
    alert = F.when(F.col("direction") == "below", F.col("value") < F.col("threshold")) \
        .otherwise(F.col("value") > F.col("threshold"))
    return metrics.join(F.broadcast(thresholds), "metric").withColumn("exceeded", alert)


def prediction_stats(df: DataFrame, keys: list[str] = (), prediction: str = "prediction") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg(prediction).alias("mean"), F.stddev_pop(prediction).alias("std"),
        F.min(prediction).alias("min"), F.max(prediction).alias("max"))


STATS = ["mean", "std", "min", "max"]


def monitor_predictions(df: DataFrame, thresholds: DataFrame, keys: list[str] = ("model",),
                        actual: str | None = "actual") -> DataFrame:
    """Long metrics of the predictions, errors too when the truth is known, with their alerts (NULL where
    a metric has no threshold)."""
    keys = list(keys)
    long = prediction_stats(df, keys).unpivot(keys, STATS, "metric", "value")
    if actual is not None:
        errors = error_metrics(df.where(F.col(actual).isNotNull()), keys, actual=actual).select(*keys, *METRICS)
        long = long.unionByName(errors.unpivot(keys, METRICS, "metric", "value"))
    alerts = F.when(F.col("direction") == "below", F.col("value") < F.col("threshold")) \
        .otherwise(F.col("value") > F.col("threshold"))
    return long.join(F.broadcast(thresholds), "metric", "left").select(
        *keys, "metric", "value", F.when(F.col("threshold").isNotNull(), alerts).alias("exceeded"))


def resource_alerts(system_metrics: DataFrame, spark: SparkSession, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Resource readings above their limit."""
    limits = threshold_table(spark, thresholds).where(F.col("metric").isin("cpu", "memory", "disk"))
    return check_thresholds(system_metrics, limits).where("exceeded")


def performance_history(log: DataFrame, model: str | None = None, names=("rmse", "mae", "mape"), bucket: str = "day") -> DataFrame:
    """Logged errors over time, one row per model and time bucket."""
    rows = log.where(F.col("metric").isin(*names))
    if model is not None:
        rows = rows.where(F.col("model") == model)
    return rows.groupBy("model", F.date_trunc(bucket, "ts").alias("period")).pivot("metric", list(names)).agg(F.avg("value"))


def freshness(df: DataFrame, as_of, keys: list[str] = (), date: str = "date") -> DataFrame:
    """Days from the newest row to ``as_of``."""
    return df.groupBy(*keys).agg(F.max(date).alias("last_date"), F.datediff(F.lit(as_of), F.max(date)).alias("age_days"))


def retrain_decision(status: DataFrame, as_of, max_age_days: int = 30, max_error_ratio: float = 1.1,
                     drift_p: float = 0.05) -> DataFrame:
    """Whether and why each model should be retrained.

    ``status`` has ``model, trained_on, error_ratio, p_value``; an unknown value triggers nothing.
    """
    age = F.datediff(F.lit(as_of), F.col("trained_on"))
    reasons = F.array_compact(F.array(
        F.when(age > max_age_days, "age"),
        F.when(F.col("error_ratio") > max_error_ratio, "performance"),
        F.when(F.col("p_value") < drift_p, "drift")))
    return status.withColumn("reason", F.concat_ws(",", reasons)).withColumn(
        "decision", F.when(F.col("reason") == "", "skip").otherwise("retrain"))


def prediction_anomalies(predictions: DataFrame, keys: list[str], threshold: float = 3.0,
                         prediction: str = "prediction") -> DataFrame:
    return outlier_rows(predictions, prediction, keys, threshold)
