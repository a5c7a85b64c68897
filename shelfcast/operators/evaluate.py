"""Error metrics, model comparison and run selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

METRICS = ["mse", "rmse", "mae", "mape"]


def error_metrics(df: DataFrame, keys: list[str] = (), prediction: str = "prediction", actual: str = "actual") -> DataFrame:
    """mse, rmse, mae and mape (percent) per key. Rows with a zero actual do not enter mape and are counted."""
    error = F.col(prediction) - F.col(actual)
    share = F.abs(F.try_divide(error, F.col(actual)))
    return df.groupBy(*keys).agg(
        F.count(error).alias("n"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(share) * 100).alias("mape"),
        F.count_if(F.col(actual) == 0).alias("n_zero_actual"))


def macro_average(per_series: DataFrame, metrics: list[str] = METRICS, keys: list[str] = ()) -> DataFrame:
    """Mean over series of each metric, as ``avg_<metric>``."""
    return per_series.groupBy(*keys).agg(*[F.avg(m).alias(f"avg_{m}") for m in metrics])


def compare_models(metrics: DataFrame, names: list[str] = METRICS) -> DataFrame:
    """Long ``(model, metric, value)`` to one row per model; repeated values are averaged."""
    return metrics.groupBy("model").pivot("metric", names).agg(F.avg("value"))


def best_model(metrics: DataFrame, candidates: list[str], metric: str = "rmse") -> DataFrame:
    """The candidate with the smallest value, as one row ``(model, value)``.

    A candidate without the metric counts as infinite; ties go to the earlier one; an error is raised when
    none has it.
    """
    spark = metrics.sparkSession
    listed = spark.createDataFrame(list(enumerate(candidates)), "ordinal int, model string")
    values = metrics.where(F.col("metric") == metric).groupBy("model").agg(F.avg("value").alias("value"))
    scored = listed.join(values, "model", "left").withColumn(
        "_v", F.when(F.col("value").isNull() | F.isnan("value"), float("inf")).otherwise(F.col("value")))
    picked = scored.agg(F.min_by("model", F.struct("_v", "ordinal")).alias("model"), F.min("_v").alias("value"))
    missing = F.raise_error(F.lit(f"no candidate has the metric {metric}")).cast("string")
    return picked.select(F.when(F.col("value") == float("inf"), missing).otherwise(F.col("model")).alias("model"), "value")


def best_run(run_metrics: DataFrame, metric: str = "rmse", split: str | None = "test", ascending: bool = True) -> DataFrame:
    """The run with the best last value of a metric; empty when no run has it."""
    rows = run_metrics.where((F.col("metric") == metric) & F.col("value").isNotNull())
    if split is not None:
        rows = rows.where(F.col("split") == split)
    last = rows.groupBy("run_id").agg(F.max_by("value", "step").alias("value"))
    return last.orderBy(F.asc("value") if ascending else F.desc("value"), "run_id").limit(1)


def compare_runs(runs: DataFrame, run_metrics: DataFrame, names: list[str], experiment: str = "default",
                 max_runs: int = 5, experiments: list[str] | None = None) -> DataFrame:
    """The newest runs of an experiment with the named metrics."""
    if experiments is not None and experiment not in experiments:
        raise ValueError(f"unknown experiment {experiment!r}")
    newest = runs.where(F.col("experiment") == experiment).orderBy(F.desc("start_time"), "run_id").limit(max_runs) \
        .select("run_id", "start_time")
    # at most ``max_runs`` rows
    values = run_metrics.where(F.col("metric").isin(*names)).join(F.broadcast(newest.select("run_id")), "run_id")
    wide = values.groupBy("run_id").agg(*[
        F.max_by(F.when(F.col("metric") == n, F.col("value")), F.when(F.col("metric") == n, F.col("step"))).alias(n)
        for n in names])
    return newest.join(wide, "run_id", "left")


def promote_or_keep(current: DataFrame, candidate: DataFrame, keys: list[str], metric: str = "rmse") -> DataFrame:
    """``promote`` where the candidate is better than what is in use, or nothing is in use; else ``keep``."""
    old = current.select(*keys, F.col(metric).alias("current_value"))
    new = candidate.select(*keys, F.col(metric).alias("candidate_value"))
    better = (F.col("candidate_value") < F.col("current_value")) | \
        (F.col("current_value").isNull() & F.col("candidate_value").isNotNull())
    return old.join(new, keys, "full").withColumn(
        "decision", F.when(better, "promote").otherwise("keep"))
