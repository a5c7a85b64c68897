"""Sinks, the metrics log, run tables and model tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import schemas


def write_processed(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                    mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def to_long_metrics(df: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """One row per metric from a wide row of metric columns; missing values are left out."""
    wide = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(ids, metrics, "metric", "value").where(F.col("value").isNotNull())


def append_metrics(df: DataFrame, path: str) -> None:
    """Append long metric rows, partitioned by day so that range reads skip files."""
    (
        df.withColumn("dt", F.to_date("ts"))
        .write.mode("append").partitionBy("metric_type", "dt").parquet(path)
    )


def replace_metrics(df: DataFrame, path: str) -> None:
    """Long metric rows of one run; the run's rows are replaced when it is written again."""
    _replace_run(df, path)


def read_metrics_log(spark: SparkSession, path: str, metric_type: str | None = None,
                     start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """History between two inclusive instants; empty when nothing was logged."""
    stored = T.StructType([*schemas.METRIC_LOG.fields, T.StructField("dt", T.DateType())])
    try:
        df = spark.read.schema(stored).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.METRIC_LOG)
    return metrics_between(df, metric_type, start, end).select(*schemas.METRIC_LOG.names)


def metrics_between(df: DataFrame, metric_type: str | None = None, start: datetime | None = None,
                    end: datetime | None = None) -> DataFrame:
    if metric_type is not None:
        df = df.where(F.col("metric_type") == metric_type)
    for bound, is_start in ((start, True), (end, False)):
        if bound is None:
            continue
        cut = F.lit(bound)
        if "dt" in df.columns:
            day = F.lit(bound.date())
            df = df.where(F.col("dt") >= day if is_start else F.col("dt") <= day)
        df = df.where(F.col("ts") >= cut if is_start else F.col("ts") <= cut)
    return df


def read_metric_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON metric lines to long rows; accepts flat objects and objects with a nested ``metrics`` map.

    Each line carries ``timestamp`` and any number of numeric entries.
    """
    lines = spark.read.text(path)
    entries = F.from_json("value", "map<string,string>")
    nested = F.from_json(F.get_json_object("value", "$.metrics"), "map<string,double>")
    flat = F.transform_values(
        F.map_filter(entries, lambda k, v: ~k.isin("timestamp", "metrics")),
        lambda k, v: v.try_cast("double"),
    )
    return (
        lines.select(
            F.try_to_timestamp(F.get_json_object("value", "$.timestamp")).alias("ts"),
            F.explode(F.coalesce(nested, flat)).alias("metric", "value"),
        )
        .where(F.col("value").isNotNull())
    )


def retain_days(df: DataFrame, days: int = 90, ts: str = "ts") -> DataFrame:
    """Rows within the last ``days`` days before the newest one."""
    newest = df.agg(F.max(ts).alias("newest")).scalar()
    return df.where(F.col(ts) >= newest - F.expr(f"INTERVAL {int(days)} DAYS"))


def rewrite_retained(spark: SparkSession, path: str, days: int, kept_path: str) -> None:
    """Write the retained history to a new folder; the caller then switches readers to it."""
    kept = retain_days(spark.read.parquet(path), days)
    kept.write.mode("errorifexists").partitionBy("metric_type", "dt").parquet(kept_path)


def write_predictions(df: DataFrame, path: str, run_id: str) -> None:
    rows = df.withColumn("run_id", F.lit(run_id)).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.PREDICTIONS.fields])
    _replace_run(rows, path)


def _replace_run(rows: DataFrame, path: str) -> None:
    """Write a run's partition; a run written again replaces itself, others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def write_model_table(coefficients: DataFrame, path: str, run_id: str) -> None:
    """The ``(series, term, value)`` rows of one run."""
    rows = coefficients.select(F.lit(run_id).alias("run_id"), F.col("series").cast("string").alias("series"),
                               "term", F.col("value").cast("double").alias("value"))
    _replace_run(rows, path)


def write_fits(fits: DataFrame, path: str, run_id: str) -> None:
    """A model's whole parameter table (orders, coefficients, variances, spans) under its run."""
    _replace_run(fits.withColumn("run_id", F.lit(run_id)), path)


def read_fits(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The parameter table of a run as ``fit`` returned it."""
    return spark.read.parquet(path).where(F.col("run_id") == run_id).drop("run_id")


def read_model_table(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    return (
        spark.read.schema(schemas.MODEL_TABLE).parquet(path)
        .where(F.col("run_id") == run_id)
        .select(*schemas.MODEL_TABLE.names)
    )


def log_run(spark: SparkSession, folder: str, run_id: str, model: str, start_time: datetime,
            params: dict[str, object] | None = None, metrics: list[tuple[str, str, int, float]] | None = None,
            parent_id: str | None = None, experiment: str = "default") -> None:
    """One run: its header, parameters, and ``(split, metric, step, value)`` rows. Each table has a folder per run, so a run
    logged again replaces what it is given again."""
    tables = (("run_params", schemas.RUN_PARAMS, [(run_id, k, str(v)) for k, v in (params or {}).items()]),
              ("run_metrics", schemas.RUN_METRICS, [(run_id, *m) for m in metrics or []]),
              ("runs", schemas.RUNS, [(run_id, parent_id, experiment, model, start_time)]))
    for name, schema, rows in tables:
        if rows:
            _replace_run(spark.createDataFrame(rows, schema), f"{folder}/{name}")


def log_runs(runs: DataFrame, run_metrics: DataFrame, folder: str) -> None:
    """Many runs at once: frames with the columns of the run and metric tables; runs logged before are replaced."""
    for rows, schema, name in ((run_metrics, schemas.RUN_METRICS, "run_metrics"), (runs, schemas.RUNS, "runs")):
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        # the rows of a run in one file
        _replace_run(typed.repartition("run_id"), f"{folder}/{name}")


def read_runs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return tuple(spark.read.schema(schema).parquet(f"{folder}/{name}").select(*schema.names)
                 for name, schema in (("runs", schemas.RUNS), ("run_metrics", schemas.RUN_METRICS)))
