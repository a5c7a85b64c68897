"""Structured Streaming jobs over the metrics and prediction logs."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators.drift import both_sides, ks_by_group, ks_of_counts, value_counts
from ..operators.monitor import check_thresholds
from ..session import materialize

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                pattern: str | None = None, max_files: int | None = None) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def run_available(stream: DataFrame, out: str, checkpoint: str, partition_by: list[str] = ()) -> DataFrame:
    """Process what is there, append it to Parquet exactly once, and return the written table."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(out).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def run_each_batch(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Write ``transform`` of each micro-batch to its own folder, so a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            transform(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start().awaitTermination()


def windowed_prediction_stats(rows: DataFrame, window: str = "1 hour", slide: str | None = None,
                              delay: str = "1 hour", keys: list[str] = ("model",), ts: str = "ts") -> DataFrame:
    """Prediction statistics and errors per event-time window; rows later than the delay are dropped on a
    stream. The same function serves batch frames."""
    error = F.col("prediction") - F.col("actual")
    marked = rows.withWatermark(ts, delay) if rows.isStreaming else rows
    slots = F.window(ts, window, slide) if slide else F.window(ts, window)
    return (
        marked.groupBy(slots.alias("window"), *keys)
        .agg(F.count("*").alias("n"), F.avg("prediction").alias("mean"), F.stddev_pop("prediction").alias("std"),
             F.min("prediction").alias("min"), F.max("prediction").alias("max"),
             F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys,
                "n", "mean", "std", "min", "max", F.sqrt("mse").alias("rmse"), "mae")
    )


def threshold_alerts(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Metric rows beyond their limit."""
    return check_thresholds(metrics, thresholds).where("exceeded")


def drift_alerts(stream: DataFrame, reference: DataFrame, cols: list[str], out: str, checkpoint: str) -> None:
    """Kolmogorov–Smirnov drift of each micro-batch against a fixed reference, whose value counts are stored once."""
    counted = materialize(value_counts(reference, cols))
    run_each_batch(stream, lambda batch: ks_of_counts(both_sides(counted, value_counts(batch, cols))), out, checkpoint)


def windowed_value_counts(rows: DataFrame, cols: list[str], window: str = "1 day", delay: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Occurrences of each known value per event-time window, as ``(window_start, column, value, n)``. On a stream a window
    appears once, whole, when the watermark has passed its end, however the rows were cut into micro-batches."""
    marked = rows.withWatermark(ts, delay) if rows.isStreaming else rows
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    long = marked.select(ts, F.explode(pairs).alias("_p")).select(ts, "_p.column", "_p.value").where("value IS NOT NULL")
    counted = long.groupBy(F.window(ts, window).alias("window"), "column", "value").agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), "column", "value", "n")


def windowed_drift(stream: DataFrame, reference: DataFrame, cols: list[str], out: str, checkpoint: str, window: str = "1 day",
                   delay: str = "1 hour", ts: str = "ts") -> None:
    """Kolmogorov–Smirnov drift of each closed event-time window against a fixed reference: ``window_start, column, ks_stat, n,
    m, p_value, is_drift``."""
    counted = materialize(value_counts(reference, cols))
    counts = windowed_value_counts(stream, cols, window, delay, ts)
    run_each_batch(counts, lambda closed: ks_by_group(counted, closed, ["window_start"]), out, checkpoint)


def score(rows: DataFrame, coefficients: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Linear score of each row with its key's coefficients ``(key, intercept, <feature>_coef …)``.

    One row per key on the right; Spark broadcasts it while it is small and shuffles both sides beyond that. A
    row whose key has no coefficients keeps a NULL score.
    """
    total = F.col("intercept")
    for f in features:
        total = total + F.col(f"{f}_coef") * F.col(f)
    return rows.join(coefficients, key, "left").withColumn("score", total).drop("intercept", *[f"{f}_coef" for f in features])


# Buckets that share a state, and a time before all others (µs) for keys and rows without one.
BUCKETS = 1024
NEVER = -(1 << 62)


class _FirstOfRun(StatefulProcessor):
    """State of a bucket: when each of its keys last came, kept until the watermark has passed that by the delay. All keys of a
    bucket are compared at once and their state is one value, so calls to the state store do not grow with the keys."""

    def __init__(self, delay: timedelta, columns: list[str]):
        self.delay, self.columns = delay // timedelta(microseconds=1), columns

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "table binary")

    def handleInputRows(self, key, rows, timerValues):
        # the rows of one bucket in one micro-batch
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["key", "us"], kind="stable")
        seen = self.last.get()
        last = pa.ipc.open_stream(bytes(seen[0])).read_pandas().set_index("key")["us"] if seen is not None else pd.Series(dtype="int64")
        times, seen_at = pdf["us"], last.reindex(pdf["key"], fill_value=NEVER).to_numpy()
        before = times.groupby(pdf["key"], sort=False).shift(fill_value=NEVER).clip(lower=seen_at)  # rows may be older than what was seen
        fresh = times.eq(NEVER) | before.eq(NEVER) | (times > before + self.delay)
        self._keep(pd.concat([last, times.set_axis(pdf["key"])]).groupby(level=0).max(), timerValues.getCurrentWatermarkInMs() * 1000)
        yield pdf.loc[fresh, self.columns]

    def _keep(self, last: pd.Series, watermark: int) -> None:
        last = last[last + self.delay >= watermark]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if last.empty:
            self.last.clear()
            return
        table, sink = pa.table({"key": last.index.to_numpy(), "us": last.to_numpy()}), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        self.last.update((sink.getvalue().to_pybytes(),))
        self.handle.registerTimer((int(last.max()) + self.delay) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.last.clear()
        return iter([])


def _same_as_text(rows: DataFrame, keys: list[str]) -> Column:
    """One text for each combination of key values that grouping takes as equal, NULL included."""
    def text(field: T.StructField) -> Column:
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return (c + F.lit(0).cast(kind)).cast("string")  # -0.0 is 0.0
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(c).cast("string")
        if isinstance(kind, T.BinaryType):
            return F.hex(c)
        if isinstance(kind, (T.StructType, T.ArrayType)):
            micros = {f"timestamp{n}Format": f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS{zone}" for n, zone in (("", "XXX"), ("NTZ", ""))}
            return F.to_json(c, micros | {"ignoreNullFields": "false"})
        return c.cast("string")
    texts = [text(rows.schema[k]) for k in keys]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def suppress_duplicates(rows: DataFrame, keys: list[str], delay: str = "1 hour", ts: str = "ts") -> DataFrame:
    """The first of re-sent rows: a row is dropped if an equal key came at most the delay before it, kept or not.

    A stream and a batch mean the same and, for rows in order of time, give the same rows wherever the stream is cut: the
    state of a key is the time it last came, and it is cleared once no row on time can come within the delay. A row that
    comes after later ones of its key is compared with the newest of them; one behind the watermark is dropped. Of rows
    with equal key and time one stays; rows without a time all stay. Keys are dealt to buckets whose state is kept in RocksDB,
    which the session is set to; a bucket holds its rows of one micro-batch in memory, so ``maxFilesPerTrigger`` bounds them.
    """
    if not rows.isStreaming:
        w = Window.partitionBy(*keys).orderBy(ts)
        fresh = F.coalesce(F.col(ts) > F.lag(ts).over(w) + F.expr(f"INTERVAL {delay}"), F.lit(True))
        return rows.withColumn("_fresh", fresh).where("_fresh").drop("_fresh")
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    length = rows.sparkSession.sql(f"SELECT INTERVAL '0' SECOND + INTERVAL {delay} AS d").first()[0]
    # pandas would make doubles of longs beside NULLs and loses names with a leading underscore
    kinds = {f"c{i}": T.StringType() if isinstance(f.dataType, T.LongType) else f.dataType for i, f in enumerate(rows.schema.fields)}
    sent = [F.col(f"`{f.name}`").cast(kinds[c]).alias(c) for c, f in zip(kinds, rows.schema.fields)]
    dealt = rows.withWatermark(ts, delay).select(
        F.col(ts).alias("at"), *sent, _same_as_text(rows, keys).alias("key"), F.coalesce(F.unix_micros(ts), F.lit(NEVER)).alias("us"))
    kept = dealt.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS))).groupBy("bucket").transformWithStateInPandas(
        _FirstOfRun(length, list(kinds)), T.StructType([T.StructField(c, kind) for c, kind in kinds.items()]), "append", "eventTime")
    return kept.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(kinds, rows.schema.fields)])


def predictions_with_late_actuals(predictions: DataFrame, actuals: DataFrame, keys: list[str], wait: str = "1 day",
                                  delay: str = "1 hour", ts: str = "ts") -> DataFrame:
    """Each prediction with its first actual, or NULL if none came within ``wait`` of it: the prediction's columns,
    ``actual`` and ``actual_ts``.

    ``actuals`` has (keys, actual, ts) at the time the value became known, possibly repeated; the earliest counts, of equally early
    ones the smallest. ``keys`` name one prediction. On streams both sides have watermarks: a prediction appears once, when the
    watermark has passed the end of its wait, so the rows do not depend on how either side was cut into micro-batches.
    """
    left, right = predictions, actuals.select(*[F.col(k).alias(f"_{k}") for k in keys], "actual", F.col(ts).alias("actual_ts"))
    if predictions.isStreaming:
        left, right = left.withWatermark(ts, delay), right.withWatermark("actual_ts", delay)
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    in_time = (F.col("actual_ts") >= F.col(ts)) & (F.col("actual_ts") <= F.col(ts) + F.expr(f"INTERVAL {wait}"))
    joined = left.join(right, same & in_time, "leftOuter")
    columns = [c for c in predictions.columns if c not in keys and c != ts]
    # the time of a prediction is part of its group, so the group closes when the watermark passes it
    first = joined.groupBy(ts, *keys).agg(
        *[F.first(c).alias(c) for c in columns], F.min(F.when(F.col("actual_ts").isNotNull(), F.struct("actual_ts", "actual"))).alias("_a"))
    return first.select(*predictions.columns, F.col("_a.actual").alias("actual"), F.col("_a.actual_ts").alias("actual_ts"))
