import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import monitor
from shelfcast.streaming import streams

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "row_id int, ts timestamp, model string, prediction double, actual double"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


@pytest.fixture
def folder(spark, tmp_path):
    """Three files, read one per trigger; the last one brings a row that is hours late."""
    parts = [
        [(i, at(i * 10), "m", float(i), float(i % 3)) for i in range(20)],
        [(i, at(i * 10), "m", float(i), float(i % 3)) for i in range(20, 60)],
        [(100, at(5), "m", 1000.0, 0.0), (101, at(590), "m", 1.0, 1.0), (102, at(900), "m", 2.0, 2.0)],
    ]
    for i, rows in enumerate(parts):
        out = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        out.write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in"), tmp_path


def stream(spark, path):
    return streams.read_stream(spark, path, spark.read.parquet(path).schema, max_files=1)


def test_late_row_is_dropped_and_the_rest_equals_batch(spark, folder):
    path, tmp = folder
    stats = streams.windowed_prediction_stats(stream(spark, path), "1 hour", delay="30 minutes")
    got = streams.run_available(stats, str(tmp / "out"), str(tmp / "cp"))
    on_time = spark.read.parquet(path).where("row_id <> 100")
    want = streams.windowed_prediction_stats(on_time, "1 hour")
    closed = want.where(F.col("window_end") <= F.lit(at(870)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, closed.collect()))
    assert got.where("max = 1000").count() == 0 and got.count() >= 10


def test_alerts_and_scores(spark, folder):
    path, tmp = folder
    limits = monitor.threshold_table(spark, {"m": 50.0})
    metrics = stream(spark, path).select("ts", F.col("model").alias("metric"), F.col("prediction").alias("value"))
    alerts = streams.run_available(streams.threshold_alerts(metrics, limits), str(tmp / "a"), str(tmp / "acp"))
    assert alerts.count() == 10
    coef = spark.createDataFrame([("m", 1.0, 2.0)], "model string, intercept double, prediction_coef double")
    scored = streams.run_available(streams.score(stream(spark, path), coef, "model", ["prediction"]), str(tmp / "s"), str(tmp / "scp"))
    none = spark.createDataFrame([("other", 1.0, 2.0)], "model string, intercept double, prediction_coef double")
    assert streams.score(spark.read.parquet(path), none, "model", ["prediction"]).where("score IS NULL").count() == 63
    assert scored.count() == 63 and scored.where("score <> 1 + 2 * prediction").count() == 0


def test_duplicates_are_suppressed(spark, tmp_path):
    rows = spark.createDataFrame([(i % 10, at(i), "m", 1.0, 1.0) for i in range(30)], SCHEMA)
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    kept = streams.suppress_duplicates(stream(spark, str(tmp_path / "in")), ["row_id"])
    assert streams.run_available(kept, str(tmp_path / "out"), str(tmp_path / "cp")).count() == 10
    assert streams.suppress_duplicates(rows, ["row_id"]).count() == 10


def test_restart_appends_only_new_files(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    one = spark.createDataFrame([(1, T0, "m", 1.0, 1.0)], SCHEMA)
    one.write.parquet(src)
    assert streams.run_available(stream(spark, src), out, cp).count() == 1
    one.write.mode("append").parquet(src)
    assert streams.run_available(stream(spark, src), out, cp).count() == 2


def test_drift_per_batch(spark, folder):
    path, tmp = folder
    reference = spark.range(60).select(F.col("id").cast("double").alias("prediction"))
    streams.drift_alerts(stream(spark, path), reference, ["prediction"], str(tmp / "d"), str(tmp / "dcp"))
    got = {r.batch_id: r.ks_stat for r in spark.read.parquet(str(tmp / "d")).collect()}
    assert len(got) == 3 and got[0] == pytest.approx(40 / 60)


def test_rerun_of_a_line_means_the_same_in_stream_and_batch(spark, tmp_path):
    """Rows at 0, 50 and 100 minutes are one run of re-sent lines under an hour's delay, however the stream is cut."""
    lines = [("a", m) for m in (0, 50, 100, 300, 301, 420)] + [("b", m) for m in (10, 10, 71, 200)]
    rows = spark.createDataFrame([(k, at(m), float(i)) for i, (k, m) in enumerate(sorted(lines, key=lambda x: x[1]))], "k string, ts timestamp, v double")
    batch = sorted((r.k, r.ts) for r in streams.suppress_duplicates(rows, ["k"]).collect())
    assert batch == sorted([("a", at(0)), ("a", at(300)), ("a", at(420)), ("b", at(10)), ("b", at(71)), ("b", at(200))])
    ordered = [r for r in rows.orderBy("ts").collect()]
    for size in (2, len(ordered)):
        src = str(tmp_path / f"in{size}")
        for a in range(0, len(ordered), size):
            spark.createDataFrame(ordered[a:a + size], rows.schema).coalesce(1).write.mode("append").parquet(src)
        kept = streams.suppress_duplicates(streams.read_stream(spark, src, rows.schema, max_files=1), ["k"])
        got = streams.run_available(kept, str(tmp_path / f"out{size}"), str(tmp_path / f"cp{size}"))
        assert sorted((r.k, r.ts) for r in got.collect()) == batch


def test_state_of_many_keys_is_kept_in_buckets(spark, tmp_path):
    """The state store holds a value and a timer a bucket, not a key; every row comes twice and is kept once."""
    rows = spark.range(5000).select(F.col("id").alias("k"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"))
    rows.union(rows).orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    kept = streams.suppress_duplicates(streams.read_stream(spark, str(tmp_path / "in"), rows.schema), ["k"])
    running = kept.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    running.awaitTermination()
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(rows.collect())
    held = [p["stateOperators"][0]["numRowsTotal"] for p in running.recentProgress]
    assert 0 < max(held) <= 4 * streams.BUCKETS


def test_keys_of_any_kind_and_rows_unchanged(spark, tmp_path):
    """Keys are equal as in grouping; longs beside NULLs, names with a leading underscore and rows without a time survive."""
    big = (1 << 53) + 1
    lines = [(1.0, "a:1", None, 0, big), (0.0, None, T0, 0, None), (-0.0, None, T0, 10, big), (None, "", T0, 20, big + 1), (None, None, T0, 30, 5),
             (1.0, "a:1", T0, 40, None), (1.0, "a", T0, 50, big), (1.0, "a:1", T0, 60, 7), (0.0, None, None, 70, 8), (0.0, None, at(0), 200, 9)]
    schema = "_x double, y string, z timestamp, m int, _v long"
    made = spark.createDataFrame(lines, schema).withColumn("ts", F.when(F.col("_v").isNull() | (F.col("_v") != 5), F.lit(T0) + F.make_dt_interval(mins=F.col("m"))))
    made.orderBy("m").coalesce(1).write.parquet(str(tmp_path / "in"))
    keys = ["_x", "y", "z"]
    kept = streams.suppress_duplicates(streams.read_stream(spark, str(tmp_path / "in"), made.schema), keys)
    got = streams.run_available(kept, str(tmp_path / "out"), str(tmp_path / "cp"))
    want = streams.suppress_duplicates(made, keys)
    assert got.columns == made.columns and got.schema == made.schema
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.count() == 8  # two come again within the hour


def late_frames(spark):
    predictions = [(i, at(i * 10), "m", float(i)) for i in range(120)]
    actuals = []
    for i in range(120):
        if i % 7:  # every seventh is never told
            actuals.append((i, i + 0.5, at(i * 10 + i % 5 * 40)))  # the latest comes after 160 minutes, too late
        if i % 3 == 0 and i % 7:
            actuals.append((i, i + 9.0, at(i * 10 + i % 5 * 40 + 15)))  # told again, otherwise
    return (spark.createDataFrame(predictions, "row_id int, ts timestamp, model string, prediction double"),
            spark.createDataFrame(sorted(actuals, key=lambda r: r[2]), "row_id int, actual double, ts timestamp"))


def test_late_missing_and_repeated_actuals(spark, tmp_path):
    predictions, actuals = late_frames(spark)
    batch = {r.row_id: r for r in streams.predictions_with_late_actuals(predictions, actuals, ["row_id"], "2 hours").collect()}
    assert len(batch) == 120
    for i, r in batch.items():
        told = i % 7 and i % 5 * 40 <= 120
        assert (r.actual, r.actual_ts) == ((i + 0.5, at(i * 10 + i % 5 * 40)) if told else (None, None))
    seen = []
    for files in (1, 5):
        sources = []
        for name, df in (("p", predictions), ("a", actuals)):
            src, part = str(tmp_path / f"{name}{files}"), -(-df.count() // files)
            ordered = df.orderBy("ts").collect()
            for a in range(0, len(ordered), part):
                spark.createDataFrame(ordered[a:a + part], df.schema).coalesce(1).write.mode("append").parquet(src)
            sources.append(streams.read_stream(spark, src, df.schema, max_files=1))
        joined = streams.predictions_with_late_actuals(*sources, ["row_id"], "2 hours")
        got = streams.run_available(joined, str(tmp_path / f"o{files}"), str(tmp_path / f"c{files}")).collect()
        assert len({r.row_id for r in got}) == len(got)
        assert all((r.actual, r.actual_ts, r.ts) == (batch[r.row_id].actual, batch[r.row_id].actual_ts, batch[r.row_id].ts) for r in got)
        seen.append({r.row_id for r in got})
    assert seen[0] == seen[1] and len(seen[0]) > 90


def test_drift_by_event_time_does_not_depend_on_the_cuts(spark, tmp_path):
    rows = spark.createDataFrame([(i, at(i * 10), "m", float(i * 37 % 100), 0.0) for i in range(600)], SCHEMA)
    reference = spark.range(50).select(F.col("id").cast("double").alias("prediction"), (F.col("id") % 2).cast("double").alias("actual"))
    found = []
    for files in (1, 5):
        src = str(tmp_path / f"in{files}")
        for i in range(files):  # later files bring older rows too
            rows.where(F.col("row_id") % 5 % files == i).coalesce(1).write.mode("append").parquet(src)
        source = streams.read_stream(spark, src, rows.schema, max_files=files)
        streams.windowed_drift(source, reference, ["prediction", "actual"], str(tmp_path / f"d{files}"), str(tmp_path / f"c{files}"), "1 day")
        got = spark.read.parquet(str(tmp_path / f"d{files}")).drop("batch_id").collect()
        found.append(sorted((r.window_start, r.column, r.ks_stat, r.n, r.m) for r in got))
    assert found[0] == found[1] and len(found[0]) == 2 * 4
    for start, column, stat, n, m in found[0]:
        ref = sorted(r[column] for r in reference.collect())
        cur = sorted(r[column] for r in rows.collect() if start <= r.ts < start + dt.timedelta(days=1))
        places = sorted(set(ref) | set(cur))
        want = max(abs(sum(v <= x for v in ref) / len(ref) - sum(v <= x for v in cur) / len(cur)) for x in places)
        assert (stat, n, m) == (pytest.approx(want), len(ref), len(cur))
