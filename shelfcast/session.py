"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, name: str = "shelfcast") -> SparkSession:
    """Session for tests and the local benchmark; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SHELFCAST_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Rows of one task, beyond which a shuffle gets more partitions than the session's.
ROWS_PER_TASK = 500_000


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """The frame dealt by its keys for a grouping, window or join over them, with so many partitions that the memory of a task
    does not grow with ``rows``. Frames that the session's number of partitions suits are left as they are."""
    parts = -(-rows // ROWS_PER_TASK)
    return df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Like ``spread``, but dealt by the keys in any case, into the session's number of partitions at least."""
    many = spread(df, rows, *keys)
    return df.repartition(*keys) if many is df else many


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster without it is an error,
    since a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="shelfcast-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; the session's file system deletes what lies there when it ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: later steps read the columns they need of it, however executors
    come and go."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """The frame stored, so that later steps neither repeat its work nor depend on the executors that did it."""
    return stored(df, "kept")
