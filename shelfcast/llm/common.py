"""Helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfcast.session import stored


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of the frame is called so (case aside)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def numbered(df: DataFrame, row: str) -> DataFrame:
    """The rows with a unique long ``row``, stored: ids that are made anew by each scan could differ between scans."""
    return stored(df.withColumn(row, F.monotonically_increasing_id()), "rows")


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: T.StructType) -> DataFrame:
    """``work`` over the columns by place: their names may hold anything, dots included."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(work, schema)


def batch_of(schema: T.StructType, columns: list) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, type=f.type) for c, f in zip(columns, arrow)],
        schema=arrow)


def slices(sizes: Iterator[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of items whose sizes add to about ``most``; an item above it is a run of its own."""
    start, held, n = 0, 0, 0
    for n, size in enumerate(sizes, 1):
        if held and held + size > most:
            yield start, n - 1
            start, held = n - 1, 0
        held += size
    if n > start:
        yield start, n


def text_runs(column: pa.Array, most: int = 1 << 20, binary: bool = False) -> Iterator[list]:
    """The texts of a column (NULL as empty) as Python values, about ``most`` bytes at a time: a batch of long texts
    is never held twice."""
    column = column.cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for a, b in slices(sizes, most):
        part = [x or b"" for x in column.slice(a, b - a).to_pylist()]
        yield part if binary else [x.decode("utf-8", "replace") for x in part]


def texts_of(column: pa.Array) -> Iterator[str]:
    for run in text_runs(column):
        yield from run


def running_sums(df: DataFrame, order: list, size: str, before: str, within: str | None = None) -> DataFrame:
    """The rows, range-sorted by ``order``, with the sum of ``size`` over all earlier rows (of the same
    ``within``, by which ``order`` must then begin). No task holds more than one range partition at a time, and
    only one row per partition (and group in it) is summed across partitions. Stored."""
    spark = df.sparkSession
    part = free_name(df, "part_no")
    out = T.StructType([*df.schema.fields, T.StructField(before, T.LongType()), T.StructField(part, T.IntegerType())])
    at, group_at = df.columns.index(size), df.columns.index(within) if within else None

    def sums(batches):
        number, total, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            n = batch.num_rows
            sizes = np.asarray(batch.column(at).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            run = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            if group_at is None:
                values = run + total
                total += int(sizes.sum())
            else:
                keys = batch.column(group_at).to_pylist()
                first = np.array([k != p for k, p in zip(keys, [last, *keys])]) if n else np.zeros(0, bool)
                if n and last is None and total == 0:
                    first[0] = True
                starts = np.where(first, np.arange(n), -1)
                at_start = np.maximum.accumulate(starts) if n else starts
                values = np.where(at_start >= 0, run - run[np.maximum(at_start, 0)], run + total)
                if n:
                    total = int(values[-1] + sizes[-1])
                    last = keys[-1]
            yield batch_of(out, [*batch.columns, values, np.full(n, number, np.int32)])

    summed = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(sums, out), "sums")
    keys = [part, *([within] if within else [])]
    ends = summed.groupBy(*keys).agg(F.max(F.col(before) + F.coalesce(size, F.lit(0))).alias("part_total"))
    by = f"PARTITION BY {within}" if within else ""
    earlier = spark.sql(
        f"SELECT {', '.join(keys)}, coalesce(sum(part_total) OVER ({by} ORDER BY {part} ROWS BETWEEN UNBOUNDED "
        "PRECEDING AND 1 PRECEDING), 0) AS part_before FROM {ends}", ends=ends)
    left, right = summed.alias("l"), earlier.alias("r")
    on = F.col(f"l.{part}") == F.col(f"r.{part}")
    if within:
        on = on & F.col(f"l.{within}").eqNullSafe(F.col(f"r.{within}"))
    return left.join(right, on).select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col(f"l.{before}") + F.col("r.part_before")).alias(before))
