"""Missing dates and continuity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def missing_dates(df: DataFrame, keys: list[str] = (), date: str = "date") -> DataFrame:
    """Days inside the (key's) span on which it has no row."""
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(date)
    steps = df.select(*keys, date).where(F.col(date).isNotNull()).distinct().withColumn("_next", F.lead(date).over(w))
    gaps = steps.where(F.datediff("_next", date) > 1)
    return gaps.select(*keys, F.explode(F.sequence(F.date_add(date, 1), F.date_sub("_next", 1))).alias(date))


def first_missing_dates(df: DataFrame, n: int = 5, date: str = "date") -> DataFrame:
    return missing_dates(df, date=date).orderBy(date).limit(n)


def is_continuous(df: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """Whether each key has a row on every day of its span."""
    days = F.datediff(F.max(date), F.min(date)) + 1
    present = df.select(*keys, date).distinct()
    return present.groupBy(*keys).agg((F.count(date) == days).alias("continuous"))
