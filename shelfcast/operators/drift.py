"""Distribution and performance drift between two periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import kolmogorov_p
from ..functions.special import chi2_tail
from .evaluate import METRICS, error_metrics
from .ordered import running_totals


def value_counts(df: DataFrame, cols: list[str], kind: str = "double") -> DataFrame:
    """Occurrences of each known value, as ``(column, value, n)``."""
    rows = df.select(*[F.col(c).cast(kind).alias(c) for c in cols]).unpivot([], cols, "column", "value")
    return rows.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))


def _side_counts(reference: DataFrame, current: DataFrame, cols: list[str], kind: str) -> DataFrame:
    """Occurrences of each value on both sides, as ``(column, value, n_ref, n_cur)``."""
    return both_sides(value_counts(reference, cols, kind), value_counts(current, cols, kind))


def both_sides(reference: DataFrame, current: DataFrame) -> DataFrame:
    both = reference.withColumn("_ref", F.lit(1)).unionByName(current.withColumn("_ref", F.lit(0)))
    return both.groupBy("column", "value").agg(
        F.sum(F.col("n") * F.col("_ref")).alias("n_ref"), F.sum(F.col("n") * (1 - F.col("_ref"))).alias("n_cur"))


def ks_drift(reference: DataFrame, current: DataFrame, cols: list[str], alpha: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov statistic and asymptotic p-value of each column."""
    return ks_of_counts(_side_counts(reference, current, cols, "double"), alpha)


def ks_of_counts(counts: DataFrame, alpha: float = 0.05) -> DataFrame:
    """The same from ``(column, value, n_ref, n_cur)``."""
    totals = counts.groupBy("column").agg(F.sum("n_ref").alias("n"), F.sum("n_cur").alias("m"))
    cumulative = running_totals(counts, ["column"], "value", ["n_ref", "n_cur"])
    gap = F.abs(F.try_divide(F.col("n_ref_upto"), F.col("n")) - F.try_divide(F.col("n_cur_upto"), F.col("m")))
    # ``totals`` has one row per listed column
    widest = cumulative.join(F.broadcast(totals), "column").groupBy("column").agg(
        F.max(gap).alias("ks_stat"), F.first("n").alias("n"), F.first("m").alias("m"))
    scored = widest.withColumn("p_value", kolmogorov_p(F.col("ks_stat"), F.col("n"), F.col("m")))
    return scored.withColumn("is_drift", F.col("p_value") < alpha)


def ks_by_group(reference: DataFrame, current: DataFrame, by: list[str], alpha: float = 0.05) -> DataFrame:
    """The same for many current groups against one reference, from ``(column, value, n)`` and ``(by, column, value, n)``.

    The two distribution functions are furthest apart at a current value or just before one, so the reference is looked up
    at the current values only and never repeated per group.
    """
    reference = reference.select("column", "value", "n")
    # the reference's totals up to every value of either side
    places = reference.select("column", "value", F.col("n").alias("n_ref")).unionByName(
        current.select("column", "value", F.lit(0).cast("long").alias("n_ref"))).groupBy("column", "value").agg(F.sum("n_ref").alias("n_ref"))
    ref = running_totals(places, ["column"], "value", ["n_ref"]).select("column", "value", "n_ref", "n_ref_upto")
    cur = running_totals(current.select(*by, "column", "value", "n"), [*by, "column"], "value", ["n"])
    sizes = current.groupBy(*by, "column").agg(F.sum("n").alias("m"))
    total = reference.groupBy("column").agg(F.sum("n").alias("_total"))
    # ``total`` has one row per listed column
    joined = cur.join(ref, ["column", "value"]).join(sizes, [*by, "column"]).join(F.broadcast(total), "column", "left")

    def gap(upto_ref, upto_cur):
        return F.abs(F.try_divide(upto_ref, F.col("_total")) - upto_cur / F.col("m"))
    at, before = gap(F.col("n_ref_upto"), F.col("n_upto")), gap(F.col("n_ref_upto") - F.col("n_ref"), F.col("n_upto") - F.col("n"))
    widest = joined.groupBy(*by, "column").agg(F.max(F.greatest(at, before)).alias("ks_stat"), F.first("_total").alias("n"),
                                               F.first("m").alias("m"))
    scored = widest.withColumn("p_value", kolmogorov_p(F.col("ks_stat"), F.col("n"), F.col("m")))
    return scored.withColumn("is_drift", F.col("p_value") < alpha)


def moment_drift(reference: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """Change of mean and sample deviation, as ``(column, mean_diff, std_diff)``."""
    def moments(df, tag):
        return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value") \
            .groupBy("column").agg(F.avg("value").alias(f"mean_{tag}"), F.stddev_samp("value").alias(f"std_{tag}"))
    both = moments(reference, "ref").join(moments(current, "cur"), "column")
    return both.select("column", (F.col("mean_cur") - F.col("mean_ref")).alias("mean_diff"),
                       (F.col("std_cur") - F.col("std_ref")).alias("std_diff"))


def chi2_drift(reference: DataFrame, current: DataFrame, cols: list[str], alpha: float = 0.05) -> DataFrame:
    """Chi-square statistic of the category counts of both sides, per column."""
    counts = _side_counts(reference, current, cols, "string")
    totals = counts.groupBy("column").agg(F.sum("n_ref").alias("n"), F.sum("n_cur").alias("m"))
    joined = counts.join(F.broadcast(totals), "column")
    all_rows, row = F.col("n") + F.col("m"), F.col("n_ref") + F.col("n_cur")

    def term(observed, side):
        expected = row * F.col(side) / all_rows
        return F.try_divide((F.col(observed) - expected) * (F.col(observed) - expected), expected)
    scored = joined.groupBy("column").agg(
        F.sum(term("n_ref", "n") + term("n_cur", "m")).alias("statistic"), (F.count("*") - 1).alias("df"))
    return scored.withColumn("p_value", chi2_tail("statistic", "df")).withColumn("is_drift", F.col("p_value") < alpha)


def concept_drift(reference: DataFrame, current: DataFrame, keys: list[str] = ("model",)) -> DataFrame:
    """Errors in both periods with their difference and ratio, as ``(keys, metric, …)``."""
    def long(df, tag):
        wide = error_metrics(df, list(keys)).select(*keys, *METRICS)
        return wide.unpivot(list(keys), METRICS, "metric", tag)
    both = long(reference, "reference").join(long(current, "current"), [*keys, "metric"])
    return both.withColumns({
        "diff": F.col("current") - F.col("reference"),
        "ratio": F.try_divide(F.col("current"), F.col("reference"))})
