"""Exact running totals, quantiles and row positions without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialize

CUTS = 256


def _search(df: DataFrame, value: Column) -> DataFrame:
    """Adds ``_bucket``, the number of cut points in ``_cuts`` below the value, by binary search."""
    names, steps = [c for c in df.columns if c != "_cuts"], [F.lit(0).alias(f"_at{CUTS}")]
    step = CUTS // 2
    while step:
        at = F.col(f"_at{2 * step}")
        steps.append(F.when(F.get("_cuts", at + (step - 1)) < value, at + step).otherwise(at).alias(f"_at{step}"))
        step //= 2
    return df.select("*", *steps).select(*names, F.col("_at1").alias("_bucket"))


def bucketed(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Adds ``_bucket``: an order-keeping split of each key's distinct values into even parts.

    The cut points are approximate quantiles of the distinct values (at most 255 numbers per key); they
    only balance the parts, results do not depend on them.
    """
    number = F.col(value).cast("double")
    cut = F.percentile_approx(number, [i / CUTS for i in range(1, CUTS)], 10 * CUTS)
    if keys:
        cuts = counts.groupBy(*keys).agg(cut.alias("_cuts"))
        # with one row per listed column the cuts are small, and a join by column would put each column in one task
        tagged = counts.join(F.broadcast(cuts) if keys == ["column"] else cuts, keys)
    else:
        tagged = counts.withColumn("_cuts", counts.agg(cut.alias("_cuts")).scalar())
    return _search(tagged, number)


def _partition(keys: list[str]):
    return keys or [F.lit(0)]


def bucket_totals(tagged: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Per bucket: its totals, and the totals of the buckets before it. At most 256 rows per key."""
    sums = tagged.groupBy(*keys, "_bucket").agg(*[F.sum(m).alias(m) for m in measures])
    before = Window.partitionBy(*_partition(keys)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("*", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_before_{m}") for m in measures])


def running_totals(counts: DataFrame, keys: list[str], value: str, measures: list[str]) -> DataFrame:
    """Adds ``<m>_upto``: the total of each measure over values up to and including the row's.

    ``counts`` has one row per key and value. Totals run inside a bucket and start from the sum of the
    buckets before it, so the work of one key is spread over the buckets.
    """
    tagged = bucketed(counts, keys, value)
    offsets = bucket_totals(tagged, keys, measures).drop(*measures)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    joined = tagged.join(offsets, [*keys, "_bucket"])
    totals = [(F.sum(m).over(inside) + F.col(f"_before_{m}")).alias(f"{m}_upto") for m in measures]
    return joined.select(*counts.columns, *totals)


def exact_quantiles(df: DataFrame, value: str, probs: list[float], keys: list[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles as rows ``(keys, prob, quantile)``.

    Counts each distinct value, finds by bucket totals which buckets hold the wanted ranks, and sorts
    only those.
    """
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")) \
        .agg(F.count("*").alias("_n"))
    tagged = bucketed(counts, keys, "_v")
    totals = bucket_totals(tagged, keys, ["_n"])
    all_rows = F.sum("_n").over(Window.partitionBy(*_partition(keys)))
    sized = totals.withColumn("_last", (all_rows - 1).cast("double"))

    def edges(p):
        at = p * F.col("_last")
        part = at - F.floor(at)
        return F.array(
            F.struct(p.alias("prob"), F.floor(at).alias("rank"), (1 - part).alias("weight")),
            F.struct(p.alias("prob"), (F.floor(at) + 1).alias("rank"), part.alias("weight")))

    ranks = F.flatten(F.transform(F.array(*[F.lit(float(p)) for p in probs]), edges))
    wanted = (
        sized.withColumn("_w", F.explode(ranks))
        .where((F.col("_w.weight") > 0) & (F.col("_w.rank") >= F.col("_before__n"))
               & (F.col("_w.rank") < F.col("_before__n") + F.col("_n")))
        .groupBy(*keys, "_bucket", "_before__n").agg(F.collect_list("_w").alias("_wanted"))
    )
    # each bucket that holds a rank once, with its few ranks as an array
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = tagged.join(wanted, [*keys, "_bucket"]).withColumn("_end", F.sum("_n").over(inside) + F.col("_before__n"))
    hits = placed.withColumn("_hits", F.filter(
        "_wanted", lambda w: (w["rank"] < F.col("_end")) & (w["rank"] >= F.col("_end") - F.col("_n"))))
    return (
        hits.where(F.size("_hits") > 0)
        .select(*keys, "_v", F.explode("_hits").alias("_w"))
        .groupBy(*keys, F.col("_w.prob").alias("prob"))
        .agg(F.sum(F.col("_v") * F.col("_w.weight")).alias("quantile"))
    )


def quantile_columns(df: DataFrame, value: str, probs: dict[str, float], keys: list[str] = ()) -> DataFrame:
    """The quantiles as one named column each, one row per key."""
    rows = exact_quantiles(df, value, list(probs.values()), keys)
    return rows.groupBy(*keys).agg(*[
        F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for name, p in probs.items()])


def rows_at(df: DataFrame, order: list[str], ranks: Callable[[Column], list[Column]]) -> DataFrame:
    """The order keys of the rows at some 0-based positions, as ``(_rank, order columns)``.

    ``ranks`` gets the row count. A position asked for twice comes twice, one at or past the row count not at
    all. The position is narrowed level by level: totals per first column, then per second column within the
    values found, and so on; no level sorts the whole table. The first column is a date, so its totals are
    bounded by the calendar.
    """
    first = order[0]
    if isinstance(df.schema[first].dataType, (T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{first} has more values than a calendar has days; order by its date first")
    totals = df.groupBy(first).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(F.lit(0)).orderBy(first)
    placed = totals.select(
        first, "_n", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_all"))
    found = (
        placed.withColumn("_rank", F.explode(F.array(*ranks(F.col("_all")))))
        .where((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_n")))
        .select(first, "_rank", (F.col("_rank") - F.col("_start")).alias("_rest"))
    )
    for depth in range(1, len(order)):
        path, col = order[:depth], order[depth]
        inside = df.join(found.select(*path).distinct(), path, "left_semi")
        totals = inside.groupBy(*path, col).agg(F.count("*").alias("_n"))
        w = Window.partitionBy(*path).orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
        starts = totals.withColumn("_start", F.coalesce(F.sum("_n").over(w), F.lit(0)))
        found = (
            starts.join(found, path)
            .where((F.col("_rest") >= F.col("_start")) & (F.col("_rest") < F.col("_start") + F.col("_n")))
            .select(*path, col, "_rank", (F.col("_rest") - F.col("_start")).alias("_rest"))
        )
    return found.drop("_rest")


def segment_by_rank(df: DataFrame, order: list[str], ranks: Callable[[Column], list[Column]],
                    name: str = "segment") -> DataFrame:
    """Number of cut positions at or before each row: 0 before the first cut, 1 before the second, … Equal cuts
    count each, a cut at 0 lies before all rows, one at the row count or beyond after all.

    ``order`` must identify a row. Rows are compared with the cut rows' keys, so the table itself is
    neither sorted nor shuffled.
    """
    # the order columns are read level by level: stored once, so that the table is read twice in all
    cuts = rows_at(materialize(df.select(*order)), order, ranks)
    bounds = cuts.agg(F.array_sort(F.collect_list(F.struct(*order))).alias("b")).scalar()
    return (
        df.withColumn("_bounds", bounds)
        .withColumn(name, F.size(F.filter("_bounds", lambda b: b <= F.struct(*order))))
        .drop("_bounds")
    )
