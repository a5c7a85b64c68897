"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target number of words. Its complete epochs (every document, once each) come first; what is left
of the target is filled with documents in the order of exponential keys, -ln(u) / quality weight, where u comes from a
hash of the document, so that reruns agree. The keys are sorted within the source over many tasks and the sizes
prefix-summed to the budget. A document that would cross the budget is left out, and the small rest is filled by further
prefix sums over the documents that still fit until none does, at last by the one smallest document if that
brings the source nearer to its target: then it misses by at most half of that document. Documents are taken whole.

Defined results: a NULL text has size 0; documents of size 0 are taken with complete epochs only and count nothing.
Sources are ordered by code point, NULL last, and weigh 5, 2, 1, repeating. Rows equal in doc_id and text have equal
keys; which of them is taken is not told apart. A source of no words has target 0. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import free_name, numbered, running_sums, stored

WORD = "[^\\x20\\x09-\\x0D]+"
CYCLE = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_EPOCHS = 2
#: Weight of a document by its quality label; unlabelled documents weigh 1.
QUALITY_WEIGHT = {1: 2.0, 0: 0.5}


def targets(sizes: list[tuple[str | None, int]], share: float = SHARE, cycle=CYCLE, most: int = MOST_EPOCHS):
    """(source, size, target) for each source: ``share`` of all sizes dealt by weight, stopped at ``most`` times
    the source, the excess dealt again by weight until none is above."""
    ordered = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = [cycle[i % len(cycle)] for i in range(len(ordered))]
    cap = [float(most * n) for _, n in ordered]
    target = [0.0] * len(ordered)
    left, open_ = share * sum(n for _, n in ordered), set(range(len(ordered)))
    while open_:
        total = sum(weight[i] for i in open_)
        full = [i for i in sorted(open_) if left * weight[i] / total > cap[i]]
        if not full:
            for i in open_:
                target[i] = left * weight[i] / total
            break
        for i in full:
            target[i] = cap[i]
            open_.discard(i)
        left -= sum(cap[i] for i in full)
    return [(s, n, t) for (s, n), t in zip(ordered, target)]


def _source_plan(rows: DataFrame) -> DataFrame:
    """source, source_size, target, epochs, budget. The sources are the mix's settings, one row each; they are the
    only thing the driver sees."""
    sums = [(r.source, r.n) for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    made = []
    for source, size, target in targets(sums):
        epochs = min(MOST_EPOCHS, int(target // size)) if size else 0
        made.append((source, size, target, epochs, max(0, round(target - epochs * size)) if size else 0))
    return rows.sparkSession.createDataFrame(
        made, "source string, source_size long, target double, epochs int, budget long")


def _joined(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    right = by_source.withColumnRenamed("source", "source_key")
    return rows.join(F.broadcast(right), rows["source"].eqNullSafe(right["source_key"])).drop("source_key")


def mix(rows: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """``rows`` has row_no, doc_id, source, size, text_hash. Returns them with weight, source_size, target and copies,
    how many times the mix takes the document. What grows with the documents is merged, never broadcast: stored row numbers
    are a few bytes each, and tens of bytes in the driver's tables."""
    if quality is not None:
        label = quality.groupBy("doc_id").agg(F.max("quality").alias("quality")).withColumnRenamed("doc_id", "label_id")
        rows = rows.join(label.hint("merge"), rows["doc_id"] == label["label_id"], "left").drop("label_id")
        weight = F.lit(1.0)
        for value, w in QUALITY_WEIGHT.items():
            weight = F.when(F.col("quality") == value, w).otherwise(weight)
        rows = rows.withColumn("weight", weight).drop("quality")
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash", F.lit("mix")), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    rows = stored(rows.withColumn("key", -F.log(uniform) / F.col("weight")), "mix-rows")
    plan = _source_plan(rows)

    rest = _joined(rows, plan).where("size > 0 AND budget > 0").select("row_no", "source", "size", "key", "budget")
    chosen = None
    while True:
        summed = running_sums(rest.where("size <= budget"), ["source", "key", "row_no"], "size", "before", "source")
        summed = stored(summed.withColumn("take", F.col("before") + F.col("size") <= F.col("budget")), "mix-sums")
        took = summed.where("take").select("row_no", "source", "size")
        chosen = took if chosen is None else chosen.unionByName(took)
        spent = [(r.source, r.n) for r in took.groupBy("source").agg(F.sum("size").alias("n")).collect()]
        if not spent:
            break
        used = rows.sparkSession.createDataFrame(spent, "source string, spent long")
        # rows larger than the budget of this turn can only come back in the last step
        rest = rest.join(took.select("row_no").hint("merge"), "row_no", "left_anti")
        right = used.withColumnRenamed("source", "source_key")
        rest = (rest.join(F.broadcast(right), rest["source"].eqNullSafe(right["source_key"]), "left")
                .withColumn("budget", F.col("budget") - F.coalesce("spent", F.lit(0))).drop("source_key", "spent"))
        rest = stored(rest.where("budget > 0"), "mix-rest")
    nearest = rest.where("budget > 0").groupBy("source").agg(
        F.min(F.struct("size", "key", "row_no")).alias("m"), F.max("budget").alias("budget"))
    nearest = nearest.where("m.size < 2 * budget").select(F.col("m.row_no").alias("row_no"))
    extra = chosen.select("row_no").unionByName(nearest).withColumn("extra", F.lit(1))
    return _joined(rows, plan).join(extra.hint("merge"), "row_no", "left").withColumn(
        "copies", F.col("epochs") + F.coalesce("extra", F.lit(0))).drop("key", "epochs", "budget", "extra")


def sized(docs: DataFrame, row: str = "row_no") -> DataFrame:
    """row_no, doc_id, source, size, text_hash of numbered documents."""
    return docs.select(
        F.col(row).alias("row_no"), "doc_id", "source",
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"))


def mixture(docs: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix takes)."""
    rows = stored(sized(docs.withColumn("mix_row", F.monotonically_increasing_id()), "mix_row"), "sizes")
    return mix(rows, quality).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all columns."""
    row = free_name(docs, "mix_row")
    kept = numbered(docs, row)
    copies = mix(stored(sized(kept, row), "sizes"), quality).where("copies > 0").select(F.col("row_no").alias(row), "copies")
    many = free_name(docs, "copies")
    joined = kept.join(copies.withColumnRenamed("copies", many), row)
    return joined.withColumn(many, F.explode(F.sequence(F.lit(1), F.col(many)))).select(*[F.col(f"`{c}`") for c in docs.columns])
