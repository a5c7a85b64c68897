"""Exact dedup by deterministic block naming, in DataFrame and SQL functions only.

A text is cut into blocks of ``BLOCK_BYTES`` bytes of its UTF-8 form. Sorted blocks get integer names: equal blocks
the same name, different blocks different names. Then neighbouring names are paired and the pairs named again, until
each text has one name. Names are ranks in sorted order, not hashes, so they cannot collide; together with the number
of blocks they identify a text.

Blocks are sorted inside many small buckets (20 bits of a hash of the block), and the bucket is part of the name. A
block that occurs very often would fill its bucket, so the most frequent block hashes are found first, their
occurrences are dealt over several salted buckets, and the few names of each such block are merged afterwards.

Defined results: a NULL text counts as empty; all empty texts are equal. Of equal texts the row with the largest
doc_id stays, a NULL id counting as smaller than any; of rows equal in text and id, one stays. An empty table gives an
empty result. Other columns of the input may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import free_name, stored

BLOCK_BYTES = 16384
BUCKET_BITS = 20
#: Blocks that occur more often than HOT_COUNT times are salted: the HOT_BLOCKS most frequent ones, into about
#: HOT_SALTS salts altogether. Any other block has at most 1/HOT_BLOCKS of all occurrences.
HOT_COUNT, HOT_BLOCKS, HOT_SALTS = 64, 4096, 4096


def _blocks(docs: DataFrame, text: str, block_bytes: int) -> DataFrame:
    """One row per block: the columns of ``docs``, block_count, position, block (binary)."""
    count = F.greatest(F.lit(1), F.ceil(F.length("bytes") / block_bytes)).cast("int")
    cut = docs.withColumn("bytes", F.coalesce(F.col(text), F.lit("")).cast("binary")).withColumn("block_count", count)
    return (cut.withColumn("position", F.explode(F.sequence(F.lit(0), F.col("block_count") - 1)))
            .withColumn("block", F.substring("bytes", F.col("position") * block_bytes + 1, F.lit(block_bytes))))


def _hot_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """The most frequent block hashes and their number of salts; at most HOT_BLOCKS rows."""
    counts = (_blocks(docs, "text", block_bytes).groupBy(F.xxhash64("block").alias("hash")).agg(F.count("*").alias("n"))
              .where(F.col("n") > HOT_COUNT).orderBy(F.desc("n"), "hash").limit(HOT_BLOCKS))
    rows = counts.collect()  # at most HOT_BLOCKS pairs of numbers
    total = sum(r.n for r in rows) or 1
    made = [(r.hash, max(2, min(-(-r.n // HOT_COUNT), -(-r.n * HOT_SALTS // total)))) for r in rows]
    return docs.sparkSession.createDataFrame(made, "hash long, salts int")


def _name_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """One row per block, without its bytes: row_no, doc_id, sha, block_count, position, name."""
    hot = _hot_blocks(docs, block_bytes)
    blocks = _blocks(docs.withColumn("row_no", F.monotonically_increasing_id()), "text", block_bytes)
    rows = (blocks.withColumn("sha", F.when(F.col("position") == 0, F.sha2("bytes", 256)))
            .withColumn("hash", F.xxhash64("block")).join(F.broadcast(hot), "hash", "left")
            .withColumn("bucket", F.shiftrightunsigned("hash", 64 - BUCKET_BITS))
            .withColumn("salt", F.when(F.col("salts").isNotNull(),
                                       1 + F.pmod(F.xxhash64("row_no", "position"), F.col("salts"))).otherwise(F.lit(0)))
            .select("row_no", "doc_id", "sha", "block_count", "position", "bucket", "salt", "block"))
    named = docs.sparkSession.sql("""
        SELECT row_no, doc_id, sha, block_count, position,
               shiftleft(bucket, 42) + shiftleft(salt, 28) + dense_rank() OVER w AS name,
               CASE WHEN salt > 0 AND lag(block) OVER w IS DISTINCT FROM block THEN block END AS sample
        FROM {rows} WINDOW w AS (PARTITION BY bucket, salt ORDER BY block)""", rows=rows)
    named = stored(named, "block-names")
    # one row per salted name; at most HOT_BLOCKS + HOT_SALTS blocks, whatever the size of the table
    samples = named.where(F.col("sample").isNotNull()).select("sample", "name")
    first = samples.groupBy("sample").agg(F.min("name").alias("canon"))
    same = samples.join(first, "sample").select("name", "canon")
    return (named.drop("sample").join(F.broadcast(same), "name", "left")
            .withColumn("name", F.coalesce("canon", "name")).drop("canon"))


def _name_pairs(names: DataFrame) -> DataFrame:
    """Half as many positions per row: neighbouring names paired, and the pairs named in sorted order."""
    half = F.floor(F.col("position") / 2)
    pairs = names.groupBy("row_no", half.alias("position")).agg(
        F.max(F.when(F.col("position") % 2 == 0, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(F.col("position") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
    distinct = pairs.select("a", "b").distinct().withColumn(
        "bucket", F.shiftrightunsigned(F.xxhash64("a", "b"), 64 - BUCKET_BITS))
    named = names.sparkSession.sql("""
        SELECT a, b, shiftleft(bucket, 42) + dense_rank() OVER (PARTITION BY bucket ORDER BY a, b) AS name
        FROM {distinct}""", distinct=distinct)
    return pairs.join(named, ["a", "b"]).select("row_no", "position", "name")


def text_names(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): row_no, doc_id, text_sha256, block_count, name. Two rows agree in
    (block_count, name) exactly if their texts are equal."""
    blocks = stored(_name_blocks(docs.select("doc_id", "text"), block_bytes), "blocks")
    first = blocks.where("position = 0").select("row_no", "doc_id", F.col("sha").alias("text_sha256"), "block_count", "name")
    most = blocks.agg(F.max("block_count").alias("most")).first().most or 1
    if most == 1:
        return first.select("row_no", "doc_id", "text_sha256", "block_count", "name")
    level = blocks.where("block_count > 1").select("row_no", "position", "name")
    while most > 1:
        level = stored(_name_pairs(level), "pair-names")
        most = -(-most // 2)
    long_names = level.select("row_no", F.col("name").alias("whole"))
    return first.join(long_names, "row_no", "left").select(
        "row_no", "doc_id", "text_sha256", "block_count", F.coalesce("whole", "name").alias("name"))


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, and twins, the number of rows
    that are equal to it in text and doc_id."""
    rows = stored(text_names(docs, block_bytes), "text-names")
    twins = rows.groupBy("block_count", "name", "doc_id").agg(F.count("*").alias("twins"), F.max("row_no").alias("row_no"))
    groups = twins.groupBy("block_count", "name").agg(
        F.max_by(F.struct("doc_id", "row_no", "twins"), F.struct("doc_id", "row_no")).alias("keep"),
        F.sum("twins").alias("group_size"))
    groups = stored(groups, "text-groups")  # so that the join's large groups can be split
    return rows.join(groups, ["block_count", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row_no") == F.col("keep.row_no")).alias("kept"), "text_sha256", F.col("keep.twins").alias("twins"))


def dedup_exact(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Of rows equal in id and text one stays: the one whose other
    columns (but those with a MAP or VARIANT in them, which have no order) hash highest."""
    sha, key = free_name(docs, "text_sha"), free_name(docs, "keep_doc_id")
    other = free_name(docs, "other_sha")
    kept = stored(exact_groups(docs, block_bytes).where("kept").select(
        F.col("doc_id").alias(key), F.col("text_sha256").alias(sha), "twins"), "kept")
    rows = docs.withColumn(sha, F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))

    def of(keys: DataFrame) -> DataFrame:
        return rows.join(keys.withColumnRenamed(sha, other),
                         rows["doc_id"].eqNullSafe(keys[key]) & (rows[sha] == F.col(other)), "left_semi")

    once = of(kept.where("twins = 1")).drop(sha)
    repeated = kept.where("twins > 1")
    if repeated.isEmpty():
        return once
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    picked = of(repeated).groupBy("doc_id", sha).agg(F.max_by(whole, F.xxhash64(*hashed)).alias("r"))
    return once.unionByName(picked.select(*[F.col(f"r.`{c}`").alias(c) for c in docs.columns]))
