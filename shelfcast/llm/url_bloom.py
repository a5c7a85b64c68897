"""URL filters: a blocked Bloom filter of listed URLs in front of an exact hash join, in DataFrame functions only.

Listed keys are canonical URLs (host without ``www.``, path without a closing slash) and rules, a host with the start
of a path. All keys of both lists go into one Bloom filter of 512-bit blocks: a key picks one block and sets one bit in
each of the block's eight words. A page asks for its canonical URL and, for every shape of rule (labels of the host,
length of the path), for its own host end and path start of that shape. Keys that pass all eight bits are possible
hits; a hash join with the lists drops the false positives. The filter is a table of blocks, joined by block number,
so Spark chooses by its size how to join it.

Defined results: a NULL url, or one without ``://``, has empty host and path, fits no rule, is not listed and is
allowed. Hosts are compared with A-Z lowered, other letters as they are. Of the rules that fit, the longest (host and path) wins;
of equally long ones a block rule, then the first by code point. Repeated rows are judged each. Empty tables and lists are allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import stored

WORDS = 8
#: Filter bits per key; with one bit in each of eight words about one key in a thousand passes falsely.
BITS_PER_KEY = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url):
    """Host and path columns of a url column."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def canonical(host, path):
    """Host without ``www.`` and path without closing slashes, as one key."""
    return F.concat(F.regexp_replace(host, "^www\\.", ""), F.rtrim(path, F.lit("/")))


def _bit(word: int):
    return F.shiftrightunsigned("bits", 6 * word).bitwiseAND(F.lit(63)).cast("int")


def _placed(keys: DataFrame, blocks: int) -> DataFrame:
    """keys (key) with its block and the hash its bit positions come from."""
    return keys.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))).withColumn(
        "bits", F.xxhash64("key", F.lit("bits")))


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7) of the distinct or repeated ``key`` values; repeated keys set the same bits."""
    one = F.lit(1).cast("long")
    return _placed(keys, blocks).groupBy("block").agg(
        *[F.bit_or(F.call_function("shiftleft", one, _bit(i))).alias(f"w{i}") for i in range(WORDS)])


def possible(rows: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """The rows whose ``key`` may be in the filter."""
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.call_function("shiftrightunsigned", F.col(f"w{i}"), _bit(i)).bitwiseAND(F.lit(1)) == 1)
    return _placed(rows, blocks).join(filter_, "block").where(hit).select(*rows.columns)


def listed_by_label(pages: DataFrame, labels: list[str]) -> DataFrame:
    """Canonical URLs (key) of the pages whose host has one of the labels: the list of bad sites the query uses."""
    host, path = host_and_path(F.col("url"))
    bad = F.arrays_overlap(F.split(F.col("host"), "\\."), F.array(*[F.lit(x) for x in labels]))
    return pages.select(host.alias("host"), path.alias("path")).where(bad).select(
        canonical(F.col("host"), F.col("path")).alias("key")).distinct()


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, listed. ``rules`` are (verdict, host, path start),
    settings of the filter; ``listed`` has canonical URLs in ``key``, of any number."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    rows = stored(pages.select(F.monotonically_increasing_id().alias("row_no"), "page_id", host.alias("host"),
                               path.alias("path")), "urls")
    named = [(f"r {h} {p}", h + p, v, len(h + p)) for v, h, p in rules]
    rule_keys = spark.createDataFrame(named or [], "key string, rule string, rule_verdict string, rule_length int")
    keys = listed.select(F.concat(F.lit("u "), "key").alias("key")).unionByName(rule_keys.select("key")).distinct()
    lists = stored(keys.join(rule_keys, "key", "left"), "listed")
    blocks = max(1, -(-lists.count() * BITS_PER_KEY // 512))
    filter_ = stored(bloom_filter(lists.select("key"), blocks), "bloom")

    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules})
    labels = F.size(F.split(F.col("host"), "\\."))
    asked = [F.concat(F.lit("u "), canonical(F.col("host"), F.col("path")))]
    for n, length in shapes:
        fits = (F.col("host") != "") & (labels >= n) & (F.length("path") >= length)
        end = F.substring_index(F.col("host"), ".", -n)
        asked.append(F.when(fits, F.concat(F.lit("r "), end, F.lit(" "), F.substring("path", 1, length))))
    asks = rows.select("row_no", F.explode(F.array_compact(F.array(*asked))).alias("key"))
    hits = possible(asks, filter_, blocks)

    # the stored lists are a side of their own, so that a key most pages ask for can be split
    found = hits.join(lists.hint("shuffle_hash"), "key").groupBy("row_no").agg(
        F.min(F.when(F.col("rule").isNotNull(), F.struct(
            (-F.col("rule_length")).alias("shorter"), (F.col("rule_verdict") != "block").alias("allows"),
            F.col("rule").alias("rule"), F.col("rule_verdict").alias("rule_verdict")))).alias("best"),
        F.max(F.col("rule").isNull()).alias("listed"))
    return rows.join(found, "row_no", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.rule_verdict"), F.when(F.col("listed"), F.lit("block")), F.lit("allow")).alias("verdict"),
        F.coalesce("listed", F.lit(False)).alias("listed"))
