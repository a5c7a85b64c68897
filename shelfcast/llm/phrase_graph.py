"""Phrase collocations from a weighted de Bruijn graph of word four-grams.

Nodes are three words, an edge is a four-gram from its first three words to its last three, weighted by its occurrences.
Every word position of a piece of text is counted once, under the longest phrase that begins there and may still be frequent: four
words, or fewer at the end of a piece or before a pair of words that is surely rare. So the count of a shorter phrase is the flow out
of it, over all longer phrases that begin with it, plus the corrections counted under the phrase itself; counts of one
and two words come from those of one more in the same way.

Surely rare pairs are known from a sieve, a bit for each of at most ``MOST_SLOTS`` hash slots that tells whether all pairs of the
slot together reach ``least``. It only removes phrases that cannot be candidates. Its slots grow with the text up to that bound (16 MB
broadcast); beyond it the sieve lets more phrases through, and the counts stay exact.

A node with one frequent edge in and one out, both of its whole count, is unary: the two edges belong to one path. Paths
are compacted by pointer doubling, in rounds logarithmic in the longest path. A three-word phrase inside a path is as frequent as
the edge that holds it, so it is no collocation of its own and is left out before any score is computed.

Defined results: NULL text counts as empty, NULL language as ``und``. Only A-Z are lowered. Repeated rows count again. Empty tables
and texts give no rows; other columns may have any name. Memory of a task: about
twenty times ``RUN_BYTES`` of text or its longest text, and a byte per slot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import batch_of, stored, text_runs

LEAST = 30
LONGEST = 4
TOP = 2000
RUN_BYTES = 4 << 20
#: Bytes of text per slot of the sieve, and bounds of their number.
SLOT_BYTES, LEAST_SLOTS, MOST_SLOTS = 32, 1 << 20, 1 << 27
RANGE_SLOTS = 1 << 16

_MARKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_MARKS + b"\t" + bytes(range(65, 91)), b"." * len(_MARKS) + b" " + bytes(range(97, 123)))

SIEVE = T.StructType([T.StructField("slots", T.IntegerType()), T.StructField("counts", T.BinaryType())])
FLOWS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("phrase", T.StringType()),
                      T.StructField("size", T.IntegerType()), T.StructField("n", T.LongType())])


class _Run:
    """Whole texts by language."""

    def __init__(self):
        self.parts: dict[str, list[bytes]] = {}
        self.size = 0

    def add(self, text: bytes, lang: str) -> None:
        self.parts.setdefault(lang, []).append(text.translate(_TABLE))
        self.size += len(text)

    def sequences(self):
        """(lang, distinct words, numbers) of each language: number 0, a full stop, ends a piece, and enough of them the
        numbers."""
        while self.parts:
            lang, parts = self.parts.popitem()
            text = b".".join([b"", *parts, b"." * LONGEST]).replace(b".", b" . ")
            del parts
            words = pc.ascii_split_whitespace(pa.array([text], pa.large_string())).flatten()
            # the text begins and ends with white space
            coded = words.slice(1, len(words) - 2).dictionary_encode()
            yield lang, coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _runs(batches):
    run = _Run()
    for batch in batches:
        langs, at = batch.column(1).to_pylist(), 0
        for texts in text_runs(batch.column(0), binary=True):
            for text in texts:
                run.add(text, "und" if langs[at] is None else langs[at])
                at += 1
                if run.size >= RUN_BYTES:
                    yield run
                    run = _Run()
                    pa.default_memory_pool().release_unused()
    if run.size:
        yield run


def _slots_of(lang: str, words: pa.Array, numbers: np.ndarray, slots: int) -> np.ndarray:
    """The sieve slot of each pair of neighbours; pairs across the end of a piece have slots too, which nobody asks for."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words))
    left, right = hashes * np.uint64(0x9E3779B97F4A7C15 | 1), hashes ^ (hashes >> np.uint64(31))
    mixed = (left[numbers[:-1]] + right[numbers[1:]]) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def pair_sieve(docs: DataFrame, least: int, slots: int) -> np.ndarray:
    """One bit per slot: whether the pairs of neighbouring words that fall into it occur ``least`` times together."""
    most = min(least, 255)
    width = min(slots, RANGE_SLOTS)

    def count(batches):
        held = np.zeros(slots, np.uint8)
        for run in _runs(batches):
            for lang, words, numbers in run.sequences():
                inside = (numbers[:-1] > 0) & (numbers[1:] > 0)
                found, n = np.unique(_slots_of(lang, words, numbers, slots)[inside], return_counts=True)
                held[found] = np.minimum(held[found] + n, most)
        squeeze = zstandard.ZstdCompressor(level=1)
        for at in range(0, slots, width):
            part = held[at:at + width]
            if part.any():
                yield batch_of(SIEVE, [[at // width], [squeeze.compress(part.tobytes())]])

    def add(batches):
        number, total = None, None
        for batch in batches:
            for at, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at != number:
                    if number is not None:
                        yield batch_of(SIEVE, [[number], [np.packbits(total >= most).tobytes()]])
                    number, total = at, np.zeros(width, np.uint32)
                got = np.frombuffer(zstandard.ZstdDecompressor().decompress(counts), np.uint8)
                total = np.minimum(total + got, most).astype(np.uint32)
        if number is not None:
            yield batch_of(SIEVE, [[number], [np.packbits(total >= most).tobytes()]])

    counted = docs.mapInArrow(count, SIEVE).repartition("slots").sortWithinPartitions("slots").mapInArrow(add, SIEVE)
    bits = np.zeros(slots // 8, np.uint8)
    for row in counted.collect():  # a bit per slot, whatever the size of the table
        bits[row.slots * width // 8:(row.slots + 1) * width // 8] = np.frombuffer(row.counts, np.uint8)
    return bits


def flows(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, size, n): each word position counted under the longest phrase that begins there. Stored."""
    docs = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("size")).first().size or 0
    slots = max(LEAST_SLOTS, min(MOST_SLOTS, 1 << (size // SLOT_BYTES).bit_length()))
    sieve = docs.sparkSession.sparkContext.broadcast(pair_sieve(docs, least, slots))

    def count(batches):
        bits = sieve.value
        for run in _runs(batches):
            for lang, words, numbers in run.sequences():
                slot = _slots_of(lang, words, numbers, slots)
                goes_on = (numbers[:-1] > 0) & (numbers[1:] > 0) & (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1 > 0)
                at = np.flatnonzero(numbers)
                sizes = np.ones(len(at), np.int64)
                more = np.ones(len(at), bool)
                for i in range(LONGEST - 1):
                    more &= goes_on[np.minimum(at + i, len(goes_on) - 1)]
                    sizes += more
                for g in range(1, LONGEST + 1):
                    begins = at[sizes == g]
                    if not len(begins):
                        continue
                    low = numbers[begins] * len(words) + (numbers[begins + 1] if g > 1 else 0)
                    high = numbers[begins + 2] * len(words) + (numbers[begins + 3] if g > 3 else 0) if g > 2 else np.zeros_like(low)
                    order = np.lexsort((high, low)) if g > 2 else np.argsort(low)
                    low, high = low[order], high[order]
                    first = np.flatnonzero(np.concatenate(([True], (low[1:] != low[:-1]) | (high[1:] != high[:-1]))))
                    n = np.diff(np.append(first, len(low)))
                    places = begins[order][first]
                    for a in range(0, len(places), 1 << 16):
                        part = places[a:a + (1 << 16)]
                        taken = [words.take(pa.array(numbers[part + i])) for i in range(g)]
                        phrases = pc.binary_join_element_wise(*taken, pa.scalar(" ", pa.large_string())) if g > 1 else taken[0]
                        yield batch_of(FLOWS, [[lang] * len(part), phrases.cast(pa.string()), np.full(len(part), g, np.int32),
                                               n[a:a + (1 << 16)]])

    counted = docs.mapInArrow(count, FLOWS).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    return stored(counted, "flows")


def shorter_counts(flow: DataFrame) -> DataFrame:
    """(lang, phrase, size, n) of one to three words: flow out of the phrase plus what is counted under itself."""
    def first_words(size: int):
        return F.substring_index("phrase", " ", size).alias("phrase")

    levels, longer = [], flow.where(F.col("size") == LONGEST)
    for size in range(LONGEST - 1, 0, -1):
        ends = flow.where(F.col("size") == size)
        longer = longer.select("lang", first_words(size), "n").unionByName(ends.select("lang", "phrase", "n")).groupBy(
            "lang", "phrase").agg(F.sum("n").alias("n"))
        levels.append(longer.withColumn("size", F.lit(size)))
    return levels[0].unionByName(levels[1]).unionByName(levels[2]).select("lang", "phrase", "size", "n")


def compacted(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``edges`` (lang, phrase, n) with the first edge of their path, ``head``, and their ``place`` behind it; ``nodes``
    (lang, phrase, n) are the counts of three words. Stored."""
    ends = edges.withColumn("source", F.substring_index("phrase", " ", LONGEST - 1)).withColumn(
        "target", F.substring_index("phrase", " ", 1 - LONGEST))
    out = ends.groupBy("lang", "source").agg(F.count("*").alias("outs"), F.max("phrase").alias("next"), F.max("n").alias("n"))
    into = ends.groupBy("lang", "target").agg(F.count("*").alias("ins"), F.max("phrase").alias("previous"), F.max("n").alias("in_n"))
    unary = (out.where("outs = 1").withColumnRenamed("source", "node").join(
        into.where("ins = 1").withColumnRenamed("target", "node"), ["lang", "node"]).where("n = in_n")
        .join(nodes.withColumnRenamed("phrase", "node"), ["lang", "node", "n"]))
    links = unary.select("lang", F.col("next").alias("phrase"), "previous")
    paths = stored(edges.join(links, ["lang", "phrase"], "left").select(
        "lang", "phrase", "n", F.coalesce("previous", "phrase").alias("head"),
        F.when(F.col("previous").isNull(), 0).otherwise(1).cast("long").alias("place")), "paths")
    while True:
        # no cycles: a piece that runs along a path began at a node whose count is above the flow into it
        before = paths.select("lang", F.col("phrase").alias("head"), F.col("head").alias("first"), F.col("place").alias("more"))
        joined = stored(paths.join(before, ["lang", "head"]).select(
            "lang", "phrase", "n", F.col("first").alias("head"), (F.col("place") + F.col("more")).alias("place"), "more"), "paths")
        paths = joined.drop("more")
        if joined.where("more > 0").isEmpty():
            return paths


def path_texts(paths: DataFrame) -> DataFrame:
    """(lang, path, edges, n): the words of each compacted path. A path is no longer than a piece of text."""
    word = F.struct("place", F.substring_index("phrase", " ", -1).alias("word"))
    joined = paths.groupBy("lang", "head").agg(F.max("n").alias("n"), F.count("*").alias("edges"),
                                               F.sort_array(F.collect_list(word)).alias("words"))
    later = F.slice("words", 2, F.size("words")).getField("word")
    return joined.select("lang", F.array_join(F.concat(F.array("head"), later), " ").alias("path"), "edges", "n")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best ``top`` phrases of two to four words that occur
    ``least`` times."""
    flow = flows(docs, least)
    words = flow.groupBy("lang").agg(F.sum("n").alias("n"))
    # only phrases of ``least`` occurrences are candidates or parts of one
    counts = stored(shorter_counts(flow).where(F.col("n") >= least), "counts")
    edges = stored(flow.where((F.col("size") == LONGEST) & (F.col("n") >= least)).select("lang", "phrase", "n"), "edges")
    paths = compacted(edges, counts.where(F.col("size") == LONGEST - 1).select("lang", "phrase", "n"))

    inside = paths.where("place > 0").select("lang", F.substring_index("phrase", " ", LONGEST - 1).alias("phrase"))
    shorter = counts.where("size > 1").join(inside, ["lang", "phrase"], "left_anti")
    candidates = stored(shorter.select("lang", "phrase", "size", F.col("n").alias("a")).unionByName(
        edges.select("lang", "phrase", F.lit(LONGEST).alias("size"), F.col("n").alias("a"))), "candidates")

    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.selectExpr("lang", "phrase", "a", "k", "substring_index(phrase, ' ', k) AS left_part",
                           "substring_index(phrase, ' ', k - size) AS right_part")
    part = counts.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    scored = (cuts.join(part.withColumnsRenamed({"part": "left_part", "f": "l"}), ["lang", "left_part"])
              .join(part.withColumnsRenamed({"part": "right_part", "f": "r"}), ["lang", "right_part"])
              .withColumn("score", F.expr("CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(20, 0)) div (l + r)")))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = candidates.where("size > 2").withColumn("length", F.explode(F.expr("sequence(2, size - 1)")))
    inner = inner.withColumn("start", F.explode(F.expr("sequence(0, size - length)")))
    longer = inner.selectExpr("lang", "substring_index(substring_index(phrase, ' ', start + length), ' ', -length) AS phrase",
                              "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = best.join(longer, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 80 * a")
    ranked = left.selectExpr("*", "row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase) AS rank")
    return ranked.where(F.col("rank") <= top).join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        "n", F.col("cut.score").alias("score"))
