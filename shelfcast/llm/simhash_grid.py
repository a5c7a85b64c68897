"""SimHash near-dedup through a segment-popcount embedding.

A 64-bit fingerprint is mapped to the bit counts of its 32 two-bit segments. The Manhattan distance of two such
vectors is never above the Hamming distance of the fingerprints. Pairs within three bits have at most one differing
bit in one of the two halves of the fingerprint, so in that half their vectors are equal or one step apart: each
fingerprint lies in the grid cell of each half's vector and looks into its own cell and the cells one step up. Inside a cell
the Manhattan distance of the whole vectors drops pairs first, the exact bit distance decides.

Only distinct fingerprints are compared. A cell gives at most about as many links as it has members (a spanning
forest of its links), and a cell of more than ``CELL`` members is dealt over chunk pairs of bounded size, so neither rows nor memory grow with the square of a group. Components are found by
alternating large-star and small-star steps on the stored links.

Defined results: a NULL text counts as empty; texts without words have fingerprint zero and are linked like others.
Rows may repeat. component_id is the smallest doc_id of the component, NULL ids aside (NULL if it has no other). An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import batch_of, free_name, map_arrow, slices, stored, text_runs
from shelfcast.llm.hashing import xxh64_slices

SHINGLE, DISTANCE = 3, 3
#: Members of one side of a cell that are compared at once.
CELL = 4096
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTES = np.uint64(0x0101010101010101)


def _bit_totals(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(runs, 64) number of hashes with each bit set, for the runs that begin at ``starts``. Eight byte-wide counters
    share a word, and no counter sees more than 255 hashes."""
    ends = np.append(starts[1:], len(hashes))
    pieces = np.maximum(1, -(-(ends - starts) // 255))
    owner = np.repeat(np.arange(len(starts)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cut = starts[owner] + nth * 255
    totals = np.empty((len(starts), 64), np.int64)
    first = np.flatnonzero(nth == 0)
    for j in range(8):
        counted = np.add.reduceat((hashes >> np.uint64(j)) & _BYTES, cut)
        each = counted[:, None] >> (np.arange(8, dtype=np.uint64) * np.uint64(8)) & np.uint64(255)
        totals[:, j::8] = np.add.reduceat(each.astype(np.int64), first, axis=0)
    return totals


def _fingerprints(texts: list[bytes], words_per: int) -> np.ndarray:
    """Fingerprints of short texts that fit together in memory."""
    out = np.zeros(len(texts), np.uint64)
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" " * 9, np.uint8)]
    text_end = np.cumsum(np.array([len(t) for t in texts]) + 1) - 1
    space = _SPACE[data]
    word = ~space
    begin = np.flatnonzero(word & np.concatenate(([True], space[:-1])))
    if not len(begin):
        return out
    end = np.flatnonzero(space & np.concatenate(([False], word[:-1])))
    # the words again, each followed by one space
    keep = word.copy()
    keep[end] = True
    packed = np.concatenate((data[keep], np.full(8, 32, np.uint8)))
    packed[: len(packed) - 8][~word[keep]] = 32
    length = end - begin
    place = np.cumsum(length + 1) - (length + 1)
    owner = np.searchsorted(text_end, begin, side="right")
    words = np.bincount(owner, minlength=len(texts))
    shingles = np.where(words > 0, np.maximum(1, words - words_per + 1), 0)
    first_word = np.cumsum(words) - words
    first_shingle = np.cumsum(shingles) - shingles
    total = int(shingles.sum())
    of = np.repeat(np.arange(len(texts)), shingles)
    a = first_word[of] + np.arange(total) - first_shingle[of]
    b = a + np.minimum(words[of], words_per) - 1
    hashes = xxh64_slices(packed, place[a], place[b] + length[b] - place[a])
    have = np.flatnonzero(shingles)
    bits = 2 * _bit_totals(hashes, first_shingle[have]) > shingles[have][:, None]
    out[have] = np.packbits(bits[:, ::-1], axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def _long_fingerprint(text: bytes, words_per: int, step: int = 1 << 20) -> np.uint64:
    """The same for a text of any length, in windows of ``step`` bytes and the shingles that begin in them."""
    words, totals, count = [], np.zeros(64, np.int64), 0
    pending: list[bytes] = []  # what follows the last white space, joined once the next is found
    for i in range(0, len(text), step):
        part = text[i:i + step]
        last = i + step >= len(text)
        cut = len(part) if last else max(part.rfind(c) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) + 1
        if not cut:
            pending.append(part)
            continue
        words += b"".join([*pending, part[:cut]]).lower().split()
        pending = [part[cut:]]
        if len(words) >= words_per:
            joined = np.frombuffer(b" ".join(words) + b" " * 9, np.uint8)
            length = np.array([len(w) for w in words])
            place = np.cumsum(length + 1) - (length + 1)
            a = np.arange(len(words) - words_per + 1)
            b = a + words_per - 1
            hashes = xxh64_slices(joined, place[a], place[b] + length[b] - place[a])
            totals += _bit_totals(hashes, np.array([0]))[0]
            count += len(hashes)
            words = words[-(words_per - 1):] if words_per > 1 else []
    if not count:
        return _fingerprints([text], words_per)[0]
    return np.packbits((2 * totals > count)[::-1]).view(">u8").astype(np.uint64)[0]


def fingerprints(texts: list[bytes], words_per: int = SHINGLE, together: int = 1 << 20) -> np.ndarray:
    out = np.empty(len(texts), np.uint64)
    for a, b in slices((len(t) for t in texts), together):
        if b == a + 1 and len(texts[a]) > together:
            out[a] = _long_fingerprint(texts[a], words_per)
        else:
            out[a:b] = _fingerprints(texts[a:b], words_per)
    return out


def with_fingerprint(docs: DataFrame, name: str, words_per: int = SHINGLE) -> DataFrame:
    """``docs`` with its fingerprint as a signed long."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    at = docs.columns.index("text")

    def work(batches):
        for batch in batches:
            prints = [fingerprints(run, words_per) for run in text_runs(batch.column(at), binary=True)]
            yield batch_of(schema, [*batch.columns, np.concatenate([*prints, np.zeros(0, np.uint64)]).view(np.int64)])

    return map_arrow(docs, work, schema)


def _segments(value):
    """The packed vector: a two-bit count for each two-bit segment."""
    even = F.lit(0x5555555555555555)
    a, b = value.bitwiseAND(even), F.shiftrightunsigned(value, 1).bitwiseAND(even)
    return a.bitwiseXOR(b).bitwiseOR(F.shiftleft(a.bitwiseAND(b), 1))  # a + b in each field


def _cells(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cell, fp) of each print's own two cells, and (cell, fp) of the cells one step up."""
    packed = prints.withColumn("packed", _segments(F.col("fp")))
    sides = packed.select("fp", F.explode(F.array(*[
        F.struct(F.lit(h).alias("half"),
                 F.shiftrightunsigned("packed", 32 * h).bitwiseAND(F.lit(0xFFFFFFFF)).alias("vector"))
        for h in (0, 1)])).alias("s")).select("fp", "s.half", "s.vector")
    cell = (F.shiftleft(F.col("half").cast("long"), 32) + F.col("vector")).alias("cell")
    step = [F.when(F.shiftright("vector", 2 * j).bitwiseAND(F.lit(3)) < 2, F.col("vector") + F.lit(1 << (2 * j)))
            for j in range(16)]
    up = sides.select("fp", "half", F.explode(F.array_compact(F.array(*step))).alias("vector"))
    return sides.select(cell, "fp"), up.select(cell, "fp")


MEMBERS = T.StructType([T.StructField("cell", T.LongType()), T.StructField("block", T.LongType()),
                        T.StructField("up", T.BooleanType()), T.StructField("fp", T.LongType())])
LINKS = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def _manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of the segment-count vectors of fingerprints, 16-bit parts summed from tables."""
    even = np.uint64(0x5555555555555555)
    x = (a & even) + (a >> np.uint64(1) & even)
    y = (b & even) + (b >> np.uint64(1) & even)
    total = np.zeros(np.broadcast(x, y).shape, np.int64)
    high = np.uint64(0xCCCCCCCCCCCCCCCC)
    for lane in (high, ~high):  # every second two-bit count, with room for its difference
        p, q = x & lane, y & lane
        if lane == high:
            p, q = p >> np.uint64(2), q >> np.uint64(2)
        # 4-bit fields: 2 + p - q is in 0..4, and its distance from 2 is |p - q|
        diff = p + np.uint64(0x2222222222222222) - q
        one = diff & np.uint64(0x1111111111111111)
        ends = (diff >> np.uint64(2) & np.uint64(0x1111111111111111)) + (
            ~(diff >> np.uint64(1) | diff >> np.uint64(2) | diff) & np.uint64(0x1111111111111111))
        total += np.bitwise_count(one).astype(np.int64) + 2 * np.bitwise_count(ends).astype(np.int64)
    return total


def _near(one, many: np.ndarray, distance: int) -> np.ndarray:
    """Where ``many`` are within ``distance`` of ``one``: the lower bound first, the exact distance for the rest."""
    some = np.flatnonzero(_manhattan(many, one) <= distance)
    return some[np.bitwise_count(many[some] ^ one) <= distance]


def _cell_links(own: np.ndarray, ups: np.ndarray, distance: int) -> list[tuple]:
    """A spanning forest of the links among ``own`` and between ``own`` and ``ups``: a breadth-first walk, which
    looks at every pair once and remembers only what it has not reached."""
    links, rest_own, rest_up = [], own, ups
    while len(rest_own):
        queue, rest_own = [(rest_own[0], True)], rest_own[1:]
        while queue:
            at, is_own = queue.pop()
            hit = _near(at, rest_own, distance)
            if len(hit):
                found = rest_own[hit]
                links += [(at, x) for x in found]
                queue += [(x, True) for x in found]
                rest_own = np.delete(rest_own, hit)
            if is_own and len(rest_up):
                hit = _near(at, rest_up, distance)
                if len(hit):
                    found = rest_up[hit]
                    links += [(at, x) for x in found]
                    queue += [(x, False) for x in found]
                    rest_up = np.delete(rest_up, hit)
    return links


def _split_cells(own: DataFrame, ups: DataFrame, cell: int) -> DataFrame:
    """All members with the block of their cell they are compared in; cells above ``cell`` members get many blocks,
    one for each pair of chunks, so that every pair still meets."""
    sizes = (own.withColumn("up", F.lit(0)).unionByName(ups.withColumn("up", F.lit(1))).groupBy("cell").agg(
        F.sum(1 - F.col("up")).alias("own_n"), F.sum("up").alias("up_n")))
    # a cell matters if it holds two of its own, or one and a visitor
    live = sizes.where((F.col("own_n") >= 2) | ((F.col("own_n") >= 1) & (F.col("up_n") >= 1)))
    live = live.select("cell", F.ceil(F.col("own_n") / cell).cast("int").alias("k"),
                       F.ceil(F.col("up_n") / cell).cast("int").alias("m"))
    # never broadcast: Spark takes both sides for as small as the prints they are exploded from
    both = own.withColumn("up", F.lit(False)).unionByName(ups.withColumn("up", F.lit(True))).join(live.hint("merge"), "cell")
    chunk = F.pmod(F.xxhash64("fp"), F.when(F.col("up"), F.col("m")).otherwise(F.col("k")))
    # blocks: own chunk i with own chunk j >= i at i * k + j; own chunk i with visitors' chunk j at k * k + i * m + j
    k, m = F.col("k"), F.col("m")
    single = (k == 1) & (m <= 1)
    own_blocks = F.flatten(F.array(
        F.transform(F.sequence(F.lit(0), k - 1), lambda j: F.least(F.col("c"), j) * k + F.greatest(F.col("c"), j)),
        F.when(m > 0, F.transform(F.sequence(F.lit(0), F.greatest(m - 1, F.lit(0))), lambda j: k * k + F.col("c") * m + j))
        .otherwise(F.array().cast("array<bigint>"))))
    up_blocks = F.transform(F.sequence(F.lit(0), k - 1), lambda i: k * k + i * m + F.col("c"))
    blocks = F.when(single, F.array(F.lit(0).cast("long"))).when(F.col("up"), up_blocks).otherwise(own_blocks)
    return both.withColumn("c", chunk).select("cell", F.explode(blocks).alias("block"), "up", "fp").withColumn(
        "block", F.col("block").cast("long"))


def links_of(prints: DataFrame, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """Links (u, v) between the distinct fingerprints ``fp`` within ``distance`` bits (3 at most): enough of them to
    have the same components as all."""
    if distance > 3:
        raise ValueError("one of two halves holds at most one of three differing bits; more bits need other cells")
    own, ups = _cells(prints)
    members = _split_cells(own, ups, cell).repartition("cell", "block")
    members = members.sortWithinPartitions("cell", "block", "up", "fp")

    def compare(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            cells, blocks = held["cell"].to_numpy(), held["block"].to_numpy()
            if not len(cells):
                continue
            edge = np.flatnonzero((np.diff(cells) != 0) | (np.diff(blocks) != 0)) + 1
            if len(edge):
                yield found(held.slice(0, int(edge[-1])), np.concatenate(([0], edge)))
                held = held.slice(int(edge[-1]))
        if held is not None and held.num_rows:
            yield found(held, np.array([0, held.num_rows]))

    def found(table, edges):
        prints = table["fp"].to_numpy().view(np.uint64)
        up = table["up"].to_numpy(zero_copy_only=False)
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a > 1:
                split = a + int(np.searchsorted(up[a:b], True))
                out += _cell_links(prints[a:split], prints[split:b], distance)
        pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        return batch_of(LINKS, [pairs.max(axis=1), pairs.min(axis=1)])

    return members.mapInArrow(compare, LINKS).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, root) for every linked node but the roots: root is the smallest node of its component. Alternating
    large-star and small-star steps; each step's links are stored."""
    links = stored(links, "links")
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return links.select("u", F.col("v").alias("root"))
        before = state
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        links = stored(small.unionByName(least.select("u", F.col("low").alias("v"))).distinct(), "links")


def near_classes(docs: DataFrame, words_per: int = SHINGLE, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed), component_id."""
    rows = stored(with_fingerprint(docs.select("doc_id", "text"), "fp", words_per).select("doc_id", "fp"), "prints")
    classes = _classes(rows, distance, cell)
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def _classes(rows: DataFrame, distance: int, cell: int) -> DataFrame:
    """(fp, component_id) of the distinct fingerprints of (doc_id, fp)."""
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-prints")
    roots = components(links_of(prints.select("fp"), distance, cell)).withColumnRenamed("u", "fp")
    placed = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = stored(placed, "placed")
    ids = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return placed.join(ids, "root").select("fp", "component_id")


def dedup_near(docs: DataFrame, words_per: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each component stays, with all its columns: the one of the smallest doc_id."""
    name, row = free_name(docs, "fp"), free_name(docs, "near_row")
    marked = with_fingerprint(docs.withColumn(row, F.monotonically_increasing_id()), name, words_per)
    marked = stored(marked, "marked")
    rows = stored(marked.select(F.col(row).alias("row_no"), "doc_id", F.col(name).alias("fp")), "prints")
    classes = _classes(rows.select("doc_id", "fp"), distance, CELL)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_no")).alias("first")
    # by fingerprint first, so that many equal prints are combined before they move
    by_print = rows.groupBy("fp").agg(first)
    roots = by_print.join(classes.select("fp", F.coalesce("component_id", "fp").alias("class"),
                                         F.col("component_id").isNull().alias("no_id")), "fp")
    keep = roots.groupBy("class", "no_id").agg(F.min("first").alias("first")).select(F.col("first.row_no").alias(row))
    return marked.join(keep, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
