"""Source divergence audit: term counts through factored chunks, and how far each source is from its language.

A task counts the chunks (runs without ASCII white space, A-Z lowered) of each of its documents, and sends for each chunk of
a language the number of documents and the occurrences per source. All rows of a chunk meet in one task, which adds them,
tokenizes the chunk once and joins its terms to the sums. No character of a term is white space, so a term never spans two
chunks. Then all rows of a term meet.

Occurrences of a term are sums over its chunks. Its documents are not: one document can hold several of them. They are at
least the most that one of its chunks has and at most their sum, and these bounds decide nearly every term against
``least``. For the rest, each of whose chunks has fewer than ``least`` documents, the row numbers of those documents were
counted along, and distinct ones are counted.

Divergence compares smoothed integer shares: p = 1 + floor(SCALE * (count + 2) / (N + 2 V)) and
f = floor((p - q)^2 / (p + q)). All pairs of sources are the wanted result; the sums behind them come from blocks of terms
against tiles of ``TILE`` sources, so that a task holds two tiles' shares and never a row per term and pair.

Defined results: NULL text, language or source counts as empty text. Repeated rows are documents of their own. A language
without kept terms has value 0 for its pairs and no term rows. Other columns may have any name. Memory of a task: about
ten times ``RUN_BYTES`` of text, or twenty times its longest document; a chunk's or term's rows, which are at most one per
counting task and language, and one per chunk that holds the term.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import batch_of, slices, stored

LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
RUN_BYTES = 32 << 20
#: Rows that are added up at a time.
ROWS = 1 << 16
#: Sources whose shares a task holds at once, times two; parts that a pair of tiles is dealt over; shares in a block.
TILE, PARTS, BLOCK = 256, 64, 1 << 19
_NO_TERM = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

#: ``entries`` and ``doc_rows`` are packed: (source number, occurrences) and row numbers.
ENTRY = np.dtype([("number", "<i4"), ("count", "<i8")])
CHUNKS = T.StructType([
    T.StructField("chunk", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("docs", T.LongType()),
    T.StructField("doc_rows", T.BinaryType()), T.StructField("entries", T.BinaryType())])
TERMS = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("term", T.StringType()), T.StructField("times", T.LongType()),
    T.StructField("docs", T.LongType()), T.StructField("doc_rows", T.BinaryType()), T.StructField("entries", T.BinaryType())])
#: ``first`` marks one row of each term of a language.
COUNTS = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("term", T.StringType()), T.StructField("number", T.IntegerType()),
    T.StructField("count", T.LongType()), T.StructField("first", T.BooleanType())])


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal entries begins."""
    changed = np.zeros(len(columns[0]), bool)
    changed[:1] = True
    for c in columns:
        changed[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(changed)


def _codes(column: pa.Array) -> np.ndarray:
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def _pack(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary array of the values of each row."""
    ends = np.concatenate(([0], np.cumsum(sizes))) * values.dtype.itemsize
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), data]).cast(pa.binary())


def _unpack(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows, and their number by row."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    return data.view(kind), np.diff(ends) // kind.itemsize


def _summed(group: np.ndarray, number: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, entries) sorted by group and source, with the counts of equal ones added."""
    sources = int(number.max(initial=0)) + 1
    key = group * sources + number
    order = np.argsort(key, kind="stable")
    first = _starts(key[order])
    key = key[order][first]
    out = np.empty(len(key), ENTRY)
    out["number"] = key % sources
    if len(key):
        out["count"] = np.add.reduceat(count[order], first)
    return key // sources, out


def _runs(batches):
    """(texts, languages, numbers) of about RUN_BYTES or one longer text."""
    held, size = [], 0
    for batch in batches:
        texts = batch.column(0).cast(pa.large_string()).fill_null("")
        for a, b in slices(pc.binary_length(texts).to_pylist(), RUN_BYTES):
            part = (texts.slice(a, b - a), batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a))
            held.append(part)
            size += pc.sum(pc.binary_length(part[0])).as_py()
            if size >= RUN_BYTES // 2:
                yield [pa.concat_arrays(c) for c in zip(*held)]
                held, size = [], 0
                pa.default_memory_pool().release_unused()
    if held:
        yield [pa.concat_arrays(c) for c in zip(*held)]


def counted_run(texts: pa.Array, langs: pa.Array, numbers: np.ndarray, first_row: int, least: int) -> pa.RecordBatch | None:
    """The chunks of whole documents, as rows of CHUNKS."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    lengths = pc.list_value_length(words).to_numpy()
    coded = words.flatten().dictionary_encode()
    del words
    chunks, width = coded.dictionary, len(coded.dictionary)
    empty = pc.index(chunks, pa.scalar("", pa.large_string())).as_py()  # white space at the ends of a text
    code = coded.indices.to_numpy().astype(np.int64)
    key = (np.repeat(np.arange(len(lengths)), lengths) * width + code)[code != empty]
    if not len(key):
        return None
    pairs, n = np.unique(key, return_counts=True)
    del key, code, coded
    doc = pairs // width
    lang = langs.dictionary_encode()
    place = lang.indices.to_numpy().astype(np.int64)[doc] * width + pairs % width
    order = np.argsort(place, kind="stable")
    place, doc, n = place[order], doc[order], n[order]
    of_chunk = _starts(place)
    docs = np.diff(np.append(of_chunk, len(place)))
    few = docs < least
    group, entries = _summed(np.repeat(np.arange(len(docs)), docs), numbers[doc], n)
    place = place[of_chunk]
    return batch_of(CHUNKS, [
        chunks.take(pa.array(place % width)).cast(pa.string()), lang.dictionary.take(pa.array(place // width)), docs,
        _pack(first_row + doc[np.repeat(few, docs)], np.where(few, docs, 0)), _pack(entries, np.bincount(group, minlength=len(docs)))])


def numbered_sources(docs: DataFrame) -> DataFrame:
    """(lang, source, number, sources): the sources of each language numbered by name, and how many it has. Stored."""
    return stored(docs.select("lang", "source").distinct().selectExpr(
        "lang", "source", "CAST(row_number() OVER (PARTITION BY lang ORDER BY source) - 1 AS INT) AS number",
        "CAST(count(*) OVER (PARTITION BY lang) AS INT) AS sources"), "sources")


def _whole_groups(batches, keys: int):
    """Tables of about ROWS sorted rows that do not cut rows with equal first ``keys`` columns apart."""
    held, n, wanted = [], 0, ROWS
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n < wanted:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = np.ones(n, bool)
        for k in range(keys):
            last &= pc.equal(table.column(k), table.column(k)[-1]).to_numpy()
        cut = n - int(last.sum())
        if cut:
            yield table.slice(0, cut)
        held, n = table.slice(cut).to_batches(), n - cut
        wanted = max(ROWS, 2 * n)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(table: pa.Table, at: int) -> pa.Array:
    column = table.column(at).combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def with_terms(table: pa.Table, least: int) -> pa.RecordBatch:
    """Rows of CHUNKS, sorted by chunk and language, to rows of TERMS: those of a chunk and language added, the chunk
    tokenized once, and a row for each of its terms."""
    chunk, lang = _column(table, 0), _column(table, 1)
    chunk_code = _codes(chunk)
    starts = _starts(chunk_code, _codes(lang))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(chunk))))
    docs = np.add.reduceat(_column(table, 2).to_numpy(), starts)
    rows, row_sizes = _unpack(_column(table, 3), np.dtype("<i8"))
    few = (docs < least)[group]  # then each part has fewer, and its row numbers
    kept = np.bincount(group, weights=np.where(few, row_sizes, 0), minlength=len(starts)).astype(np.int64)
    packed_rows = _pack(rows[np.repeat(few, row_sizes)], kept)
    entries, sizes = _unpack(_column(table, 4), ENTRY)
    owner, entries = _summed(np.repeat(group, sizes), entries["number"].astype(np.int64), entries["count"])
    packed = _pack(entries, np.bincount(owner, minlength=len(starts)))

    of_chunk = _starts(chunk_code)
    pieces = pc.split_pattern_regex(chunk.take(pa.array(of_chunk)), _NO_TERM)
    terms = pieces.flatten().dictionary_encode()
    code = terms.indices.to_numpy().astype(np.int64)
    width = max(1, len(terms.dictionary))
    key = np.repeat(np.arange(len(of_chunk)), pc.list_value_length(pieces).to_numpy()) * width + code
    empty = pc.index(terms.dictionary, pa.scalar("", pa.string())).as_py()
    key, times = np.unique(key[code != empty], return_counts=True)
    many = np.bincount(key // width, minlength=len(of_chunk))  # distinct terms of each chunk
    first_term = np.cumsum(many) - many
    which = np.searchsorted(of_chunk, starts, side="right") - 1  # the chunk of each group
    repeat = many[which]
    at = np.repeat(np.arange(len(starts)), repeat)
    term = np.arange(len(at)) - np.repeat(np.cumsum(repeat) - repeat, repeat) + np.repeat(first_term[which], repeat)
    place = pa.array(at)
    return batch_of(TERMS, [
        lang.take(pa.array(starts)).take(place), terms.dictionary.take(pa.array(key[term] % width)), times[term], docs[at],
        packed_rows.take(place), packed.take(place)])


def kept_counts(table: pa.Table, least: int) -> pa.RecordBatch | None:
    """Rows of TERMS, sorted by language and term, to the COUNTS of the terms that enough documents hold."""
    lang, term = _column(table, 0), _column(table, 1)
    starts = _starts(_codes(lang), _codes(term))
    ends = np.append(starts[1:], len(lang))
    docs = _column(table, 3).to_numpy()
    low, high = np.maximum.reduceat(docs, starts), np.add.reduceat(docs, starts)
    keep = low >= least
    unsure = np.flatnonzero(~keep & (high >= least))
    if len(unsure):
        rows, sizes = _unpack(_column(table, 4), np.dtype("<i8"))
        at = np.concatenate(([0], np.cumsum(sizes)))
        for g in unsure:
            keep[g] = len(np.unique(rows[at[starts[g]]:at[ends[g]]])) >= least
    if not keep.any():
        return None
    group = np.repeat(np.arange(len(starts)), ends - starts)
    entries, sizes = _unpack(_column(table, 5), ENTRY)
    used = np.repeat(keep[group], sizes)
    counts = entries["count"] * np.repeat(_column(table, 2).to_numpy(), sizes)
    owner, entries = _summed(np.repeat(group, sizes)[used], entries["number"].astype(np.int64)[used], counts[used])
    first = np.zeros(len(owner), bool)
    first[_starts(owner)] = True
    place = pa.array(starts[owner])
    return batch_of(COUNTS, [lang.take(place), term.take(place), entries["number"], entries["count"], pa.array(first)])


def term_counts(docs: DataFrame, sources: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """COUNTS of the terms that at least ``least`` documents of the language hold, in the sources where they occur; stored.
    ``docs`` has no NULL language or source."""
    def count(batches):
        row = TaskContext.get().partitionId() << 40
        for texts, langs, numbers in _runs(batches):
            made = counted_run(texts, langs, numbers.to_numpy().astype(np.int64), row, least)
            row += len(texts)
            if made is not None:
                yield made

    def tokenize(batches):
        for table in _whole_groups(batches, 1):
            yield with_terms(table, least)

    def keep(batches):
        for table in _whole_groups(batches, 2):
            made = kept_counts(table, least)
            if made is not None:
                yield made

    # Spark broadcasts the sources while they are small
    numbered = docs.join(sources.select("lang", "source", "number"), ["lang", "source"]).select("text", "lang", "number")
    chunks = numbered.mapInArrow(count, CHUNKS).repartition("chunk").sortWithinPartitions("chunk", "lang")
    terms = chunks.mapInArrow(tokenize, TERMS).repartition("lang", "term").sortWithinPartitions("lang", "term")
    return stored(terms.mapInArrow(keep, COUNTS), "term-counts")


def _share(count, total, kinds):
    """1 + floor(SCALE * (count + 2) / (total + 2 kinds)) in decimals, which hold what 64 bits may not."""
    wide = f"CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + 2 AS DECIMAL(20, 0))"
    return F.expr(f"1 + CASE WHEN {total} + 2 * {kinds} > 0 THEN {wide} div ({total} + 2 * {kinds}) END")


def _distance(p, q):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


_SUMS = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
    T.StructField("value", T.LongType()), T.StructField("seen", T.LongType())])


class _Tiles:
    """Sums of f for the source pairs of one (lang, i, j, part). Rows come sorted: first those without a term, the share of a
    source that lacks a term, then the others by term."""

    def __init__(self, key):
        self.key, self.seen, self.done, self.last = key, 0, 0, None
        self.base = np.zeros(2 * TILE, np.int64)
        self.sums = np.zeros((TILE, TILE), np.int64)
        self.held: list[tuple] = []
        self.size = 0

    def add(self, terms: pa.Array, numbers: np.ndarray, shares: np.ndarray) -> None:
        _, i, j, _ = self.key
        heads = terms.null_count  # NULLs come first
        for tile, at in ((i, 0), (j, TILE)):
            here = numbers[:heads] // TILE == tile
            self.base[numbers[:heads][here] - tile * TILE + at] = shares[:heads][here]
        terms, numbers, shares = terms.slice(heads), numbers[heads:], shares[heads:]
        if not len(terms):
            return
        fresh = np.zeros(len(terms), np.int64)
        fresh[_starts(terms.dictionary_encode().indices.to_numpy())] = 1
        fresh[0] = terms[0].as_py() != self.last
        places = self.seen + np.cumsum(fresh) - 1
        self.seen, self.last = int(places[-1]) + 1, terms[-1].as_py()
        self.held.append((places, numbers, shares))
        self.size += len(places)
        if self.size >= BLOCK:
            self.flush(self.seen - 1)  # the last term may go on

    def flush(self, upto: int) -> None:
        if not self.held:
            return
        places, numbers, shares = (np.concatenate(c) for c in zip(*self.held))
        _, i, j, _ = self.key
        columns = np.flatnonzero(self.base)
        column = np.full(2 * TILE, -1)
        column[columns] = np.arange(len(columns))
        left, right = np.flatnonzero(columns < TILE), np.flatnonzero(columns >= TILE)
        rows = max(1, BLOCK // max(1, len(columns)))
        for a in range(self.done, upto, rows):
            b = min(a + rows, upto)
            block = np.repeat(self.base[columns][None, :], b - a, axis=0)
            inside = slice(*np.searchsorted(places, [a, b]))
            for tile, at in ((i, 0), (j, TILE)):
                here = numbers[inside] // TILE == tile
                block[places[inside][here] - a, column[numbers[inside][here] - tile * TILE + at]] = shares[inside][here]
            q = block[:, right]
            for c in left:
                p = block[:, c:c + 1]
                self.sums[columns[c], columns[right] - TILE] += ((p - q) ** 2 // (p + q)).sum(axis=0)
        left_over = np.searchsorted(places, upto)
        self.held = [(places[left_over:], numbers[left_over:], shares[left_over:])]
        self.size, self.done = len(places) - left_over, upto

    def finished(self) -> pa.RecordBatch:
        self.flush(self.seen)
        lang, i, j, _ = self.key
        have = np.argwhere((self.base[:TILE, None] > 0) & (self.base[None, TILE:] > 0))
        a, b = have[:, 0], have[:, 1]
        return batch_of(_SUMS, [[lang] * len(have), (a + i * TILE).astype(np.int32), (b + j * TILE).astype(np.int32),
                                self.sums[a, b], np.full(len(have), self.seen)])


def _tile_sums(batches):
    tiles = None
    for batch in batches:
        lang, term = batch.column(0).dictionary_encode(), batch.column(4)
        i, j, part, number, share = (batch.column(c).to_numpy() for c in (1, 2, 3, 5, 6))
        starts = _starts(lang.indices.to_numpy(), i, j, part)
        for a, b in zip(starts, np.append(starts[1:], batch.num_rows)):
            key = (batch.column(0)[int(a)].as_py(), int(i[a]), int(j[a]), int(part[a]))
            if tiles is None or tiles.key != key:
                if tiles is not None:
                    yield tiles.finished()
                tiles = _Tiles(key)
            tiles.add(term.slice(int(a), int(b - a)), number[a:b], share[a:b])
    if tiles is not None:
        yield tiles.finished()


def _pair_sums(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, a, b, value, seen): f summed over the ``seen`` terms that some source of the two tiles has."""
    def tiled(rows):
        own = F.floor(F.col("number") / TILE).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / TILE).cast("int")))
        return rows.withColumn("own", own).withColumn("other", other).withColumn("i", F.least("own", "other")).withColumn(
            "j", F.greatest("own", "other"))

    columns = ["lang", "i", "j", "part", "term", "number", "share"]
    part = F.pmod(F.xxhash64("term"), F.lit(PARTS)).cast("int")
    heads = tiled(groups.withColumn("term", F.lit(None).cast("string")).withColumn("share", F.col("none"))).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    rows = tiled(shares).withColumn("part", part).select(*columns).unionByName(heads.select(*columns))
    keys = ["lang", "i", "j", "part"]
    sums = rows.repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_first("term")).mapInArrow(_tile_sums, _SUMS)
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, most_terms: int = 10) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank: every other source of the language by distance, and
    the ``most_terms`` terms by which the source is most above its language."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    sources = numbered_sources(docs)
    counts = term_counts(docs, sources, least)
    kinds = counts.where("first").groupBy("lang").agg(F.count("*").alias("kinds"))
    totals = counts.groupBy("lang", "number").agg(F.sum("count").alias("total"))
    by_lang = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    groups = (sources.join(totals, ["lang", "number"], "left").join(kinds, "lang", "left").join(by_lang, "lang", "left")
              .na.fill(0, ["total", "kinds", "lang_total"]))
    # one row per source of a language, with the share of a term it lacks
    groups = stored(groups.withColumn("none", _share("0", "total", "kinds")), "groups")

    shares = counts.join(groups, ["lang", "number"]).withColumn("share", _share("count", "total", "kinds"))
    sums = _pair_sums(groups.where("kinds > 0"), shares)
    a = groups.select("lang", "source", F.col("number").alias("na"), F.col("none").alias("pa"), "kinds")
    b = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("nb"), F.col("none").alias("pb"))
    # pairs of the sources of a language are the wanted rows
    pairs = a.join(b, "lang").where("na <> nb").withColumn("a", F.least("na", "nb")).withColumn("b", F.greatest("na", "nb"))
    rest = (F.col("kinds") - F.coalesce("seen", F.lit(0))) * _distance("pa", "pb")
    pairs = pairs.join(sums, ["lang", "a", "b"], "left").select(
        "lang", "source", "item", F.coalesce(F.coalesce("value", F.lit(0)) + rest, F.lit(0)).cast("long").alias("value"))

    # a term has at most a row per source
    terms = shares.withColumn("lang_count", F.expr("sum(count) OVER (PARTITION BY lang, term)"))
    terms = (terms.withColumn("q", _share("lang_count", "lang_total", "kinds")).where("share > q")
             .select("lang", "source", F.col("term").alias("item"), _distance("share", "q").alias("value")))
    ranked = "row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank"
    return (pairs.selectExpr("lang", "source", "'pair' AS part", "item", "value", ranked).unionByName(
        terms.selectExpr("lang", "source", "'term' AS part", "item", "value", ranked).where(F.col("rank") <= most_terms)))
