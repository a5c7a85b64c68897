"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors are turned into integers; a component is a term. Vectors are ordered by their nearest of ``PIVOTS`` pivots
(a bounded sample; only the order depends on it) and cut into blocks of neighbouring places, ``BLOCK`` vectors each. A
block keeps the largest and smallest value of each term and a forward index: the vectors themselves. The summed term
maxima (minima for negative query terms) bound every score in the block. Each query takes the blocks in the order of
their bounds, scores whole blocks through the forward index, and stops when the next bound is below its k-th score.

Queries and blocks are dealt over a grid of (block shard, query chunk) cells of bounded size. A first pass gives every
query a k-th score from the blocks with its best bounds, so that all cells of the second pass start with it. Each cell
returns k rows per query at most; these are merged. Nothing is approximate.

Defined results: vectors that are NULL or hold NULL or non-finite components take no part, neither as queries nor as
candidates. Shorter vectors have missing components taken as 0. Equal scores go to the smaller vec_id, NULL ids last.
Every row but the query's own is a candidate, also one of the same vec_id. With fewer than k candidates all are
returned. Scores must stay below 2**62. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import batch_of, stored

SCALE, EVERY, K = 1024, 100, 10
BLOCK, PIVOTS = 256, 64
#: Blocks in a shard and queries in a chunk: what one task holds at a time.
SHARD, CHUNK = 256, 8192
#: Blocks a query scores in the first pass.
FIRST = 2
#: Below any score, and above any id.
LOWEST, NO_ID = -(1 << 62), (1 << 63) - 1

VECTORS = T.StructType([T.StructField("row_no", T.LongType()), T.StructField("vec_id", T.LongType()),
                        T.StructField("vector", T.ArrayType(T.LongType()))])


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """row_no, vec_id, vector (longs) of the rows that take part; stored."""
    x = F.col("embedding")
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    made = F.transform(x, lambda v: F.floor(F.lit(float(SCALE)) * v.cast("double")))
    return stored(embeddings.where(fine).select(
        F.monotonically_increasing_id().alias("row_no"), F.col("vec_id").cast("long").alias("vec_id"), made.alias("vector")),
        "vectors")


def _matrix(column, width: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = values.offsets.to_numpy()
    flat = np.asarray(values.values.to_numpy(zero_copy_only=False), np.int64)
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), width), np.int64)
    if len(sizes) and (sizes == width).all():
        out[:] = flat[ends[0]:ends[-1]].reshape(-1, width)
    else:
        for i, (a, n) in enumerate(zip(ends[:-1], sizes)):
            out[i, :n] = flat[a:a + n]
    return out


BLOCKS = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("rows", T.BinaryType()),
    T.StructField("ids", T.BinaryType()), T.StructField("matrix", T.BinaryType()), T.StructField("high", T.BinaryType()),
    T.StructField("low", T.BinaryType())])


def blocks_of(vectors: DataFrame, width: int) -> DataFrame:
    """Blocks of up to BLOCK vectors that lie next to each other in the order of their pivots; stored."""
    pivots = [r.vector + [0] * (width - len(r.vector)) for r in
              vectors.orderBy(F.xxhash64("vec_id", "row_no")).limit(PIVOTS).select("vector").collect()]
    centre = np.array(pivots, float).reshape(-1, width)
    keyed = T.StructType([*VECTORS.fields, T.StructField("near", T.IntegerType())])

    def key(batches):
        for batch in batches:
            x = _matrix(batch.column(2), width).astype(float)
            far = (x ** 2).sum(1)[:, None] - 2 * x @ centre.T + (centre ** 2).sum(1)
            yield batch_of(keyed, [*batch.columns, far.argmin(axis=1).astype(np.int32)])

    def cut(batches):
        from pyspark import TaskContext
        number, held = TaskContext.get().partitionId() << 40, None
        for batch in [*batches, None]:
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
            while held is not None and held.num_rows >= (BLOCK if batch is not None else 1):
                part, held = held.slice(0, BLOCK), held.slice(BLOCK)
                x = _matrix(part["vector"], width)
                yield batch_of(BLOCKS, [
                    [number], [len(x)], [part["row_no"].to_numpy().astype("<i8").tobytes()],
                    [part["vec_id"].fill_null(NO_ID).to_numpy().astype("<i8").tobytes()],
                    [x.astype("<i8").tobytes()], [x.max(axis=0).astype("<i8").tobytes()], [x.min(axis=0).astype("<i8").tobytes()]])
                number += 1

    ordered = vectors.mapInArrow(key, keyed).repartitionByRange("near", "vec_id", "row_no").sortWithinPartitions(
        "near", "vec_id", "row_no").select("row_no", "vec_id", "vector")
    return stored(ordered.mapInArrow(cut, BLOCKS), "vector-blocks")


def _numbers(raw, width: int | None = None) -> np.ndarray:
    x = np.frombuffer(raw, "<i8")
    return x if width is None else x.reshape(-1, width)


def _product(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Matrix product of integers; through doubles where every sum stays below 2**53."""
    return (a.astype(float) @ b.astype(float)).astype(np.int64) if exact else a @ b


class _Best:
    """The K best (score, vec_id) of each query so far."""

    def __init__(self, n: int):
        self.score = np.full((n, K), LOWEST)
        self.vec = np.full((n, K), NO_ID)

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        score = np.concatenate([self.score[which], scores], axis=1)
        vec = np.concatenate([self.vec[which], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((vec, -score), axis=1)[:, :K]
        rows = np.arange(len(which))[:, None]
        self.score[which], self.vec[which] = score[rows, order], vec[rows, order]


def search_cell(queries: np.ndarray, query_rows: np.ndarray, start: np.ndarray, blocks: list, most: int | None = None):
    """Best scores of the queries among the blocks (rows, ids, matrix, high, low). ``start`` is a score the k-th best
    of each query is known to reach; ``most`` blocks are scored at most per query, all that matter if None."""
    best = _Best(len(queries))
    if not blocks or not len(queries):
        return best
    high, low = np.stack([b[3] for b in blocks]), np.stack([b[4] for b in blocks])
    largest = max(int(np.abs(queries).max(initial=0)), 1) * max(int(np.abs(high).max(initial=0)), int(np.abs(low).max(initial=0)), 1)
    exact = largest * queries.shape[1] < 1 << 52
    bound = _product(np.maximum(queries, 0), high.T, exact) + _product(np.minimum(queries, 0), low.T, exact)
    order = np.argsort(-bound, axis=1, kind="stable")
    active = np.arange(len(queries))
    for turn in range(len(blocks) if most is None else min(most, len(blocks))):
        at = order[active, turn]
        floor = np.maximum(best.score[active, K - 1], start[active])
        go = bound[active, at] >= floor
        active, at = active[go], at[go]
        if not len(active):
            break
        by_block = np.argsort(at, kind="stable")
        edges = np.flatnonzero(np.diff(at[by_block], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:]):
            which = active[by_block[a:b]]
            rows, ids, matrix, _, _ = blocks[at[by_block[a]]]
            scores = _product(queries[which], matrix.T, exact)
            own = query_rows[which][:, None] == rows[None, :]
            best.add(which, np.where(own, LOWEST, scores), np.where(own, NO_ID, ids[None, :]))
    return best


FOUND = T.StructType([T.StructField("query_row", T.LongType()), T.StructField("query_id", T.LongType()),
                      T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])


def _pass(queries: DataFrame, blocks: DataFrame, width: int, most: int | None) -> DataFrame:
    """The K best rows of every query in each cell of the grid."""
    def cell(key, left, right):
        held = [(_numbers(r.rows), _numbers(r.ids), _numbers(r.matrix, width), _numbers(r.high), _numbers(r.low))
                for r in left.itertuples()]
        if not len(right):
            return pd.DataFrame(columns=FOUND.names)
        vectors = np.stack([_numbers(v) for v in right["vector"]])
        rows = right["row_no"].to_numpy(np.int64)
        best = search_cell(vectors, rows, right["floor"].to_numpy(np.int64), held, most)
        fine = best.score > LOWEST
        which = np.repeat(np.arange(len(rows)), fine.sum(axis=1))
        return pd.DataFrame({"query_row": rows[which], "query_id": right["vec_id"].to_numpy(np.int64)[which],
                             "vec_id": best.vec[fine], "score": best.score[fine]})

    n, cores = blocks.count(), blocks.sparkSession.sparkContext.defaultParallelism
    chunks = max(1, -(-queries.count() // CHUNK))
    # cells of bounded size, and enough of them for all cores
    shards = max(1, -(-n // SHARD), min(n, -(-2 * cores // chunks)))
    dealt = blocks.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    asked = queries.withColumn("chunk", F.pmod(F.xxhash64("row_no"), F.lit(chunks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return dealt.groupBy("shard", "chunk").cogroup(asked.groupBy("shard", "chunk")).applyInPandas(cell, FOUND)


def _merged(found: DataFrame) -> DataFrame:
    """The K best of each query, ranked; Spark keeps K of each partition before they move."""
    ranked = found.selectExpr("*", "CAST(row_number() OVER (PARTITION BY query_row, query_id ORDER BY score DESC, vec_id) AS INT) AS rank")
    return ranked.where(F.col("rank") <= K).select(
        "query_row", "query_id", "rank", F.nullif(F.col("vec_id"), F.lit(NO_ID)).alias("vec_id"), "score")


def top_k(embeddings: DataFrame, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score of the K best candidates of each query (vec_id divisible by ``every``)."""
    vectors = integer_vectors(embeddings)
    width = max(1, vectors.agg(F.max(F.size("vector"))).first()[0] or 1)
    blocks = blocks_of(vectors, width)

    def raw(batches):
        for batch in batches:
            x = _matrix(batch.column(2), width)
            yield batch_of(queried, [batch.column(0), batch.column(1), [v.astype("<i8").tobytes() for v in x],
                                     np.full(len(x), LOWEST)])

    queried = T.StructType([*VECTORS.fields[:2], T.StructField("vector", T.BinaryType()), T.StructField("floor", T.LongType())])
    queries = stored(vectors.where(F.col("vec_id") % every == 0).mapInArrow(raw, queried), "queries")
    first = _merged(_pass(queries, blocks, width, FIRST)).where(F.col("rank") == K).select(
        F.col("query_row").alias("row_no"), F.col("score").alias("reached"))
    known = queries.join(first, "row_no", "left").withColumn("floor", F.coalesce("reached", "floor")).drop("reached")
    return _merged(_pass(stored(known, "queries"), blocks, width, None)).select("query_id", "rank", "vec_id", "score")
