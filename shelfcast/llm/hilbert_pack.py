"""Packing documents into token sequences in the order of a space-filling curve.

Each document's tokens are hashed into a vector of ``VECTOR`` counts, the vector is projected to ``DIMS`` dimensions by
random signs, and the standardised projection gives a Hilbert key. Documents are range-sorted by that key and laid
end to end along the curve inside every range partition, cut where a sequence of ``LENGTH`` tokens is full, so a
sequence holds neighbours on the curve. Only the last sequence of a range partition can be short: it is left so when
at most ``SLACK`` of it would be padding, else cut into runs whose lengths are powers of two, which need none.

Defined results: a NULL or empty text is one token, the closing id 1. Equal keys keep the order of the rows read.
An empty table gives an empty result. The vocabulary file is a parameter.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import batch_of, stored, texts_of

LENGTH, CLOSE = 2048, 1
#: Tokens of a range partition, two bytes each.
PART_TOKENS = 1 << 25
VECTOR, DIMS, BITS = 1024, 4, 8
SLACK = 0.02
#: Words whose ids a worker remembers; words beyond are encoded each time.
REMEMBERED = 400_000
_SPACES = re.compile(r"\s\s\s|\s\s$")


class _Words(dict):
    """word -> its ids with a space in front, as little-endian 16-bit numbers."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word):
        ids = self.encode(" " + word)
        if len(self) < REMEMBERED:
            self[word] = ids
        return ids


def _byte_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """The vocabulary with its letters turned back into bytes: byte-level BPE writes printable bytes as themselves and
    the others, in order, as the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    return {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if all(c in byte for c in token)}


class WordTokenizer:
    """Ids of whole texts. The pre-tokenizer of byte-level BPE never joins a word to what follows it, so a text cut in
    front of single spaces has the ids of its pieces, and frequent pieces are encoded once per worker. Other pieces go
    through tiktoken, which merges by the same ranks several times faster. Texts with longer runs of white space or
    with control strings are encoded whole by the tokenizer itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        if self.whole.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids are kept in 16 bits: the vocabulary has more than 65,536 tokens")
        special = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, sorted(special)))) if special else None
        ranks = _byte_ranks({t: i for t, i in self.whole.get_vocab(with_added_tokens=True).items() if t not in special})
        self.fast = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.words = _Words(self._encode)

    def _encode(self, text: str) -> bytes:
        return array("H", self.fast.encode_ordinary(text)).tobytes()

    def _encode_whole(self, text: str) -> bytes:
        return array("H", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u2")
        if _SPACES.search(text) or (self.special is not None and self.special.search(text)):
            return np.frombuffer(self._encode_whole(text), "<u2")
        first, *words = text.split(" ")
        head = self._encode(first) if first else b""
        get = self.words.__getitem__
        return np.frombuffer(head + b"".join([get(w) for w in words]), "<u2")


@lru_cache(maxsize=1)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def projection(tokens: int = 65536) -> tuple[np.ndarray, np.ndarray]:
    """The vector slot each id is hashed to, and the signs of every slot in each dimension."""
    slot = (np.arange(tokens, dtype=np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(VECTOR)
    return slot.astype(np.int64), np.random.default_rng(8).choice(np.array([-1.0, 1.0]), size=(VECTOR, DIMS))


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer points (n, dims), each coordinate below 2**bits."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(n):
            upper = (x[i] & q) != 0
            swap = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> level) & 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


ENCODED = T.StructType([
    T.StructField("row_no", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("tokens", T.LongType()),
    T.StructField("point", T.ArrayType(T.FloatType())), T.StructField("ids", T.BinaryType())])
PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("ids", T.BinaryType())])


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """row_no, doc_id, tokens, point, ids (little-endian 16-bit, closing id included) of every document; stored."""
    def encode(batches):
        token, (slot, signs) = tokenizer(path), projection()
        for batch in batches:
            ids, points, counts = [], [], []
            for text in texts_of(batch.column(2)):
                own = token(text)
                n = len(own)
                points.append(np.bincount(slot[own], minlength=VECTOR) @ signs / max(1, n))
                ids.append(own.tobytes() + CLOSE.to_bytes(2, "little"))
                counts.append(n + 1)
            yield batch_of(ENCODED, [batch.column(0), batch.column(1), counts, points, ids])

    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(encode, ENCODED), "tokens")


def curve_ordered(rows: DataFrame) -> DataFrame:
    """The encoded rows with curve_key, the place of their point on the Hilbert curve."""
    stats = rows.agg(*[f(F.col("point")[i]).alias(f"{n}{i}") for i in range(DIMS)
                       for n, f in (("mean", F.avg), ("dev", F.stddev_pop))]).first()
    mean = np.array([stats[f"mean{i}"] or 0.0 for i in range(DIMS)])
    dev = np.array([stats[f"dev{i}"] or 1.0 for i in range(DIMS)])
    schema = T.StructType([*rows.schema.fields, T.StructField("curve_key", T.LongType())])

    def keys(batches):
        for batch in batches:
            points = np.array(batch.column(batch.schema.get_field_index("point")).to_pylist(), float).reshape(-1, DIMS)
            level = np.clip((points - mean) / dev / 6 + 0.5, 0, 1) * ((1 << BITS) - 1)
            yield batch_of(schema, [*batch.columns, hilbert_keys(level.astype(np.int64))])

    return rows.mapInArrow(keys, schema)


def _cut(held: list, sequence: int, out: list) -> int:
    """Adds the pieces of the last, short sequence; returns how many sequences they make."""
    total = sum(len(ids) for _, _, _, ids in held)
    if not total:
        return 0
    lengths = [total] if LENGTH - total <= SLACK * LENGTH else [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
    room, number, offset = lengths[0], 0, 0
    for doc, start, tokens, ids in held:
        while len(ids):
            part = ids[:room]
            out.append((doc, start, tokens, part, sequence + number, offset))
            ids, start, offset, room = ids[len(part):], start + len(part), offset + len(part), room - len(part)
            if not room and number + 1 < len(lengths):
                number, offset = number + 1, 0
                room = lengths[number]
    return len(lengths)


def packed(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (16-bit)."""
    rows = encoded(docs, path)
    ordered = curve_ordered(rows).select("curve_key", "row_no", "doc_id", "tokens", "ids")
    # the session's number of partitions, or as many as hold PART_TOKENS each
    parts = -(-(rows.agg(F.sum("tokens")).first()[0] or 0) // PART_TOKENS)
    more = [parts] if parts > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    ordered = ordered.repartitionByRange(*more, "curve_key", "row_no").sortWithinPartitions("curve_key", "row_no")

    def written(out):
        ids = [p[3] for p in out]
        return batch_of(PIECES, [
            [p[0] for p in out], [p[1] for p in out], [len(i) for i in ids],
            [zlib.crc32(i.astype("<u4").tobytes()) for i in ids], [p[2] for p in out], [p[4] for p in out],
            [p[5] for p in out], [i.tobytes() for i in ids]])

    def pack(batches):
        sequence, used, held = TaskContext.get().partitionId() << 40, 0, []
        for batch in batches:
            out = []
            for doc, tokens, raw in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)):
                ids, start = np.frombuffer(raw.as_buffer(), "<u2"), 0
                while start < tokens:
                    part = ids[start:start + LENGTH - used]
                    held.append((doc, start, tokens, part))
                    start, used = start + len(part), used + len(part)
                    if used == LENGTH:
                        offset = 0
                        for d, s, t, i in held:
                            out.append((d, s, t, i, sequence, offset))
                            offset += len(i)
                        sequence, used, held = sequence + 1, 0, []
                if len(out) >= 4096:
                    yield written(out)
                    out = []
            held = [(d, s, t, i.copy()) for d, s, t, i in held]
            if out:
                yield written(out)
        out = []
        _cut(held, sequence, out)
        if out:
            yield written(out)

    return ordered.mapInArrow(pack, PIECES)
