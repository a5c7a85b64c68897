"""WARC writer with a Zstandard dictionary per archive file, and the reader that gives the records back.

Every page becomes one WARC/1.1 record: a ``response`` holding an HTTP head and the page, or, where an equal payload of
at least ``LEAST_REVISIT`` bytes is archived with a larger page_id, a ``revisit`` that names that record and holds the
HTTP head alone. A task buffers its first ``TRAIN_BYTES`` of records, trains the file's dictionary on them, writes it as a
leading skippable frame (magic 0x184D2A5D, the dictionary itself compressed), and compresses each record to a frame of
its own, so any record can be read alone. Files are written by Spark's text sink: its commit survives lost executors
and repeated tasks, it reaches every file system Spark reaches, and the line separator is an empty skippable frame,
which every Zstandard reader passes over. Spark names the files; one file holds one task's pages.

Defined results: a NULL payload counts as empty, and empty payloads are responses. A NULL page_id is smaller than any.
Rows that repeat the largest page_id of equal payloads are all responses. A NULL url is recorded as the record's own
id; control characters and spaces of an url are percent-encoded in its header. Rows equal in page_id and payload share a
record id. A file of too few records to train on has no dictionary. An empty table gives an empty archive. Memory of a
task: TRAIN_BYTES, and a few times its longest payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import batch_of, stored

LEAST_REVISIT = 1000
TRAIN_BYTES = 8 << 20
DICTIONARY_BYTES = 112640
LEVEL = 3

# fixed values of the WARC and Zstandard formats
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
SEPARATOR = "P*M\x18\x00\x00\x00\x00"  # a skippable frame of no bytes
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_UNSAFE = re.compile("[\x00-\x20\x7f]")
FRAMES = T.StructType([T.StructField("frame", T.BinaryType())])
RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("payload", T.BinaryType())])


def record_id(page_id: int | None, payload_sha256: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{payload_sha256}')}>"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, payload_sha256: str, revisits: bool, refers_to, date: str) -> bytes:
    own = record_id(page_id, payload_sha256)
    target = own[1:-1] if url is None else _UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", url)
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields = [("WARC-Type", "revisit" if revisits else "response"), ("WARC-Record-ID", own), ("WARC-Date", date),
              ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if page_id is not None:
        fields.append(("Page-ID", page_id))
    if revisits:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, payload_sha256)),
                   ("Refers-To-Page-ID", refers_to)]
    fields.append(("Content-Type", "application/http;msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _record(fields, http if revisits else http + payload)


def train(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the records; None where there is too little to learn from."""
    try:
        return zstandard.train_dictionary(size, records, k=512, d=8)
    except zstandard.ZstdError:
        return None


def dictionary_frame(dictionary: zstandard.ZstdCompressionDict) -> bytes:
    body = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
    return struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body


def frames_of(records, train_bytes: int = TRAIN_BYTES):
    """The frames of one archive file: the dictionary's, then one for each record."""
    records, held, size = iter(records), [], 0
    for record in records:
        held.append(record)
        size += len(record)
        if size >= train_bytes:
            break
    if not held:
        return
    dictionary = train(held)
    if dictionary is not None:
        yield dictionary_frame(dictionary)
        dictionary.precompute_compress(level=LEVEL)
    squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True, write_content_size=True)
    for part in (held, records):
        for record in part:
            yield squeeze.compress(record)
        held.clear()


def records_of(archive: bytes):
    """The uncompressed records of one archive file, which may come from another writer."""
    data, at, dictionary = memoryview(archive), 0, None
    while at < len(data):
        if len(data) - at < 8:
            raise ValueError("archive ends inside a frame")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            if len(data) - at - 8 < size:
                raise ValueError("archive ends inside a skippable frame")
            if magic == DICTIONARY_MAGIC and at == 0:
                body = bytes(data[8:8 + size])
                if body.startswith(ZSTD_MAGIC):
                    body = zstandard.ZstdDecompressor().decompress(body, max_output_size=64 << 20)
                dictionary = zstandard.ZstdCompressionDict(body)
            at += 8 + size
            continue
        frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        out, step = [], 1 << 16
        while not frame.eof:
            if at >= len(data):
                raise ValueError("archive ends inside a record")
            out.append(frame.decompress(data[at:at + step]))
            at += min(step, len(data) - at)
        at -= len(frame.unused_data)
        yield b"".join(out)


def parsed(record: bytes):
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) of a page's record, or None for
    records of other types. A payload that disagrees with its digest or length is an error."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in
              (line.partition(":") for line in head.decode("utf-8").split("\r\n")[1:])}
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = [int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
    if kind == "response" and (lengths[0] != len(payload) or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['warc-record-id']} does not hold the payload it names")
    number = {k: int(fields[k]) if k in fields else None for k in ("page-id", "refers-to-page-id")}
    return (number["page-id"], fields["warc-target-uri"], kind, lengths[0], digest, number["refers-to-page-id"],
            payload if kind == "response" else None)


def write_archive(pages: DataFrame, path: str, least: int = LEAST_REVISIT, train_bytes: int = TRAIN_BYTES,
                  date: str = "1970-01-01T00:00:00Z") -> None:
    """Archives ``pages`` (page_id, url, html) below ``path``. ``date`` stands in every record: pages have none."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("sha"))
    # groups of equal payloads, without the payloads; stored, so that a join with a hot group can be split
    groups = (rows.where(F.length("payload") >= least).groupBy("sha")
              .agg(F.max("page_id").alias("keep_id"), F.count("*").alias("n")).where("n > 1"))
    groups = stored(groups.select(F.col("sha").alias("group_sha"), "keep_id"), "payloads")
    known = rows.join(groups, F.col("sha") == F.col("group_sha"), "left").select(
        "page_id", "url", "payload", "sha",
        (F.col("group_sha").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep_id"))).alias("revisits"), "keep_id")

    def archive(batches):
        def records():
            for batch in batches:
                for i in range(batch.num_rows):  # a row at a time: a batch of long pages is never held twice
                    yield page_record(*[batch.column(c)[i].as_py() for c in range(6)], date)

        out, size = [], 0
        for frame in frames_of(records(), train_bytes):
            out.append(frame)
            size += len(frame)
            if size > 1 << 20:
                yield batch_of(FRAMES, [out])
                out, size = [], 0
        if out:
            yield batch_of(FRAMES, [out])

    frames = known.mapInArrow(archive, FRAMES)
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per page record: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (NULL for
    revisits, and everywhere without ``payloads``; digests are checked either way)."""
    schema = RECORDS if payloads else T.StructType(RECORDS.fields[:-1])
    width = len(schema)

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for record in records_of(batch.column(0)[i].as_buffer()):
                    row = parsed(record)
                    if row is None:
                        continue
                    rows.append(row[:width])
                    size += len(record) if payloads else 100
                    if size > 1 << 20:
                        yield batch_of(schema, [list(c) for c in zip(*rows)])
                        rows, size = [], 0
                if rows:
                    yield batch_of(schema, [list(c) for c in zip(*rows)])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(read, schema)
