import hashlib
import random

import pytest
import zstandard

from shelfcast.llm import warc_zstd
from shelfcast.session import scratch_path

PAGES = "page_id long, url string, html string, sha string, payload string, keep_id long"


def plain(rows):
    best = {}
    for p, _, h in rows:
        best[h or ""] = max((x for x in (p, best.get(h or "")) if x is not None), default=None)
    out = []
    for p, _, h in rows:
        body = (h or "").encode()
        keep = best[h or ""]
        again = len(body) >= 1000 and p != keep
        out.append((p, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", keep if again else None))
    return sorted(out, key=str)


def some_pages():
    rng = random.Random(4)
    bodies = ["<html>" + " ".join(rng.choices(["<p>word", "é", "x", "</p>\r\n\r\n"], k=400)) for _ in range(30)]
    rows = [(i, f"http://h.org/{i} a\r\nWARC-Type: none", rng.choice(bodies)) for i in range(200)]
    rows += [(500, None, None), (501, "", ""), (None, "u", bodies[0]), (502, "u", "short"), (503, "u", "short"), (199, "again", bodies[1]),
             (600, "sep", warc_zstd.SEPARATOR * 300), (601, "sep", warc_zstd.SEPARATOR * 300), (700, "long", "y" * 3_000_000),
             (None, "v", "z" * 2000), (None, "w", "z" * 2000), (701, "b999", "b" * 999), (702, "b999", "b" * 999), (703, "é", "é" * 500), (704, "é", "é" * 500)]
    rng.shuffle(rows)
    return rows


def pages_of(spark, rows):
    return spark.createDataFrame([(p, u, h, "s", "p", 1) for p, u, h in rows], PAGES)


def archived(spark, rows, files=4, **settings):
    path = scratch_path(spark, "warc-test")
    warc_zstd.write_archive(pages_of(spark, rows).coalesce(files), path, **settings)
    return path


def test_archive_reads_back_as_written(spark):
    rows = some_pages()
    got = warc_zstd.read_archive(spark, archived(spark, rows)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == plain(rows)
    # responses hold their payload, revisits none
    assert sorted((r.page_id, bytes(r.payload)) for r in got if r.record_type == "response" and r.page_id is not None) == sorted(
        (p, (h or "").encode()) for (p, _, h) in rows if (p, "response") in {(r.page_id, r.record_type) for r in got} and p is not None)
    assert all(r.payload is None for r in got if r.record_type == "revisit")


def files(spark, path):
    return [bytes(r.content) for r in spark.read.format("binaryFile").load(path).select("content").collect() if r.content]


def test_files_are_plain_zstandard_with_a_leading_dictionary(spark):
    rows = some_pages()
    seen = 0
    for data in files(spark, archived(spark, rows, 1, train_bytes=50_000)):
        assert int.from_bytes(data[:4], "little") == warc_zstd.DICTIONARY_MAGIC
        size = int.from_bytes(data[4:8], "little")
        dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + size], max_output_size=1 << 20))
        assert dictionary.as_bytes()[:4] == bytes.fromhex("37a430ec")
        # a reader that knows nothing of this module: frame after frame, skippable ones passed over
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data[8 + size:], read_across_frames=True)
        text = reader.read()
        records = list(warc_zstd.records_of(data))
        assert text == b"".join(records) and all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
        seen += len(records)
    assert seen == len(rows)


def test_a_dictionary_saves_space():
    records = [warc_zstd.page_record(i, f"http://a.org/{i}", b"<html><head><title>page</title></head>" + bytes(str(i * 7919), "ascii") * 5,
                                     "00", False, None, "1970-01-01T00:00:00Z") for i in range(2000)]
    with_it = sum(map(len, warc_zstd.frames_of(records)))
    alone = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert with_it < 0.7 * alone


def test_archives_of_other_writers():
    record = warc_zstd.page_record(7, "http://a.org/", b"x" * 50, "00", False, None, "1970-01-01T00:00:00Z")
    info = warc_zstd._record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:x>")], b"software: other\r\n")
    stream = zstandard.ZstdCompressor().compressobj()  # a frame without its content's size
    unsized = stream.compress(record) + stream.flush()
    data = zstandard.ZstdCompressor().compress(info) + b"\x51\x2a\x4d\x18\x03\x00\x00\x00abc" + unsized
    records = list(warc_zstd.records_of(data))
    assert warc_zstd.parsed(records[0]) is None and warc_zstd.parsed(records[1])[0] == 7
    assert list(warc_zstd.records_of(b"")) == []


def test_damage_is_noticed():
    record = warc_zstd.page_record(7, "http://a.org/", b"x" * 50, "00", False, None, "1970-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        warc_zstd.parsed(record.replace(b"xxxxx", b"xyxxx", 1))
    frame = zstandard.ZstdCompressor().compress(record)
    with pytest.raises(ValueError):
        list(warc_zstd.records_of(frame[:-4]))
    with pytest.raises(ValueError):
        list(warc_zstd.records_of(frame + b"P*M"))


def test_no_pages(spark):
    assert warc_zstd.read_archive(spark, archived(spark, [])).count() == 0
    assert warc_zstd.read_archive(spark, archived(spark, [(1, "u", "h")])).count() == 1
