import hashlib
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from shelfcast.llm import exact_blocks, simhash_grid
from shelfcast.llm.hashing import xxh64_slices

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = SCHEMA + ", row_no long, name string, fp long, near_row long, text_sha string, keep_doc_id long, part_no int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), 1, "n", 2, 3, "k", 4, 5) for d, t in rows], CLASH)


def exact_expected(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    return sorted(((d, max((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""]),
                    hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows), key=str)


ROWS = [(1, "same"), (2, "same"), (3, None), (4, ""), (None, ""), (5, "x" * 100), (6, "x" * 100), (7, "x" * 99 + "y"),
        (8, "é" * 50), (9, "y" + "x" * 99), (10, "abcdabcd"), (11, "abcd"), (12, "abcdabcdabcd"), (13, "abcdabcd"), (5, "x" * 100)]


def test_exact_groups_match_brute_force(spark):
    rows = ROWS + [(100 + i, "hot copy " * 3) for i in range(300)]
    for size in (4, exact_blocks.BLOCK_BYTES):
        got = exact_blocks.exact_groups(frame(spark, rows), size).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == exact_expected(rows)
        # exactly one row of each group is kept, and it has the group's largest id
        kept = [r for r in got if r.kept]
        assert len(kept) == len({t or "" for _, t in rows}) and all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_keeps_columns_and_one_of_repeated_rows(spark):
    got = exact_blocks.dedup_exact(frame(spark, ROWS))
    assert got.columns == frame(spark, ROWS).columns
    assert sorted((r.doc_id, r.text or "") for r in got.collect()) == sorted(
        {(max(d or 0 for d, u in ROWS if (u or "") == (t or "")), t or "") for _, t in ROWS})


def test_exact_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_blocks.exact_groups(empty).count() == 0 and exact_blocks.dedup_exact(empty).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_xxh64_of_slices():
    rng = random.Random(3)
    data = np.frombuffer(bytes(rng.randrange(256) for _ in range(400)) + b" " * 8, np.uint8)
    pairs = [(a, n) for a in (0, 1, 5) for n in range(0, 120)]
    got = xxh64_slices(data, np.array([a for a, _ in pairs]), np.array([n for _, n in pairs]))
    assert [int(x) for x in got] == [xxhash.xxh64_intdigest(data[a:a + n].tobytes(), 42) for a, n in pairs]


def test_fingerprints_of_odd_texts():
    texts = [None, "", " \t\n", "One", "one TWO", "É é \x0b É\x0ca\x1cb", "w " * 5000, "a b c " * 700, " x y z"]
    raw = [(t or "").encode() for t in texts]
    want = [plain_fingerprint(t) for t in texts]
    assert [int(x) for x in simhash_grid.fingerprints(raw)] == want
    assert [int(x) for x in simhash_grid.fingerprints(raw, together=300)] == want  # the windows of long texts


def plain_components(rows):
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    distinct = sorted({f for _, f in prints})
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for d, f in prints:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return sorted(((d, f, least.get(find(f))) for d, f in prints), key=str)


def near_rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    base = [rng.choice(vocabulary) for _ in range(220)]
    rows = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "lonely words here"), (4, "ONE")]
    for i in range(150):  # a chain of near copies: each differs from the first in a few words
        words = list(base)
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30)))) for i in range(150)]
    return rows


def test_near_classes_match_brute_force(spark):
    rows = near_rows()
    want = plain_components(rows)
    for cell in (2, simhash_grid.CELL):  # tiny cells force the chunk pairs
        got = simhash_grid.near_classes(frame(spark, rows), cell=cell).collect()
        assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want


def test_links_lose_no_close_pair(spark):
    rng = random.Random(11)
    centre = rng.getrandbits(64)
    prints = {centre}
    for _ in range(400):  # a dense cloud, with chains three bits apart
        flipped = rng.choice(sorted(prints)) if rng.random() < 0.5 else centre
        for b in rng.sample(range(20), rng.randint(1, 3)):
            flipped ^= 1 << (3 * b)
        prints.add(flipped)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in sorted(prints)]
    frame_ = spark.createDataFrame(signed, "fp long")
    for cell in (3, 4096):
        links = simhash_grid.links_of(frame_, cell=cell).collect()
        mask = (1 << 64) - 1
        assert all(((r.u & mask) ^ (r.v & mask)).bit_count() <= 3 for r in links)
        root = {p: p for p in prints}

        def find(f, root=root):
            while root[f] != f:
                f = root[f]
            return f

        for r in links:
            root[find(r.u & mask)] = find(r.v & mask)
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 3:
                    assert find(a) == find(b)


def test_near_dedup_keeps_the_smallest_id(spark):
    rows = near_rows()
    got = simhash_grid.dedup_near(frame(spark, rows))
    assert got.columns == frame(spark, rows).columns
    classes = {(c if c is not None else f) for _, f, c in plain_components(rows)}
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == sorted(
        {c for _, _, c in plain_components(rows) if c is not None})
    assert got.count() == len(classes)


def test_near_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash_grid.near_classes(empty).count() == 0 and simhash_grid.dedup_near(empty).count() == 0


def test_members_of_cells_are_not_broadcast(spark, capsys):
    prints = spark.range(2000).select(F.xxhash64("id").alias("fp"))
    links = simhash_grid.links_of(prints)
    links.explain()
    assert "BroadcastExchange" not in capsys.readouterr().out
