import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from shelfcast.llm import es_mix, hilbert_pack
from shelfcast.llm.common import running_sums, slices

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, mix_row long, copies int, key string"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, len(t or ""), 1, 2, "k") for d, t, s in rows], SCHEMA)


def many(n=300):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([1, 3, 10, 40, 200]))),
             rng.choice(["b", "a", "a", "a", "é", None, "Z"])) for i in range(n)]
    return rows + [(n, None, "a"), (n + 1, "", "b"), (None, "x y", "a"), (7, "again", "a"), (7, "again", "a"), (n + 2, None, "silent")]


def test_targets_stop_at_the_cap_and_share_the_rest():
    plan = es_mix.targets([(None, 100), ("b", 1000), ("a", 10), ("c", 500)])
    assert [p[0] for p in plan] == ["a", "b", "c", None]
    target = {s: t for s, _, t in plan}
    assert abs(sum(target.values()) - 1.5 * 1610) < 1e-6 and target["a"] == 20
    assert all(t <= 2 * n for _, n, t in plan)
    open_ = {s: t for s, n, t in plan if t < 2 * n}
    weight = {"a": 5, "b": 2, "c": 1, None: 5}
    assert len({round(t / weight[s], 6) for s, t in open_.items()}) <= 1
    assert es_mix.targets([]) == [] and es_mix.targets([("x", 0)]) == [("x", 0, 0.0)]


def test_mixture_comes_near_its_targets_and_repeats(spark):
    rows = many()
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(3, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    got = es_mix.mixture(docs, labels).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter(
        (d, len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))) for d, t, _ in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    again = es_mix.mixture(docs.repartition(5), labels).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    by_size = defaultdict(lambda: [0, 0.0, 0])
    for r in got:
        by_size[r.source_size][0] += r.taken
        by_size[r.source_size][1] = r.target
    for size, (taken, target, _) in by_size.items():
        assert size == 0 or abs(taken - target) <= 100  # half of the longest document


def test_epochs_come_before_fractions(spark):
    got = es_mix.mixture(documents(spark, many())).where("size > 0").collect()
    for r in got:
        epochs = int(r.target // r.source_size)
        assert epochs * r.size <= r.taken <= min(2, epochs + 1) * r.size


def test_heavier_documents_are_taken_more_often(spark):
    rows = [(i, "one two three four", "s" if i < 4000 else "t") for i in range(6000)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(6000)], "doc_id long, quality int, toxic int")
    taken = Counter()
    for r in es_mix.mixture(documents(spark, rows), labels).collect():
        taken[r.source_size, r.doc_id % 2] += r.taken > r.size * int(r.target // r.source_size)
    part = {k: v for k, v in taken.items() if 0 < taken[k[0], 0] + taken[k[0], 1] < k[0] // 4}
    assert part and all(taken[n, 1] > 1.3 * taken[n, 0] for n, _ in part)


def test_rows_of_the_mix_are_not_broadcast(spark, capsys):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    es_mix.mixture(documents(spark, many()), labels).explain()
    # the sources only, one row each
    assert "BroadcastHashJoin [row_no" not in capsys.readouterr().out


def test_mixed_documents_are_whole_rows(spark):
    rows = many()
    docs = documents(spark, rows)
    got = es_mix.mixed_documents(docs)
    assert got.columns == docs.columns
    want = Counter()
    for r in es_mix.mixture(docs).collect():
        if r.size:
            want[r.doc_id] += r.taken // r.size
    assert Counter(r.doc_id for r in got.collect() if (r.text or "").strip()) == +want
    empty = spark.createDataFrame([], SCHEMA)
    assert es_mix.mixture(empty).count() == 0 and es_mix.mixed_documents(empty).count() == 0


def test_running_sums_within_groups(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None, ""]), i, rng.choice([0, 1, 5, None])) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i long, n long")
    got = {r.i: r.before for r in running_sums(df, ["g", "i"], "n", "before", "g").collect()}
    total = Counter()
    for g, i, n in sorted(rows, key=lambda r: r[1]):
        assert got[i] == total[g]
        total[g] += n or 0
    assert [list(range(a, b)) for a, b in slices(iter([3, 3, 9, 1]), 6)] == [[0, 1], [2], [3]]


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert_pack.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        walk = grid[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "x\n\n y", "tail   ", "\t\tq", "é  x", "a<|endoftext|>b <|endoftext|>",
       "don't  we'll", "1 234  5", "🙂 🙂\U0001f600", "a\x1cb !\x1c c", "word " * 6000, "x" * 9000, "new\nline \n more"]


def test_word_pieces_have_the_ids_of_whole_texts():
    token, plain = hilbert_pack.tokenizer(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    rng = random.Random(9)
    texts = ODD[1:] + ["".join(rng.choice("ab é\n\t.'1  ") for _ in range(40)) for _ in range(500)]
    for text in texts:
        assert token(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_round_trip(spark):
    rows = [(i, t, "s") for i, t in enumerate(ODD)] + [(1000 + i, "some words " * (i % 37), None) for i in range(200)] + [(None, "no id", "s")]
    got = hilbert_pack.packed(documents(spark, rows), VOCABULARY).collect()
    plain = Tokenizer.from_file(VOCABULARY)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == r.length > 0 and zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, text, _ in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted(pieces[doc], key=lambda r: r.start)
        assert [i for r in own for i in np.frombuffer(r.ids, "<u2").tolist()] == ids
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert {r.doc_tokens for r in own} == {len(ids)}
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= hilbert_pack.LENGTH
        total += at
        padding += 0 if at & (at - 1) == 0 else hilbert_pack.LENGTH - at
    assert padding <= 0.02 * total
    assert hilbert_pack.packed(spark.createDataFrame([], SCHEMA), VOCABULARY).count() == 0
