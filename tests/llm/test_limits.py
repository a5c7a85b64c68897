"""Odd column names and types, and inputs that once took quadratic time."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import es_mix, exact_blocks, hilbert_pack, lang_kn, pii_boost, secret_cost, simhash_grid
from shelfcast.llm.queries import table


def odd(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({"a.b": F.col("doc_id"), "text_sha_k": F.lit(1), "tags": F.create_map(F.lit("k"), F.col("doc_id")), "other_sha": F.lit("x")})


def test_dotted_clashing_and_map_columns(spark):
    words = [" ".join(random.Random(i).choices(["house", "tree", "river", "stone", "light"], k=60)) for i in range(30)]
    df = odd(spark, [(i, w, "en", "s") for i, w in enumerate(words)] + [(3, words[3], "en", "t"), (99, words[3], "en", "s")])
    kept = exact_blocks.dedup_exact(df)
    assert kept.columns == df.columns and kept.count() == 30 and kept.where("doc_id = 99").first()["tags"] == {"k": 99}
    twins = odd(spark, [(1, "same", "en", "s"), (1, "same", "en", "s"), (1, "same", "de", "s")])
    assert exact_blocks.dedup_exact(twins).count() == 1
    near = simhash_grid.dedup_near(df)
    assert near.columns == df.columns and near.where("doc_id = 99").count() == 0
    named = lang_kn.keep_identified(df)
    assert named.columns == df.columns and named.select("`a.b`").count() > 20


def brute_walk(value):
    """The keyboard walk part alone, tried at every length."""
    best = [0.0] + [np.inf] * len(value)
    for i in range(len(value)):
        best[i + 1] = min(best[i + 1], best[i] + np.log10(26))
        for a in range(i - 1):
            best[i + 1] = min(best[i + 1], best[a] + 0.3 + np.log10(47) + 0.35 * (i - a))
    return best[-1]


def test_long_keyboard_walk_is_linear():
    for n in (3, 4, 9, 40):
        assert secret_cost.guess_cost("qwedsa"[:n] if n < 6 else ("qw" * n)[:n], {}) <= brute_walk("q" * n) + 1e-9
    start = time.perf_counter()
    secret_cost.guess_cost("qw" * 4000, {})
    assert time.perf_counter() - start < 4


def test_short_values_are_priced():
    base, added, highest = secret_cost.scan("password: 一丁丂七丄丅1 and token: abc", {})
    assert highest is not None and highest > secret_cost.LEAST_COST and len(added) == 1


def test_a_word_of_sixteen_megabytes():
    start = time.perf_counter()
    simhash_grid.fingerprints([b"x" * (16 << 20), b"a b " + b"y" * (3 << 20) + b" c d"])
    assert time.perf_counter() - start < 5


def test_many_spans_of_one_document():
    rng = random.Random(1)
    spans = [(0, s, s + rng.randrange(1, 9)) for s in rng.sample(range(1_000_000), 100_000)]
    start = time.perf_counter()
    kept = pii_boost.apart(spans)
    assert time.perf_counter() - start < 5
    taken = np.zeros(1_000_010, bool)
    for _, s, e in spans[:2000]:
        free = not taken[s:e].any()
        assert free == ((0, s, e) in set(kept[:2000]))
        if free:
            taken[s:e] = True


def test_personal_data_of_the_given_documents(spark):
    """Beside the base spans, the given texts hold no number or address that a reader would take for personal: numbers with
    a wrong check digit, section numbers and strings of letters and digits."""
    other = re.compile(r"\d{16}\W*|\d+\.(\d+\.)?|\W*(?=[0-9a-zA-Z+/_=-]*\d)(?=[0-9a-zA-Z+/_=-]*[a-zA-Z])[0-9a-zA-Z+/_=-]{8,}\W*")
    left = []
    for row in table(spark, "/root/testdata/sf0.01", "documents").collect():
        covered = pii_boost.base_spans(row.text) + [(0, m.start(), m.end()) for m in re.finditer(r"AKIA\w+|[0-9a-f]{16,}", row.text)]
        for m in re.finditer(r"\S*[0-9@]\S*", row.text):
            if not any(s < m.end() and m.start() < e for _, s, e in covered) and not other.fullmatch(m.group()):
                left.append(m.group())
    assert len(left) <= 5, left[:20]


def test_large_vocabularies_are_refused(tmp_path):
    from tokenizers import Tokenizer, models
    path = str(tmp_path / "large.json")
    Tokenizer(models.WordLevel({f"w{i}": i for i in range(70_000)}, unk_token="w0")).save(path)
    with pytest.raises(ValueError, match="65,536"):
        hilbert_pack.WordTokenizer(path)


def test_a_model_too_large_to_broadcast_stays_in_tables(spark, monkeypatch):
    monkeypatch.setattr(lang_kn, "MOST_CELLS", 500)
    rng = random.Random(3)
    rows = [(i, "".join(chr(0x4e00 + 40 * (i % 6) + rng.randrange(40)) for _ in range(60)), f"l{i % 6}", "s") for i in range(120)]
    model = lang_kn.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert isinstance(model, lang_kn.TableModel) and len(model.langs) == 6


def test_mix_equals_its_plain_version(spark):
    rng = random.Random(8)
    rows = [(i, " ".join("w" for _ in range(rng.choice([1, 2, 7, 30, 90, 400]))), rng.choice(["a", "b", "b", "c", None])) for i in range(400)]
    docs = spark.createDataFrame([(d, t, "en", s) for d, t, s in rows], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 400, 3)], "doc_id long, quality int")
    hashed = docs.select("doc_id", F.xxhash64("doc_id", F.xxhash64("text"), F.lit("mix")).alias("h")).collect()
    uniform = {r.doc_id: (((r.h % (1 << 64)) >> 11) + 0.5) / (1 << 53) for r in hashed}
    weight = {i: {1: 2.0, 0: 0.5}[i % 2] for i in range(0, 400, 3)}
    size = {d: len(t.split()) for d, t, _ in rows}
    total = {}
    for d, _, s in rows:
        total[s] = total.get(s, 0) + size[d]
    want = {}
    for s, n, target in es_mix.targets(list(total.items())):
        own = sorted((-np.log(uniform[d]) / weight.get(d, 1.0), d) for d, _, x in rows if x == s)
        epochs = min(2, int(target // n))
        budget = max(0, round(target - epochs * n))
        copies = {d: epochs for _, d in own}
        while True:
            before, took = 0, []
            for _, d in [x for x in own if size[x[1]] <= budget]:
                if before + size[d] <= budget:
                    took.append(d)
                before += size[d]
            if not took:
                break
            budget -= sum(size[d] for d in took)
            copies.update({d: epochs + 1 for d in took})
            own = [x for x in own if x[1] not in took]
        if budget > 0 and own:
            smallest = min(own, key=lambda x: (size[x[1]], x[0]))[1]
            if size[smallest] < 2 * budget:
                copies[smallest] = epochs + 1
        want.update({d: c * size[d] for d, c in copies.items()})
    got = {r.doc_id: r.taken for r in es_mix.mixture(docs, labels).collect()}
    assert got == want
