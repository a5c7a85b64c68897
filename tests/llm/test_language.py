import math
from collections import Counter

import numpy as np
import pytest

from shelfcast.llm import lang_kn
from shelfcast.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, score string, lang_pred int, rejected string"


def model_of(corpus: dict[str, list[str]]) -> lang_kn.KneserNey:
    langs = sorted(corpus)
    of, codes, counts = [], [], []
    for i, lang in enumerate(langs):
        code, n = np.unique(lang_kn._codes([lang_kn._letters(t) for t in corpus[lang]])[0], return_counts=True)
        of += [i] * len(code)
        codes += code.tolist()
        counts += n.tolist()
    return lang_kn.KneserNey(langs, np.array(of, np.int64), np.array(codes, np.uint64), np.array(counts))


CORPUS = {"xx": ["abab baba abba", "aab aba", "bb ab a"], "yy": ["cdcd dcc", "ccd ddc cdd c"]}


def plain_probability(texts, gram, order, size):
    """Interpolated Kneser-Ney straight from its formula, over dictionaries."""
    tables = {lang_kn.ORDER: Counter()}
    for t in texts:
        s = " " * (lang_kn.ORDER - 1) + lang_kn._letters(t) + " "
        tables[lang_kn.ORDER].update(s[i:i + lang_kn.ORDER] for i in range(len(s) - lang_kn.ORDER + 1))
    for k in range(lang_kn.ORDER - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    if order == 0:
        return 1 / size
    table = tables[order]
    ones, twos = (sum(n == k for n in table.values()) for k in (1, 2))
    d = min(0.9, max(0.1, ones / max(1, ones + 2 * twos)))
    own = gram[-order:]
    following = {g: n for g, n in table.items() if g[:-1] == own[:-1]}
    below = plain_probability(texts, gram, order - 1, size)
    if not following:
        return below
    total = sum(following.values())
    return max(table[own] - d, 0) / total + d * len(following) / total * below


def test_probabilities_follow_the_formula():
    model = model_of(CORPUS)
    size = len({c for t in CORPUS.values() for x in t for c in lang_kn._letters(x) + " "}) + 1
    for gram in ("abab", " aba", "cdcd", "  ab", "zzzz", "abac", "   a", "bab ", "dcdc"):
        code = np.array([sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(gram))], np.uint64)
        for j, lang in enumerate(sorted(CORPUS)):
            assert math.isclose(math.exp(model.score(code)[0, j]), plain_probability(CORPUS[lang], gram, 4, size), rel_tol=1e-4)


def test_probabilities_add_to_one():
    model = model_of(CORPUS)
    letters = "abcd \0"  # the alphabet and one symbol for all others
    for context in ("aba", "  c", "zzz", "cdd"):
        codes = np.array([sum(ord(c) << (16 * (3 - i)) for i, c in enumerate(context + x)) for x in letters], np.uint64)
        assert np.allclose(np.exp(model.score(codes)).sum(axis=0), 1, atol=1e-3)


def test_entropy_of_long_texts_in_parts():
    model = model_of(CORPUS)
    text = lang_kn._letters("abab baba " * 9)
    whole, n = model.entropies([text, "ab"])
    assert n.tolist() == [len(text) + 1, 3] and whole[0, 0] < whole[0, 1]


def test_held_out_accuracy(spark):
    got = QUERIES["op4_language_kn"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    kept_out = [r for r in rows if r.held_out and r.lang is not None]
    assert sum(r.lang == r.lang_pred for r in kept_out) >= 0.98 * len(kept_out)
    assert sum(r.rejected for r in rows) <= 0.005 * len(rows)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


@pytest.fixture(scope="module")
def two_languages(spark):
    rows = [(i, ("the cat and the hat " if i % 2 else "der hund und die katze ") * (1 + i % 5), "en" if i % 2 else "de")
            for i in range(200)]
    rows += [(500, None, "en"), (501, "", "de"), (502, "12 34 !! \u00b2\u00bd", "en"), (503, "the cat", None), (503, "the cat", None),
             (None, "der hund und", "de"), (504, "the cat and the hat " * 20000, None), (505, "ψφξ ωλκ θηβ " * 30, None)]
    return spark.createDataFrame([(d, t, lang, "s", "mine", 1, "x") for d, t, lang in rows], SCHEMA)


def test_cases_without_letters_and_rejection(spark, two_languages):
    names = ("a", "b", "c")
    got = lang_kn.identified(two_languages, lang_kn.train_on_fold(two_languages), names).collect()
    assert len(got) == 208
    by = {r.doc_id: r for r in got}
    for d in (500, 501, 502):
        assert (by[d].a, by[d].b, by[d].c) == ("und", 0.0, True)
    assert by[503].a == by[504].a == "en" and by[None].a == "de" and not by[504].c
    assert by[505].c and by[505].a in ("de", "en")  # letters no model knows
    assert all(by[i].a == ("en" if i % 2 else "de") and not by[i].c for i in range(200))
    kept = lang_kn.keep_identified(two_languages)
    assert kept.columns == two_languages.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id >= 500) == [503, 503, 504]


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lang_kn.keep_identified(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, "abc", None, "s", "", 1, "")], SCHEMA)
    r = lang_kn.identified(unlabelled, lang_kn.train_on_fold(unlabelled), ("a", "b", "c")).first()
    assert (r.a, r.b, r.c) == ("und", 0.0, True)


def test_rare_languages_are_not_rejected(spark):
    """Six languages of one document each beside thousands of another: all documents count in the calibration."""
    import random
    rng = random.Random(4)
    words = {"en": "the cat and hat house river walks under over stone".split(), "f": "talo joki kivi kissa hattu alla yli kulkee".split()}
    rows = [(i, " ".join(rng.choices(words["f" if i % 1500 == 0 else "en"], k=12)), f"f{i}" if i % 1500 == 0 else "en")
            for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_kn.train(docs)
    assert np.isfinite(model.calibration).all() and (model.calibration > 0).all()
    got = lang_kn.identified(docs.where("lang <> 'en'"), model).collect()
    assert len(got) == 6 and all(r.lang_pred == r.lang and not r.rejected for r in got)


def test_language_without_calibration_is_not_rejected():
    model = model_of(CORPUS)
    model.calibrate({"xx": (100, 10_000, 9000.0, 8200.0)})
    assert model.predict(["cdcd dcc ccd"])[0] == ["yy"] and not model.predict(["cdcd dcc ccd"])[2][0]
    model.calibrate({})
    assert not model.predict(["cdcd dcc ccd", "abab"])[2].any()


def test_model_in_tables_gives_the_same(spark, two_languages, monkeypatch):
    names = ("a", "b", "c")
    small = lang_kn.train_on_fold(two_languages)
    want = lang_kn.identified(two_languages, small, names).collect()
    monkeypatch.setattr(lang_kn, "MOST_CELLS", 3)
    large = lang_kn.train_on_fold(two_languages)
    assert large.langs == small.langs == ["de", "en"]  # no count is dropped
    assert np.allclose(large.calibration, small.calibration, rtol=1e-3, atol=1e-4)
    got = lang_kn.identified(two_languages, large, names).collect()
    key = lambda r: (str(r.doc_id), r.a, r.c)
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert np.allclose(sorted(r.b for r in got), sorted(r.b for r in want), atol=1e-4)
    probes = ["the cat", "der hund", "zzz qqq", "thd hun"]
    rows = spark.createDataFrame(list(enumerate(probes)), "row_no long, text string")
    entropy, chars = small.entropies(probes)
    for r in large.entropies(rows).collect():
        assert r.chars == chars[r.row_no] and np.allclose(np.array(r.nats) / r.chars, entropy[r.row_no], rtol=1e-4)
