import random
import re
from collections import Counter

import pytest

from shelfcast.llm import phrase_graph as pg

CLASH = "doc_id long, text string, lang string, source string, phrase string, n long, a long, head string"


def counted(rows):
    counts, words = Counter(), Counter()
    for text, lang in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall("[^ \t]+", piece)
            words["und" if lang is None else lang] += len(w)
            for size in range(1, 5):
                for i in range(len(w) - size + 1):
                    counts["und" if lang is None else lang, tuple(w[i:i + size])] += 1
    return counts, words


def plain(rows, least, top=2000):
    counts, words = counted(rows)
    candidates = {k: n for k, n in counts.items() if n >= least and len(k[1]) > 1}
    best = {}
    for (lang, w), a in candidates.items():
        longest = max((n for (g, v), n in candidates.items() if g == lang and len(v) > len(w)
                       and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))), default=None)
        if longest is not None and 100 * longest >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        best.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -a, x, y, words[lang], -score) for lang, found in best.items()
                  for i, (score, a, p, x, y) in enumerate(sorted(found)[:top], 1))


def frame(spark, rows):
    return spark.createDataFrame([(1, t, g, "s", "p", 2, 3, "h") for t, g in rows], CLASH)


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def some_rows(n=400):
    rng = random.Random(11)
    words = ["The", "the", "é", "É", "of", "a", "x-y", "#", "\x1cu", "w\x00", "　"]
    weights = [9, 5, 4, 3, 3, 2, 1, 1, 1, 1, 1]
    marks = [" "] * 14 + ["\t", ". ", ",", "\n", "! ", "\r\n", ";x ", "\x0b", "\x0c", ": "]

    def text():
        return "".join(w + rng.choice(marks) for w in rng.choices(words, weights, k=rng.randrange(60)))

    licence = "this text may be copied by all who keep this notice with it and ask for no more than that"
    rows = [(text(), rng.choice(["en", "de", None])) for _ in range(n)]
    rows += [(f"{text()}. {licence}. {text()}", "en") for _ in range(40)] + [(licence, "en")] * 35
    return rows + [(None, "en"), ("", None), ("...", "fr"), ("one", "it"), ("a b c d e", "")]


@pytest.mark.parametrize("least", [2, 30])
def test_collocations_equal_plain_version(spark, least):
    rows = some_rows()
    assert result(pg.collocations(frame(spark, rows), least)) == plain(rows, least)


def test_top_and_ties(spark):
    rows = [(f"p{i} q{i}", "en") for i in range(20) for _ in range(5)]
    assert result(pg.collocations(frame(spark, rows), 5, 7)) == plain(rows, 5, 7)


def test_shorter_counts_from_flow_and_ends(spark):
    rows = some_rows(150)
    counts, _ = counted(rows)
    got = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in pg.shorter_counts(pg.flows(frame(spark, rows), 1)).collect()}
    assert got == {k: n for k, n in counts.items() if len(k[1]) < 4}


def test_sieve_drops_no_frequent_phrase(spark):
    rng = random.Random(2)
    rows = [(" ".join(f"r{rng.randrange(4000)}" for _ in range(200)) + ". one two three four five", "en") for _ in range(60)]
    flow = pg.flows(frame(spark, rows), 30)
    counts, _ = counted(rows)
    frequent = {k: n for k, n in counts.items() if n >= 30}
    shorter = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in pg.shorter_counts(flow).collect()}
    assert all(shorter[k] == n for k, n in frequent.items() if len(k[1]) < 4)
    # and it does remove rare pairs
    assert flow.where("size = 1").count() > 3000 and flow.where("size = 4").count() < 100


def test_paths_are_compacted(spark):
    rows = [("a b c d e f g h", "en")] * 9 + [("x b c d e f y", "en")] * 4 + [("p q r s t u", "en")] * 3 + [("a a a a a a", "de")] * 5
    df = frame(spark, rows)
    flow = pg.flows(df, 2)
    edges = flow.where("size = 4").select("lang", "phrase", "n")
    nodes = pg.shorter_counts(flow).where("size = 3").select("lang", "phrase", "n")
    got = {(r.lang, r.path, r.edges, r.n) for r in pg.path_texts(pg.compacted(edges, nodes)).collect()}
    # b c d and d e f branch, c d e lies inside the shared path; piece ends stop a path
    assert got == {("en", "a b c d", 1, 9), ("en", "x b c d", 1, 4), ("en", "b c d e f", 2, 13), ("en", "d e f g h", 2, 9),
                   ("en", "d e f y", 1, 4), ("en", "p q r s t u", 3, 3), ("de", "a a a a", 1, 15)}


def test_long_path_and_long_text(spark):
    long = " ".join(f"w{i}" for i in range(700))
    rows = [(long, "en")] * 4 + [("z " * 700_000 + "end", "en"), ("y" * 2_000_000, "en")]
    paths = pg.flows(frame(spark, rows), 3)
    nodes = pg.shorter_counts(paths).where("size = 3").select("lang", "phrase", "n")
    edges = paths.where("size = 4 and n >= 3").select("lang", "phrase", "n")
    texts = {r.path for r in pg.path_texts(pg.compacted(edges, nodes)).collect()}
    assert long in texts
    assert result(pg.collocations(frame(spark, rows), 3))[0][6] == 4 * 700 + 700_002


def test_nothing(spark):
    assert pg.collocations(frame(spark, [])).count() == 0
    assert pg.collocations(frame(spark, [(None, None), ("", "en")])).count() == 0
