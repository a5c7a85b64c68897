import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from shelfcast.llm import chunk_divergence as cd

CLASH = "doc_id long, text string, lang string, source string, n_chars long, chunk string, term string, number int, docs long"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def plain(rows, least):
    """The contract, restated over (text, lang, source) rows."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        terms = TERM.findall(lowered(text or ""))
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    kept = {g: sorted(t for t, n in docs[g].items() if n >= least) for g in {lang for lang, _ in groups}}

    def share(count, total, v):
        return 1 + 1_000_000_000 * (count + 2) // (total + 2 * v)

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    out, p = [], {}
    for lang, source in groups:
        total, v = sum(counts[lang, source][t] for t in kept[lang]), len(kept[lang])
        p[lang, source] = {t: share(counts[lang, source][t], total, v) for t in kept[lang]}
    for lang, source in groups:
        own, ranked = p[lang, source], []
        ranked.append(("pair", [(sum(f(own[t], p[lang, s][t]) for t in own), s) for g, s in groups if g == lang and s != source]))
        whole = Counter()
        for g, s in groups:
            if g == lang:
                whole.update({t: counts[g, s][t] for t in own})
        q = {t: share(whole[t], sum(whole.values()), len(own)) for t in own}
        ranked.append(("term", [(f(own[t], q[t]), t) for t in own if counts[lang, source][t] > 0 and own[t] > q[t]]))
        for part, items in ranked:
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, i) for i, (value, item) in enumerate(items, 1) if part == "pair" or i <= 10]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i % 7, t, g, s, 1, "c", "t", 3, 4) for i, (t, g, s) in enumerate(rows)], CLASH)


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def some_rows(n=300):
    rng = random.Random(5)
    words = ["The", "the,", "(the)", "é", "É", "don't", "x1y", "a-b-A", "naïve", "　wide", "𝒳z", "--", "12", "_q_"] + [f"w{c}" for c in "abcdefghij"]
    rows = [(rng.choice([" ", "\t", "\n", "\x0b", "\x1c"]).join(rng.choices(words, k=rng.randrange(30))),
             rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "b", "c", None, "ä"])) for _ in range(n)]
    rows += [(None, "en", "only null"), ("", "fr", "x"), ("rare words here", "fr", "y"), (None, None, None)]
    return rows + [("same text the", "en", "a")] * 40


def test_divergence_equals_plain_version(spark):
    rows = some_rows()
    assert result(cd.divergence(frame(spark, rows))) == plain(rows, 10)


def test_small_runs_tiles_and_long_texts(spark, monkeypatch):
    # the settings are module values that workers read from the closure's module, so only driver-side ones are changed
    monkeypatch.setattr(cd, "PARTS", 3)
    rows = some_rows(60) + [("long " * 400_000 + "x" * 2_000_000 + " tail", "en", "a"), ("é" * 600_000, "en", "b")]
    assert result(cd.divergence(frame(spark, rows), least=3)) == plain(rows, 3)


def test_many_sources_take_several_tiles(spark):
    rng = random.Random(9)
    rows = [(" ".join(rng.choices("abcdefgh", k=4)), "en", f"s{i % 300:03d}") for i in range(900)]
    assert result(cd.divergence(frame(spark, rows), least=2)) == plain(rows, 2)


def test_document_counts_near_the_limit(spark):
    """Terms in several chunks whose documents overlap are kept by distinct documents, not by sums."""
    nine = [("edge edge, (edge)", "en", f"s{i % 2}") for i in range(9)]
    ten = [("limit", "en", "s0")] * 5 + [("limit, limit", "en", "s1")] * 5
    got = result(cd.divergence(frame(spark, nine + ten)))
    assert got == plain(nine + ten, 10)
    docs = frame(spark, nine + ten).select("text", "lang", "source")
    counts = cd.term_counts(docs, cd.numbered_sources(docs))
    assert {tuple(r) for r in counts.collect()} == {("en", "limit", 0, 5, True), ("en", "limit", 1, 10, False)}


def test_nothing(spark):
    assert cd.divergence(frame(spark, [])).count() == 0
    assert result(cd.divergence(frame(spark, [(None, "en", "a"), ("", "en", "b")]))) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def unpacked(batch):
    rows = []
    for r in batch.to_pylist():
        entries = np.frombuffer(r["entries"], cd.ENTRY)
        rows.append({**r, "doc_rows": np.frombuffer(r["doc_rows"], "<i8").tolist(), "entries": {int(e["number"]): int(e["count"]) for e in entries}})
    return rows


def test_counts_of_a_run_and_its_terms():
    texts = pa.array(["one Two two three" if i % 2 else "two" for i in range(20)] + [" ", "", "x-two-two \u3000 12"], pa.large_string())
    got = cd.counted_run(texts, pa.array(["en"] * 23), np.arange(23) % 4, 100, 12)
    rows = {r["chunk"]: r for r in unpacked(got)}
    assert {c: r["docs"] for c, r in rows.items()} == {"one": 10, "two": 20, "three": 10, "x-two-two": 1, "\u3000": 1, "12": 1}
    assert rows["two"]["doc_rows"] == [] and sorted(rows["one"]["doc_rows"]) == list(range(101, 120, 2))
    assert rows["two"]["entries"] == {0: 5, 1: 10, 2: 5, 3: 10} and rows["one"]["entries"] == {1: 5, 3: 5}
    assert cd.counted_run(texts.slice(20, 2), pa.array(["en"] * 2), np.zeros(2, np.int64), 0, 3) is None
    # the same rows from two tasks, tokenized together
    both = pa.Table.from_batches([got, got]).sort_by("chunk")
    terms = {(r["term"], r["docs"]): r for r in unpacked(cd.with_terms(both, 30))}
    assert set(terms) == {("one", 20), ("two", 40), ("three", 20), ("x", 2), ("two", 2), ("\u3000", 2)}
    assert terms["two", 2]["times"] == 2 and terms["two", 40]["entries"] == {0: 10, 1: 20, 2: 10, 3: 20}
    assert terms["two", 40]["doc_rows"] == [] and len(terms["one", 20]["doc_rows"]) == 20


def test_groups_are_never_cut(monkeypatch):
    monkeypatch.setattr(cd, "ROWS", 4)
    rows = [("a", i) for i in range(3)] + [("b", i) for i in range(30)] + [("c", 0), ("d", 0)]
    batches = [pa.RecordBatch.from_pylist([{"k": k, "v": v} for k, v in rows[i:i + 3]]) for i in range(0, len(rows), 3)]
    tables = list(cd._whole_groups(iter(batches), 1))
    keys = [set(t.column(0).to_pylist()) for t in tables]
    assert sum(len(t) for t in tables) == len(rows) and len(keys) > 1
    assert all(not a & b for i, a in enumerate(keys) for b in keys[i + 1:])
