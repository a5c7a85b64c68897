import math
import random

import numpy as np

from shelfcast.llm import topk_blocks, url_bloom
from shelfcast.llm.queries import BAD_LABELS, RULES

PAGES = "page_id long, url string, html string, key string, block long, row_no long"


def plain_judge(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for mark in "/?#":
        host = host.split(mark)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), v == "block", h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    key = (host[4:] if host.startswith("www.") else host) + path.rstrip("/")
    verdict = best[3] if best else "block" if key in listed else "allow"
    return host, path, best[2] if best else None, verdict


def test_pages_are_judged_as_by_hand(spark):
    rng = random.Random(12)
    hosts = ["org", "example.org", "A.Example.ORG", "xexample.org", "com", "a.com", "www.spam-farm.net", "cheap-pills.com", "b.net", "", ".org", "a..org"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/123?q=/es/", "/fr/x#/de/", "/de/", "/de", "?x", "#/fr/", "/FR/"]
    urls = [f"{s}{h}{p}" for s in ("http://", "x://", "") for h in hosts for p in paths]
    urls += [None, "", "://", "a://b://c.org/", "http://user@h.com:80/fr/", "h://É.org/", "http://" + "a." * 3000 + "org/x", "http://o.net/" + "y" * 50_000]
    rng.shuffle(urls)
    rows = [(i if i else None, u, "h", "k", 1, 2) for i, u in enumerate(urls + urls[:20])]
    pages = spark.createDataFrame(rows, PAGES)
    listed = url_bloom.listed_by_label(pages, BAD_LABELS)
    keys = {r.key for r in listed.collect()}
    assert keys and "b.net" not in keys
    got = url_bloom.judged(pages, RULES, listed).collect()
    want = sorted(((i, *plain_judge(u, keys)) for i, u, *_ in rows), key=str)
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=str) == want


def test_filter_has_no_false_negatives_and_few_false_hits(spark):
    keys = spark.range(5000).selectExpr("concat('u ', id) AS key")
    blocks = -(-5000 * url_bloom.BITS_PER_KEY // 512)
    made = url_bloom.bloom_filter(keys, blocks)
    assert made.count() <= blocks
    assert url_bloom.possible(keys, made, blocks).count() == 5000
    others = spark.range(5000, 105_000).selectExpr("concat('u ', id) AS key")
    assert url_bloom.possible(others, made, blocks).count() < 1000


def test_no_pages_and_no_lists(spark):
    empty = spark.createDataFrame([], PAGES)
    nothing = spark.createDataFrame([], "key string")
    assert url_bloom.judged(empty, RULES, nothing).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/", "", "", 1, 1)], PAGES)
    r = url_bloom.judged(one, [], nothing).first()
    assert (r.rule, r.verdict, r.listed) == (None, "allow", False)


VECTORS = "vec_id long, embedding array<float>, label int, row_no long, vector string"


def plain_top(rows, every=100, k=10):
    fine = [(i, v, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, (v, e) in enumerate(rows)
            if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, v, q in fine:
        if v is not None and v % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c)), w is None, w or 0) for j, w, c in fine if j != i)
            out += [(v, n + 1, None if null else w, -s) for n, (s, null, w) in enumerate(scored[:k])]
    return sorted(out, key=str)


def search(spark, rows):
    df = spark.createDataFrame([(v, e, 1, 2, "x") for v, e in rows], VECTORS)
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in topk_blocks.top_k(df).collect()), key=str)


def test_search_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16))
    rows = [(i, [float(x) for x in centres[i % 6] + 0.3 * rng.normal(size=16)]) for i in range(1500)]
    rows += [(2000 + i, [0.25] * 16) for i in range(300)]  # ties
    rows += [(3000, None), (3001, [float("nan")] * 16), (3002, [None] * 16), (3100, [float("inf")] + [0.0] * 15),
             (None, [0.25] * 16), (100, [float(x) for x in centres[1]]), (2000, [0.25] * 16), (4000, [0.5, 0.5]), (4001, [])]
    assert search(spark, rows) == plain_top(rows)


def test_small_shards_and_blocks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(700)]
    want = plain_top(rows)
    monkeypatch.setattr(topk_blocks, "SHARD", 2)
    monkeypatch.setattr(topk_blocks, "CHUNK", 3)
    monkeypatch.setattr(topk_blocks, "BLOCK", 16)
    assert search(spark, rows) == want


def test_blocks_are_pruned():
    rng = np.random.default_rng(7)
    scored = []

    class Watched(np.ndarray):
        pass

    blocks = []
    for b in range(50):
        x = rng.integers(-10, 10, size=(32, 8)) + (1000 if b == 3 else 0)
        blocks.append((np.arange(32) + 32 * b, np.arange(32) + 32 * b, x, x.max(axis=0), x.min(axis=0)))
    kept = topk_blocks._Best.add
    try:
        topk_blocks._Best.add = lambda self, which, s, i: (scored.append(len(which)), kept(self, which, s, i))[1]
        best = topk_blocks.search_cell(np.ones((1, 8), np.int64), np.array([-1]), np.array([topk_blocks.LOWEST]), blocks)
    finally:
        topk_blocks._Best.add = kept
    assert sum(scored) == 1 and (best.vec[0] // 32 == 3).all()


def test_few_and_no_vectors(spark):
    assert search(spark, []) == []
    assert search(spark, [(0, [1.0]), (1, [0.5])]) == [(0, 1, 1, 512 * 1024)]
    assert search(spark, [(0, [1.0])]) == []
    assert search(spark, [(0, None)]) == []
