"""Registered queries against their SQL, and each pipeline stage against a plain version on its own input."""

import os
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from shelfcast.llm import queries
from test_dedup import plain_components

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    base = duckdb.connect()
    for file in os.listdir(SF):
        base.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    want = base.sql(queries.SQL[name])
    columns = sorted(want.columns)
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    # as Python values: pandas has two kinds of missing numbers
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want.select(*columns).fetchall())


def test_stages_follow_each_other(spark, tmp_path):
    docs = queries.table(spark, SF, "documents")
    columns, kept = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / f"{i}")
        stage(spark, docs, SF).write.parquet(out)
        docs = spark.read.parquet(out)
        kept.append(docs)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    rows = [[(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()] for df in kept[:4]]
    # clean documents are kept by language identification
    assert len(rows[0]) >= 0.99 * queries.table(spark, SF, "documents").count()
    best = {}
    for d, t in rows[0]:
        best[t] = max(d, best.get(t, d))
    assert sorted(rows[1]) == sorted((d, t) for t, d in best.items())
    assert sorted(d for d, _ in rows[2]) == sorted({c for _, _, c in plain_components(rows[1])})
    times = Counter(d for d, _ in rows[3])
    assert set(times) <= {d for d, _ in rows[2]} and max(times.values()) <= 2
    tokens = defaultdict(int)
    for r in kept[4].collect():
        tokens[r.doc_id] += r.length
    assert set(tokens) == set(times)
    assert corpus_pipeline.run(spark, SF).count() == kept[4].count()
