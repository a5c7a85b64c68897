import __spark_entry__ as entry


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema and first.limit(1).count() == 1


def test_other_queries_stay_without_the_corpus_folder(monkeypatch):
    import importlib
    import sys
    for name in [m for m in sys.modules if m.startswith("shelfcast.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        names = importlib.reload(entry).queries()
        assert "pipeline" not in names and "win2_rolling" in names and set(entry.oracle_sql()) <= set(names)
    finally:
        monkeypatch.undo()
        importlib.reload(entry)


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 100
