"""Every query with SQL gives the same rows as DuckDB; the others give rows."""

import os

import pytest

import compare
from conftest import SF_DIR
from shelfcast import catalog

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows(spark, con, name):
    problems, _ = compare.differences(catalog.QUERIES[name](spark, SF_DIR), con, catalog.SQL[name])
    assert not problems


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF_DIR).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(catalog.SQL) <= set(catalog.QUERIES)
