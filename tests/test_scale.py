"""Shuffles whose number of partitions follows the input."""

import os

import pytest

from conftest import SF_DIR
from shelfcast import session
from shelfcast.operators import clean, profile
from shelfcast.plans import jobs
from shelfcast.sources import retail_views as views

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def rows(df):
    return sorted(map(repr, df.collect()))


def test_partitions_of_the_fact_and_the_transactions_follow_the_input(spark, monkeypatch):
    lines = views.sale_lines(spark, SF_DIR).count()
    fact, tickets = (rows(f(spark, SF_DIR)) for f in (views.sales_fact, views.transactions))
    gate, one = (rows(clean.quality_measures(views.sales_fact(spark, SF_DIR), views.transactions(spark, SF_DIR))),
                 rows(profile.sales_profile(views.sales_fact(spark, SF_DIR))))
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    for parts_beyond in (views.BROADCAST_ROWS, 0):  # the parts broadcast, and both sides dealt by part
        monkeypatch.setattr(views, "BROADCAST_ROWS", parts_beyond)
        for make, want in ((views.sales_fact, fact), (views.transactions, tickets)):
            many = make(spark, SF_DIR)
            assert many.rdd.getNumPartitions() == -(-lines // 100)
            assert rows(many) == want
        assert rows(profile.sales_profile(views.sales_fact(spark, SF_DIR))) == one
        assert rows(clean.quality_measures(views.sales_fact(spark, SF_DIR), views.transactions(spark, SF_DIR))) == gate


def test_lines_are_added_by_region_without_sums_by_store(spark, capsys):
    views.dense_sales(spark, SF_DIR).explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1


def test_features_are_prepared_with_few_shuffles(spark, capsys):
    jobs.prepare_features(views.bundle(spark, SF_DIR)).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") < 12 and plan.count("lineitem") == 2
