import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import days, rows_of
from shelfcast.operators import clean, coverage, decompose, drift, ordered, outliers, profile, splits
from shelfcast.functions.special import dickey_fuller_p, upper_gamma


@pytest.fixture(scope="module")
def skewed(spark):
    """One key and one value hold a third of the rows or more."""
    rng = random.Random(1)
    rows = [("hot", 7.0) for _ in range(2000)] + [("hot", rng.gauss(0, 100)) for _ in range(2000)]
    rows += [(rng.choice("abc"), float(rng.randint(0, 5))) for _ in range(500)] + [("one", 3.0), ("none", None)]
    return spark.createDataFrame(rows, "k string, v double").repartition(6).cache()


def test_quantiles_match_numpy(skewed):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    pdf = skewed.toPandas().dropna()
    got = {r["prob"]: r["quantile"] for r in ordered.exact_quantiles(skewed, "v", probs).collect()}
    assert [got[p] for p in probs] == pytest.approx(np.quantile(pdf["v"], probs))
    for r in ordered.exact_quantiles(skewed, "v", probs, ["k"]).collect():
        assert r["quantile"] == pytest.approx(np.quantile(pdf[pdf["k"] == r["k"]]["v"], r["prob"]))


def test_running_totals_match_cumsum(skewed):
    counts = skewed.where("v is not null").groupBy("k", "v").agg(F.count("*").alias("n"))
    got = ordered.running_totals(counts, ["k"], "v", ["n"]).toPandas().sort_values(["k", "v"])
    assert (got.groupby("k")["n"].cumsum() == got["n_upto"]).all()


def test_describe_methods_agree(skewed):
    exact = rows_of(profile.describe(skewed, "v", ["k"]), "k")
    grouped = rows_of(profile.describe(skewed, "v", ["k"], "grouped"), "k")
    for a, b in zip(exact, grouped):
        assert a["k"] == b["k"] and a["count"] == b["count"]
        assert (a["p50"] is None and b["p50"] is None) or a["p50"] == pytest.approx(b["p50"])


@pytest.fixture(scope="module")
def indexed(spark):
    # one date holds half of the rows
    rows = [(days(10)[min(i // 20, 5)], i % 7, i) for i in range(240)]
    return spark.createDataFrame(rows, "date date, store_nbr int, row_id int").repartition(5).cache()


ORDER = ["date", "store_nbr", "row_id"]


def positions(df):
    return {r["row_id"]: i for i, r in enumerate(sorted(df.collect(), key=lambda r: (r["date"], r["store_nbr"], r["row_id"])))}


def test_three_way_split(indexed):
    at = positions(indexed)
    for r in splits.label_split(indexed, ORDER, 0.2, 0.1).collect():
        i = at[r["row_id"]]
        assert r["split"] == ("train" if i < int(240 * (1 - 0.2 - 0.1)) else "val" if i < 192 else "test")


def test_folds(indexed):
    at = positions(indexed)
    blocked = splits.kfold_blocked(indexed, 7, ORDER)
    assert all(r["fold"] == min(at[r["row_id"]] // 34, 7) for r in blocked.collect())
    train, val = splits.fold(blocked, 2)
    assert val.count() == 34 and train.count() == 206
    expanding = splits.time_series_folds(indexed, 5, ORDER)
    for k in range(1, 6):
        before, now = splits.expanding_fold(expanding, k)
        assert max(at[r["row_id"]] for r in before.collect()) < min(at[r["row_id"]] for r in now.collect())
        assert now.count() == 40


def test_split_by_date_share(spark):
    df = spark.createDataFrame([(d, s) for d in days(50) for s in range(4)], "date date, store_nbr int")
    train, test = splits.split_by_date(df, 0.2)
    assert (train.count(), test.count()) == (160, 40)


def test_cv_summary(spark):
    df = spark.createDataFrame([("m", "rmse", 1.0), ("m", "rmse", 3.0)], "model string, metric string, value double")
    row = splits.cv_summary(df).first()
    assert (row["mean"], row["std"]) == (2.0, 1.0)


def test_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(20), 1000]], "x double")
    z, iqr = outliers.outliers(df, "x", "zscore").first(), outliers.outliers(df, "x", "iqr").first()
    assert z["total_outliers"] == iqr["total_outliers"] == 1 and z["outlier_mean"] == 1000
    assert outliers.outlier_counts(df, ["x"]).first()["outliers"] == 1
    with pytest.raises(ValueError):
        outliers.outliers(df, "x", "other")


def test_group_stats_on_a_hot_key(skewed):
    filled = clean.fill_group_mean(skewed, "v", ["k"])
    assert filled.count() == skewed.count()
    assert filled.where("k = 'none'").first()["v"] is None


def test_coverage(spark):
    d = days(6)
    df = spark.createDataFrame([(1, d[0]), (1, d[1]), (1, d[4]), (1, d[4]), (2, d[0]), (2, d[1])], "store_nbr int, date date")
    assert [r.date for r in coverage.first_missing_dates(df).collect()] == [d[2], d[3]]
    assert {r.store_nbr: r.continuous for r in coverage.is_continuous(df, ["store_nbr"]).collect()} == {1: False, 2: True}


def test_duplicates_and_negatives(spark):
    df = spark.createDataFrame([(1, -1.0), (1, -1.0), (1, -1.0), (2, 0.0)], "a int, x double")
    row = profile.duplicate_rows(df).first()
    assert (row["duplicates"], row["percentage"]) == (2, 50.0)
    assert {r["column"]: r["negatives"] for r in profile.negatives_by_column(df).collect()} == {"a": 0, "x": 3}


def test_decomposition_recovers_a_planted_week(clean_series):
    for extrapolate in (False, True):
        out = rows_of(decompose.decompose(clean_series, "sales", 7, ["store_nbr"], extrapolate=extrapolate), "date")
        inner = out[10:-10]
        assert all(r["trend"] == pytest.approx(0.1 * i + 51, abs=1e-9) for i, r in enumerate(inner))
        assert all(abs(r["resid"]) < 1e-9 for r in inner)
        assert (out[0]["trend"] is None) != extrapolate
    strength = decompose.strengths(decompose.decompose(clean_series, "sales", 7, ["store_nbr"]), ["store_nbr"]).first()
    assert strength["seasonal_strength"] == pytest.approx(1, abs=0.02) and strength["trend_strength"] == pytest.approx(1)


def test_acf(spark, clean_series):
    got = {r.lag: r.acf for r in decompose.acf(clean_series, "sales", 10).collect()}
    y = np.array([r.sales for r in clean_series.orderBy("date").collect()])
    c = y - y.mean()
    assert [got[k] for k in range(11)] == pytest.approx([(c[k:] * c[:len(c) - k]).sum() / (c * c).sum() for k in range(11)])


def test_drift(spark):
    base = spark.range(1000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 4).alias("kind"))
    same = drift.ks_drift(base, base, ["x"]).first()
    assert same["ks_stat"] == 0 and same["p_value"] == 1 and not same["is_drift"]
    moved = base.select((F.col("x") + 250).alias("x"), (F.col("kind") % 2).alias("kind"))
    shifted = drift.ks_drift(base, moved, ["x"]).first()
    assert shifted["ks_stat"] == pytest.approx(0.25) and shifted["is_drift"]
    diff = drift.moment_drift(base, moved, ["x"]).first()
    assert diff["mean_diff"] == pytest.approx(250) and diff["std_diff"] == pytest.approx(0)
    chi = drift.chi2_drift(base, moved, ["kind"]).first()
    # 250 each against 500, 500, 0, 0
    assert chi["df"] == 3 and chi["statistic"] == pytest.approx(2 * 2 * (125 ** 2 / 375 + 125)) and chi["p_value"] < 1e-9


def test_distribution_tails():
    # chi-square with two degrees of freedom is exponential; published 5 % points of the other two
    assert upper_gamma(1.0, 3.0) == pytest.approx(np.exp(-3))
    assert upper_gamma(2.5, 11.0705 / 2) == pytest.approx(0.05, abs=1e-5)
    assert dickey_fuller_p(-2.86) == pytest.approx(0.05, abs=1e-3)
    assert dickey_fuller_p(-3.43) == pytest.approx(0.01, abs=1e-3)


def test_normality_and_importance(spark):
    rng = random.Random(3)
    rows = [(rng.gauss(0, 1), rng.uniform(0, 1) ** 4, i % 3) for i in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, c int").withColumn("y", F.col("a") * 2 + F.col("b"))
    assert profile.normality_test(df, "a").first()["is_normal"]
    assert not profile.normality_test(df, "b").first()["is_normal"]
    for method in ("correlation", "mutual_info"):
        scores = profile.feature_importance(df, "y", ["a", "b", "c"], method=method).collect()
        assert scores[0]["feature"] == "a" and all(r["importance"] >= 0 for r in scores)
        assert [r["importance"] for r in scores] == sorted((r["importance"] for r in scores), reverse=True)
    with pytest.raises(ValueError):
        profile.feature_importance(df, "y", ["a"], method="other")


def test_pivot_refuses_duplicates(spark):
    d = days(1)[0]
    df = spark.createDataFrame([(d, 1, 2.0), (d, 1, 3.0)], "date date, store_nbr int, sales double")
    with pytest.raises(Exception, match="more than one value"):
        profile.pivot_series(df, [1]).collect()


def test_histogram_keeps_all_rows(skewed):
    bins = profile.histogram(skewed, "v", 10).collect()
    assert sum(b["n"] for b in bins) == skewed.where("v is not null").count() and max(b["bin"] for b in bins) == 10
