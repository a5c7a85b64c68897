import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import days, rows_of
from shelfcast.operators import calendar as cal, clean, encode, joins, windows
from shelfcast.sources import schemas

ONE_KEY = windows.Series(("store_nbr",))


@pytest.fixture(scope="module")
def features(spark):
    """Two stores, 31 days, some sales unknown."""
    rows = [(d, s, None if s == 1 and 1 <= i <= 5 else float((i * 37 + s * 11) % 100), i % 3)
            for s in (1, 2) for i, d in enumerate(days(31))]
    return spark.createDataFrame(rows, "date date, store_nbr int, sales double, onpromotion int")


def frame(df, *cols):
    return df.orderBy("store_nbr", "date").toPandas()


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2021, 1, 4),)], "date date")
    first, second = rows_of(cal.calendar_features(df), "date")
    assert (first["day_of_week"], first["week_of_year"], first["year"], first["month"], first["day"]) == (6, 53, 2021, 1, 3)
    assert (second["day_of_week"], second["week_of_year"]) == (0, 1)


def test_lags_match_pandas(features):
    got = frame(windows.lags(features, "sales", (1, 7), ONE_KEY))
    want = got.groupby("store_nbr")["sales"].shift(7)
    pd.testing.assert_series_equal(got["sales_lag_7"], want, check_names=False)


@pytest.mark.parametrize("stat", ["mean", "std", "min", "max", "median"])
def test_rolling_matches_pandas(features, stat):
    got = frame(windows.rolling(features, "sales", (7,), (stat,), ONE_KEY))
    rolled = got.groupby("store_nbr")["sales"].rolling(7, min_periods=1)
    want = (rolled.std(ddof=0) if stat == "std" else getattr(rolled, stat)()).reset_index(drop=True)
    pd.testing.assert_series_equal(got[f"sales_rolling_{stat}_7"], want, check_names=False, atol=1e-6)


def test_rolling_bounds_and_unknown_statistic(features, caplog):
    df = windows.rolling(features, "sales", (7,), ("mean", "min", "max", "mode"), ONE_KEY)
    assert "mode" in caplog.text and "sales_rolling_mode_7" not in df.columns
    bad = df.where((F.col("sales_rolling_min_7") > F.col("sales_rolling_mean_7") + 1e-9)
                   | (F.col("sales_rolling_mean_7") > F.col("sales_rolling_max_7") + 1e-9))
    assert bad.count() == 0


@pytest.mark.parametrize("block", [14, 40, 1000])
def test_blocks_do_not_change_results(spark, block):
    # one hot series with four rows per day beside a short one
    rows = [(d, 1, k, float((i * 13 + k * 7) % 50)) for i, d in enumerate(days(120)) for k in range(4)]
    rows += [(d, 2, 0, float(i)) for i, d in enumerate(days(9))]
    df = spark.createDataFrame(rows, "date date, store_nbr int, k int, sales double")

    def build(series):
        out = windows.lags(df, "sales", (1, 14), series)
        out = windows.rolling(out, "sales", (7, 14), ("mean", "min"), series)
        return windows.trend_flags(out, "sales", (7,), series)
    whole = windows.Series(("store_nbr",), ("date", "k"))
    cut = windows.Series(("store_nbr",), ("date", "k"), block_rows=block, chunk="week")
    assert rows_of(build(whole), "store_nbr", "date", "k") == rows_of(build(cut), "store_nbr", "date", "k")
    ahead = windows.sequences(df, ["sales"], "sales", 5, 3, series=whole)
    blocked = windows.sequences(df, ["sales"], "sales", 5, 3, series=cut)
    assert rows_of(ahead, "store_nbr", "date", "k") == rows_of(blocked, "store_nbr", "date", "k")


def test_blocks_must_cover_frames(features):
    with pytest.raises(ValueError):
        windows.lags(features, "sales", (30,), windows.Series(("store_nbr",), block_rows=10))


def test_trend_and_cycles(features):
    df = windows.all_features(cal.calendar_features(features), series=ONE_KEY)
    values = {r[0] for r in df.select("sales_trend_7").distinct().collect()}
    assert values <= {0, 1}
    wrong = df.where((F.abs("day_of_week_sin") > 1) | (F.abs("day_cos") > 1) | (F.abs("month_sin") > 1))
    assert wrong.count() == 0


def test_trend_strength(features):
    df = windows.trend_strength(features.where("store_nbr = 2"), "sales", (7,), ONE_KEY)
    first = df.orderBy("date").first()
    assert first["sales_trend_strength_7"] in (0.0, None)


def test_interactions(features):
    df = features.withColumn("type", F.lit("A")).withColumn("city", F.lit("Quito"))
    row = encode.interactions(df, [("sales", "onpromotion"), ("type", "city")]).where("sales is not null").first()
    assert row["sales_onpromotion_interaction"] == row["sales"] * row["onpromotion"]
    assert row["type_city_interaction"] == "A_Quito"


def test_scaling_round_trip(features):
    train, test = encode.scale(features.where("store_nbr = 2"), features.where("store_nbr = 1"), ["sales"])
    mean, std = train.agg(F.avg("sales"), F.stddev_samp("sales")).first()
    assert mean == pytest.approx(0, abs=1e-9) and std == pytest.approx(1)
    scaler = encode.fit_scaler(features.where("store_nbr = 2"), ["sales"])
    back = encode.invert_scaler(test, scaler, ["sales"])
    want = {r.date: r.sales for r in features.where("store_nbr = 1").collect()}
    assert all(r.sales == pytest.approx(want[r.date]) for r in back.collect() if r.sales is not None)


def test_fill_forward_then_backward(spark):
    rows = [(d, v) for d, v in zip(days(6), [None, 1.0, None, 3.0, None, None])]
    filled = clean.fill_forward_backward(spark.createDataFrame(rows, "date date, x double"), "x")
    assert [r.x for r in filled.orderBy("date").collect()] == [1.0, 1.0, 1.0, 3.0, 3.0, 3.0]


def test_resample_daily(spark):
    rows = [(dt.date(2021, 1, 1), 2.0), (dt.date(2021, 1, 1), 4.0), (dt.date(2021, 1, 4), 9.0)]
    out = clean.resample_daily(spark.createDataFrame(rows, "date date, x double"), "x")
    assert [r.x for r in out.orderBy("date").collect()] == [3.0, 3.0, 3.0, 9.0]


def test_fact_keeps_rows_and_fills(small_bundle):
    fact = joins.build_fact(small_bundle)
    assert fact.count() == 10
    assert fact.where("dcoilwtico is null or transactions is null or transactions_rolling_mean is null").count() == 0
    assert {"holiday_type_Holiday", "holiday_type_Work_Day", "locale_National", "day_of_week"} <= set(fact.columns)
    assert fact.agg(F.sum("holiday_type_Holiday")).first()[0] == 5


def test_transactions_of_days_without_a_count(spark):
    d = days(4)
    sales = [(d[0], 1, "A", 1.0, 0), (d[0], 1, "B", 1.0, 0), (d[1], 1, "A", 1.0, 0), (d[2], 1, "A", 1.0, 0), (d[0], 2, "A", 1.0, 0)]
    # the day of d[3] has a count but no sales; d[1] has no row, d[2] an unknown count, store 2 no row
    counts = [(d[0], 1, 10), (d[2], 1, None), (d[3], 1, 40), (d[3], 3, 70)]
    got = joins.filled_transactions(spark.createDataFrame(sales, schemas.SALES), spark.createDataFrame(counts, schemas.TRANSACTIONS))
    mean = (10 + 40 + 70) / 3
    store = (10 * 2 + mean) / 3
    assert {(r.date, r.store_nbr): (r.transactions, r.transactions_rolling_mean) for r in got.collect()} == {
        (d[0], 1): (10.0, 10.0), (d[1], 1): (pytest.approx(store), pytest.approx(store)),
        (d[2], 1): (mean, (10 + mean) / 2), (d[0], 2): (None, None)}


def test_holiday_modes(spark, small_bundle):
    # two rows on one date, one of them transferred
    d = days(1)[0]
    twice = spark.createDataFrame(
        [(d, "Holiday", "National", "Ecuador", "a", True), (d, "Transfer", "Local", "Quito", "b", False)], schemas.HOLIDAYS)
    assert joins.join_holidays(small_bundle.sales, twice).count() == 10
    assert joins.join_holidays(small_bundle.sales, twice, "fanout").count() == 11
    with pytest.raises(ValueError):
        joins.join_holidays(small_bundle.sales, twice, "other")
    effective = cal.effective_holidays(twice).first()
    assert (effective["is_day_off"], effective["is_work_day"]) == (1, 0)


def test_local_holidays(spark, small_bundle):
    d = days(3)
    rows = [(d[0], "Holiday", "Local", "Quito", "a", False), (d[1], "Holiday", "Local", "Guayaquil", "b", False),
            (d[2], "Holiday", "Regional", "Pichincha", "c", False)]
    flagged = cal.local_holidays(small_bundle.sales, small_bundle.stores, spark.createDataFrame(rows, schemas.HOLIDAYS))
    assert [r.is_store_holiday for r in flagged.orderBy("date").limit(4).collect()] == [1, 0, 1, 0]


def test_oil_outside_its_span(spark, small_bundle):
    oil = spark.createDataFrame([(days(5)[2], 10.0), (days(5)[4], 20.0)], schemas.OIL)
    got = joins.join_oil(small_bundle.sales, oil).orderBy("date").collect()
    assert [r.dcoilwtico for r in got] == [10.0, 10.0, 10.0, 10.0] + [20.0] * 6


def test_repeated_price_dates_are_averaged(spark, small_bundle):
    first = days(3)[0]
    oil = spark.createDataFrame([(first, 10.0), (first, 20.0), (days(3)[2], 30.0)], schemas.OIL)
    prices = joins.daily_prices(oil).orderBy("date").collect()
    assert [(r.date, r.dcoilwtico) for r in prices] == [(days(3)[0], 15.0), (days(3)[1], 15.0), (days(3)[2], 30.0)]
    assert joins.join_oil(small_bundle.sales, oil).count() == small_bundle.sales.count()


def test_validation(features):
    clean.validate_schema(features, ["date", "store_nbr", "sales"], numeric=["sales"])
    with pytest.raises(ValueError):
        clean.validate_schema(features, ["missing"])
    with pytest.raises(ValueError):
        clean.validate_schema(features, ["date"], date="sales")
    checks = {r["check"]: r["violations"] for r in clean.validate_values(features, ["date", "sales"]).collect()}
    assert checks == {"null_date": 0, "null_sales": 5, "negative_sales": 0}
    ranged = clean.validate_ranges(features, {"sales": (10, None), "onpromotion": (0, 1)})
    assert {r["check"]: r["violations"] for r in ranged.collect()}["range_onpromotion"] == 20


def test_window_counts(spark):
    df = spark.createDataFrame([(d, 1, float(i)) for i, d in enumerate(days(100))], "date date, store_nbr int, sales double")
    assert windows.sequences(df, ["sales"] * 5, "sales", 10, 1, series=ONE_KEY).count() == 90
    row = windows.sequences(df, ["sales"], "sales", 3, 2, series=ONE_KEY).orderBy("date").first()
    assert [v[0] for v in row["x"]] == [0.0, 1.0, 2.0] and row["y"] == [3.0, 4.0]


def test_rolling_apply(features):
    got = frame(windows.rolling_apply(features.where("store_nbr = 2"), "sales", 3, lambda s: s.max() - s.min(), "spread", ONE_KEY))
    want = got["sales"].rolling(3, min_periods=1).max() - got["sales"].rolling(3, min_periods=1).min()
    pd.testing.assert_series_equal(got["spread"], want, check_names=False)
