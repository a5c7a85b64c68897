import datetime as dt
import math
import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.session import local_session  # noqa: E402
from shelfcast.sources import schemas  # noqa: E402
from shelfcast.sources.bundle import SalesBundle  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


def days(n, start=dt.date(2021, 1, 1)):
    return [start + dt.timedelta(days=i) for i in range(n)]


@pytest.fixture(scope="session")
def small_bundle(spark):
    """One store, ten days; the first five dates are holidays, the others transfers."""
    rng = random.Random(42)
    dates = days(10)
    sales = [(d, 1, "GROCERY", rng.uniform(0, 100), i % 2) for i, d in enumerate(dates)]
    oil = [(d, None if 2 <= i <= 4 else rng.uniform(0, 50)) for i, d in enumerate(dates)]
    holidays = [(d, *(("Holiday", "National") if i < 5 else ("Transfer", "Regional")), "Ecuador", "x", False)
                for i, d in enumerate(dates)]
    transactions = [(d, 1, None if 2 <= i <= 4 else rng.randint(100, 999)) for i, d in enumerate(dates)]
    return SalesBundle(
        sales=spark.createDataFrame(sales, schemas.SALES),
        stores=spark.createDataFrame([(1, "Quito", "Pichincha", "A", 1)], schemas.STORES),
        oil=spark.createDataFrame(oil, schemas.OIL),
        holidays=spark.createDataFrame(holidays, schemas.HOLIDAYS),
        transactions=spark.createDataFrame(transactions, schemas.TRANSACTIONS))


def wave(i, noise=0.0, yearly=False, rng=None):
    value = 0.1 * i + 10 * math.sin(2 * math.pi * i / 7) + 50
    if yearly:
        value += 5 * math.sin(2 * math.pi * i / 365)
    return value + (rng.gauss(0, noise) if noise else 0.0)


@pytest.fixture(scope="session")
def weekly_series(spark):
    """Two stores, trend and week with noise, 400 days."""
    rng = random.Random(42)
    rows = [(d, s, wave(i, 1.0, rng=rng)) for s in (1, 2) for i, d in enumerate(days(400))]
    return spark.createDataFrame(rows, "date date, store_nbr int, sales double").cache()


@pytest.fixture(scope="session")
def clean_series(spark):
    """One store, trend and week without noise, 140 days."""
    rows = [(d, 1, wave(i)) for i, d in enumerate(days(140))]
    return spark.createDataFrame(rows, "date date, store_nbr int, sales double").cache()


def rows_of(df, *order):
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
