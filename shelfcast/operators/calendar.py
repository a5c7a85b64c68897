"""Calendar features and the holiday table at date grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.expressions import indicator, weekday_monday0
from ..sources.schemas import HOLIDAY_LOCALES, HOLIDAY_TYPES
from .encode import one_hot


def calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Year, month, day, day of week (Monday is 0) and ISO week."""
    return df.withColumns({
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "day_of_week": weekday_monday0(date),
        "week_of_year": F.weekofyear(date),
    })


def holiday_dates(holidays: DataFrame) -> DataFrame:
    """The distinct dates, one row each."""
    return holidays.select("date").distinct()


def mark_members(df: DataFrame, members: DataFrame, key: str, name: str) -> DataFrame:
    """1 where the key occurs among the members, else 0. ``members`` holds each key once.

    Dates are at most one row per calendar day and are broadcast; for other keys Spark decides by size.
    """
    marked = members.select(key).withColumn(name, F.lit(1))
    if isinstance(members.schema[key].dataType, T.DateType):
        marked = F.broadcast(marked)
    return df.join(marked, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def weekend_holiday_flags(df: DataFrame, holidays: DataFrame, date: str = "date") -> DataFrame:
    df = df.withColumn("is_weekend", (weekday_monday0(date) >= 5).cast("int"))
    return mark_members(df, holiday_dates(holidays).withColumnRenamed("date", date), date, "is_holiday")


def holiday_flags(holidays: DataFrame) -> DataFrame:
    """The holiday rows with a 0/1 column for each type and locale."""
    df = one_hot(holidays, "type", HOLIDAY_TYPES, "holiday_type")
    return one_hot(df, "locale", HOLIDAY_LOCALES, "locale")


def collapse_holidays(holidays: DataFrame) -> DataFrame:
    """One row per date: each flag is set when any row of the date sets it."""
    flagged = holiday_flags(holidays)
    flags = [c for c in flagged.columns if c.startswith(("holiday_type_", "locale_")) and c != "locale_name"]
    return flagged.groupBy("date").agg(*[F.max(f).alias(f) for f in flags])


def effective_holidays(holidays: DataFrame) -> DataFrame:
    """Whether a date is really free: a transferred holiday counts on its Transfer row's date, and a
    Work Day cancels what else falls on the date."""
    kept = holidays.where(~F.col("transferred"))
    off = F.max(indicator(F.col("type").isin("Holiday", "Transfer", "Additional", "Bridge")))
    work = F.max(indicator(F.col("type") == "Work Day"))
    event = F.max(indicator(F.col("type") == "Event"))
    return kept.groupBy("date").agg(
        F.when(work == 1, 0).otherwise(off).alias("is_day_off"), work.alias("is_work_day"), event.alias("is_event"))


def local_holidays(fact: DataFrame, stores: DataFrame, holidays: DataFrame) -> DataFrame:
    """Holiday flags that apply to each row's store: national always, regional by state, local by city.

    Each kind is joined by what it depends on, the date alone or the date and the place, so the right sides have at most a
    row per holiday, Spark broadcasts them while they are small, and the fact is not shuffled for them.
    """
    kept = holidays.where(~F.col("transferred"))
    flags = ["is_national", "is_regional", "is_local"]

    def days(locale, place, name):
        rows = kept.where(F.col("locale") == locale)
        return rows.select("date", *[F.col("locale_name").alias(p) for p in place]).distinct().withColumn(name, F.lit(1))

    df = fact.join(stores.select("store_nbr", "city", "state"), "store_nbr", "left")
    for locale, place, name in (("National", [], flags[0]), ("Regional", ["state"], flags[1]), ("Local", ["city"], flags[2])):
        df = df.join(days(locale, place, name), ["date", *place], "left")
    df = df.withColumns({f: F.coalesce(f, F.lit(0)) for f in flags})
    return df.withColumn("is_store_holiday", F.greatest(*flags))
