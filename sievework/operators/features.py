"""Derived columns for a model table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.holidays import is_us_holiday, us_holiday_name
from sievework.functions.temporal import (
    cyclical,
    hour_of,
    is_night,
    is_weekend,
    month_of,
    season,
    weekday_of,
    year_of,
)
from sievework.functions.text import as_column, contains_any


def calendar_parts(df: DataFrame, ts: str) -> DataFrame:
    """Add hour, day_of_week (Monday = 0) and month."""
    return df.withColumns({"hour": hour_of(ts), "day_of_week": weekday_of(ts), "month": month_of(ts)})


def calendar_flags(df: DataFrame, ts: str) -> DataFrame:
    """Add weekend, night and holiday flags, season and the position of the hour on the day circle."""
    sine, cosine = cyclical(hour_of(ts), 24)
    return df.withColumns(
        {
            "is_weekend": is_weekend(ts),
            "is_night": is_night(ts),
            "is_holiday": is_us_holiday(ts),
            "season": season(ts),
            "hour_sin": sine,
            "hour_cos": cosine,
        }
    )


def us_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """(holiday_date, name) for every holiday of the years, bounds included."""
    days = F.sequence(
        F.make_date(F.lit(first_year), F.lit(1), F.lit(1)),
        F.make_date(F.lit(last_year), F.lit(12), F.lit(31)),
    )
    dates = spark.range(1).select(F.explode(days).alias("holiday_date"))
    named = dates.withColumn("name", us_holiday_name("holiday_date"))
    return named.where(F.col("name").isNotNull())


def holiday_flag(df: DataFrame, ts: str, calendar: DataFrame | None = None, out: str = "is_holiday") -> DataFrame:
    """Add a 0/1 holiday flag.

    Without a calendar the US rules are evaluated on the row itself, with no join.  A
    calendar of one's own is a table with ``holiday_date``, at most one row per day.
    """
    if calendar is None:
        return df.withColumn(out, is_us_holiday(ts))
    days = calendar.select(F.col("holiday_date").alias("_day")).distinct().withColumn(out, F.lit(1))
    dated = df.withColumn("_day", as_column(ts).cast("date"))
    return dated.join(days, "_day", "left").select(*df.columns, F.coalesce(F.col(out), F.lit(0)).alias(out))


def keyword_flag(df: DataFrame, column: str, keywords: Sequence[str], out: str) -> DataFrame:
    """Add a 0/1 flag: the text holds one of the keywords."""
    return df.withColumn(out, contains_any(column, keywords))


def temporal_split(ts: Column | str, train_until: int, validation_until: int, test_until: int) -> Column:
    """Name of the split a row belongs to by year; NULL for later years."""
    year = year_of(ts)
    return (
        F.when(year <= train_until, F.lit("train"))
        .when(year <= validation_until, F.lit("validation"))
        .when(year <= test_until, F.lit("test"))
    )
