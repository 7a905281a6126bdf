"""Calendar parts and flags of a timestamp."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions.text import as_column

SATURDAY = 5


def hour_of(ts: Column | str) -> Column:
    return F.hour(as_column(ts))


def weekday_of(ts: Column | str) -> Column:
    """Day of week with Monday as 0."""
    return F.weekday(as_column(ts))


def month_of(ts: Column | str) -> Column:
    return F.month(as_column(ts))


def year_of(ts: Column | str) -> Column:
    return F.year(as_column(ts))


def is_weekend(ts: Column | str) -> Column:
    """1 on Saturday and Sunday; a missing timestamp is not a weekend."""
    return F.coalesce((weekday_of(ts) >= SATURDAY).cast("int"), F.lit(0))


def is_night(ts: Column | str, start_hour: int = 22, end_hour: int = 5) -> Column:
    """1 from ``start_hour`` on and up to and including ``end_hour``."""
    hour = hour_of(ts)
    return F.coalesce(((hour >= start_hour) | (hour <= end_hour)).cast("int"), F.lit(0))


def season(ts: Column | str) -> Column:
    """Meteorological season of the northern hemisphere."""
    quarter = F.pmod(month_of(ts), F.lit(12))
    return (
        F.when(quarter < 3, F.lit("Winter"))
        .when(quarter < 6, F.lit("Spring"))
        .when(quarter < 9, F.lit("Summer"))
        .otherwise(F.lit("Fall"))
    )


def cyclical(value: Column | str, period: float) -> tuple[Column, Column]:
    """Sine and cosine of the value's position on a circle of length ``period``."""
    angle = as_column(value) * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
