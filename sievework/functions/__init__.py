"""Column expressions; everything here compiles to built-in Spark functions."""

from sievework.functions.casts import parse_timestamp, to_bool, to_double, to_long
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
from sievework.functions.text import (
    DEFAULT_MISSING_TOKENS,
    contains_any,
    null_if_missing,
    standardize,
    strip,
)

__all__ = [
    "DEFAULT_MISSING_TOKENS",
    "contains_any",
    "cyclical",
    "hour_of",
    "is_night",
    "is_us_holiday",
    "is_weekend",
    "month_of",
    "null_if_missing",
    "parse_timestamp",
    "season",
    "standardize",
    "strip",
    "to_bool",
    "to_double",
    "to_long",
    "us_holiday_name",
    "weekday_of",
    "year_of",
]
