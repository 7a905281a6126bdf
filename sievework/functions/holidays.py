"""US public holidays as date arithmetic: no calendar table, no year limits to outgrow.

Every rule holds from its first to its last year; a holiday that was moved has a rule for each period.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions.text import as_column

# Holidays on a fixed day, as (name, month, day, first year, last year); None: open.
FIXED_DAY_HOLIDAYS = [
    ("New Year's Day", 1, 1, None, None),
    ("Washington's Birthday", 2, 22, 1885, 1970),
    ("Memorial Day", 5, 30, 1888, 1970),
    ("Juneteenth National Independence Day", 6, 19, 2021, None),
    ("Independence Day", 7, 4, None, None),
    ("Columbus Day", 10, 12, 1937, 1970),
    ("Armistice Day", 11, 11, 1938, 1953),
    ("Veterans Day", 11, 11, 1954, 1970),
    ("Veterans Day", 11, 11, 1978, None),
    ("Christmas Day", 12, 25, None, None),
]

# Holidays on a weekday rule, as (name, month, weekday with Monday = 0,
# first and last day of the month the rule can fall on, first year, last year).
WEEKDAY_RULE_HOLIDAYS = [
    ("Martin Luther King Jr. Day", 1, 0, 15, 21, 1986, None),
    ("Washington's Birthday", 2, 0, 15, 21, 1971, None),
    ("Memorial Day", 5, 0, 25, 31, 1971, None),
    ("Labor Day", 9, 0, 1, 7, 1894, None),
    ("Columbus Day", 10, 0, 8, 14, 1971, None),
    ("Veterans Day", 10, 0, 22, 28, 1971, 1977),
    ("Thanksgiving Day", 11, 3, 24, 30, 1863, 1938),
    ("Thanksgiving Day", 11, 3, 17, 23, 1939, 1941),
    ("Thanksgiving Day", 11, 3, 22, 28, 1942, None),
]

MONDAY, FRIDAY = 0, 4


def _holds(day: Column, first_year: int | None, last_year: int | None) -> Column:
    """Whether the day lies in the years of a rule."""
    since = F.lit(True) if first_year is None else F.year(day) >= first_year
    return since if last_year is None else since & (F.year(day) <= last_year)


def _falls_on(day: Column, month: int, day_of_month: int, first_year: int | None, last_year: int | None) -> Column:
    return (F.month(day) == month) & (F.dayofmonth(day) == day_of_month) & _holds(day, first_year, last_year)


def us_holiday_name(column: Column | str) -> Column:
    """Name of the holiday on that date, NULL on ordinary days.

    A fixed-day holiday on a Saturday is also observed on the Friday before, one on a
    Sunday on the Monday after; the day itself stays a holiday.
    """
    day = as_column(column).cast("date")
    weekday = F.weekday(day)
    name = F.lit(None).cast("string")
    for title, *rule in FIXED_DAY_HOLIDAYS:
        eve = (weekday == FRIDAY) & _falls_on(F.date_add(day, 1), *rule)
        morrow = (weekday == MONDAY) & _falls_on(F.date_sub(day, 1), *rule)
        name = F.when(eve | morrow, F.lit(f"{title} (observed)")).otherwise(name)
        name = F.when(_falls_on(day, *rule), F.lit(title)).otherwise(name)
    for title, month, rule_weekday, first_day, last_day, *years in WEEKDAY_RULE_HOLIDAYS:
        hit = (
            (F.month(day) == month)
            & (weekday == rule_weekday)
            & F.dayofmonth(day).between(first_day, last_day)
            & _holds(day, *years)
        )
        name = F.when(hit, F.lit(title)).otherwise(name)
    return name


def is_us_holiday(column: Column | str) -> Column:
    """1 on a holiday, else 0."""
    return us_holiday_name(column).isNotNull().cast("int")
