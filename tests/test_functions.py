import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from sievework import functions as fn
from sievework.functions import holidays
from sievework.functions.info import digamma


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_strip_removes_every_kind_of_whitespace(spark):
    texts = ["\t a b \n", None, "  ", "\u3000x\xa0", "a\tb"]
    assert values(spark, texts, fn.strip("t")) == ["a b", None, "", "x", "a\tb"]
    assert values(spark, [" theft\t"], fn.standardize("t")) == ["THEFT"]


def test_missing_tokens(spark):
    assert values(spark, ["NA", "null", "", "nAn", "0", None], fn.null_if_missing("t")) == [
        None, None, None, "nAn", "0", None,
    ]


def test_numbers(spark):
    texts = ["3.0", "7.9", "-7.9", " 4 ", "x", None, "3d", "1e3", "nan", "inf", "0x1p3"]
    assert values(spark, texts, fn.to_double("t")) == [3.0, 7.9, -7.9, 4.0, None, None, None, 1000.0, None, None, None]
    assert values(spark, texts, fn.to_long("t")) == [3, 7, -7, 4, 0, 0, 0, 1000, 0, 0, 0]
    assert values(spark, ["x"], fn.to_long("t", None)) == [None]


def test_booleans(spark):
    assert values(spark, ["true", " FALSE\t", "False", "maybe", None, "1"], fn.to_bool("t")) == [
        True, False, False, None, None, None,
    ]


def test_timestamps_accept_one_digit_parts_and_reject_nonsense(spark):
    texts = ["01/15/2023 11:45:00 PM", "1/5/2023 1:02:03 am", "13/45/2024 01:00:00 PM", "01/15/2023 13:00:00 PM", None]
    assert values(spark, texts, fn.parse_timestamp("t")) == [
        dt.datetime(2023, 1, 15, 23, 45), dt.datetime(2023, 1, 5, 1, 2, 3), None, None, None,
    ]


def test_wall_clock_time_in_a_daylight_saving_gap_is_kept(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = values(spark, ["03/12/2023 02:30:00 AM"], fn.parse_timestamp("t").cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2023-03-12 02:30:00"]


def test_keywords_are_plain_substrings(spark):
    texts = ["small retail Restaurant", "ALLEY", None, "a.b"]
    assert values(spark, texts, fn.contains_any("t", ["RESTAURANT", "A.B"])) == [1, 0, 0, 1]
    assert values(spark, ["axb"], fn.contains_any("t", ["a.b"])) == [0]


def test_calendar(spark):
    ts = F.col("t").cast("timestamp_ntz")
    days = ["2024-01-01 22:00:00", "2024-01-06 05:59:59", "2024-07-07 12:00:00", None]
    assert values(spark, days, fn.weekday_of(ts)) == [0, 5, 6, None]
    assert values(spark, days, fn.is_weekend(ts)) == [0, 1, 1, 0]
    assert values(spark, days, fn.is_night(ts)) == [1, 1, 0, 0]
    assert values(spark, days[:3], fn.season(ts)) == ["Winter", "Winter", "Summer"]
    every_month = [f"2023-{m:02d}-01" for m in range(1, 13)]
    assert values(spark, every_month, fn.season(ts)) == (
        ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    )


def test_hour_circle(spark):
    sine, cosine = fn.cyclical(F.col("t").cast("int"), 24)
    for s, c in zip(values(spark, ["0", "6", "17"], sine), values(spark, ["0", "6", "17"], cosine)):
        assert s * s + c * c == pytest.approx(1.0)


@pytest.mark.parametrize(
    "year, days",
    [
        (2011, "01-01 01-17 02-21 05-30 07-04 09-05 10-10 11-11 11-24 12-25 12-26"),
        (2021, "01-01 01-18 02-15 05-31 06-18 06-19 07-04 07-05 09-06 10-11 11-11 11-25 12-24 12-25 12-31"),
        (2022, "01-01 01-17 02-21 05-30 06-19 06-20 07-04 09-05 10-10 11-11 11-24 12-25 12-26"),
    ],
)
def test_holidays_of_a_year(spark, year, days):
    from sievework.operators.features import us_holidays

    got = [r[0].strftime("%m-%d") for r in us_holidays(spark, year, year).orderBy("holiday_date").collect()]
    assert got == days.split()


def test_digamma_matches_harmonic_numbers(spark):
    got = dict(spark.range(1, 60).select("id", digamma(F.col("id"))).collect())
    harmonic = 0.0
    for n in range(1, 60):
        assert got[n] == pytest.approx(harmonic - 0.5772156649015329, abs=1e-14)
        harmonic += 1 / n
    assert math.isclose(spark.range(1).select(digamma(F.lit(10**6))).first()[0], 13.815510057964191, abs_tol=1e-12)


def test_whole_numbers_keep_all_digits(spark):
    df = spark.createDataFrame([("9007199254740993",), (" 12 ",), ("3.9",), ("x",), ("99999999999999999999",)], "s string")
    got = [r[0] for r in df.select(fn.to_long("s", default=None)).collect()]
    assert got == [9007199254740993, 12, 3, None, None]


def test_holiday_rules_start_with_their_first_year(spark):
    from sievework.operators.features import us_holidays

    names = {r["name"] for r in us_holidays(spark, 1880, 1880).collect()}
    assert names & {"Memorial Day", "Veterans Day", "Labor Day", "Washington's Birthday"} == set() and {"Independence Day", "Thanksgiving Day"} <= names


@pytest.mark.parametrize(
    ("year", "days"),
    [
        (1926, "01-01 02-22 05-30 05-31 07-04 07-05 09-06 11-25 12-24 12-25 12-31"),
        (1939, "01-01 01-02 02-22 05-30 07-04 09-04 10-12 11-10 11-11 11-23 12-25"),
        (1970, "01-01 02-22 02-23 05-29 05-30 07-03 07-04 09-07 10-12 11-11 11-26 12-25"),
        (1975, "01-01 02-17 05-26 07-04 09-01 10-13 10-27 11-27 12-25"),
        (1985, "01-01 02-18 05-27 07-04 09-02 10-14 11-11 11-28 12-25"),
    ],
)
def test_holidays_of_earlier_times(spark, year, days):
    from sievework.operators.features import us_holidays

    got = [r[0].strftime("%m-%d") for r in us_holidays(spark, year, year).orderBy("holiday_date").collect()]
    assert got == days.split()


def test_days_that_moved(spark):
    written = {
        "1863-11-26": "Thanksgiving Day", "1938-11-24": "Thanksgiving Day", "1939-11-23": "Thanksgiving Day", "1940-11-21": "Thanksgiving Day",
        "1941-11-20": "Thanksgiving Day", "1942-11-26": "Thanksgiving Day", "1951-11-22": "Thanksgiving Day", "1951-11-29": None,
        "1937-11-11": None, "1953-11-11": "Armistice Day", "1954-11-11": "Veterans Day", "1971-10-25": "Veterans Day", "1977-10-24": "Veterans Day",
        "1975-11-11": None, "1978-11-11": "Veterans Day", "1968-02-22": "Washington's Birthday", "1971-02-15": "Washington's Birthday", "1971-02-22": None,
        "1969-05-30": "Memorial Day", "1971-05-31": "Memorial Day", "1936-10-12": None, "1937-10-12": "Columbus Day", "1971-10-11": "Columbus Day",
    }
    df = spark.createDataFrame(list(written.items()), "day string, name string")
    wrong = df.withColumn("found", holidays.us_holiday_name(F.to_date("day"))).filter("NOT found <=> name").collect()
    assert wrong == []
