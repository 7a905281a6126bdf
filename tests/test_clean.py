import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievework.operators import clean, integrity


def test_first_row_wins_whatever_the_partitioning(spark, rows):
    data = [(3, "a", "x"), (1, "a", "y"), (2, None, "z"), (5, None, "w"), (4, "b", "v")]
    df = spark.createDataFrame(data, "id int, k string, v string")
    for n in (1, 4, 17):
        kept = clean.dedup_keep_first(df.repartition(n), ["k"], ["id"])
        assert rows(kept) == [(1, "a", "y"), (2, None, "z"), (4, "b", "v")]
    assert clean.dedup_keep_first(df, ["no_such_key"], ["id"]).count() == 5


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(100_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    plan = clean.dedup_keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_duplicates_count_null_keys_as_equal(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 3), ("b", 4)], "k string, v int")
    assert rows(integrity.duplicate_row_count(df)) == [(1,)]
    assert rows(integrity.duplicate_key_count(df, ["k"])) == [(2,)]
    assert clean.drop_exact_duplicates(df).count() == 4


def test_fingerprint_ignores_order_and_sees_borders_and_nulls(spark):
    def mark(data):
        df = spark.createDataFrame(data, "a string, b string").repartition(3)
        return integrity.table_fingerprint(df, ["a", "b"]).first()["fingerprint"]

    assert mark([("x", "y"), ("z", None)]) == mark([("z", None), ("x", "y")])
    assert len({mark([("a|b", "c")]), mark([("a", "b|c")]), mark([("a", None)]), mark([("a", "")])}) == 4


def test_fill_and_drop(spark, rows):
    df = spark.createDataFrame([(None, None, 1), ("t", 2.0, None)], "t string, n double, m int")
    filled = clean.fill_missing(clean.fill_missing(df, ["t", "absent"], "UNKNOWN"), ["n"], 0)
    assert rows(filled) == [("UNKNOWN", 0.0, 1), ("t", 2.0, None)]
    assert rows(clean.drop_missing(df, ["t", "n"])) == [("t", 2.0, None)]
    assert rows(clean.normalize_missing(df.select("t"), ["t", "absent"], ["t"])) == [(None,), (None,)]
    assert rows(clean.missing_counts(df, ["t", "m", "absent"])) == [(1, 1)]


def test_bounds_are_inclusive_and_the_last_day_ends_at_its_start(spark, rows):
    box = clean.Box(1.0, 2.0, -3.0, -2.0)
    df = spark.createDataFrame([(1.0, -3.0), (2.0, -2.0), (2.1, -2.5), (None, -2.5), (1.5, None)], "la double, lo double")
    assert rows(clean.bbox_filter(df, "la", "lo", box)) == [(1.0, -3.0), (2.0, -2.0)]
    times = ["2001-01-01 00:00:00", "2000-12-31 23:59:59", "2020-05-01 00:00:00", "2020-05-01 00:00:01", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    kept = clean.time_range_filter(df, "t", dt.date(2001, 1, 1), dt.date(2020, 5, 1))
    assert rows(kept.select(F.col("t").cast("string"))) == [("2001-01-01 00:00:00",), ("2020-05-01 00:00:00",)]


def test_bad_times_drop_or_become_null(spark):
    df = spark.createDataFrame([("01/02/2020 03:04:05 AM",), ("bad",), (None,)], "t string")
    assert clean.parse_ts(df, "t").count() == 1
    assert clean.parse_ts(df, "t", on_error="null").where(F.col("t").isNull()).count() == 2
    with pytest.raises(ValueError):
        clean.parse_ts(df, "t", on_error="ignore")


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_rare_classes_below_the_threshold_are_merged(spark, rows, broadcast):
    df = spark.createDataFrame(
        [("A",)] * 5 + [("B",)] * 3 + [("C",)] * 2 + [(None,)], "Primary_Type string"
    ).withColumnRenamed("Primary_Type", "Primary Type")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        merged = clean.merge_rare(df, "Primary Type", 3)
        assert rows(merged.groupBy("Primary Type").count()) == [("A", 5), ("B", 3), ("OTHER", 2), (None, 1)]
        again = clean.merge_rare(merged, "Primary Type", 2)
        assert rows(again.groupBy("Primary Type").count()) == rows(merged.groupBy("Primary Type").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(clean.rare_categories(df, "Primary Type", 3)) == [("C", 2)]


def test_outlier_fences_are_sequential(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"i": range(2000), "a": rng.normal(size=2000), "b": rng.standard_t(2, size=2000)})
    pdf.loc[pdf.a.abs() > 2.5, "b"] += 50
    expected = pdf
    for c in ("a", "b"):
        q1, q3 = expected[c].quantile(0.25), expected[c].quantile(0.75)
        expected = expected[expected[c].between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))]
    df = spark.createDataFrame(pdf)
    got = sorted(r["i"] for r in clean.iqr_filter(df, ["a", "b"]).select("i").collect())
    assert got == sorted(expected.i)
    fences = clean.iqr_fences(df, ["a", "b"]).orderBy("step").collect()
    assert sum(f["removed"] for f in fences) == 2000 - len(expected)


def test_outlier_filter_of_an_empty_column_keeps_nothing(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert clean.iqr_filter(df, ["a"]).count() == 0
    assert clean.iqr_fences(df, ["a"]).first()["removed"] == 1


def test_quality_summary_and_strict_mode(spark):
    df = spark.createDataFrame([("A", 1.0, True), ("B", None, False), ("A", 3.0, None)], "c string, x double, f boolean")
    row = clean.quality_summary(df, ["c", "x"], ["x"], "c", "f").first()
    assert row.asDict() == {
        "row_count": 3, "critical_nulls": 1, "x_min": 1.0, "x_max": 3.0, "class_count": 2, "f_rate": 0.5,
    }
    with pytest.raises(clean.QualityError):
        clean.quality_summary(df, ["c", "x"], ["x"], "c", "f", strict=True)
