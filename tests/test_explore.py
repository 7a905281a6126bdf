import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievework.operators import audit, explore, profile, validate
from sievework.plans.catalog import annotation_table


def test_null_summary_and_schema(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, `b c` string")
    assert rows(profile.null_summary(df)) == [("a", 1, 33.33), ("b c", 2, 66.67)]
    assert rows(profile.null_summary(df.limit(0))) == []
    assert rows(profile.schema_check(df, ["a", "z"])) == [("a", "ok"), ("b c", "extra"), ("z", "missing")]
    assert profile.missing_columns(df, ["a", "z"]) == ["z"]
    assert rows(profile.table_shape(df)) == [(3, 2)]


@pytest.mark.parametrize("approx", [False, True])
def test_profile(spark, rows, approx):
    df = spark.createDataFrame([(1, True, "x", None), (5, False, "x", None), (None, None, "y", None)],
                               "a int, b boolean, c string, d double")
    assert rows(profile.profile_columns(df, approx=approx)) == [
        ("a", 1, 2, "int", 1.0, 5.0),
        ("b", 1, 2, "boolean", 0.0, 1.0),
        ("c", 0, 2, "string", None, None),
        ("d", 3, 0, "double", None, None),
    ]


def test_catalogue_keeps_columns_the_data_lacks(spark):
    notes = annotation_table(spark, [("a", "int", True, "both", "feature", None, "first"), ("gone", "int", True, "raw", "excluded", None)])
    assert [r["description"] for r in notes.orderBy("column_name").collect()] == ["first", None]
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    got = {r["column_name"]: r["null_count"] for r in profile.column_catalog(profile.profile_columns(df), notes).collect()}
    assert got == {"a": 0, "gone": None}
    assert profile.drop_by_role(df, [("b", "int", True, "both", "excluded", None)], "excluded").columns == ["a"]


def test_frequencies_leave_null_out_and_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), (None,), (None,)], "v string")
    assert [tuple(r) for r in profile.value_counts(df, "v", 2).collect()] == [("c", 2), ("a", 1)]
    assert [tuple(r) for r in profile.value_counts(df, "v", 9, sort="key").collect()] == [("a", 1), ("b", 1), ("c", 2)]
    assert [tuple(r) for r in profile.value_counts(df, "v", sort="count").collect()][0] == ("c", 2)
    assert profile.distinct_count(df, "v").first()[0] == 3
    assert sorted(r["v"] for r in explore.filter_top_k(df, "v", 2).collect()) == ["a", "c", "c"]


def test_correlation_matches_pairwise_complete_pearson(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(size=(200, 3)), columns=list("abc"))
    pdf["c"] += pdf["a"]
    holes = pdf.mask(rng.random(pdf.shape) < 0.1)
    df = spark.createDataFrame(holes).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in "abc"], F.lit(1.0).alias("k"))
    expected = holes.corr()
    for a, b, r in explore.correlation_matrix(df, ["a", "b", "c", "k"]).collect():
        if "k" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(expected.loc[a, b], abs=1e-12)


def test_box_stats(spark):
    numbers = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([(v,) for v in numbers], "x double")
    row = explore.box_stats(df, ["x"]).first()
    q1, median, q3 = np.quantile(numbers, [0.25, 0.5, 0.75])
    assert (row["q1"], row["median"], row["q3"]) == (q1, median, q3)
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (1.0, 5.0, 1)


def test_class_balance(spark, rows):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "c string")
    assert rows(explore.class_balance(df, "c")) == [("a", 3, 0.75, 1.0), ("b", 1, 0.25, 3.0)]


def test_grid_and_temporal_counts(spark, rows):
    df = spark.createDataFrame([(1.05, -2.05, "x"), (1.09, -2.01, "x"), (None, 1.0, "x")], "a double, b double, c string")
    assert rows(explore.spatial_grid(df, "a", "b", "c", 0.1)) == [(10, -21, "x", 2)]
    times = spark.createDataFrame([("2024-01-01 05:00:00",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert rows(explore.temporal_counts(times, "t", "weekday")) == [(0, 1)]


def test_audit_balances(spark):
    df = spark.range(10)
    steps = audit.rows_after_steps(df, [("even", F.col("id") % 2 == 0), ("big", F.col("id") > 3)], first_no=2)
    table = audit.audit_table(profile.table_shape(df), [audit.rows_after_step(df.limit(9), "first", 1), steps])
    got = [tuple(r) for r in table.orderBy("step_no").collect()]
    assert got == [(1, "first", 10, 9, 1), (2, "even", 9, 5, 4), (3, "big", 5, 3, 2)]
    assert tuple(audit.audit_totals(table).first()) == (10, 3, 7, 30.0)
    impacts = audit.assumption_impacts(df, [("A", "x", F.col("id") > 6), ("B", "x", F.lit(None).cast("boolean"))])
    assert sorted(tuple(r) for r in impacts.collect()) == [("A", "x", 3, 30.0), ("B", "x", 0, 0.0)]
    assert audit.impacts_by_category(impacts).first()["assumptions"] == 2


def test_validation(spark, rows):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (9.0, None)], "x double, c string")
    report = validate.validation_report(
        [
            validate.check_schema(df, ["x", "c"]),
            validate.check_rows(df, [validate.null_rule("c"), validate.range_rule("x", 0, 5)]),
            validate.check_class_count(df, "c", 3),
        ]
    )
    assert rows(report) == [
        ("classes:c", 1, False), ("in_range:x", 2, False), ("not_null:c", 1, False), ("schema", 0, True),
    ]
    assert tuple(validate.verdict(report).first()) == (4, 3, False)
    inventory = spark.createDataFrame([("z", "f", 10, 0.0, None)], "zone string, filename string, size_bytes bigint, size_mb double, modified timestamp")
    inventory = inventory.withColumn("modified", F.current_timestamp())
    presence = validate.expected_present(inventory, [("z", "f"), ("z", "g"), ("y", "h")])
    assert rows(presence.select("zone", "filename", "status")) == [("y", "h", "missing"), ("z", "f", "ok"), ("z", "g", "missing")]
    assert rows(validate.zones_complete(presence)) == [("files:y", 1, False), ("files:z", 1, False)]
    documents = spark.createDataFrame([("a", 3, 0), ("b", 3, 1), ("c", 0, 0)], "document string, entries bigint, broken bigint")
    assert rows(validate.check_documents(documents)) == [
        ("document:a", 0, True), ("document:b", 1, False), ("document:c", 1, False),
    ]
