"""Merged summaries of versions against the rows themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.operators import summaries


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(30_000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 7 != 0, F.pmod(F.hash("id"), F.lit(5000)) / 10.0).alias("x"),
        F.concat(F.lit("name "), (F.col("id") % 900).cast("string")).alias("text col"),
        (F.col("id") % 3 == 0).alias("flag"),
        F.lit(None).cast("double").alias("nothing"),
    )


def test_versions_merge_without_their_rows(spark, table, tmp_path):
    parts = [table.filter("k < 10000"), table.filter("k >= 10000 AND k < 12000"), table.filter("k >= 12000")]
    for i, part in enumerate(parts):
        summaries.save_summary(part, str(tmp_path), f"v{i}", "2026-01-01")
    stored = summaries.read_summaries(spark, str(tmp_path))
    found = {r["column_name"]: r for r in summaries.estimates(summaries.merged(stored), [0.1, 0.5, 0.9]).collect()}
    assert set(found) == set(table.columns)
    rows = table.toPandas()
    for name, r in found.items():
        values = rows[name].dropna()
        assert (r["row_count"], r["null_count"]) == (len(rows), int(rows[name].isna().sum()))
        assert abs(r["distinct_count"] - values.nunique()) <= 0.03 * values.nunique()
        if name in ("k", "x"):
            assert (r["min_value"], r["max_value"]) == (values.min(), values.max())
            for p, q in zip([0.1, 0.5, 0.9], r["quantiles"]):
                assert abs((values <= q).mean() - p) <= 0.02
    assert found["text col"]["quantiles"] is None and found["nothing"]["quantiles"] is None
    assert (found["flag"]["min_value"], found["flag"]["max_value"]) == (0.0, 1.0)
    some = summaries.estimates(summaries.merged(stored.filter("version IN ('v0', 'v1')"))).filter("column_name = 'k'").first()
    assert some["row_count"] == 12_000 and abs(some["quantiles"][1] - 6000) < 240


def test_merging_is_associative_in_its_exact_parts(spark, table):
    a, b, c = (summaries.summarise(table.sample(0.3, seed=s)) for s in (1, 2, 3))
    ab = summaries.merged(a.unionByName(b))
    exact = ["column_name", "row_count", "null_count", "low", "high"]
    left = summaries.merged(ab.select(a.columns).unionByName(c)).select(exact)
    right = summaries.merged(a.unionByName(summaries.merged(b.unionByName(c)).select(a.columns))).select(exact)
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


def test_empty_and_not_a_number(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,), (float("inf"),), (None,)], "x double")
    r = summaries.estimates(summaries.merged(summaries.summarise(df))).first()
    assert (r["row_count"], r["null_count"], r["min_value"], r["max_value"]) == (4, 1, 2.0, np.inf)
    r = summaries.estimates(summaries.merged(summaries.summarise(df.limit(0)))).first()
    assert (r["row_count"], r["distinct_count"], r["quantiles"]) == (0, 0, None)
