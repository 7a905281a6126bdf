from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sievework.operators import encode
from sievework.scratch import scratch_root, written, written_path


def session(master, setting=None, checkpoint_dir=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting),
        sparkContext=SimpleNamespace(
            master=master, applicationId="app", getCheckpointDir=lambda: checkpoint_dir
        ),
    )


def test_the_cluster_names_the_folder():
    assert scratch_root(session("yarn", "hdfs://shared/scratch/")) == "hdfs://shared/scratch"
    assert scratch_root(session("yarn", None, "hdfs://shared/other")) == "hdfs://shared/other"
    with pytest.raises(RuntimeError):
        scratch_root(session("yarn"))
    local = scratch_root(session("local[2]"))
    assert local == scratch_root(session("local[2]"))


def test_written_tables_are_scans_of_their_own(spark):
    df = spark.range(5).withColumn("a b", F.lit("x"))
    table = written(df, "t")
    assert table.dtypes == df.dtypes and table.count() == 5
    assert written_path(df, "t") != written_path(df, "t")
    plan = written(df, "t").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_large_lookups_split_frequent_keys(spark):
    """Without a broadcast, a value that fills a third of the table is spread over tasks."""
    df = spark.range(300_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.col("id") % 1000)).alias("c")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        coded = encode.label_encode(df.repartition(8), "c", "code")
        rows = coded.groupBy("c", "code").count().collect()
        joined = encode.label_encode(df.repartition(8), "c", "code")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    codes = {r["c"]: r["code"] for r in rows}
    assert len(rows) == len(codes)
    assert [codes[c] for c in sorted(codes)] == list(range(len(codes)))
    assert sum(r["count"] for r in rows) == 300_000
    assert "skew=true" in plan
