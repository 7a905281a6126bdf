"""Intermediate tables on shared storage.

Some operators need one result twice (once to measure or to fit, once to apply).
Writing it as Parquet cuts the lineage, keeps column pruning and filter push-down
for the second read, and survives the loss of executors, which a cached or locally
checkpointed result does not.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


@lru_cache(maxsize=None)
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="sievework-")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local master may run without one (tests); a cluster must name a folder every
    executor can reach.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    return _local_root(context.applicationId)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder at which nothing lies yet.

    Tables of one application share a folder, which can be removed when it has ended.
    """
    return f"{scratch_root(spark)}/sievework/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def written_path(df: DataFrame, label: str) -> str:
    """Write ``df`` to a fresh scratch table and return its path."""
    path = fresh_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh scratch table and return a scan of it."""
    return df.sparkSession.read.schema(df.schema).parquet(written_path(df, label))
