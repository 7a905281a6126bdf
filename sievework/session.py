"""Session settings the toolkit relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution sizes shuffle partitions at run time and splits skewed
#: join partitions; both are relied on wherever a lookup table is too large to
#: broadcast.  Timestamps are zone-less, so the session zone only matters for
#: display, and is pinned.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Call-site capture on every column expression slows down building large plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "sievework",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit
    command and the cluster defaults decide.  Tests pass ``local[n]`` and a small
    shuffle width.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
