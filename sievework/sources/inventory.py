"""What lies in a zone: file names, sizes, times and checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.sources.paths import child_files, path_exists

MEGABYTE = 1024 * 1024
CHECKSUM_SCHEMA = "filename string, size_bytes bigint, md5 string"
_EMPTY_INVENTORY = "zone string, filename string, size_bytes bigint, size_mb double, modified timestamp"


def _files(spark: SparkSession, path: str) -> DataFrame:
    """All files below a path; sub-folders may be tables of any partitioning."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def file_inventory(spark: SparkSession, zones: dict[str, str], recursive: bool = False) -> DataFrame:
    """Regular files of each zone folder; a zone that does not exist has none.

    Only files that lie directly in the folder, unless ``recursive``: that lists the whole tree,
    by Spark, and selects no content.  Hidden files (leading dot or underscore) are left out.
    """
    inventory = spark.createDataFrame([], _EMPTY_INVENTORY)
    for zone, path in zones.items():
        if not path_exists(spark, path):
            continue
        if recursive:
            files = _files(spark, path).select("path", "length", "modificationTime")
        else:
            direct = [f for f in child_files(spark, path) if f[0][0] not in "._"]
            files = spark.createDataFrame(direct, "path string, length bigint, millis bigint").withColumn("modificationTime", F.timestamp_millis("millis"))
        listed = files.select(
            F.lit(zone).alias("zone"),
            F.element_at(F.split("path", "/"), -1).alias("filename"),
            F.col("length").alias("size_bytes"),
            F.round(F.col("length") / MEGABYTE, 2).alias("size_mb"),
            F.col("modificationTime").alias("modified"),
        )
        inventory = inventory.unionByName(listed)
    return inventory


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """MD5 of the bytes of each file, many files in parallel.

    One file is one row, so a single file must stay below 2 GiB;
    ``operators.integrity.table_fingerprint`` has no such limit.
    """
    return _files(spark, path).select(
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        F.col("length").alias("size_bytes"),
        F.md5("content").alias("md5"),
    )
