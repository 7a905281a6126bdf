"""Column catalogue, lineage, assumptions and zone registry of a processed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.text import as_column
from sievework.operators.audit import assumption_impacts, lineage
from sievework.operators.profile import (
    ANNOTATION_SCHEMA,
    column_catalog,
    profile_columns,
    roles_summary,
)
from sievework.sources.documents import write_json_document
from sievework.sources.inventory import file_inventory


def annotation_table(spark: SparkSession, annotations: Sequence[tuple]) -> DataFrame:
    """Hand-written annotations as a table, one row per column; what a short tuple leaves out is NULL."""
    width = ANNOTATION_SCHEMA.count(",") + 1
    return spark.createDataFrame([(*row, *[None] * (width - len(row))) for row in annotations], ANNOTATION_SCHEMA)


def dataset_summary(df: DataFrame, category: str, timestamp: str) -> DataFrame:
    """One row of measured facts: rows, columns, classes, first and last time."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_distinct(as_column(category)).alias("class_count"),
        F.min(as_column(timestamp)).alias("first_ts"),
        F.max(as_column(timestamp)).alias("last_ts"),
    ).withColumn("column_count", F.lit(len(df.columns)).cast("bigint"))


def run_catalog(
    cleaned: DataFrame,
    raw: DataFrame,
    annotations: Sequence[tuple],
    category: str,
    timestamp: str,
    stages: Sequence[DataFrame],
    rules: Sequence[tuple[str, str, Column]],
    zones: dict[str, str],
    catalog_zone: str,
) -> dict[str, DataFrame]:
    """Measure and write the metadata documents; returns them as tables by name.

    ``rules`` are conditions on the raw table; ``cleaned`` and ``raw`` should be scans.
    """
    spark = cleaned.sparkSession
    annotated = annotation_table(spark, annotations)
    documents = {
        "data_catalog": column_catalog(profile_columns(cleaned), annotated),
        "dataset_summary": dataset_summary(cleaned, category, timestamp),
        "column_roles": roles_summary(annotated),
        "lineage": lineage(stages),
        "assumptions": assumption_impacts(raw, rules),
    }
    for name, table in documents.items():
        write_json_document(table, f"{catalog_zone.rstrip('/')}/{name}")
    documents["zone_registry"] = file_inventory(spark, zones)
    write_json_document(
        documents["zone_registry"], f"{catalog_zone.rstrip('/')}/zone_registry", single_file=False
    )
    return documents
