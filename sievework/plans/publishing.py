"""Publish tables and read them back for validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators.validate import (
    RowRule,
    check_class_count,
    check_documents,
    check_rows,
    check_schema,
    expected_present,
    validation_report,
    zones_complete,
)
from sievework.sources.documents import document_check
from sievework.sources.inventory import file_inventory
from sievework.sources.paths import path_exists
from sievework.sources.tables import publish, read_processed


def publish_and_validate(
    spark: SparkSession,
    cleaned: DataFrame,
    features: DataFrame,
    uri: str,
    expected_columns: Sequence[str],
    expected_features: Sequence[str],
    label: str,
    rules: Sequence[RowRule],
) -> DataFrame:
    """Write both tables below ``uri``, read them back whole, and check them."""
    places = publish({"cleaned": cleaned, "features": features}, uri)
    return validate_published(spark, places, expected_columns, expected_features, label, rules)


def check_zones(spark: SparkSession, zones: dict[str, str]) -> DataFrame:
    """One result per zone: its folder or container exists."""
    found = [(f"zone:{name}", 0 if path_exists(spark, path) else 1) for name, path in zones.items()]
    results = spark.createDataFrame(found, "rule string, failures bigint")
    return results.withColumn("passed", F.col("failures") == 0)


def validate_published(
    spark: SparkSession,
    places: dict[str, str],
    expected_columns: Sequence[str],
    expected_features: Sequence[str],
    label: str,
    rules: Sequence[RowRule],
    expected_files: Sequence[tuple[str, str]] = (),
    zones: dict[str, str] | None = None,
    catalog_zone: str | None = None,
    documents: Sequence[str] = (),
) -> DataFrame:
    """Rule results for published tables and, optionally, for zones, files and documents."""
    cleaned = read_processed(spark, places["cleaned"])
    features = read_processed(spark, places["features"])
    results = [
        check_schema(cleaned, expected_columns, "schema:cleaned"),
        check_schema(features, [*expected_features, label], "schema:features"),
        check_rows(cleaned, rules),
        check_class_count(features, label),
    ]
    if zones:
        results.append(check_zones(spark, zones))
    if expected_files:
        presence = expected_present(file_inventory(spark, zones or {}), expected_files)
        results.append(zones_complete(presence))
    if documents:
        results.append(check_documents(document_check(spark, catalog_zone, documents)))
    return validation_report(results)
