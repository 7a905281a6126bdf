"""Landing a raw delimited file set as an immutable version, with its first profile."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.text import as_column
from sievework.operators.integrity import duplicate_key_count, duplicate_row_count, table_fingerprint
from sievework.operators.profile import (
    distinct_count,
    null_summary,
    sample_values,
    schema_check,
    table_shape,
    value_counts,
)
from sievework.operators.summaries import save_summary
from sievework.sources.delimited import header_columns, land_delimited, landed_rows, quarantined_lines
from sievework.sources.documents import read_json_document, write_json_document
from sievework.sources.inventory import CHECKSUM_SCHEMA, MEGABYTE, file_checksums, file_inventory
from sievework.sources.paths import path_exists


@dataclass(frozen=True)
class Dataset:
    """Name and version of a dataset and where its zones lie."""

    name: str
    version: str
    source: str
    raw_zone: str
    processed_zone: str
    catalog_zone: str


@dataclass(frozen=True)
class Landed:
    """The landed table, its path, the report tables by name, and the lines that were not accepted."""

    table: DataFrame
    path: str
    reports: dict[str, DataFrame]
    quarantine: DataFrame


def ingestion_manifest(df: DataFrame, dataset: Dataset, raw_path: str, ingest_date: dt.date) -> DataFrame:
    """One row that describes a landed version.

    The checksum is a fingerprint of the landed rows: any size, in parallel, and the same
    however the rows are spread over files.  Files and bytes are those below ``raw_path``.
    """
    content = table_fingerprint(df, df.columns).select("fingerprint").scalar()
    files = file_inventory(df.sparkSession, {"raw": raw_path}, recursive=True)
    files = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size"))
    size = files.select("size").scalar()
    return table_shape(df).select(
        F.lit(dataset.name).alias("dataset_name"),
        F.lit(dataset.version).alias("version"),
        F.lit(ingest_date.isoformat()).alias("ingestion_date"),
        F.lit("batch").alias("ingestion_mode"),
        F.lit(dataset.source).alias("source"),
        F.lit(raw_path).alias("raw_path"),
        content.alias("checksum"),
        "row_count",
        "column_count",
        files.select("n").scalar().alias("file_count"),
        size.alias("size_bytes"),
        F.round(size / MEGABYTE, 2).alias("size_mb"),
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        F.lit("new version on demand").alias("refresh_strategy"),
        F.struct(
            F.lit(dataset.raw_zone).alias("raw_zone"),
            F.lit(dataset.processed_zone).alias("processed_zone"),
            F.lit(dataset.catalog_zone).alias("catalog_zone"),
        ).alias("storage_layout"),
    )


def run_ingest(
    spark: SparkSession,
    dataset: Dataset,
    expected: Sequence[str],
    key: Sequence[str],
    category: str,
    date_column: str,
    year_column: str,
    order_by: Sequence[str],
    ingest_date: dt.date,
    file_md5: bool = False,
    arrival: bool = False,
    multi_line: bool | None = None,
    summary: bool = False,
) -> Landed:
    """Land the source files, then describe what landed; the manifest is written last.

    Accepted rows and quarantined lines land from one parse under one commit.  With ``arrival`` the table
    also has ``_position``, by which its rows sort as they stood in the files.  ``multi_line`` is that of
    ``read_delimited``.  ``summary`` stores the mergeable column summaries of the version in the catalogue.  ``file_md5`` adds the MD5 of every source file, each below 2 GiB, at the price of one more read.
    """
    if not path_exists(spark, dataset.source):
        raise FileNotFoundError(dataset.source)
    columns = header_columns(spark, dataset.source)
    path = land_delimited(spark, dataset.source, columns, dataset.raw_zone, dataset.version, ingest_date.isoformat(), multi_line=multi_line)
    table, quarantine = landed_rows(spark, path, columns), quarantined_lines(spark, path)
    reports = {
        "schema": schema_check(table, expected),
        "bad_lines": quarantine.agg(F.count("*").alias("bad_lines")),
        "shape": table_shape(table),
        "nulls": null_summary(table),
        "duplicate_rows": duplicate_row_count(table),
        "duplicate_keys": duplicate_key_count(table, key),
        "date_samples": sample_values(table, date_column, 5, order_by),
        "class_count": distinct_count(table, category),
        "top_classes": value_counts(table, category, 10),
    }
    if year_column in table.columns:
        reports["years"] = value_counts(table.select(as_column(year_column)), year_column)
    catalog_zone = dataset.catalog_zone.rstrip("/")
    if summary:
        save_summary(table, f"{catalog_zone}/summaries", dataset.version, ingest_date.isoformat())
    if file_md5:
        write_json_document(file_checksums(spark, dataset.source), f"{catalog_zone}/file_checksums", single_file=False)
        reports["file_checksums"] = read_json_document(spark, f"{catalog_zone}/file_checksums", CHECKSUM_SCHEMA)
    manifest = ingestion_manifest(table, dataset, path, ingest_date)
    write_json_document(manifest, f"{catalog_zone}/ingestion_manifest")
    return Landed(landed_rows(spark, path, columns, arrival), path, reports, quarantine)
