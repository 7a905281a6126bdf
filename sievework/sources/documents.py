"""Metadata documents: one JSON object per file."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.sources.paths import path_exists


def read_json_document(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read JSON documents as rows; fields a document lacks are NULL.

    Reports written by :func:`write_json_document` hold one entry per line; a file with one
    object spread over lines is read with ``multi_line``.
    """
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def write_json_document(df: DataFrame, path: str, single_file: bool = True) -> None:
    """Write a report as JSON lines, one entry per line.

    One file suits manifests, audits and catalogues, whose rows do not grow with the data;
    for results that may grow (file listings, code maps) leave the number of files to Spark.
    """
    rows = df.coalesce(1) if single_file else df
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def _is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value; in brackets, as the parser stops after a first value."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull()


def document_check(spark: SparkSession, zone: str, names: Sequence[str]) -> DataFrame:
    """Per document of a catalogue zone: entries read and entries that are not valid JSON.

    A document that is not there has no entries.
    """
    checks = []
    for name in names:
        path = f"{zone.rstrip('/')}/{name}"
        if path_exists(spark, path):
            # A file is one object, however it is spread over lines, or one entry per line.
            files = spark.read.text(path, wholetext=True)
            lines = F.filter(F.split("value", "\\r?\\n"), lambda x: F.trim(x) != "")
            bad = F.size(F.filter(lines, lambda x: ~_is_json(x)))
            whole = _is_json(F.col("value"))
            counts = files.select(
                F.when(whole & (bad > 0), F.lit(1)).otherwise(F.size(lines)).alias("entries"),
                F.when(whole, F.lit(0)).otherwise(bad).alias("broken"),
            )
            found = counts.agg(F.coalesce(F.sum("entries"), F.lit(0)).cast("bigint").alias("entries"), F.coalesce(F.sum("broken"), F.lit(0)).cast("bigint").alias("broken"))
        else:
            found = spark.range(1).select(F.lit(0).cast("bigint").alias("entries"), F.lit(0).cast("bigint").alias("broken"))
        checks.append(found.select(F.lit(name).alias("document"), "entries", "broken"))
    return reduce(DataFrame.unionByName, checks)


def document_counts(documents: DataFrame) -> DataFrame:
    """Number of entries in every top-level list or map of each document.

    A map of lists (entries by category) also gives the total over its lists.
    """
    counts = []
    for field in documents.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, T.ArrayType):
            counts.append(F.coalesce(F.size(column), F.lit(0)).alias(f"{field.name}_count"))
        elif isinstance(kind, T.MapType):
            counts.append(F.coalesce(F.size(column), F.lit(0)).alias(f"{field.name}_count"))
            if isinstance(kind.valueType, T.ArrayType):
                total = F.aggregate(
                    F.map_values(column), F.lit(0), lambda acc, entries: acc + F.size(entries)
                )
                counts.append(F.coalesce(total, F.lit(0)).alias(f"{field.name}_total"))
    return documents.select(*counts)
