"""Checks of published outputs, as tables of rule results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import as_column
from sievework.operators.profile import schema_check

RESULT_COLUMNS = ["rule", "failures", "passed"]


class RowRule(NamedTuple):
    """A named condition every row must meet."""

    name: str
    holds: Column


def null_rule(column: str) -> RowRule:
    """The column has no NULL."""
    return RowRule(f"not_null:{column}", as_column(column).isNotNull())


def range_rule(column: str, low: float, high: float) -> RowRule:
    """Every value lies in the closed range; NULL does not."""
    return RowRule(f"in_range:{column}", as_column(column).between(F.lit(low), F.lit(high)))


def check_rows(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Failing rows per rule, all rules in one scan."""
    counters = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.count_if(~F.coalesce(rule.holds, F.lit(False))).alias("failures"),
        )
        for rule in rules
    ]
    counted = df.agg(F.array(*counters).alias("rules")).select(F.inline("rules"))
    return counted.withColumn("passed", F.col("failures") == 0)


def check_schema(df: DataFrame, expected: Sequence[str], name: str = "schema") -> DataFrame:
    """One result: number of expected columns the table lacks."""
    missing = F.count_if(F.col("status") == "missing")
    return schema_check(df, expected).agg(missing.alias("failures")).select(
        F.lit(name).alias("rule"), "failures", (F.col("failures") == 0).alias("passed")
    )


def check_class_count(df: DataFrame, column: str, at_least: int = 1) -> DataFrame:
    """One result: the label has at least so many classes."""
    short = F.greatest(F.lit(at_least) - F.count_distinct(as_column(column)), F.lit(0))
    return df.agg(short.cast("bigint").alias("failures")).select(
        F.lit(f"classes:{column}").alias("rule"), "failures", (F.col("failures") == 0).alias("passed")
    )


def expected_present(inventory: DataFrame, expected: Sequence[tuple[str, str]]) -> DataFrame:
    """Each expected (zone, filename) with its status, size and time.

    The inventory is the large side; the expectation is a list typed in by hand.
    """
    spark = inventory.sparkSession
    wanted = spark.createDataFrame(list(expected), "zone string, filename string")
    # Only the wanted entries leave the inventory, so the outer join stays as small as the list.
    found = inventory.join(F.broadcast(wanted), ["zone", "filename"], "left_semi")
    status = F.when(F.col("modified").isNull(), F.lit("missing")).otherwise(F.lit("ok"))
    return wanted.join(found, ["zone", "filename"], "left").select(
        "zone", "filename", status.alias("status"), "size_mb", "modified"
    )


def zones_complete(presence: DataFrame) -> DataFrame:
    """Per zone: whether every expected file is there, as rule results."""
    return presence.groupBy("zone").agg(
        F.count_if(F.col("status") == "missing").alias("failures")
    ).select(
        F.concat(F.lit("files:"), F.col("zone")).alias("rule"),
        "failures",
        (F.col("failures") == 0).alias("passed"),
    )


def check_documents(documents: DataFrame) -> DataFrame:
    """One result per document of ``document_check``: it has entries and all are readable."""
    failures = F.col("broken") + (F.col("entries") == 0).cast("bigint")
    return documents.select(
        F.concat(F.lit("document:"), F.col("document")).alias("rule"),
        failures.alias("failures"),
        (failures == 0).alias("passed"),
    )


def validation_report(results: Sequence[DataFrame]) -> DataFrame:
    """All rule results under each other; schema and range rules count like any other."""
    return reduce(DataFrame.unionByName, [r.select(*RESULT_COLUMNS) for r in results])


def verdict(report: DataFrame) -> DataFrame:
    """One row: number of rules, of failed rules, and whether all passed."""
    return report.agg(
        F.count("*").alias("rules"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.coalesce(F.bool_and("passed"), F.lit(False)).alias("passed"),
    )
