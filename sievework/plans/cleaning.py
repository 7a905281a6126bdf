"""The cleaning sequence as one flow.

The order of the steps is part of their meaning: duplicates go first, so that the first
row of a key wins even if a later check rejects it, and the outlier fences are fitted on
what all other checks left.

Physical shape: one shuffle for the deduplication, one written table, then narrow scans
of that table for the class counts, the fences and the audit, and one full scan for the
result.

Every row of the written table carries the first step it fails, and a failing one what it was like
before.  So rejected rows are data that can be read with their reason, and the audit is one grouped
count of that table, which a stage that runs again cannot change.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.casts import parse_timestamp, to_bool, to_double, to_long
from sievework.functions.text import as_column, standardize
from sievework.operators import audit, clean, integrity
from sievework.operators.profile import table_shape
from sievework.plans.spec import CleaningSpec
from sievework.scratch import written
from sievework.sources.documents import write_json_document
from sievework.sources.tables import write_processed

_COMPLETE = "_complete"
_FAILED = "_failed"
_RAW = "_raw"
OUTLIERS = "iqr_outliers"


@dataclass(frozen=True)
class Cleaned:
    """Result of the flow: the table, its audit, the merged classes, the fences, the rejected rows."""

    table: DataFrame
    audit: DataFrame
    rare: DataFrame
    fences: tuple[clean.Fence, ...]
    rejects: DataFrame


def first_rows(raw: DataFrame, spec: CleaningSpec) -> DataFrame:
    """First row per key.

    Copies of a row share its key, so this also removes exact duplicates; removing those
    in a step of their own would shuffle the whole table once more for the same result.  A
    table without the key only loses its exact duplicates.
    """
    if not set(spec.key) <= set(raw.columns):
        return clean.drop_exact_duplicates(raw)
    return clean.dedup_keep_first(raw, spec.key, [F.expr(o).asc_nulls_last() for o in spec.order_by])


def typed(df: DataFrame, spec: CleaningSpec, keep: Sequence[Column] = ()) -> DataFrame:
    """Fill, cast and standardise every column in one projection; ``keep`` are further columns of it.

    ``_complete`` records whether the raw row had all critical values, which can no
    longer be told from the typed ones.
    """
    def value(name: str) -> Column:
        column = as_column(name)
        if name in spec.fill_unknown:
            column = F.coalesce(column, F.lit(clean.UNKNOWN))
        if name in spec.texts:
            return standardize(column)
        if name == spec.timestamp or name in spec.other_timestamps:
            return parse_timestamp(column)
        if name in spec.doubles or name in spec.fence_columns:
            return to_double(column)
        if name in spec.long_keys:
            return to_long(column, default=None)
        if name in spec.longs:
            return to_long(column)
        if name in spec.booleans:
            return to_bool(column)
        return column

    return df.select(
        *[value(c).alias(c) for c in df.columns],
        (~clean.any_missing(spec.critical)).alias(_COMPLETE),
        *keep,
    )


def row_tests(spec: CleaningSpec) -> list[tuple[str, Column]]:
    """Tests of the typed table, one per step; filling and casting drop only unreadable times."""
    always = F.lit(True)
    return [
        ("drop_missing", F.col(_COMPLETE)),
        ("fill_missing", always),
        ("fix_types", as_column(spec.timestamp).isNotNull()),
        ("bounding_box", clean.in_box(spec.latitude, spec.longitude, spec.box)),
        ("time_range", clean.in_time_range(spec.timestamp, spec.first_day, spec.as_of)),
        ("merge_rare", always),
    ]


def passing(staged: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Rows of the typed table that pass every row test."""
    for _, test in row_tests(spec):
        staged = staged.where(test)
    return staged.drop(_COMPLETE)


def _as_text(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.struct(*[as_column(c).cast("string").alias(c) for c in columns])


def judged(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """The typed table with ``_failed``, the first step a row fails, and ``_raw``, what a failing row was like."""
    rows = typed(df, spec, [_as_text(df, df.columns).alias(_RAW)])
    first = F.coalesce(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in row_tests(spec)])
    rows = rows.withColumn(_FAILED, first)
    return rows.withColumn(_RAW, F.when(F.col(_FAILED).isNotNull(), F.col(_RAW))).drop(_COMPLETE)


def duplicates(raw: DataFrame, first: DataFrame) -> DataFrame:
    """``step``, ``copies`` and ``row`` of the raw rows that deduplication leaves out; ``first`` are those it keeps.

    Copies of a row are one row with their number, counted before anything is shuffled; the others are
    found by a 128-bit hash, so a key that fills a third of the table is spread.
    """
    row = _as_text(raw, raw.columns).alias("row")
    rows = raw.select(integrity.row_hash(raw).alias("h"), row).groupBy("h").agg(F.count("*").alias("n"), F.first("row").alias("row"))
    rows = written(rows, "distinct-rows")
    copies = rows.filter("n > 1").select(F.lit("drop_exact_duplicates").alias("step"), (F.col("n") - 1).alias("copies"), "row")
    other = rows.join(first.select(integrity.row_hash(first).alias("h")), "h", "left_anti")
    return copies.unionByName(other.select(F.lit("dedup_key").alias("step"), F.lit(1).cast("bigint").alias("copies"), "row"))


def run_cleaning(raw: DataFrame, spec: CleaningSpec) -> Cleaned:
    """Clean a raw table; ``raw`` should be a scan.

    ``rejects`` hold every row that is not in the table, with the step that rejected it: ``step``,
    ``copies`` and ``row`` (as text; of outliers, the cleaned values).
    """
    first = first_rows(raw, spec)
    staged = written(judged(first, spec), "staged")
    kept = staged.where(F.col(_FAILED).isNull()).drop(_FAILED, _RAW)
    fences = clean.fit_fences(kept, spec.fence_columns, spec.fence_factor)
    merged = clean.merge_rare(kept, spec.category, spec.rare_threshold)
    outside = ~F.coalesce(clean.within_fences(fences), F.lit(False))
    failed = F.coalesce(_FAILED, F.when(outside, F.lit(OUTLIERS)))
    late = staged.withColumn(_FAILED, failed).filter(F.col(_FAILED).isNotNull())
    late = late.select(F.col(_FAILED).alias("step"), F.lit(1).cast("bigint").alias("copies"), F.coalesce(_RAW, _as_text(raw, raw.columns)).alias("row"))
    return Cleaned(
        table=merged.where(clean.within_fences(fences)),
        audit=audit.audit_table(
            table_shape(raw),
            [
                audit.rows_after_step(integrity.row_hashes(raw).distinct(), "drop_exact_duplicates", 1),
                audit.rows_after_step(staged, "dedup_key", 2),
                audit.rows_after_failures(staged, failed, [*(name for name, _ in row_tests(spec)), OUTLIERS], first_no=3),
            ],
        ),
        rare=clean.rare_categories(kept, spec.category, spec.rare_threshold),
        fences=tuple(fences),
        rejects=duplicates(raw, first).unionByName(late),
    )


def save_cleaning(result: Cleaned, processed_path: str, catalog_zone: str, rejects_path: str | None = None) -> None:
    """Write the cleaned table, its audit with totals, the list of merged classes and, if asked, the rejected rows by step."""
    write_processed(result.table, processed_path)
    if rejects_path:
        result.rejects.write.mode("overwrite").partitionBy("step").parquet(rejects_path)
    zone = catalog_zone.rstrip("/")
    audited = written(result.audit, "audit")
    write_json_document(audited, f"{zone}/etl_report")
    write_json_document(audit.audit_totals(audited), f"{zone}/etl_totals")
    write_json_document(result.rare, f"{zone}/class_merges", single_file=False)
