"""Row accounting: what every step dropped, how rows flow between stages, what each
assumption touched.

Counts are ordinary aggregates.  Metrics gathered on the side while a table is written
(accumulators, ``observe``) are counted again when a lost executor's stage is rerun, and
an audit must not change because a machine failed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

AUDIT_COLUMNS = ["step_no", "step", "rows_before", "rows_after", "rows_dropped"]


def rows_after_steps(df: DataFrame, steps: Sequence[tuple[str, Column]], first_no: int = 1) -> DataFrame:
    """Rows left after each of a sequence of row tests, all in one scan.

    ``steps`` are (name, test) pairs; a row is counted for a step when it passed this
    test and all earlier ones.
    """
    kept, counters = F.lit(True), []
    for number, (name, test) in enumerate(steps, start=first_no):
        kept = kept & F.coalesce(test, F.lit(False))
        counters.append(
            F.struct(
                F.lit(number).alias("step_no"),
                F.lit(name).alias("step"),
                F.count_if(kept).alias("rows_after"),
            )
        )
    return df.agg(F.array(*counters).alias("steps")).select(F.inline("steps"))


def rows_after_failures(df: DataFrame, failed: Column, steps: Sequence[str], first_no: int = 1) -> DataFrame:
    """Rows left after each step where ``failed`` names the first step that a row fails (NULL: none).

    One grouped count over one scan; what follows works on a row per step.
    """
    counts = df.groupBy(failed.alias("step")).agg(F.count("*").alias("n"))
    numbers = F.map_from_arrays(F.array(*[F.lit(s) for s in steps]), F.array(*[F.lit(i) for i in range(len(steps))]))
    placed = counts.select(F.coalesce(F.element_at(numbers, F.col("step")), F.lit(len(steps))).alias("place"), "n")
    total = F.coalesce(F.sum("n"), F.lit(0))
    left = [F.struct(F.lit(first_no + i).alias("step_no"), F.lit(s).alias("step"), (total - F.coalesce(F.sum(F.when(F.col("place") <= i, F.col("n"))), F.lit(0))).alias("rows_after")) for i, s in enumerate(steps)]
    return placed.agg(F.array(*left).alias("steps")).select(F.inline("steps"))


def rows_after_step(df: DataFrame, name: str, number: int) -> DataFrame:
    """Rows left after a step that is not a row test, such as a deduplication."""
    return df.agg(F.count("*").alias("rows_after")).select(
        F.lit(number).alias("step_no"), F.lit(name).alias("step"), "rows_after"
    )


def audit_table(raw_rows: DataFrame, steps: Sequence[DataFrame]) -> DataFrame:
    """Before / after / dropped per step.

    ``raw_rows`` is a one-row table with ``row_count``; ``steps`` are results of the two
    functions above.  The window runs over one row per step.
    """
    start = raw_rows.select(
        F.lit(0).alias("step_no"), F.lit("raw").alias("step"), F.col("row_count").alias("rows_after")
    )
    chain = reduce(DataFrame.unionByName, steps, start)
    before = F.lag("rows_after").over(W.orderBy("step_no"))
    return (
        chain.withColumn("rows_before", before)
        .where(F.col("step_no") > 0)
        .withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))
        .select(*AUDIT_COLUMNS)
    )


def audit_totals(audit: DataFrame) -> DataFrame:
    """One row: raw, cleaned and dropped rows and the share retained in percent."""
    totals = audit.agg(
        F.min_by("rows_before", "step_no").alias("rows_raw"),
        F.max_by("rows_after", "step_no").alias("rows_cleaned"),
    )
    retained = F.try_divide(F.col("rows_cleaned") * F.lit(100.0), F.col("rows_raw"))
    return totals.select(
        "rows_raw",
        "rows_cleaned",
        (F.col("rows_raw") - F.col("rows_cleaned")).alias("rows_dropped"),
        F.round(retained, 2).alias("retention_pct"),
    )


def stage(number: int, name: str, source: str | None, target: str | None, rows: DataFrame) -> DataFrame:
    """One lineage stage; ``rows`` is a one-row table with ``row_count``."""
    return rows.select(
        F.lit(number).alias("stage"),
        F.lit(name).alias("name"),
        F.lit(source).cast("string").alias("input"),
        F.lit(target).cast("string").alias("output"),
        "row_count",
    )


def lineage(stages: Sequence[DataFrame]) -> DataFrame:
    """Stages in order with the rows each dropped and the share of the stage before it kept."""
    chain = reduce(DataFrame.unionByName, stages)
    before = F.lag("row_count").over(W.orderBy("stage"))
    return chain.withColumn("_before", before).select(
        "stage",
        "name",
        "input",
        "output",
        "row_count",
        (F.col("_before") - F.col("row_count")).alias("rows_dropped"),
        F.round(F.try_divide(F.col("row_count") * F.lit(100.0), F.col("_before")), 2).alias("retention_pct"),
    )


def lineage_reach(edges: DataFrame) -> DataFrame:
    """Everything upstream of everything: ``source``, ``target``, ``steps``, ``path`` and ``rows_dropped`` of each way.

    ``edges`` are a row for each step of a flow: ``input``, ``output``, ``rows_in``, ``rows_out``.  A way is a run of
    steps that passes no table twice, and drops what its steps drop.  Flows are metadata: a row per step.
    """
    steps = edges.select("input", "output", (F.col("rows_in") - F.col("rows_out")).alias("dropped"))
    return steps.sparkSession.sql(
        """
        WITH RECURSIVE reach(source, target, steps, path, rows_dropped) AS (
          SELECT input, output, 1, array(input, output), dropped FROM {steps}
          UNION ALL
          SELECT r.source, s.output, r.steps + 1, array_append(r.path, s.output), r.rows_dropped + s.dropped
          FROM reach r JOIN {steps} s ON s.input = r.target
          WHERE NOT array_contains(r.path, s.output)
        )
        SELECT source, target, steps, array_join(path, ' > ') AS path, rows_dropped FROM reach
        """,
        steps=steps,
    )


def assumption_impacts(df: DataFrame, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Rows each assumption touches; ``rules`` are (id, category, condition).  One scan."""
    counters = [
        F.struct(
            F.lit(rule_id).alias("rule_id"),
            F.lit(category).alias("category"),
            F.count_if(F.coalesce(condition, F.lit(False))).alias("rows_affected"),
        )
        for rule_id, category, condition in rules
    ]
    counted = df.agg(F.count("*").alias("total"), F.array(*counters).alias("rules"))
    share = F.try_divide(F.col("rows_affected") * F.lit(100.0), F.col("total"))
    return counted.select("total", F.inline("rules")).select(
        "rule_id", "category", "rows_affected", F.round(share, 2).alias("affected_pct")
    )


def impacts_by_category(impacts: DataFrame) -> DataFrame:
    """Number of assumptions per category."""
    return impacts.groupBy("category").agg(F.count("*").alias("assumptions"))
