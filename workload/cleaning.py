"""Cleaning, audit and lineage queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators import audit, clean, integrity, profile
from sievework.plans import cleaning
from sievework.scratch import written
from workload.incidents import CLEANING, TYPED_COLUMNS, WITH_CLEANED, WITH_RAW, raw_incidents, table


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.run_cleaning(raw_incidents(spark, sf), CLEANING).table.withColumnRenamed("ts_txt", "ts")


def cleaned_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Class frequency of the incidents that pass deduplication, parsing and bounds."""
    first = cleaning.first_rows(raw_incidents(spark, sf), CLEANING)
    kept = cleaning.passing(cleaning.typed(first, CLEANING), CLEANING)
    return profile.value_counts(kept, "type")


def clean_incidents(spark: SparkSession, sf: str) -> DataFrame:
    return _cleaned(spark, sf)


def etl_audit(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.run_cleaning(raw_incidents(spark, sf), CLEANING).audit


def rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Every raw incident that cleaning leaves out, with the first step that rejects it."""
    found = cleaning.run_cleaning(raw_incidents(spark, sf), CLEANING).rejects
    return found.select("step", "copies", F.col("row.id").alias("id"), F.col("row.case_no").alias("case_no"))


def audit_totals(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit_totals(etl_audit(spark, sf))


def lineage_counts(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_incidents(spark, sf)
    result = cleaning.run_cleaning(raw, CLEANING)
    # Written once: it is used three times.
    ends = written(audit.audit_totals(result.audit), "audit-totals")
    raw_rows = ends.select(F.col("rows_raw").alias("row_count"))
    clean_rows = ends.select(F.col("rows_cleaned").alias("row_count"))
    return audit.lineage(
        [
            audit.stage(1, "source", "events", None, profile.table_shape(table(spark, sf, "events"))),
            audit.stage(2, "raw", "events", "raw_incidents", raw_rows),
            audit.stage(3, "cleaned", "raw_incidents", "incidents", clean_rows),
            audit.stage(4, "features", "incidents", "features", clean_rows),
        ]
    )


def lineage_graph(spark: SparkSession, sf: str) -> DataFrame:
    """Every way through the steps of the incident flow, and the rows that are lost on it."""
    audited = written(etl_audit(spark, sf), "audit")
    steps = audited.join(audited.select((F.col("step_no") + 1).alias("step_no"), F.col("step").alias("earlier")), "step_no", "left")
    edges = steps.select(F.coalesce("earlier", F.lit("raw")).alias("input"), F.col("step").alias("output"), F.col("rows_before").alias("rows_in"), F.col("rows_after").alias("rows_out"))
    events = table(spark, sf, "events").agg(F.count("*").alias("rows_in"))
    ends = audit.audit_totals(audited)
    first = events.select(F.lit("events").alias("input"), F.lit("raw").alias("output"), "rows_in", ends.select("rows_raw").scalar().alias("rows_out"))
    last = ends.select(F.lit("iqr_outliers").alias("input"), F.explode(F.array(F.lit("features"), F.lit("published"))).alias("output"), F.col("rows_cleaned").alias("rows_in"), F.col("rows_cleaned").alias("rows_out"))
    return audit.lineage_reach(written(edges.unionByName(first).unionByName(last), "lineage-edges"))


def _assumptions(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.typed(raw_incidents(spark, sf), CLEANING)
    return audit.assumption_impacts(
        df,
        [
            ("DQ-01", "data_quality", clean.any_missing(["lat", "lon"])),
            ("DQ-02", "data_quality", F.col("type").isNull()),
            ("DQ-03", "data_quality", F.col("ts_txt").isNull()),
            ("DQ-04", "data_quality", F.col("loc") == "UNKNOWN"),
            ("DQ-05", "data_quality", F.col("ward") == 0),
            ("GEO-01", "geospatial", ~clean.in_box("lat", "lon", CLEANING.box)),
            ("TEMP-02", "temporal", ~clean.in_time_range("ts_txt", CLEANING.first_day, CLEANING.as_of)),
            ("TGT-01", "target_variable", F.col("type").startswith("RARE")),
        ],
    )


def assumption_impacts(spark: SparkSession, sf: str) -> DataFrame:
    return _assumptions(spark, sf)


def assumption_categories(spark: SparkSession, sf: str) -> DataFrame:
    touched = _assumptions(spark, sf)
    per_category = audit.impacts_by_category(touched)
    rows = touched.groupBy("category").agg(F.max("rows_affected").alias("most_rows_affected"))
    return per_category.join(rows, "category")


def exact_dups(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.duplicate_row_count(raw_incidents(spark, sf))


def drop_exact_dups(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_exact_duplicates(raw_incidents(spark, sf))


def _daily_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("day", F.to_date("ts"))


def dup_keys(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.duplicate_key_count(_daily_events(spark, sf), ["user_id", "day"])


def dup_case_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.duplicate_key_count(raw_incidents(spark, sf), ["case_no"])


def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    return clean.dedup_keep_first(_daily_events(spark, sf), ["user_id", "day"], ["ts", "event_id"])


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    labels = table(spark, sf, "labels").withColumn("grade", F.concat(F.lit("g"), "quality"))
    return documents.join(labels, "doc_id", "left")


def null_summary(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_summary(_labelled(spark, sf))


def drop_missing(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_missing(_labelled(spark, sf), ["quality", "toxic"])


def fill_missing(spark: SparkSession, sf: str) -> DataFrame:
    filled = clean.fill_missing(_labelled(spark, sf), ["grade", "no_such_column"], clean.UNKNOWN)
    return clean.fill_missing(filled, ["quality", "toxic"], 0)


def normalize_missing(spark: SparkSession, sf: str) -> DataFrame:
    rows = raw_incidents(spark, sf).select("id", "arrest", "ward")
    return clean.normalize_missing(rows, ["arrest", "ward"], [*clean.DEFAULT_MISSING_TOKENS, "maybe", "x"])


def fill_counts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.missing_counts(_labelled(spark, sf), ["grade", "quality", "no_such_column"])


def parse_us_ts(spark: SparkSession, sf: str) -> DataFrame:
    rows = raw_incidents(spark, sf).select("id", F.col("ts_txt").alias("ts"))
    return clean.parse_ts(rows, "ts")


def parse_us_ts_keep(spark: SparkSession, sf: str) -> DataFrame:
    rows = raw_incidents(spark, sf).select("id", F.col("ts_txt").alias("ts"))
    return clean.parse_ts(rows, "ts", on_error="null")


def coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    df = clean.fill_missing(raw_incidents(spark, sf), ["loc"], clean.UNKNOWN)
    df = clean.to_double(df, ["lat", "lon"])
    df = clean.to_int(df, ["ward"])
    df = clean.to_bool(df, ["arrest"])
    df = clean.standardize_text(df, ["type", "loc"])
    return clean.parse_ts(df, "ts_txt", on_error="null").withColumnRenamed("ts_txt", "ts")


def bbox(spark: SparkSession, sf: str) -> DataFrame:
    df = clean.to_double(raw_incidents(spark, sf).select("id", "lat", "lon"), ["lat", "lon"])
    return clean.bbox_filter(df, "lat", "lon", CLEANING.box)


def time_range(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return clean.time_range_filter(df, "o_orderdate", dt.date(1996, 1, 1), dt.date(1999, 6, 30))


def _types(spark: SparkSession, sf: str) -> DataFrame:
    return clean.standardize_text(raw_incidents(spark, sf).select("id", "type"), ["type"])


def rare_categories(spark: SparkSession, sf: str) -> DataFrame:
    return clean.rare_categories(_types(spark, sf), "type", 20)


def merge_rare(spark: SparkSession, sf: str) -> DataFrame:
    return clean.merge_rare(_types(spark, sf), "type", 20)


def iqr_filter(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("event_id", "value", "user_id")
    return clean.iqr_filter(df, ["value", "user_id"])


def iqr_fences(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("value", "user_id")
    fences = clean.iqr_fences(df, ["value", "user_id"])
    return fences.select(
        "step",
        "column_name",
        *[F.round(c, 6).alias(c) for c in ("q1", "q3", "iqr", "low", "high")],
        "removed",
    )


def quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = clean.quality_summary(
        _cleaned(spark, sf), ["ts", "type", "lat", "lon"], ["ts", "lat", "lon"], "type", "arrest"
    )
    return summary.withColumn("arrest_rate", F.round("arrest_rate", 9))


_LABELLED = """
WITH labelled AS (
  SELECT d.doc_id, d.lang, l.quality, l.toxic, 'g' || l.quality AS grade
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

_AUDIT = (
    WITH_CLEANED
    + """,
raw_rows AS (SELECT count(*) AS n FROM raw_incidents),
after_steps(step_no, step, rows_after) AS (
  SELECT 0, 'raw', count(*) FROM raw_incidents
  UNION ALL SELECT 1, 'drop_exact_duplicates', count(*) FROM distinct_rows
  UNION ALL SELECT 2, 'dedup_key', count(*) FROM first_rows
  UNION ALL SELECT 3, 'drop_missing', count(*) FROM complete
  UNION ALL SELECT 4, 'fill_missing', count(*) FROM complete
  UNION ALL SELECT 5, 'fix_types', count(*) FROM parsed
  UNION ALL SELECT 6, 'bounding_box', count(*) FROM boxed
  UNION ALL SELECT 7, 'time_range', count(*) FROM ranged
  UNION ALL SELECT 8, 'merge_rare', count(*) FROM merged
  UNION ALL SELECT 9, 'iqr_outliers', count(*) FROM cleaned
)"""
)

_ASSUMED = (
    WITH_RAW
    + f""",
typed AS (SELECT {TYPED_COLUMNS} FROM raw_incidents),
counted AS (
  SELECT count(*) AS total,
    count(*) FILTER (lat IS NULL OR lon IS NULL) AS dq1,
    count(*) FILTER (type IS NULL) AS dq2,
    count(*) FILTER (ts IS NULL) AS dq3,
    count(*) FILTER (loc = 'UNKNOWN') AS dq4,
    count(*) FILTER (ward = 0) AS dq5,
    count(*) FILTER (NOT (lat BETWEEN 41.60 AND 42.05 AND lon BETWEEN -88.00 AND -87.50)) AS geo1,
    count(*) FILTER (NOT ts BETWEEN TIMESTAMP '2001-01-01' AND TIMESTAMP '2024-12-31') AS temp2,
    count(*) FILTER (type LIKE 'RARE%') AS tgt1
  FROM typed
),
impacts(rule_id, category, rows_affected, total) AS (
  SELECT 'DQ-01', 'data_quality', dq1, total FROM counted
  UNION ALL SELECT 'DQ-02', 'data_quality', dq2, total FROM counted
  UNION ALL SELECT 'DQ-03', 'data_quality', dq3, total FROM counted
  UNION ALL SELECT 'DQ-04', 'data_quality', dq4, total FROM counted
  UNION ALL SELECT 'DQ-05', 'data_quality', dq5, total FROM counted
  UNION ALL SELECT 'GEO-01', 'geospatial', geo1, total FROM counted
  UNION ALL SELECT 'TEMP-02', 'temporal', temp2, total FROM counted
  UNION ALL SELECT 'TGT-01', 'target_variable', tgt1, total FROM counted
)"""
)

QUERIES = {
    "cleaned_type_counts": (
        cleaned_type_counts,
        WITH_CLEANED + "SELECT type AS value, count(*) AS row_count FROM ranged GROUP BY type",
    ),
    "clean_incidents": (clean_incidents, WITH_CLEANED + "SELECT * FROM cleaned"),
    "etl_audit": (
        etl_audit,
        _AUDIT
        + """
SELECT * FROM (
  SELECT step_no, step, lag(rows_after) OVER (ORDER BY step_no) AS rows_before, rows_after,
    lag(rows_after) OVER (ORDER BY step_no) - rows_after AS rows_dropped
  FROM after_steps
) WHERE step_no > 0""",
    ),
    "rejects": (
        rejects,
        WITH_CLEANED
        + """
SELECT 'drop_exact_duplicates' AS step, n - 1 AS copies, id, case_no FROM (SELECT *, count(*) AS n FROM raw_incidents GROUP BY ALL) WHERE n > 1
UNION ALL SELECT 'dedup_key', 1, id, case_no FROM distinct_rows WHERE id NOT IN (SELECT id FROM first_rows)
UNION ALL SELECT 'drop_missing', 1, id, case_no FROM first_rows WHERE id NOT IN (SELECT id FROM complete)
UNION ALL SELECT 'fix_types', 1, id, case_no FROM complete WHERE id NOT IN (SELECT id FROM parsed)
UNION ALL SELECT 'bounding_box', 1, id, case_no FROM parsed WHERE id NOT IN (SELECT id FROM boxed)
UNION ALL SELECT 'time_range', 1, id, case_no FROM boxed WHERE id NOT IN (SELECT id FROM ranged)
UNION ALL SELECT 'iqr_outliers', 1, id, case_no FROM merged WHERE id NOT IN (SELECT id FROM cleaned)""",
    ),
    "audit_totals": (
        audit_totals,
        _AUDIT
        + """
SELECT r.n AS rows_raw, c.n AS rows_cleaned, r.n - c.n AS rows_dropped,
  round(c.n * 100.0::DOUBLE / r.n, 2) AS retention_pct
FROM raw_rows r, (SELECT count(*) AS n FROM cleaned) c""",
    ),
    "lineage_counts": (
        lineage_counts,
        _AUDIT
        + """,
stages(stage, name, input, output, row_count) AS (
  SELECT 1, 'source', 'events', NULL::VARCHAR, count(*) FROM events
  UNION ALL SELECT 2, 'raw', 'events', 'raw_incidents', n FROM raw_rows
  UNION ALL SELECT 3, 'cleaned', 'raw_incidents', 'incidents', count(*) FROM cleaned
  UNION ALL SELECT 4, 'features', 'incidents', 'features', count(*) FROM cleaned
)
SELECT *, lag(row_count) OVER (ORDER BY stage) - row_count AS rows_dropped,
  round(row_count * 100.0::DOUBLE / lag(row_count) OVER (ORDER BY stage), 2) AS retention_pct
FROM stages""",
    ),
    "lineage_graph": (
        lineage_graph,
        _AUDIT.replace("WITH ", "WITH RECURSIVE ", 1)
        + """,
edges AS (
  SELECT coalesce(lag(step) OVER (ORDER BY step_no), 'raw') AS input, step AS output, before AS rows_in, rows_after AS rows_out
  FROM (SELECT *, lag(rows_after) OVER (ORDER BY step_no) AS before FROM after_steps) WHERE step_no > 0
  UNION ALL SELECT 'events', 'raw', (SELECT count(*) FROM events), n FROM raw_rows
  UNION ALL SELECT 'iqr_outliers', unnest(['features', 'published']), (SELECT count(*) FROM cleaned), (SELECT count(*) FROM cleaned)
),
reach(source, target, steps, path, rows_dropped) AS (
  SELECT input, output, 1, [input, output], rows_in - rows_out FROM edges
  UNION ALL
  SELECT r.source, e.output, r.steps + 1, list_append(r.path, e.output), r.rows_dropped + e.rows_in - e.rows_out
  FROM reach r JOIN edges e ON e.input = r.target WHERE NOT list_contains(r.path, e.output)
)
SELECT source, target, steps, array_to_string(path, ' > ') AS path, rows_dropped FROM reach""",
    ),
    "assumption_impacts": (
        assumption_impacts,
        _ASSUMED
        + """
SELECT rule_id, category, rows_affected,
  round(rows_affected * 100.0::DOUBLE / total, 2) AS affected_pct FROM impacts""",
    ),
    "assumption_categories": (
        assumption_categories,
        _ASSUMED
        + """
SELECT category, count(*) AS assumptions, max(rows_affected) AS most_rows_affected
FROM impacts GROUP BY category""",
    ),
    "exact_dups": (
        exact_dups,
        WITH_RAW
        + """SELECT (SELECT count(*) FROM raw_incidents)
  - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_incidents)) AS duplicate_rows""",
    ),
    "drop_exact_dups": (drop_exact_dups, WITH_RAW + "SELECT DISTINCT * FROM raw_incidents"),
    "dup_keys": (
        dup_keys,
        """SELECT (SELECT count(*) FROM events)
  - (SELECT count(*) FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM events)) AS duplicate_keys""",
    ),
    "dup_case_numbers": (
        dup_case_numbers,
        WITH_RAW
        + """SELECT (SELECT count(*) FROM raw_incidents)
  - (SELECT count(*) FROM (SELECT DISTINCT case_no FROM raw_incidents)) AS duplicate_keys""",
    ),
    "dedup_first": (
        dedup_first,
        """SELECT *, CAST(ts AS DATE) AS day FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""",
    ),
    "null_summary": (
        null_summary,
        _LABELLED
        + """,
counts(column_name, null_count) AS (
  SELECT 'doc_id', count(*) FILTER (doc_id IS NULL) FROM labelled
  UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL) FROM labelled
  UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL) FROM labelled
  UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM labelled
  UNION ALL SELECT 'grade', count(*) FILTER (grade IS NULL) FROM labelled
)
SELECT column_name, null_count,
  round(null_count * 100.0::DOUBLE / (SELECT count(*) FROM labelled), 2) AS null_pct
FROM counts WHERE null_count > 0""",
    ),
    "drop_missing": (
        drop_missing,
        _LABELLED + " SELECT * FROM labelled WHERE quality IS NOT NULL AND toxic IS NOT NULL",
    ),
    "fill_missing": (
        fill_missing,
        _LABELLED
        + """ SELECT doc_id, lang, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic,
  coalesce(grade, 'UNKNOWN') AS grade FROM labelled""",
    ),
    "normalize_missing": (
        normalize_missing,
        WITH_RAW + "SELECT id, nullif(arrest, 'maybe') AS arrest, nullif(ward, 'x') AS ward FROM raw_incidents",
    ),
    "fill_counts": (
        fill_counts,
        _LABELLED
        + """ SELECT count(*) FILTER (grade IS NULL) AS grade,
  count(*) FILTER (quality IS NULL) AS quality FROM labelled""",
    ),
    "parse_us_ts": (
        parse_us_ts,
        WITH_RAW
        + r"""SELECT id, try_strptime(ts_txt, '%m/%d/%Y %I:%M:%S %p') AS ts FROM raw_incidents
WHERE try_strptime(ts_txt, '%m/%d/%Y %I:%M:%S %p') IS NOT NULL""",
    ),
    "parse_us_ts_keep": (
        parse_us_ts_keep,
        WITH_RAW + r"SELECT id, try_strptime(ts_txt, '%m/%d/%Y %I:%M:%S %p') AS ts FROM raw_incidents",
    ),
    "coerce_types": (coerce_types, WITH_RAW + f"SELECT {TYPED_COLUMNS} FROM raw_incidents"),
    "bbox": (
        bbox,
        WITH_RAW
        + """SELECT * FROM (
  SELECT id, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM raw_incidents
) WHERE lat BETWEEN 41.60 AND 42.05 AND lon BETWEEN -88.00 AND -87.50""",
    ),
    "time_range": (
        time_range,
        """SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-06-30'""",
    ),
    "rare_categories": (
        rare_categories,
        WITH_RAW
        + """SELECT upper(trim(type)) AS value, count(*) AS row_count FROM raw_incidents
WHERE type IS NOT NULL GROUP BY 1 HAVING count(*) < 20""",
    ),
    "merge_rare": (
        merge_rare,
        WITH_RAW
        + """, classes AS (SELECT id, upper(trim(type)) AS type FROM raw_incidents)
SELECT id, CASE WHEN type IS NULL THEN NULL
  WHEN count(*) OVER (PARTITION BY type) < 20 THEN 'OTHER' ELSE type END AS type FROM classes""",
    ),
    "iqr_filter": (
        iqr_filter,
        """WITH a AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
kept AS (
  SELECT e.event_id, e.value, e.user_id FROM events e, a
  WHERE e.value BETWEEN a.q1 - 1.5 * (a.q3 - a.q1) AND a.q3 + 1.5 * (a.q3 - a.q1)
),
b AS (SELECT quantile_cont(user_id, 0.25) AS q1, quantile_cont(user_id, 0.75) AS q3 FROM kept)
SELECT k.* FROM kept k, b
WHERE k.user_id BETWEEN b.q1 - 1.5 * (b.q3 - b.q1) AND b.q3 + 1.5 * (b.q3 - b.q1)""",
    ),
    "iqr_fences": (
        iqr_fences,
        """WITH a AS (
  SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events
),
af AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM a),
kept AS (SELECT e.* FROM events e, af WHERE e.value BETWEEN af.low AND af.high),
b AS (SELECT quantile_cont(user_id, 0.25) AS q1, quantile_cont(user_id, 0.75) AS q3 FROM kept),
bf AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM b)
SELECT 1 AS step, 'value' AS column_name, round(q1, 6) AS q1, round(q3, 6) AS q3,
  round(q3 - q1, 6) AS iqr, round(low, 6) AS low, round(high, 6) AS high,
  (SELECT count(*) FROM events e WHERE NOT e.value BETWEEN af.low AND af.high) AS removed
FROM af
UNION ALL
SELECT 2, 'user_id', round(q1, 6), round(q3, 6), round(q3 - q1, 6), round(low, 6), round(high, 6),
  (SELECT count(*) FROM kept k WHERE NOT k.user_id BETWEEN bf.low AND bf.high)
FROM bf""",
    ),
    "quality_summary": (
        quality_summary,
        WITH_CLEANED
        + """SELECT count(*) AS row_count,
  count(*) FILTER (ts IS NULL) + count(*) FILTER (type IS NULL)
    + count(*) FILTER (lat IS NULL) + count(*) FILTER (lon IS NULL) AS critical_nulls,
  min(ts) AS ts_min, max(ts) AS ts_max, min(lat) AS lat_min, max(lat) AS lat_max,
  min(lon) AS lon_min, max(lon) AS lon_max, count(DISTINCT type) AS class_count,
  round(avg(CAST(arrest AS INTEGER)), 9) AS arrest_rate
FROM cleaned""",
    ),
}
