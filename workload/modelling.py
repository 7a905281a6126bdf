"""Feature, selection, validation and read/write queries."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.text import as_column
from sievework.operators import audit, clean, encode, features, profile, sampling, selection, validate
from sievework.plans.features import Features, derive, run_features, save_features
from sievework.plans.ingest import Dataset, ingestion_manifest
from sievework.plans.publishing import validate_published
from sievework.scratch import fresh_path, written
from sievework.sources.delimited import bad_line_count, land_delimited, landed_rows, quarantined_lines, read_delimited
from sievework.sources.documents import document_counts, read_json_document, write_json_document
from sievework.sources.inventory import file_inventory
from sievework.sources.paths import create_new
from sievework.sources.tables import land_raw, publish, read_latest, read_processed, write_processed
from workload.cleaning import _cleaned, etl_audit
from workload.incidents import COLUMNS, FEATURES, WITH_CLEANED, WITH_RAW, raw_incidents, table
from workload.profiling import LINEITEM_PROFILE, fingerprint_sql


def calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts")
    table_ = features.calendar_flags(features.calendar_parts(events, "ts"), "ts")
    return table_.withColumns({c: F.round(c, 9) for c in ("hour_sin", "hour_cos")}).drop("ts")


def _order_years(orders: DataFrame) -> DataFrame:
    """Holidays of all years in which orders were placed."""
    years = orders.agg(F.year(F.min("o_orderdate")).alias("lo"), F.year(F.max("o_orderdate")).alias("hi")).first()
    return features.us_holidays(orders.sparkSession, years["lo"], years["hi"])


def holidays(spark: SparkSession, sf: str) -> DataFrame:
    """Every holiday of the years orders were placed in, with the orders placed on it."""
    orders = table(spark, sf, "orders")
    daily = (
        orders.groupBy(F.to_date("o_orderdate").alias("holiday_date"))
        .agg(F.count("*").alias("orders"))
    )
    return _order_years(orders).join(daily, "holiday_date", "left").select(
        "holiday_date", "name", F.coalesce("orders", F.lit(0)).alias("orders")
    )


def holiday_flag(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return features.holiday_flag(orders, "o_orderdate")


def holiday_flag_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """The same flag through a calendar table."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return features.holiday_flag(orders, "o_orderdate", _order_years(orders))


def label_encode(spark: SparkSession, sf: str) -> DataFrame:
    return encode.label_encode(table(spark, sf, "part").select("p_partkey", "p_type"), "p_type", "code")


def label_encode_text(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers coded in text order: "10" before "2"."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return encode.label_encode(customers, F.col("c_nationkey").cast("string"), "code")


def label_mapping(spark: SparkSession, sf: str) -> DataFrame:
    return encode.label_mapping(table(spark, sf, "part"), "p_name")


def keyword_flag(spark: SparkSession, sf: str) -> DataFrame:
    places = raw_incidents(spark, sf).select("id", "loc")
    return features.keyword_flag(places, "loc", FEATURES.place_keywords, "is_crowded")


def temporal_split(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", features.temporal_split("o_orderdate", 1998, 1999, 2000).alias("split")
    )


def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = written(_cleaned(spark, sf).withColumnRenamed("ts", "ts_txt"), "cleaned")
    derived = derive(
        cleaned,
        FEATURES,
        encode.label_mapping(cleaned, FEATURES.category),
        encode.label_mapping(cleaned, as_column(FEATURES.area).cast("string")),
    )
    return derived.select(
        "id",
        *[F.round(c, 9).alias(c) if c in ("hour_sin", "hour_cos") else c for c in FEATURES.candidates],
        FEATURES.label,
    )


def fixed_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.fixed_sample(table(spark, sf, "events"), 2000, 42, "event_id")


def _event_features(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_type",
        F.hour("ts").alias("hour"),
        F.weekday("ts").alias("day_of_week"),
        (F.col("user_id") % 7).alias("user_group"),
    )


def _plugin_scores(spark: SparkSession, sf: str) -> DataFrame:
    return selection.mi_plugin(_event_features(spark, sf), ["hour", "day_of_week", "user_group"], "event_type")


def mi_plugin(spark: SparkSession, sf: str) -> DataFrame:
    return _plugin_scores(spark, sf).withColumn("mi", F.round("mi", 9))


def mi_knn(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return selection.mi_knn(events, ["value"], "event_type", "event_id").withColumn("mi", F.round("mi", 9))


def select_features(spark: SparkSession, sf: str) -> DataFrame:
    return selection.select_features(_plugin_scores(spark, sf), 0.0012).withColumn("mi", F.round("mi", 9))


def validate_report(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = written(_cleaned(spark, sf), "cleaned")
    rules = [
        validate.null_rule("ts"),
        validate.null_rule("type"),
        validate.null_rule("arrest"),
        validate.range_rule("lat", 41.60, 42.05),
        validate.range_rule("lon", -88.00, -87.50),
        validate.range_rule("ward", 1, 50),
    ]
    return validate.validation_report(
        [
            validate.check_schema(cleaned, ["id", "case_no", "ts", "type", "lat", "lon", "block"]),
            validate.check_rows(cleaned, rules),
            validate.check_class_count(cleaned, "type", at_least=5),
        ]
    )


def validate_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return validate.verdict(validate_report(spark, sf))


def delimited_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Incidents written as CSV and read back: quoting, blanks and missing values survive."""
    path = fresh_path(spark, "csv")
    write_processed(raw_incidents(spark, sf), path, "csv")
    return read_delimited(spark, path, COLUMNS)


def latest_landed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed as two versions; the newest is read."""
    orders = table(spark, sf, "orders")
    root = fresh_path(spark, "zone")
    zone = f"{root}/raw"
    land_raw(orders.where(F.col("o_orderstatus") == "F"), zone, "v1.9", "2026-01-01")
    land_raw(orders, zone, "v1.10", "2025-01-01")
    land_raw(orders.where(F.col("o_orderstatus") == "F"), zone, "v1.10", "2025-01-01")
    return read_latest(spark, zone).groupBy("o_orderstatus").agg(
        F.count("*").alias("row_count"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


def published_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and customers published, replaced, and read back from where they were put."""
    uri = fresh_path(spark, "published")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("amount"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"))
    publish({"orders": customers, "customers": customers}, uri)
    places = publish({"orders": orders, "customers": customers}, uri)
    sums = [
        read_processed(spark, place)
        .agg(F.count("*").alias("row_count"), F.round(F.sum("amount"), 2).alias("total"))
        .withColumn("name", F.lit(name))
        for name, place in places.items()
    ]
    return sums[0].unionByName(sums[1])


def document_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A profile written as a JSON document and read back."""
    profiled = profile.profile_columns(table(spark, sf, "lineitem")).drop("inferred_type")
    path = fresh_path(spark, "profile")
    write_json_document(profiled, path)
    return read_json_document(spark, path, profiled.schema)


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest of the landed incidents, with a fingerprint of all of their columns."""
    dataset = Dataset("incidents", "v1.0", sf, "raw", "processed", "catalog")
    described = ingestion_manifest(raw_incidents(spark, sf), dataset, "raw/incidents", dt.date(2026, 1, 2))
    return described.select(
        "dataset_name",
        "version",
        "ingestion_date",
        "ingestion_mode",
        "raw_path",
        "checksum",
        "row_count",
        "column_count",
        F.array_join("columns", ",").alias("columns"),
        F.col("storage_layout.raw_zone").alias("raw_zone"),
    )


def bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as delimited text in which every seventh key has a field too many, read by each policy."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    surplus = F.when(F.col("o_orderkey") % 7 == 0, F.lit(",surplus")).otherwise(F.lit(""))
    path = fresh_path(spark, "bad-lines")
    lines = orders.select(F.concat(F.col("o_orderkey").cast("string"), F.lit(","), "o_orderstatus", surplus).alias("key,status"))
    # One column under another separator, so that the surplus field is not quoted.
    lines.write.option("header", True).option("sep", ";").csv(path)
    warn = read_delimited(spark, path, ["key", "status"]).agg(F.count("*").alias("warn_rows"))
    keep = read_delimited(spark, path, ["key", "status"], on_bad_lines="keep")
    kept = keep.agg(F.count("*").alias("keep_rows"), F.sum(F.col("key").cast("bigint")).alias("keep_sum"))
    counted = bad_line_count(spark, path, ["key", "status"])
    return counted.select("bad_lines", warn.scalar().alias("warn_rows"), kept.select("keep_rows").scalar().alias("keep_rows"), kept.select("keep_sum").scalar().alias("keep_sum"))


def quarantined(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed as delimited text with quoted line ends; lines with a field too many are kept apart, with their reason."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    line = F.concat(F.col("o_orderkey").cast("string"), F.lit(',"status\n'), "o_orderstatus", F.lit('"'), F.when(F.col("o_orderkey") % 11 == 0, F.lit(",x,y")).otherwise(F.lit("")))
    path, zone = fresh_path(spark, "odd-lines"), fresh_path(spark, "zone")
    # Text files of lines, one for each task, so that none holds all of them; the first line of each file is the header.
    first = F.monotonically_increasing_id() % 2**33 == 0
    text = F.concat(F.when(first, F.lit("key,status\n")).otherwise(F.lit("")), F.coalesce(line, F.lit("")))
    orders.select(text).write.option("maxRecordsPerFile", 0).text(path)
    landed = land_delimited(spark, path, ["key", "status"], zone, "v1", "2026-01-01")
    bad = quarantined_lines(spark, landed).select("reason", "text")
    kept = landed_rows(spark, landed, ["key", "status"]).groupBy("status").agg(F.count("*").cast("string").alias("n"))
    return bad.unionByName(kept.select(F.concat(F.lit("accepted "), "n").alias("reason"), F.col("status").alias("text")))


def quoted_newlines(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, with the line ends inside their texts, written as delimited text and read back by many tasks."""
    path = fresh_path(spark, "documents")
    columns = ["doc_id", "lang", "text"]
    write_processed(table(spark, sf, "documents").select(*columns), path, "csv")
    read = read_delimited(spark, path, columns, missing_tokens=["\0"], multi_line=True)
    return read.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.coalesce("text", F.lit("")).alias("text"))


def first_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """The first line of each customer in files of orders, newest first, whatever the values say."""
    path, zone = fresh_path(spark, "orders"), fresh_path(spark, "zone")
    columns = ["o_custkey", "o_orderkey", "o_orderstatus"]
    orders = table(spark, sf, "orders").select(*columns)
    newest = orders.repartitionByRange(8, F.desc("o_orderkey")).sortWithinPartitions(F.desc("o_orderkey"))
    write_processed(newest, path, "csv")
    landed = land_delimited(spark, path, columns, zone, "v1", "2026-01-01")
    rows = landed_rows(spark, landed, columns, arrival=True)
    first = clean.dedup_keep_first(rows, ["o_custkey"], [F.col("_position")]).drop("_position")
    return first.select(*(F.col(c).cast("bigint").alias(c) if c != "o_orderstatus" else c for c in columns))


#: Candidates scored from contingency tables; the city is the same everywhere and says nothing.
_SCORED = ("hour", "day_of_week", "city")
_SELECTED = replace(FEATURES, candidates=_SCORED, discrete=_SCORED, threshold=1e-6, sample_rows=None)


def _feature_flow(spark: SparkSession, sf: str) -> tuple[Features, str]:
    """The whole flow, saved below a fresh path."""
    cleaned = _cleaned(spark, sf).withColumnRenamed("ts", "ts_txt").withColumn("city", F.lit(1))
    flow, zone = run_features(written(cleaned, "cleaned"), _SELECTED), fresh_path(spark, "features")
    save_features(flow, f"{zone}/matrix", f"{zone}/catalog")
    return flow, zone


def feature_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the feature flow, written and read back."""
    flow, zone = _feature_flow(spark, sf)
    return read_json_document(spark, f"{zone}/catalog/feature_scores", flow.scores.schema).withColumn("mi", F.round("mi", 9))


def selected_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Matrix of the selected features and the label, written and read back."""
    return read_processed(spark, f"{_feature_flow(spark, sf)[1]}/matrix")


def published_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables published, then zones, files, documents, columns and rows checked; some are absent on purpose."""
    cleaned = written(_cleaned(spark, sf), "cleaned")
    labels = encode.label_mapping(cleaned, "type")
    features_ = encode.label_encode(cleaned, "type", "type_label", labels).select("lat", "lon", "type_label")
    uri = fresh_path(spark, "published")
    places = publish({"cleaned": cleaned, "features": features_}, uri)
    write_json_document(audit.audit_totals(etl_audit(spark, sf)), f"{uri}/etl_report")
    return validate_published(
        spark,
        places,
        ["id", "ts", "type", "block"],
        ["lat", "lon"],
        "type_label",
        [validate.null_rule("type"), validate.range_rule("ward", 1, 50)],
        expected_files=[("published", "absent.bin")],
        zones={"published": uri, "nowhere": f"{uri}/nowhere"},
        catalog_zone=uri,
        documents=["etl_report", "absent"],
    )


def zone_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a zone with their bytes, and which of the expected ones are there: one is, one is not."""
    zone = fresh_path(spark, "zone")
    statuses = table(spark, sf, "orders").groupBy("o_orderstatus").count().orderBy("o_orderstatus").collect()
    create_new(spark, f"{zone}/statuses.txt", "".join(f"{r['o_orderstatus']} {r['count']}\n" for r in statuses))
    found = file_inventory(spark, {"zone": zone, "nowhere": f"{zone}/nowhere"})
    present = validate.expected_present(found, [("zone", "statuses.txt"), ("zone", "absent.txt"), ("nowhere", "statuses.txt")])
    sizes = found.select("zone", "filename", "size_bytes")
    return present.select("zone", "filename", "status").join(sizes, ["zone", "filename"], "left")


def document_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of the lists and maps of a document made from the orders."""
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()
    by_status = orders.groupBy("o_orderstatus").agg(F.collect_list("o_orderpriority").alias("entries"))
    stages = orders.agg(F.collect_set("o_orderpriority").alias("stages")).scalar()
    document = by_status.agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "entries"))).alias("categories"))
    document = document.select(stages.alias("stages"), "categories")
    path = fresh_path(spark, "document")
    write_json_document(document, path)
    counts = document_counts(read_json_document(spark, path, document.schema))
    return counts.select(*[F.col(c).cast("bigint").alias(c) for c in counts.columns])


_CALENDAR = """
  CAST(hour({ts}) AS INTEGER) AS hour, CAST(isodow({ts}) - 1 AS INTEGER) AS day_of_week,
  CAST(month({ts}) AS INTEGER) AS month,
  CAST(isodow({ts}) >= 6 AS INTEGER) AS is_weekend,
  CAST(hour({ts}) >= 22 OR hour({ts}) <= 5 AS INTEGER) AS is_night"""

# Adding zero makes a rounded negative zero a plain one, which Spark's rounding does by itself.
_CIRCLE = """
  round(sin(2 * pi() * hour({ts}) / 24.0), 9) + 0.0::DOUBLE AS hour_sin,
  round(cos(2 * pi() * hour({ts}) / 24.0), 9) + 0.0::DOUBLE AS hour_cos"""

# Weekday rules as the n-th (or last) such day of a month, unlike the day ranges used in Spark.
_HOLIDAYS = """
years AS (
  SELECT unnest(range(min(y) - 1, max(y) + 2)) AS y
  FROM (SELECT year(o_orderdate) AS y FROM orders UNION ALL SELECT year(ts) FROM events)
),
months AS (
  SELECT y, m, d, isodow(d) AS dow,
    row_number() OVER (PARTITION BY y, m, isodow(d) ORDER BY d) AS nth,
    row_number() OVER (PARTITION BY y, m, isodow(d) ORDER BY d DESC) AS nth_last
  FROM (
    SELECT y, month(d) AS m, CAST(d AS DATE) AS d FROM years,
      LATERAL (SELECT unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS d)
  )
),
fixed AS (
  SELECT d, 'New Year''s Day' AS name FROM months WHERE m = 1 AND day(d) = 1
  UNION ALL SELECT d, 'Juneteenth National Independence Day' FROM months WHERE m = 6 AND day(d) = 19 AND y >= 2021
  UNION ALL SELECT d, 'Independence Day' FROM months WHERE m = 7 AND day(d) = 4
  UNION ALL SELECT d, 'Veterans Day' FROM months WHERE m = 11 AND day(d) = 11
  UNION ALL SELECT d, 'Christmas Day' FROM months WHERE m = 12 AND day(d) = 25
),
all_holidays AS (
  SELECT d AS holiday_date, name FROM fixed
  UNION ALL SELECT CAST(d - INTERVAL 1 DAY AS DATE), name || ' (observed)' FROM fixed WHERE isodow(d) = 6
  UNION ALL SELECT CAST(d + INTERVAL 1 DAY AS DATE), name || ' (observed)' FROM fixed WHERE isodow(d) = 7
  UNION ALL SELECT d, 'Martin Luther King Jr. Day' FROM months WHERE m = 1 AND dow = 1 AND nth = 3
  UNION ALL SELECT d, 'Washington''s Birthday' FROM months WHERE m = 2 AND dow = 1 AND nth = 3
  UNION ALL SELECT d, 'Memorial Day' FROM months WHERE m = 5 AND dow = 1 AND nth_last = 1
  UNION ALL SELECT d, 'Labor Day' FROM months WHERE m = 9 AND dow = 1 AND nth = 1
  UNION ALL SELECT d, 'Columbus Day' FROM months WHERE m = 10 AND dow = 1 AND nth = 2
  UNION ALL SELECT d, 'Thanksgiving Day' FROM months WHERE m = 11 AND dow = 4 AND nth = 4
)"""

_HOLIDAY_FLAG = (
    "WITH "
    + _HOLIDAYS
    + """
SELECT o_orderkey, o_orderdate,
  CAST(CAST(o_orderdate AS DATE) IN (SELECT holiday_date FROM all_holidays) AS INTEGER) AS is_holiday
FROM orders"""
)

_PLUGIN = """
WITH f AS (
  SELECT event_type, 'hour' AS feature, hour(ts) AS x FROM events
  UNION ALL SELECT event_type, 'day_of_week', isodow(ts) - 1 FROM events
  UNION ALL SELECT event_type, 'user_group', user_id % 7 FROM events
),
cells AS (SELECT feature, x, event_type, count(*)::DOUBLE AS n FROM f GROUP BY ALL),
shares AS (
  SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS total,
    sum(n) OVER (PARTITION BY feature, x) AS nx, sum(n) OVER (PARTITION BY feature, event_type) AS ny
  FROM cells
),
scores AS (
  SELECT feature, sum(n / total * ln(n * total / (nx * ny))) AS mi FROM shares GROUP BY feature
)
"""

_FEATURE_SCORES = """, labelled AS (SELECT hour(ts) AS hour, isodow(ts) AS dow, type FROM cleaned),
f AS (SELECT 'hour' AS feature, hour AS x, type FROM labelled UNION ALL SELECT 'day_of_week', dow, type FROM labelled
  UNION ALL SELECT 'city', 1, type FROM labelled),
cells AS (SELECT feature, x, type, count(*)::DOUBLE AS n FROM f GROUP BY ALL),
shares AS (
  SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS total,
    sum(n) OVER (PARTITION BY feature, x) AS nx, sum(n) OVER (PARTITION BY feature, type) AS ny
  FROM cells
),
scores AS (SELECT feature, greatest(sum(n / total * ln(n * total / (nx * ny))), 0) + 0.0::DOUBLE AS mi FROM shares GROUP BY feature)
"""

QUERIES = {
    "calendar_features": (
        calendar_features,
        "WITH "
        + _HOLIDAYS
        + " SELECT event_id, "
        + _CALENDAR.format(ts="ts")
        + """, CAST(CAST(ts AS DATE) IN (SELECT holiday_date FROM all_holidays) AS INTEGER) AS is_holiday,
  CASE WHEN month(ts) IN (12, 1, 2) THEN 'Winter' WHEN month(ts) BETWEEN 3 AND 5 THEN 'Spring'
       WHEN month(ts) BETWEEN 6 AND 8 THEN 'Summer' ELSE 'Fall' END AS season, """
        + _CIRCLE.format(ts="ts")
        + " FROM events",
    ),
    "holidays": (
        holidays,
        "WITH "
        + _HOLIDAYS
        + """
SELECT h.holiday_date, h.name, count(o.o_orderkey) AS orders
FROM all_holidays h LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) = h.holiday_date
WHERE year(h.holiday_date) BETWEEN (SELECT min(year(o_orderdate)) FROM orders)
  AND (SELECT max(year(o_orderdate)) FROM orders)
GROUP BY 1, 2""",
    ),
    "holiday_flag": (holiday_flag, _HOLIDAY_FLAG),
    "holiday_flag_calendar": (holiday_flag_calendar, _HOLIDAY_FLAG),
    "label_encode": (
        label_encode,
        "SELECT p_partkey, p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS code FROM part",
    ),
    "label_encode_text": (
        label_encode_text,
        """SELECT c_custkey, c_nationkey,
  CAST(dense_rank() OVER (ORDER BY CAST(c_nationkey AS VARCHAR)) - 1 AS INTEGER) AS code FROM customer""",
    ),
    "label_mapping": (
        label_mapping,
        """SELECT DISTINCT p_name AS value,
  CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS code FROM part""",
    ),
    "keyword_flag": (
        keyword_flag,
        WITH_RAW
        + """SELECT id, loc, CAST(coalesce(contains(upper(loc), 'STREET') OR contains(upper(loc), 'SIDEWALK')
  OR contains(upper(loc), 'DEPARTMENT STORE') OR contains(upper(loc), 'RESTAURANT')
  OR contains(upper(loc), 'GROCERY STORE') OR contains(upper(loc), 'GAS STATION'), false) AS INTEGER)
  AS is_crowded FROM raw_incidents""",
    ),
    "temporal_split": (
        temporal_split,
        """SELECT o_orderkey, CASE WHEN year(o_orderdate) <= 1998 THEN 'train' WHEN year(o_orderdate) = 1999
  THEN 'validation' WHEN year(o_orderdate) = 2000 THEN 'test' END AS split FROM orders""",
    ),
    "feature_matrix": (
        feature_matrix,
        WITH_CLEANED
        + "SELECT id, "
        + _CALENDAR.format(ts="ts")
        + ", "
        + _CIRCLE.format(ts="ts")
        + """, lat, lon,
  CAST(regexp_matches(loc, 'STREET|SIDEWALK|DEPARTMENT STORE|RESTAURANT|GROCERY STORE|GAS STATION') AS INTEGER)
    AS is_crowded,
  CAST(dense_rank() OVER (ORDER BY CAST(ward AS VARCHAR)) - 1 AS INTEGER) AS area_enc,
  CAST(dense_rank() OVER (ORDER BY type) - 1 AS INTEGER) AS type_label
FROM cleaned""",
    ),
    "feature_scores": (feature_scores, WITH_CLEANED + _FEATURE_SCORES + "SELECT feature, round(mi, 9) AS mi FROM scores"),
    "selected_matrix": (
        selected_matrix,
        WITH_CLEANED
        + """SELECT CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(dense_rank() OVER (ORDER BY type) - 1 AS INTEGER) AS type_label FROM cleaned""",
    ),
    "quarantined_lines": (
        quarantined,
        """SELECT 'too many fields' AS reason, o_orderkey || ',"status' || chr(10) || o_orderstatus || '",x,y' AS text FROM orders WHERE o_orderkey % 11 = 0
        UNION ALL SELECT 'accepted ' || count(*), 'status' || chr(10) || o_orderstatus FROM orders WHERE o_orderkey % 11 <> 0 GROUP BY o_orderstatus""",
    ),
    "quoted_newlines": (quoted_newlines, "SELECT doc_id, lang, coalesce(text, '') AS text FROM documents"),
    "first_arrival": (
        first_arrival,
        "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey",
    ),
    "bad_lines": (
        bad_lines,
        """SELECT count(*) FILTER (o_orderkey % 7 = 0) AS bad_lines, count(*) FILTER (o_orderkey % 7 <> 0) AS warn_rows,
  count(*) AS keep_rows, CAST(sum(o_orderkey) AS BIGINT) AS keep_sum FROM orders""",
    ),
    "fixed_sample": (
        fixed_sample,
        "SELECT * FROM events ORDER BY md5('42:' || event_id), event_id LIMIT 2000",
    ),
    "mi_plugin": (mi_plugin, _PLUGIN + "SELECT feature, round(greatest(mi, 0), 9) AS mi FROM scores"),
    "mi_knn": (
        mi_knn,
        """WITH spread AS (SELECT stddev_pop(value) AS s, avg(abs(value)) AS a FROM events),
points AS (
  SELECT event_id, event_type AS y,
    value / s + 1e-10 * greatest(1.0, a / s)
      * (('0x' || substr(md5('value:' || event_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE - 0.5::DOUBLE) AS x,
    count(*) OVER (PARTITION BY event_type) AS n_c
  FROM events, spread
),
kept AS (SELECT * FROM points WHERE n_c > 1),
gaps AS (
  SELECT event_id, x, n_c, least(3, n_c - 1) AS k_i, list_sort([d FOR d IN [
    x - lag(x, 1) OVER w, x - lag(x, 2) OVER w, x - lag(x, 3) OVER w,
    lead(x, 1) OVER w - x, lead(x, 2) OVER w - x, lead(x, 3) OVER w - x] IF d IS NOT NULL]) AS near
  FROM kept WINDOW w AS (PARTITION BY y ORDER BY x, event_id)
),
radii AS (SELECT event_id, x, n_c, k_i, near[k_i] * (1 - 1e-12::DOUBLE) AS r FROM gaps),
counted AS (
  SELECT a.event_id, any_value(a.n_c) AS n_c, any_value(a.k_i) AS k_i, count(*) AS m_i
  FROM radii a JOIN kept b ON b.x > a.x - a.r AND b.x < a.x + a.r GROUP BY a.event_id
),
psi AS (
  SELECT n, coalesce(sum(1.0::DOUBLE / n) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    - 0.57721566490153286061::DOUBLE AS v
  FROM (SELECT unnest(range(1, (SELECT count(*) + 1 FROM kept))) AS n)
)
SELECT 'value' AS feature,
  round(greatest(0, (SELECT v FROM psi WHERE n = (SELECT count(*) FROM kept)) + avg(pk.v) - avg(pc.v) - avg(pm.v)), 9)
    AS mi
FROM counted c JOIN psi pk ON pk.n = c.k_i JOIN psi pc ON pc.n = c.n_c JOIN psi pm ON pm.n = c.m_i""",
    ),
    "select_features": (
        select_features,
        _PLUGIN + "SELECT feature, round(mi, 9) AS mi FROM scores WHERE mi > 0.0012",
    ),
    "validate_report": (
        validate_report,
        WITH_CLEANED
        + """, results(rule, failures) AS (
  SELECT 'schema', 1::BIGINT
  UNION ALL SELECT 'not_null:ts', count(*) FILTER (ts IS NULL) FROM cleaned
  UNION ALL SELECT 'not_null:type', count(*) FILTER (type IS NULL) FROM cleaned
  UNION ALL SELECT 'not_null:arrest', count(*) FILTER (arrest IS NULL) FROM cleaned
  UNION ALL SELECT 'in_range:lat', count(*) FILTER (NOT lat BETWEEN 41.60 AND 42.05) FROM cleaned
  UNION ALL SELECT 'in_range:lon', count(*) FILTER (NOT lon BETWEEN -88.00 AND -87.50) FROM cleaned
  UNION ALL SELECT 'in_range:ward', count(*) FILTER (NOT ward BETWEEN 1 AND 50) FROM cleaned
  UNION ALL SELECT 'classes:type', greatest(5 - count(DISTINCT type), 0) FROM cleaned
)
SELECT rule, failures, failures = 0 AS passed FROM results""",
    ),
    "validate_verdict": (
        validate_verdict,
        WITH_CLEANED
        + """, results(failures) AS (
  SELECT 1::BIGINT
  UNION ALL SELECT count(*) FILTER (ts IS NULL) FROM cleaned
  UNION ALL SELECT count(*) FILTER (type IS NULL) FROM cleaned
  UNION ALL SELECT count(*) FILTER (arrest IS NULL) FROM cleaned
  UNION ALL SELECT count(*) FILTER (NOT lat BETWEEN 41.60 AND 42.05) FROM cleaned
  UNION ALL SELECT count(*) FILTER (NOT lon BETWEEN -88.00 AND -87.50) FROM cleaned
  UNION ALL SELECT count(*) FILTER (NOT ward BETWEEN 1 AND 50) FROM cleaned
  UNION ALL SELECT greatest(5 - count(DISTINCT type), 0) FROM cleaned
)
SELECT count(*) AS rules, count(*) FILTER (failures > 0) AS failed, bool_and(failures = 0) AS passed FROM results""",
    ),
    "delimited_round_trip": (delimited_round_trip, WITH_RAW + "SELECT * FROM raw_incidents"),
    "latest_landed": (
        latest_landed,
        """SELECT o_orderstatus, count(*) AS row_count, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_orderstatus""",
    ),
    "published_tables": (
        published_tables,
        """SELECT 'orders' AS name, count(*) AS row_count, round(sum(o_totalprice), 2) AS total FROM orders
UNION ALL SELECT 'customers', count(*), round(sum(c_acctbal), 2) FROM customer""",
    ),
    "document_round_trip": (document_round_trip, LINEITEM_PROFILE),
    "manifest": (
        manifest,
        WITH_RAW
        + ", print AS ("
        + fingerprint_sql("raw_incidents", [], COLUMNS)
        + f""")
SELECT 'incidents' AS dataset_name, 'v1.0' AS version, '2026-01-02' AS ingestion_date, 'batch' AS ingestion_mode,
  'raw/incidents' AS raw_path, fingerprint AS checksum, row_count, CAST({len(COLUMNS)} AS BIGINT) AS column_count,
  '{",".join(COLUMNS)}' AS columns, 'raw' AS raw_zone FROM print""",
    ),
    "published_validation": (
        published_validation,
        WITH_CLEANED
        + """, results(rule, failures) AS (
  SELECT 'schema:cleaned', 1::BIGINT
  UNION ALL SELECT 'schema:features', 0
  UNION ALL SELECT 'not_null:type', count(*) FILTER (type IS NULL) FROM cleaned
  UNION ALL SELECT 'in_range:ward', count(*) FILTER (NOT ward BETWEEN 1 AND 50) FROM cleaned
  UNION ALL SELECT 'classes:type_label', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM cleaned
  UNION ALL SELECT 'zone:published', 0 UNION ALL SELECT 'zone:nowhere', 1
  UNION ALL SELECT 'files:published', 1
  UNION ALL SELECT 'document:etl_report', 0 UNION ALL SELECT 'document:absent', 1
)
SELECT rule, failures, failures = 0 AS passed FROM results""",
    ),
    "zone_inventory": (
        zone_inventory,
        """SELECT 'zone' AS zone, 'statuses.txt' AS filename, 'ok' AS status, CAST(sum(strlen(o_orderstatus || ' ' || n) + 1) AS BIGINT) AS size_bytes
        FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)
        UNION ALL SELECT 'zone', 'absent.txt', 'missing', NULL UNION ALL SELECT 'nowhere', 'statuses.txt', 'missing', NULL""",
    ),
    "document_sizes": (
        document_sizes,
        """SELECT count(*) AS stages_count, (SELECT count(DISTINCT o_orderstatus) FROM orders) AS categories_count,
  (SELECT count(*) FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders)) AS categories_total
FROM (SELECT DISTINCT o_orderpriority FROM orders)""",
    ),
}
