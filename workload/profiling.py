"""Integrity, profile and exploration queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators import explore, integrity, profile, summaries
from sievework.plans.catalog import annotation_table
from sievework.scratch import fresh_path, written
from sievework.sources.tables import head_sample
from workload.cleaning import _cleaned
from workload.incidents import WITH_CLEANED, table

_EXPECTED_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_clerk"]

_LINEITEM_NOTES = [
    ("l_orderkey", "int64", False, "both", "identifier", None, "order of the line"),
    ("l_partkey", "int64", False, "both", "identifier", None),
    ("l_suppkey", "int64", False, "both", "identifier", None),
    ("l_linenumber", "int32", False, "both", "identifier", None),
    ("l_quantity", "float64", False, "both", "feature", None),
    ("l_extendedprice", "float64", False, "both", "feature", None),
    ("l_discount", "float64", False, "both", "feature_candidate", None),
    ("l_tax", "float64", False, "both", "feature_candidate", None),
    ("l_returnflag", "string", False, "both", "target", None),
    ("l_linestatus", "string", False, "both", "excluded", None),
    ("l_shipdate", "datetime64[ns]", False, "both", "feature_source", None),
    ("l_comment", "string", True, "raw", "descriptive", "not delivered"),
]


def schema_check(spark: SparkSession, sf: str) -> DataFrame:
    """Expected columns of orders, with the number of values each present column holds."""
    orders = table(spark, sf, "orders")
    values = orders.agg(*[F.count(c).alias(c) for c in orders.columns]).unpivot(
        [], orders.columns, "column_name", "value_count"
    )
    return profile.schema_check(orders, _EXPECTED_ORDERS).join(values, "column_name", "left")


def profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_columns(table(spark, sf, "lineitem")).drop("inferred_type")


def profile_booleans(spark: SparkSession, sf: str) -> DataFrame:
    """Booleans have a range of 0 to 1; text has none."""
    orders = table(spark, sf, "orders").select(
        (F.col("o_totalprice") > 150000).alias("is_large"), "o_orderpriority"
    )
    return profile.profile_columns(orders)


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    profiled = profile.profile_columns(table(spark, sf, "lineitem"))
    return profile.column_catalog(profiled, annotation_table(spark, _LINEITEM_NOTES))


def column_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return _catalog(spark, sf).drop("inferred_type")


def roles(spark: SparkSession, sf: str) -> DataFrame:
    catalog = _catalog(spark, sf)
    distinct = catalog.groupBy("role").agg(F.sum("distinct_count").alias("distinct_total"))
    return profile.roles_summary(catalog).join(distinct, "role")


def excluded_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Line items without the columns a model must not see."""
    return profile.drop_by_role(table(spark, sf, "lineitem"), _LINEITEM_NOTES, "excluded")


def table_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.table_fingerprint(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"]
    )


def text_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.table_fingerprint(table(spark, sf, "documents"), ["doc_id", "text"])


def shape(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_shape(table(spark, sf, "orders"))


def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_count(table(spark, sf, "part"), "p_type")


def sample_values(spark: SparkSession, sf: str) -> DataFrame:
    return profile.sample_values(table(spark, sf, "orders"), "o_orderdate", 5, ["o_orderkey"])


def head_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    return head_sample(table(spark, sf, "orders"), 1200, ["o_orderkey"])


def head_of_customers(spark: SparkSession, sf: str) -> DataFrame:
    return head_sample(table(spark, sf, "customer"), 1100, ["c_name", "c_custkey"])


def year_counts(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))
    return profile.value_counts(orders, "year", sort="key")


def topk_types(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(table(spark, sf, "part"), "p_type", 10)


def topk_sources(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_counts(table(spark, sf, "documents"), "source", 15)


_SUMMARISED = ["o_custkey", "o_totalprice", "o_orderstatus"]


def merged_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed as two versions, each with its stored summary; the profile of both comes from the summaries.

    Estimates are held against the rows: distinct counts within 4 %, quartiles within 3 % of the rows.
    """
    orders, root = table(spark, sf, "orders").select("o_orderkey", *_SUMMARISED), fresh_path(spark, "summaries")
    for i in range(2):
        summaries.save_summary(orders.filter(F.col("o_orderkey") % 2 == i).select(*_SUMMARISED), root, f"v{i}", "2026-01-01")
    found = summaries.estimates(summaries.merged(summaries.read_summaries(spark, root)))
    rows = orders.unpivot([], [F.col(c).cast("string").alias(c) for c in _SUMMARISED], "column_name", "text")
    checked = rows.join(F.broadcast(found.select("column_name", "quantiles")), "column_name").groupBy("column_name").agg(
        F.count_distinct("text").alias("distinct_true"), *[F.avg((F.expr("try_cast(text AS double)") <= F.get("quantiles", F.lit(i))).cast("int")).alias(f"rank{i}") for i in range(3)]
    )
    near = lambda i: F.coalesce(F.abs(F.col(f"rank{i}") - 0.25 * (i + 1)) <= 0.03, F.lit(True))
    return found.join(checked, "column_name").select(
        "column_name",
        "row_count",
        "null_count",
        "min_value",
        "max_value",
        (F.abs(F.col("distinct_count") - F.col("distinct_true")) <= 0.04 * F.col("distinct_true")).alias("distinct_near"),
        (near(0) & near(1) & near(2)).alias("quartiles_near"),
    )


def topk_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The parts most often ordered: very many values, none of them frequent."""
    return profile.top_values(table(spark, sf, "lineitem"), "l_partkey", 25)


def topk_words(spark: SparkSession, sf: str) -> DataFrame:
    """The most frequent words of all documents: very many values, a few of them very frequent."""
    words = table(spark, sf, "documents").select(F.explode(F.split("text", "[ \n]+")).alias("word")).where("word <> ''")
    return profile.top_values(words, "word", 30)


def hour_counts(spark: SparkSession, sf: str) -> DataFrame:
    return explore.temporal_counts(table(spark, sf, "events"), "ts", "hour")


def weekday_counts(spark: SparkSession, sf: str) -> DataFrame:
    return explore.temporal_counts(table(spark, sf, "events"), "ts", "weekday")


def month_counts(spark: SparkSession, sf: str) -> DataFrame:
    return explore.temporal_counts(table(spark, sf, "orders"), "o_orderdate", "month")


def year_trend(spark: SparkSession, sf: str) -> DataFrame:
    return explore.temporal_counts(table(spark, sf, "orders"), "o_orderdate", "year")


def top_k_subset(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "source")
    return explore.filter_top_k(documents, "source", 5)


def spatial_grid(spark: SparkSession, sf: str) -> DataFrame:
    return explore.spatial_grid(_cleaned(spark, sf), "lat", "lon", "type", 0.01)


def corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    matrix = explore.correlation_matrix(
        table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    )
    return matrix.withColumn("r", F.round("r", 9))


def box_stats(spark: SparkSession, sf: str) -> DataFrame:
    boxes = explore.box_stats(table(spark, sf, "events").select("value", "user_id"), ["value", "user_id"])
    return boxes.select(
        "column_name",
        *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
        "outliers",
    )


#: Ten numbers of an order line.
_MEASURES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "each", "share"]
_MEASURES_SQL = "(SELECT *, l_extendedprice / l_quantity AS each, l_discount * l_quantity AS share FROM lineitem)"


def box_stats_many(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes of ten columns, fitted together; the columns made here are written first, as they are scanned several times."""
    lines = table(spark, sf, "lineitem").withColumn("each", F.col("l_extendedprice") / F.col("l_quantity")).withColumn("share", F.col("l_discount") * F.col("l_quantity"))
    boxes = explore.box_stats(written(lines.select(*_MEASURES), "measures"), _MEASURES)
    return boxes.select("column_name", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "outliers")


def _box_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median,
  round(any_value(q3), 6) AS q3,
  round(min(CASE WHEN {c} BETWEEN low AND high THEN CAST({c} AS DOUBLE) END), 6) AS whisker_low,
  round(max(CASE WHEN {c} BETWEEN low AND high THEN CAST({c} AS DOUBLE) END), 6) AS whisker_high,
  count(*) FILTER (NOT {c} BETWEEN low AND high) AS outliers
FROM {source} AS rows_, (
  SELECT q1, q2, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (
    SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q2, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3
    FROM {source} AS of_all))"""
        for c in columns
    )


def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    balance = explore.class_balance(table(spark, sf, "events"), "event_type")
    return balance.withColumns({c: F.round(c, 9) for c in ("share", "imbalance")})


def _profile_sql(name: str, columns: dict[str, bool]) -> str:
    """One SELECT per column; the flag tells whether the column has a range."""
    parts = []
    for column, ranged in columns.items():
        low = f"CAST(min({column}) AS DOUBLE)" if ranged else "NULL::DOUBLE"
        high = f"CAST(max({column}) AS DOUBLE)" if ranged else "NULL::DOUBLE"
        parts.append(
            f"SELECT '{column}' AS column_name, count(*) FILTER ({column} IS NULL) AS null_count, "
            f"count(DISTINCT {column}) AS distinct_count, {low} AS min_value, {high} AS max_value FROM {name}"
        )
    return " UNION ALL ".join(parts)


LINEITEM_PROFILE = _profile_sql(
    "lineitem",
    {
        "l_orderkey": True,
        "l_partkey": True,
        "l_suppkey": True,
        "l_linenumber": True,
        "l_quantity": True,
        "l_extendedprice": True,
        "l_discount": True,
        "l_tax": True,
        "l_returnflag": False,
        "l_linestatus": False,
        "l_shipdate": False,
    },
)

_NOTES_VALUES = ", ".join(
    "({})".format(", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower() for v in row))
    for row in ((*row, *[None] * (7 - len(row))) for row in _LINEITEM_NOTES)
)

_CATALOG_SQL = f"""
WITH profiled AS ({LINEITEM_PROFILE}),
notes(column_name, declared_type, nullable, zone, role, notes, description) AS (VALUES {_NOTES_VALUES}),
catalog AS (
  SELECT n.*, p.null_count, p.distinct_count, p.min_value, p.max_value
  FROM notes n LEFT JOIN profiled p ON n.column_name = p.column_name
)"""


def fingerprint_sql(name: str, numbers: list[str], texts: list[str]) -> str:
    fields = [f"coalesce(CAST({c} AS VARCHAR), '-')" for c in numbers]
    fields += [f"coalesce(length({c}) || ':' || {c}, '-')" for c in texts]
    row_hash = f"md5(concat_ws('|', {', '.join(fields)}))"
    words = [f"CAST(sum(('0x' || substr({row_hash}, {8 * i + 1}, 8))::BIGINT) AS VARCHAR)" for i in range(4)]
    return f"SELECT count(*) AS row_count, concat_ws('-', {', '.join(words)}) AS fingerprint FROM {name}"


QUERIES = {
    "schema_check": (
        schema_check,
        """WITH present AS (SELECT column_name FROM (DESCRIBE orders)),
expected(column_name) AS (VALUES ('o_orderkey'), ('o_custkey'), ('o_orderstatus'), ('o_totalprice'),
  ('o_orderdate'), ('o_clerk')),
filled(column_name, value_count) AS (
  SELECT 'o_orderkey', count(o_orderkey) FROM orders
  UNION ALL SELECT 'o_custkey', count(o_custkey) FROM orders
  UNION ALL SELECT 'o_orderstatus', count(o_orderstatus) FROM orders
  UNION ALL SELECT 'o_totalprice', count(o_totalprice) FROM orders
  UNION ALL SELECT 'o_orderdate', count(o_orderdate) FROM orders
  UNION ALL SELECT 'o_orderpriority', count(o_orderpriority) FROM orders
)
SELECT coalesce(p.column_name, e.column_name) AS column_name,
  CASE WHEN p.column_name IS NULL THEN 'missing' WHEN e.column_name IS NULL THEN 'extra' ELSE 'ok' END AS status,
  f.value_count
FROM present p FULL JOIN expected e ON p.column_name = e.column_name
LEFT JOIN filled f ON f.column_name = coalesce(p.column_name, e.column_name)""",
    ),
    "profile_columns": (profile_columns, LINEITEM_PROFILE),
    "profile_booleans": (
        profile_booleans,
        """SELECT 'is_large' AS column_name, 0::BIGINT AS null_count,
  count(DISTINCT o_totalprice > 150000) AS distinct_count, 'boolean' AS inferred_type,
  min(CAST(o_totalprice > 150000 AS INTEGER))::DOUBLE AS min_value,
  max(CAST(o_totalprice > 150000 AS INTEGER))::DOUBLE AS max_value FROM orders
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (o_orderpriority IS NULL),
  count(DISTINCT o_orderpriority), 'string', NULL, NULL FROM orders""",
    ),
    "column_catalog": (column_catalog, _CATALOG_SQL + " SELECT * FROM catalog"),
    "roles": (
        roles,
        _CATALOG_SQL
        + """ SELECT role, count(*) AS column_count,
  string_agg(column_name, ',' ORDER BY column_name) AS columns,
  CAST(sum(distinct_count) AS BIGINT) AS distinct_total FROM catalog GROUP BY role""",
    ),
    "excluded_columns": (excluded_columns, "SELECT * EXCLUDE (l_linestatus) FROM lineitem"),
    "table_fingerprint": (
        table_fingerprint,
        fingerprint_sql("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], ["l_returnflag"]),
    ),
    "text_fingerprint": (text_fingerprint, fingerprint_sql("documents", ["doc_id"], ["text"])),
    "shape": (shape, "SELECT count(*) AS row_count, 6::BIGINT AS column_count FROM orders"),
    "distinct_counts": (distinct_counts, "SELECT count(DISTINCT p_type) AS distinct_count FROM part"),
    "sample_values": (
        sample_values,
        "SELECT o_orderkey, o_orderdate AS value FROM orders WHERE o_orderdate IS NOT NULL ORDER BY 1 LIMIT 5",
    ),
    "head_of_orders": (head_of_orders, "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1200"),
    "head_of_customers": (head_of_customers, "SELECT * FROM customer ORDER BY c_name, c_custkey LIMIT 1100"),
    "year_counts": (
        year_counts,
        "SELECT CAST(year(o_orderdate) AS INTEGER) AS value, count(*) AS row_count FROM orders GROUP BY 1",
    ),
    "topk_types": (
        topk_types,
        "SELECT p_type AS value, count(*) AS row_count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    ),
    "merged_profile": (
        merged_profile,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
  {f'CAST(min({c}) AS DOUBLE)' if c != 'o_orderstatus' else 'NULL::DOUBLE'} AS min_value,
  {f'CAST(max({c}) AS DOUBLE)' if c != 'o_orderstatus' else 'NULL::DOUBLE'} AS max_value, true AS distinct_near, true AS quartiles_near FROM orders"""
            for c in _SUMMARISED
        ),
    ),
    "topk_parts": (
        topk_parts,
        "SELECT l_partkey AS value, count(*) AS row_count FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25",
    ),
    "topk_words": (
        topk_words,
        """SELECT word AS value, count(*) AS row_count FROM (SELECT unnest(regexp_split_to_array(text, '[ \n]+')) AS word FROM documents)
        WHERE word <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30""",
    ),
    "topk_sources": (
        topk_sources,
        "SELECT source AS value, count(*) AS row_count FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    ),
    "hour_counts": (
        hour_counts,
        "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS row_count FROM events GROUP BY 1",
    ),
    "weekday_counts": (
        weekday_counts,
        "SELECT CAST(isodow(ts) - 1 AS INTEGER) AS weekday, count(*) AS row_count FROM events GROUP BY 1",
    ),
    "month_counts": (
        month_counts,
        "SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS row_count FROM orders GROUP BY 1",
    ),
    "year_trend": (
        year_trend,
        "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS row_count FROM orders GROUP BY 1",
    ),
    "top_k_subset": (
        top_k_subset,
        """SELECT doc_id, source FROM documents WHERE source IN (
  SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 5)""",
    ),
    "spatial_grid": (
        spatial_grid,
        WITH_CLEANED
        + """SELECT CAST(floor(lat / 0.01) AS BIGINT) AS lat_cell, CAST(floor(lon / 0.01) AS BIGINT) AS lon_cell,
  type, count(*) AS row_count FROM cleaned GROUP BY 1, 2, 3""",
    ),
    "corr_matrix": (
        corr_matrix,
        """WITH n(a, x) AS (VALUES (1, 'l_quantity'), (2, 'l_extendedprice'), (3, 'l_discount'), (4, 'l_tax')),
r AS (SELECT [
  [1.0, corr(l_quantity, l_extendedprice), corr(l_quantity, l_discount), corr(l_quantity, l_tax)],
  [corr(l_extendedprice, l_quantity), 1.0, corr(l_extendedprice, l_discount), corr(l_extendedprice, l_tax)],
  [corr(l_discount, l_quantity), corr(l_discount, l_extendedprice), 1.0, corr(l_discount, l_tax)],
  [corr(l_tax, l_quantity), corr(l_tax, l_extendedprice), corr(l_tax, l_discount), 1.0]] AS m FROM lineitem)
SELECT n1.x AS a, n2.x AS b, round(CAST(m[n1.a][n2.a] AS DOUBLE), 9) AS r FROM n n1, n n2, r""",
    ),
    "box_stats": (box_stats, _box_sql("events", ["value", "user_id"])),
    "box_stats_many": (box_stats_many, _box_sql(_MEASURES_SQL, _MEASURES)),
    "class_balance": (
        class_balance,
        """SELECT event_type AS value, count(*) AS row_count,
  round(count(*)::DOUBLE / sum(count(*)) OVER (), 9) AS share,
  round(max(count(*)) OVER ()::DOUBLE / count(*), 9) AS imbalance
FROM events GROUP BY event_type""",
    ),
}
