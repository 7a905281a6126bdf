"""``raw_incidents``: a dirty, all-text incident table derived from every row of ``events``.

Row numbers decide which values are spoilt, so both engines spoil the same ones; every
event is in the table, some of them twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from sievework.operators.clean import Box
from sievework.plans.presets import BUSY_PLACES, FIRST_DAY
from sievework.plans.spec import CleaningSpec, FeatureSpec
from sievework.scratch import written_path

COLUMNS = ["id", "case_no", "ts_txt", "type", "lat", "lon", "arrest", "ward", "loc"]

CLEANING = CleaningSpec(
    key=("case_no",),
    order_by=("CAST(id AS bigint)",),
    critical=("ts_txt", "type", "lat", "lon"),
    timestamp="ts_txt",
    latitude="lat",
    longitude="lon",
    category="type",
    box=Box(41.60, 42.05, -88.00, -87.50),
    first_day=FIRST_DAY,
    as_of=dt.date(2024, 12, 31),
    rare_threshold=20,
    fill_unknown=("loc",),
    longs=("ward",),
    doubles=("lat", "lon"),
    booleans=("arrest",),
    texts=("type", "loc"),
)

FEATURES = FeatureSpec(
    timestamp="ts_txt",
    category="type",
    area="ward",
    place="loc",
    place_keywords=BUSY_PLACES,
    key="id",
    candidates=(
        "hour",
        "day_of_week",
        "month",
        "is_weekend",
        "is_night",
        "hour_sin",
        "hour_cos",
        "lat",
        "lon",
        "is_crowded",
        "area_enc",
    ),
    label="type_label",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_NUMBERED = "CAST(translate(props, '{}\": k', '') AS bigint) AS k"

_TEXT = [
    "CAST(event_id AS string) AS id",
    "CASE WHEN event_id % 97 <> 0 THEN concat('C', user_id, '-', date_format(ts, 'yyyyMMdd')) END AS case_no",
    """CASE WHEN event_id % 251 = 0 THEN '13/45/2024 01:00:00 PM'
            WHEN event_id % 211 = 0 THEN NULL
            ELSE date_format(ts, 'MM/dd/yyyy hh:mm:ss a') END AS ts_txt""",
    """CASE WHEN event_id % 101 = 0 THEN NULL
            WHEN event_id < 30 THEN concat(' Rare', event_id % 3, ' ')
            ELSE concat(' ', event_type) END AS type""",
    """CASE WHEN event_id % 89 <> 0
            THEN concat(lat_n div 1000000, '.', lpad(CAST(lat_n % 1000000 AS string), 6, '0')) END AS lat""",
    "concat('-', lon_n div 1000000, '.', lpad(CAST(lon_n % 1000000 AS string), 6, '0')) AS lon",
    "CASE k % 4 WHEN 0 THEN 'true' WHEN 1 THEN ' FALSE ' WHEN 2 THEN 'False' ELSE 'maybe' END AS arrest",
    "CASE WHEN k % 12 = 0 THEN NULL WHEN k = 5 THEN 'x' ELSE concat(k % 50, '.0') END AS ward",
    """CASE WHEN k % 10 = 0 THEN NULL WHEN k % 5 = 0 THEN 'Street' WHEN k % 5 = 1 THEN 'Apartment'
            WHEN k % 5 = 2 THEN 'small retail restaurant ' ELSE 'RESIDENCE' END AS loc""",
]

#: Landed fixture per application and scale: the input of the queries, like a landed file.
_landed: dict[tuple[str, str], str] = {}


def derive_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incident table as a query over ``events``; copies are whole rows, made last."""
    return (
        table(spark, sf_dir, "events")
        .selectExpr("*", _NUMBERED)
        .selectExpr(
            "*",
            "41590000 + CAST(round(value * 100) AS bigint) * 10 AS lat_n",
            """87650000 + (user_id % 150) * 200
               + CASE WHEN k IN (3, 4) THEN 300000 WHEN k = 6 THEN 400000 ELSE 0 END AS lon_n""",
            "explode(sequence(1, CASE WHEN event_id % 500 = 1 THEN 2 ELSE 1 END)) AS copy",
        )
        .selectExpr(*_TEXT)
    )


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed incident table; it is landed once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    derived = derive_incidents(spark, sf_dir)
    if key not in _landed:
        _landed[key] = written_path(derived, "raw-incidents")
    return spark.read.schema(derived.schema).parquet(_landed[key])


_RAW = r"""
keyed AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events
),
base AS (
  SELECT event_id,
    CAST(event_id AS VARCHAR) AS id,
    CASE WHEN event_id % 97 <> 0 THEN 'C' || user_id || '-' || strftime(ts, '%Y%m%d') END AS case_no,
    CASE WHEN event_id % 251 = 0 THEN '13/45/2024 01:00:00 PM'
         WHEN event_id % 211 = 0 THEN NULL
         ELSE strftime(ts, '%m/%d/%Y %I:%M:%S %p') END AS ts_txt,
    CASE WHEN event_id % 101 = 0 THEN NULL
         WHEN event_id < 30 THEN ' Rare' || (event_id % 3) || ' '
         ELSE ' ' || event_type END AS type,
    41590000 + CAST(round(value * 100) AS BIGINT) * 10 AS lat_n,
    87650000 + (user_id % 150) * 200
      + CASE WHEN k IN (3, 4) THEN 300000 WHEN k = 6 THEN 400000 ELSE 0 END AS lon_n,
    CASE k % 4 WHEN 0 THEN 'true' WHEN 1 THEN ' FALSE ' WHEN 2 THEN 'False' ELSE 'maybe' END AS arrest,
    CASE WHEN k % 12 = 0 THEN NULL WHEN k = 5 THEN 'x' ELSE (k % 50) || '.0' END AS ward,
    CASE WHEN k % 10 = 0 THEN NULL WHEN k % 5 = 0 THEN 'Street' WHEN k % 5 = 1 THEN 'Apartment'
         WHEN k % 5 = 2 THEN 'small retail restaurant ' ELSE 'RESIDENCE' END AS loc
  FROM keyed
),
spelled AS (
  SELECT event_id, id, case_no, ts_txt, type,
    CASE WHEN event_id % 89 <> 0
         THEN (lat_n // 1000000) || '.' || lpad(CAST(lat_n % 1000000 AS VARCHAR), 6, '0') END AS lat,
    '-' || (lon_n // 1000000) || '.' || lpad(CAST(lon_n % 1000000 AS VARCHAR), 6, '0') AS lon,
    arrest, ward, loc
  FROM base
),
raw_incidents AS (
  SELECT * EXCLUDE (event_id) FROM spelled
  UNION ALL
  SELECT * EXCLUDE (event_id) FROM spelled WHERE event_id % 500 = 1
)
"""

#: Casts of one raw row; used on raw rows and inside the cleaning chain.
TYPED_COLUMNS = r"""
    id, case_no,
    try_strptime(ts_txt, '%m/%d/%Y %I:%M:%S %p') AS ts,
    upper(regexp_replace(type, '^\s+|\s+$', '', 'g')) AS type,
    TRY_CAST(lat AS DOUBLE) AS lat,
    TRY_CAST(lon AS DOUBLE) AS lon,
    CASE upper(regexp_replace(arrest, '^\s+|\s+$', '', 'g'))
      WHEN 'TRUE' THEN true WHEN 'FALSE' THEN false END AS arrest,
    coalesce(CAST(trunc(TRY_CAST(ward AS DOUBLE)) AS BIGINT), 0) AS ward,
    upper(regexp_replace(coalesce(loc, 'UNKNOWN'), '^\s+|\s+$', '', 'g')) AS loc
"""

_CHAIN = f"""
distinct_rows AS (SELECT DISTINCT * FROM raw_incidents),
first_rows AS (
  SELECT * FROM distinct_rows
  QUALIFY row_number() OVER (PARTITION BY case_no ORDER BY CAST(id AS BIGINT)) = 1
),
complete AS (
  SELECT * FROM first_rows
  WHERE ts_txt IS NOT NULL AND type IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL
),
typed AS (SELECT {TYPED_COLUMNS} FROM complete),
parsed AS (SELECT * FROM typed WHERE ts IS NOT NULL),
boxed AS (
  SELECT * FROM parsed WHERE lat BETWEEN 41.60 AND 42.05 AND lon BETWEEN -88.00 AND -87.50
),
ranged AS (
  SELECT * FROM boxed WHERE ts BETWEEN TIMESTAMP '2001-01-01' AND TIMESTAMP '2024-12-31'
),
class_sizes AS (SELECT type AS class, count(*) AS size FROM ranged GROUP BY type),
merged AS (
  SELECT r.* REPLACE (CASE WHEN c.size < 20 THEN 'OTHER' ELSE r.type END AS type)
  FROM ranged r JOIN class_sizes c ON r.type = c.class
),
lat_box AS (SELECT quantile_cont(lat, 0.25) AS q1, quantile_cont(lat, 0.75) AS q3 FROM merged),
lat_kept AS (
  SELECT m.* FROM merged m, lat_box b
  WHERE m.lat BETWEEN b.q1 - 1.5 * (b.q3 - b.q1) AND b.q3 + 1.5 * (b.q3 - b.q1)
),
lon_box AS (SELECT quantile_cont(lon, 0.25) AS q1, quantile_cont(lon, 0.75) AS q3 FROM lat_kept),
cleaned AS (
  SELECT m.* FROM lat_kept m, lon_box b
  WHERE m.lon BETWEEN b.q1 - 1.5 * (b.q3 - b.q1) AND b.q3 + 1.5 * (b.q3 - b.q1)
)
"""

#: ``WITH`` prefixes: the raw table alone, and with the whole cleaning chain.
WITH_RAW = "WITH " + _RAW
WITH_CLEANED = "WITH " + _RAW + "," + _CHAIN
