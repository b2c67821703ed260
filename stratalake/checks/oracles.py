"""For each query, SQL over the same tables for another engine."""

from __future__ import annotations

_TRIPS = """
trips AS (
  SELECT l_suppkey AS vendorid,
         CASE WHEN l_orderkey % 17 = 0 THEN 'bad'
              ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS tpep_pickup_datetime,
         strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS tpep_dropoff_datetime,
         CASE WHEN l_orderkey % 13 = 0 THEN 'x' ELSE cast(l_linenumber AS varchar) || '.0' END AS passenger_count,
         cast(l_quantity AS varchar) AS trip_distance,
         CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_returnflag END AS payment_type,
         l_extendedprice AS total_amount,
         l_linestatus AS source_file,
         l_orderkey, l_partkey, l_linenumber
  FROM lineitem
),
typed AS (
  SELECT * REPLACE (cast(trunc(try_cast(passenger_count AS double)) AS int) AS passenger_count,
                    try_cast(trip_distance AS double) AS trip_distance),
         try_cast(tpep_pickup_datetime AS timestamp) AS p,
         try_cast(tpep_dropoff_datetime AS timestamp) AS d
  FROM trips
),
dated AS (
  SELECT *,
         strftime(p, '%Y-%m-%d %H:%M:%S') AS pickup_ts,
         strftime(d, '%Y-%m-%d %H:%M:%S') AS dropoff_ts,
         strftime(p, '%Y-%m-%d') AS ingestion_date,
         cast(year(p) AS int) AS "year",
         cast(month(p) AS int) AS "month"
  FROM typed
),
valid AS (SELECT * FROM dated WHERE p IS NOT NULL AND d IS NOT NULL),
per_file AS (
  SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY vendorid, p, d, source_file
                             ORDER BY total_amount, l_orderkey, l_partkey, l_linenumber, trip_distance) = 1
),
per_trip AS (
  SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY vendorid, p, d
                             ORDER BY total_amount, l_orderkey, l_partkey, l_linenumber, trip_distance) = 1
),
target AS (SELECT * FROM per_file WHERE source_file = 'F'),
source AS (SELECT * FROM per_file WHERE source_file = 'O'),
merged AS (
  SELECT * FROM source
  UNION ALL
  SELECT t.* FROM target t ANTI JOIN source s ON t.vendorid = s.vendorid AND t.p = s.p AND t.d = s.d
)
"""

_RAW = (
    "vendorid, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, payment_type, total_amount"
)
_SILVER = (
    "vendorid, pickup_ts, dropoff_ts, passenger_count, trip_distance, payment_type, total_amount, "
    'ingestion_date, "year", "month", l_orderkey, l_partkey, l_linenumber'
)


def _select(body: str) -> str:
    return f"WITH {_TRIPS} {body}"


def _corrected(rows: str) -> str:
    """Trips after the corrections: those named get another amount, and come once more for a new vendor."""
    named = "l_linenumber = 7 AND trip_distance = 50"
    return (
        f"SELECT {_SILVER}, source_file FROM (SELECT * REPLACE (CASE WHEN {named} THEN total_amount + 1 ELSE total_amount END "
        f"AS total_amount) FROM {rows} UNION ALL "
        f"SELECT * REPLACE (vendorid + 1000000 AS vendorid, total_amount + 1 AS total_amount) FROM {rows} WHERE {named})"
    )


def _moved(rows: str) -> str:
    """A further table of trips after the corrections, which also have another payment type."""
    named = "l_linenumber = 7 AND trip_distance = 50"
    replaced = "'M' AS payment_type, total_amount + 1 AS total_amount"
    return (
        f", moved AS (SELECT * FROM {rows} WHERE NOT ({named}) UNION ALL SELECT * REPLACE ({replaced}) FROM {rows} WHERE {named} "
        f"UNION ALL SELECT * REPLACE (vendorid + 1000000 AS vendorid, {replaced}) FROM {rows} WHERE {named})"
    )


def _summary(rows: str) -> str:
    return (
        'SELECT "year", "month", payment_type, count(*) AS total_trips, '
        "cast(sum(try_cast(total_amount AS decimal(18,2))) AS double) AS total_amount_collected "
        f'FROM {rows} GROUP BY "year", "month", payment_type'
    )


_BRONZE_DATES = 'ingestion_date AS pickup_date, "year", "month"'
_DATED_RAW = f"""
  SELECT t.vendorid, t.tpep_pickup_datetime, t.tpep_dropoff_datetime, t.passenger_count, t.trip_distance,
         t.payment_type, t.total_amount, t.source_file, d.ingestion_date, d."year", d."month"
  FROM (SELECT *, try_cast(tpep_pickup_datetime AS timestamp) AS p FROM trips) t,
       LATERAL (SELECT strftime(t.p, '%Y-%m-%d') AS ingestion_date,
                       cast(year(t.p) AS int) AS "year", cast(month(t.p) AS int) AS "month") d
"""

# Columns of the registered Silver table.
_CATALOG = [
    ("vendorid", "bigint", 0),
    ("tpep_pickup_datetime", "string", 0),
    ("tpep_dropoff_datetime", "string", 0),
    ("passenger_count", "int", 0),
    ("trip_distance", "double", 0),
    ("payment_type", "string", 0),
    ("total_amount", "double", 0),
    ("source_file", "string", 0),
    ("l_orderkey", "bigint", 0),
    ("l_partkey", "bigint", 0),
    ("l_linenumber", "int", 0),
    ("pickup_ts", "timestamp", 0),
    ("dropoff_ts", "timestamp", 0),
    ("ingestion_date", "string", 0),
    ("year", "int", 1),
    ("month", "int", 1),
]


def _catalog() -> str:
    values = ", ".join(f"({i}, '{n}', '{t}', {p})" for i, (n, t, p) in enumerate(_CATALOG, start=1))
    return (
        'SELECT (SELECT count(*) FROM per_file) AS table_rows, "position", column_name, column_type, is_partition '
        f'FROM (VALUES {values}) AS c("position", column_name, column_type, is_partition)'
    )


ORACLES: dict[str, str] = {
    "gold_aggregate": _select(_summary("per_file")),
    "csv_scan": _select(f"SELECT {_RAW} FROM trips"),
    "csv_rescue": _select(
        "SELECT * EXCLUDE (wrong, l_partkey) REPLACE (CASE WHEN wrong = 5 THEN NULL ELSE vendorid END AS vendorid, "
        "CASE WHEN wrong = 4 THEN NULL ELSE total_amount END AS total_amount, "
        "CASE WHEN wrong = 6 THEN NULL ELSE l_linenumber END AS l_linenumber), "
        "CASE WHEN wrong >= 4 THEN concat_ws(',', CASE WHEN wrong = 5 THEN 'x' ELSE '' END || vendorid, tpep_pickup_datetime, "
        "tpep_dropoff_datetime, passenger_count, trip_distance, coalesce(payment_type, ''), "
        "CASE WHEN wrong = 4 THEN 'n/a' ELSE total_amount::varchar END, l_orderkey, l_partkey, "
        "CASE WHEN wrong = 6 THEN NULL ELSE l_linenumber END, CASE WHEN wrong = 7 THEN 'more' END) END AS rescued_record, "
        "CASE WHEN wrong < 4 OR wrong IS NULL THEN NULL WHEN tpep_pickup_datetime = 'bad' THEN 'pickup not a timestamp' "
        "ELSE 'record does not fit its columns' END AS reject_reason "
        f"FROM (SELECT {_RAW}, l_orderkey, l_partkey, l_linenumber, CASE WHEN trip_distance::double = 50 THEN l_linenumber END AS wrong "
        "FROM trips)"
    ),
    "table_scan": _select(f'SELECT {_RAW}, source_file, "year", "month" FROM ({_DATED_RAW})'),
    "bronze_enrich": _select(f"SELECT {_RAW}, source_file AS source_label, {_BRONZE_DATES} FROM ({_DATED_RAW})"),
    "lineage_columns": _select(
        "SELECT vendorid, l_orderkey, l_linenumber, source_file AS source_label, 1 AS has_file_time FROM trips"
    ),
    "parse_timestamps": _select("SELECT tpep_pickup_datetime, tpep_dropoff_datetime, pickup_ts, dropoff_ts FROM dated"),
    "date_parts": _select(
        f"SELECT tpep_pickup_datetime, {_BRONZE_DATES}, "
        "cast(year(d) AS int) AS dropoff_year, cast(month(d) AS int) AS dropoff_month FROM dated"
    ),
    "format_timestamps": _select("SELECT tpep_pickup_datetime, pickup_ts, ingestion_date FROM dated"),
    "cast_numeric": _select(
        "SELECT passenger_count AS passenger_text, trip_distance AS distance_text, "
        "cast(trunc(try_cast(passenger_count AS double)) AS int) AS passenger_count, "
        "try_cast(trip_distance AS double) AS trip_distance, "
        "-l_linenumber AS truncated, "
        "cast(try_cast(total_amount AS decimal(18,2)) AS double) AS amount FROM trips"
    ),
    "valid_dates_filter": _select("SELECT vendorid, pickup_ts, dropoff_ts, source_file, l_orderkey FROM valid"),
    "quarantine_rejects": _select(
        f"SELECT {_RAW}, source_file, 'pickup not a timestamp' AS reject_reason FROM trips "
        "WHERE try_cast(tpep_pickup_datetime AS timestamp) IS NULL"
    ),
    "dedup_subset": _select("SELECT DISTINCT vendorid, pickup_ts, dropoff_ts, source_file FROM valid"),
    "dedup_deterministic": _select(f"SELECT {_SILVER}, source_file FROM per_file"),
    "merge_key_conflicts": _select(
        "SELECT vendorid, pickup_ts, dropoff_ts, count(*) AS source_rows FROM per_file "
        "GROUP BY vendorid, pickup_ts, dropoff_ts HAVING count(*) > 1"
    ),
    "silver_clean": _select(f"SELECT {_SILVER}, source_file FROM per_trip"),
    "silver_upsert": _select(f"SELECT {_SILVER}, source_file FROM merged"),
    "upsert_touched_files": _select(_corrected("per_trip")),
    "bucketed_upsert": _select(f"SELECT {_SILVER}, source_file FROM merged"),
    "upsert_by_location": _select(_corrected("merged")),
    "merge_frames": _select(f"SELECT {_SILVER}, source_file FROM merged"),
    "merge_matched_update": _select(
        f"SELECT {_SILVER}, source_file FROM source s "
        "SEMI JOIN target t ON t.vendorid = s.vendorid AND t.p = s.p AND t.d = s.d"
    ),
    "merge_not_matched_insert": _select(
        f"SELECT {_SILVER}, source_file FROM source s "
        "ANTI JOIN target t ON t.vendorid = s.vendorid AND t.p = s.p AND t.d = s.d"
    ),
    "merge_target_retained": _select(f"SELECT {_SILVER}, source_file FROM merged WHERE source_file = 'F'"),
    "gold_upsert": _select(
        f"{_summary('per_file')} UNION ALL SELECT * FROM ({_summary('per_file')}) WHERE payment_type IS NULL"
    ),
    "gold_upsert_nullsafe": _select(_summary("per_file")),
    # doubles of 256 and more are whole numbers of 2^-44; the sum is rounded once, as its two halves are added
    "gold_exact_sum": _select(
        'SELECT "year", "month", payment_type, total_trips, (units // 17592186044416)::double '
        "+ (units % 17592186044416)::double / 17592186044416 AS total_amount_collected FROM ("
        'SELECT "year", "month", payment_type, count(*) AS total_trips, sum((total_amount / 3 * 17592186044416)::hugeint) AS units '
        'FROM per_file GROUP BY "year", "month", payment_type)'
    ),
    "gold_delta_refresh": _select(
        f"{_moved('merged')} {_summary('moved')}"
    ),
    "preview_limit": _select(
        f"SELECT * FROM ({_summary('per_file')}) WHERE payment_type IS NOT NULL "
        'ORDER BY "year", "month", payment_type LIMIT 5'
    ),
    "partitioned_overwrite": _select(f"SELECT {_SILVER}, source_file FROM per_file"),
    "partitioned_append": _select(
        f'SELECT {_RAW}, source_file, "year", "month" FROM ({_DATED_RAW}) '
        f'UNION ALL SELECT {_RAW}, source_file, "year", "month" FROM ({_DATED_RAW})'
    ),
    "append_new_column": _select(
        f'SELECT {_RAW}, source_file, l_linenumber::bigint AS l_linenumber, "year", "month", '
        "CASE WHEN source_file = 'O' THEN upper(payment_type) END AS fare_class FROM (" + _DATED_RAW.replace("t.source_file", "t.source_file, t.l_linenumber") + ")"
    ),
    "upsert_new_column": _select(
        f"SELECT * REPLACE (l_linenumber::bigint AS l_linenumber, CASE WHEN source_file = 'F' THEN l_partkey END AS l_partkey), "
        f"CASE WHEN source_file = 'O' THEN true END AS checked FROM (SELECT {_SILVER}, source_file FROM merged)"
    ),
    "register_external_table": _select(f"SELECT {_SILVER}, source_file FROM per_file"),
    "catalog_schema": _select(_catalog()),
    "row_count_metric": _select(
        "SELECT 'bronze' AS step, count(*) AS \"rows\" FROM trips "
        "UNION ALL SELECT 'silver', count(*) FROM per_trip "
        "UNION ALL SELECT 'quarantine', count(*) FROM dated WHERE p IS NULL OR d IS NULL "
        f"UNION ALL SELECT 'gold', count(*) FROM ({_summary('per_trip')})"
    ),
    "bronze_run": _select(f"SELECT {_RAW}, source_file AS source_label, {_BRONZE_DATES} FROM ({_DATED_RAW})"),
    "silver_run": _select(f"SELECT {_SILVER}, source_file AS source_label FROM per_trip"),
    "gold_run": _select(_summary("per_file")),
    "medallion_end_to_end": _select(_summary("per_trip")),
    "incremental_ingest": _select(
        f'SELECT {_RAW}, source_file AS source_label, "year", "month" FROM ({_DATED_RAW})'
    ),
    "incremental_bronze_table": _select(
        "SELECT *, CASE WHEN source_label = 'F' THEN 0 ELSE 1 END AS batch FROM "
        f'(SELECT {_RAW}, source_file AS source_label, "year", "month" FROM ({_DATED_RAW}))'
    ),
    "incremental_metrics": _select(
        "SELECT 'bronze' AS step, count(*) AS \"rows\" FROM trips "
        "UNION ALL SELECT 'silver', count(*) FROM per_file "
        "UNION ALL SELECT 'quarantine', count(*) FROM dated WHERE p IS NULL OR d IS NULL "
        f"UNION ALL SELECT 'gold', (SELECT count(*) FROM ({_summary('target')})) + (SELECT count(*) FROM ({_summary('merged')}) "
        'WHERE ("year", "month") IN (SELECT ("year", "month") FROM source))'
    ),
    "incremental_dedup": _select(
        "SELECT DISTINCT vendorid, pickup_ts, dropoff_ts, (SELECT count(*) FROM per_trip) AS rows_merged, "
        "0::bigint AS rows_late FROM valid"
    ),
    "incremental_upsert": _select(f"SELECT {_SILVER}, source_file AS source_label FROM merged"),
    "incremental_refresh": _select(_summary("merged")),
}
