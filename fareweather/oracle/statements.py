"""One DuckDB statement per query name."""

from __future__ import annotations

from .base import with_

SQL: dict[str, str] = {}

FLAGS = (
    "dq_pickup_unparseable", "dq_dropoff_unparseable", "dq_non_positive_duration", "dq_duration_exceeds_24h",
    "dq_pickup_out_of_range", "dq_zero_distance_paid", "dq_implausible_distance", "dq_no_passengers",
    "dq_negative_total", "dq_unknown_zone", "dq_duplicate_row",
)
GAP = (
    "total_amount - (fare_amount + extra + mta_tax + tip_amount + tolls_amount + ifnull(improvement_surcharge, 0)"
    ' + ifnull(congestion_surcharge, 0) + ifnull("Airport_fee", 0))'
)
OFF = f"abs({GAP}) > 0.01 AND total_amount > 0"


# Mean of a two-digit amount, rounded half away from zero, in whole cents.
MEAN_FARE = """sign(sum(CAST(round(total_amount * 100) AS BIGINT)))
  * ((2 * abs(sum(CAST(round(total_amount * 100) AS BIGINT))) + count(*)) // (2 * count(*))) / 100::DOUBLE"""


def sql(name: str, needs: tuple[str, ...], text: str) -> None:
    SQL[name] = (with_(*needs) if needs else "") + text.strip()


def r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


# -- staging and quality
sql("trips_conformed", ("conformed",), "SELECT * FROM conformed")
sql("dedupe_rank", ("ranked",), "SELECT trip_id, dupe_rank FROM ranked")
sql("trips_flagged", ("flagged",), f"SELECT trip_id, duration_seconds, {', '.join(FLAGS)} FROM flagged")
sql("trips_validity", ("staged",),
    "SELECT trip_id, pickup_utc, dropoff_utc, pickup_local, pickup_hour_utc, is_valid FROM staged")
sql("trips_quarantine", ("reasons",),
    "SELECT trip_id, total_amount, failure_reason FROM reasons WHERE failure_reason IS NOT NULL")
sql("dq_rule_counts", ("staged",), " UNION ALL ".join(
    [f"SELECT '{f}' AS rule, count(*) FILTER ({f}) AS rows FROM staged" for f in FLAGS]
    + ["SELECT 'is_valid', count(*) FILTER (is_valid) FROM staged",
       "SELECT 'dq_undetermined', count(*) FILTER (is_valid IS NULL) FROM staged"]))
sql("dq_run_metrics", ("staged",), " UNION ALL ".join(
    f"SELECT '2024-01' AS run_id, '{m}' AS metric, count(*) FILTER ({w}) AS rows FROM staged"
    for m, w in (("rows_in", "true"), ("rows_passed", "is_valid"), ("rows_quarantined", "is_valid IS DISTINCT FROM true"),
                 *((f, f) for f in FLAGS))))
sql("revenue_accounting", ("reasons",), """
SELECT ifnull(failure_reason, 'valid') AS failure_reason, count(*) AS rows, round(sum(total_amount), 2) AS revenue
FROM reasons GROUP BY 1""")
sql("dq_report_header", ("raw_trips", "bronze_weather"), """
SELECT count(*) AS total_rows, min(tpep_pickup_datetime) AS trip_min, max(tpep_pickup_datetime) AS trip_max,
       sum(CASE WHEN CAST(tpep_pickup_datetime AS DATE) BETWEEN '2024-01-02' AND '2024-01-29' THEN 1 ELSE 0 END)::BIGINT
         AS in_month,
       (SELECT count(*) FROM bronze_weather) AS weather_rows,
       (SELECT min(observed_at_utc) FROM bronze_weather) AS weather_min,
       (SELECT max(observed_at_utc) FROM bronze_weather) AS weather_max
FROM raw_trips""")
FINDINGS = (
    ("pickup_before_window", "tpep_pickup_datetime", "quarantine", "tpep_pickup_datetime < '2024-01-02'"),
    ("pickup_after_window", "tpep_pickup_datetime", "quarantine", "tpep_pickup_datetime >= '2024-01-30'"),
    ("non_positive_duration", "pickup/dropoff", "quarantine", "tpep_dropoff_datetime <= tpep_pickup_datetime"),
    ("duration_exceeds_24h", "pickup/dropoff", "quarantine",
     "date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) > 86400"),
    ("no_passengers", "passenger_count", "flag (keep)", "passenger_count IS NULL OR passenger_count = 0"),
    ("too_many_passengers", "passenger_count", "flag (keep)", "passenger_count > 6"),
    ("zero_distance_paid", "trip_distance/fare", "flag (keep)", "trip_distance = 0 AND fare_amount > 0"),
    ("implausible_distance", "trip_distance", "quarantine", "trip_distance > 500"),
    ("negative_fare", "fare_amount", "flag (keep)", "fare_amount < 0"),
    ("negative_total", "total_amount", "flag (keep)", "total_amount < 0"),
    ("large_total", "total_amount", "flag (keep)", "total_amount > 1000"),
    ("unknown_zone", "PU/DOLocationID", "flag (keep)", '"PULocationID" IN (23, 24) OR "DOLocationID" IN (23, 24)'),
    ("total_not_sum_of_components", "fare columns", "flag (keep)", OFF),
)
sql("dq_report_findings", ("raw_trips",), (
    'SELECT *, round(100.0::DOUBLE * "count" / total, 2) AS pct FROM ('
    + " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{cols}' AS columns, '{action}' AS action, "
        f'count(*) FILTER ({where}) AS "count", count(*) AS total FROM raw_trips'
        for rule, cols, action, where in FINDINGS)
    + """ UNION ALL SELECT 'duplicate_rows', 'composite key', 'quarantine',
    count(*) - count(DISTINCT ("VendorID", tpep_pickup_datetime, ifnull(tpep_dropoff_datetime, '1900-01-01'),
                               "PULocationID", "DOLocationID", total_amount)), count(*) FROM raw_trips)"""))
sql("passenger_histogram", ("raw_trips",),
    "SELECT passenger_count, count(*) AS n FROM raw_trips GROUP BY 1 ORDER BY 1")
sql("trip_extremes", ("raw_trips",), """
SELECT max(trip_distance) AS longest_miles, max(total_amount) AS highest_total, max(tip_amount) AS highest_tip,
       max(passenger_count) AS most_passengers FROM raw_trips""")
sql("duplicate_count", ("raw_trips",), """
SELECT count(*) AS duplicates FROM (SELECT row_number() OVER (
  PARTITION BY "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, "PULocationID", "DOLocationID", total_amount) AS i
  FROM raw_trips) WHERE i > 1""")
sql("fare_reconciliation", ("raw_trips",), f"""
SELECT CAST("VendorID" AS INTEGER) AS vendor_id, count(*) AS trips, count(*) FILTER ({OFF}) AS unreconciled,
       round(100::DOUBLE * count(*) FILTER ({OFF}) / count(*), 2) AS unreconciled_pct,
       round(avg({GAP}) FILTER ({OFF}), 4) AS mean_gap FROM raw_trips GROUP BY 1""")
sql("fare_reconciliation_flags", ("raw_trips",),
    f"SELECT trip_id, round({GAP}, 2) AS fare_gap, {OFF} AS dq_total_mismatch FROM raw_trips")
sql("fare_gap_histogram", ("raw_trips",), f"""
SELECT round({GAP}, 2) AS gap, count(*) AS n FROM raw_trips WHERE total_amount > 0
GROUP BY 1 ORDER BY n DESC, gap LIMIT 15""")

# -- conditions
WEATHER_NUMBERS = ("temperature_2m", "apparent_temperature", "precipitation", "rain", "snowfall", "wind_speed_10m")
sql("weather_bronze", ("bronze_weather",), f"""
SELECT observed_at_raw, {r6(*WEATHER_NUMBERS)}, weather_code, source, latitude, longitude,
       observed_at_utc, observed_at_local, observed_at_is_valid, observed_at_reason FROM bronze_weather""")
sql("weather_hourly", ("hours",), f"""
SELECT observed_at_utc, observed_hour_utc,
       {r6('temperature_c', 'apparent_temperature_c', 'precipitation_mm', 'snowfall_cm', 'wind_speed_kmh')},
       weather_code, is_wet_hour, is_snowing, precipitation_band FROM hours""")
sql("scalar_bands", (), """
WITH m AS (SELECT *, CASE WHEN event_id % 11 <> 0 THEN greatest(value / 10::DOUBLE - 1, 0) END AS mm FROM events),
b AS (SELECT *, CASE WHEN mm IS NULL OR mm = 0 THEN 0 WHEN mm < 0.5 THEN 1 WHEN mm < 2.5 THEN 2 WHEN mm < 7.6 THEN 3
                     ELSE 4 END AS severity FROM m)
SELECT event_id, ['dry', 'trace', 'light', 'moderate', 'heavy'][severity + 1] AS band, severity,
       ifnull(mm, 0) >= 0.5 AS is_wet, ifnull(mm, 0) > 0 AS is_snowing,
       CASE WHEN event_id % 900 > 0 THEN round(value / ((event_id % 900) / 3600::DOUBLE), 6) END AS speed_mph,
       substr(props, 1, 4) AS label
FROM b""")
sql("weather_json_flatten", ("raw_weather",), f"""
SELECT observed_at_raw, {r6(*WEATHER_NUMBERS)}, weather_code, 'landed-json' AS source, latitude, longitude
FROM raw_weather""")
sql("weather_coalesce", (), """
WITH o AS (SELECT event_type, CAST(user_id % 25 AS INTEGER) AS zone_id, date_trunc('hour', ts) AS hour_utc,
                  round(avg(value), 4) AS temperature_c, count(*) AS readings
           FROM events WHERE event_type IN ('error', 'view') GROUP BY ALL),
k AS (SELECT zone_id, hour_utc, arg_min(event_type, event_type) AS best, count(*) AS sources FROM o GROUP BY ALL)
SELECT k.zone_id, k.hour_utc, o.temperature_c, o.readings,
       CASE WHEN sources = 2 THEN 'both' WHEN best = 'error' THEN 'primary' ELSE 'backfill' END AS filled_from
FROM k JOIN o ON o.zone_id = k.zone_id AND o.hour_utc = k.hour_utc AND o.event_type = k.best""")

# -- facts and mart
FACTS = (
    "trip_id, vendor_id, pickup_utc, pickup_local, pickup_hour_utc, duration_seconds, trip_distance_miles, "
    "passenger_count, fare_amount, tip_amount, total_amount, pickup_zone, pickup_borough, dropoff_zone, "
    "dropoff_borough, temperature_c, precipitation_mm, precipitation_band, is_wet_hour, is_snowing, "
    "wind_speed_kmh, pickup_hour_of_day, pickup_day_of_week, pickup_date_local"
)
CELL = "pickup_zone, pickup_borough, pickup_date_local, pickup_hour_of_day, pickup_day_of_week"
sql("dim_zones", ("zones",), "SELECT * FROM zones")
sql("join_zone_roles", ("conformed", "zones"), """
SELECT a."Zone" AS pickup_zone, a."Borough" AS pickup_borough, b."Zone" AS dropoff_zone,
       b."Borough" AS dropoff_borough, count(*) AS trips
FROM conformed LEFT JOIN zones a ON pickup_zone_id = a."LocationID" LEFT JOIN zones b ON dropoff_zone_id = b."LocationID"
GROUP BY ALL""")
sql("join_hour_weather", ("facts",),
    "SELECT trip_id, pickup_hour_utc, precipitation_band, is_wet_hour, wind_speed_kmh FROM facts")
sql("trip_facts", ("facts",), f"SELECT {FACTS} FROM facts")
sql("zone_hour_demand", ("mart",), f"""
SELECT {CELL}, precipitation_band, is_wet_hour, trips,
       {r6('temperature_c', 'revenue', 'avg_duration_seconds', 'avg_speed_mph', 'dry_baseline_trips', 'demand_lift_vs_dry')}
FROM mart""")
sql("dry_baseline", ("baseline",), f"""
SELECT pickup_zone, pickup_day_of_week, pickup_hour_of_day, {r6('dry_baseline_trips')} FROM baseline""")
sql("max_band_by_severity", ("facts",), f"""
SELECT {CELL}, max(precipitation_band) AS max_band_name,
       ['dry', 'trace', 'light', 'moderate', 'heavy'][max(list_position(
         ['dry', 'trace', 'light', 'moderate', 'heavy'], precipitation_band))] AS worst_band
FROM facts WHERE pickup_zone IS NOT NULL GROUP BY ALL""")
sql("scalar_time_parts", (), """
SELECT event_id, utc, ts AS local, date_trunc('hour', utc) AS hour_utc, CAST(hour(ts) AS INTEGER) AS hour_of_day,
       CAST(extract(dow FROM ts) AS INTEGER) AS day_of_week, CAST(ts AS DATE) AS date_local,
       date_diff('second', date_trunc('hour', utc), utc) AS seconds_into_hour,
       strftime(utc, '%Y-%m-%dT%H:%M') AS iso_minutes
FROM (SELECT *, (ts AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS utc FROM events)""")

# -- insights
sql("demand_by_band", ("facts",), f"""
SELECT precipitation_band, count(*) AS trips, {MEAN_FARE} AS avg_fare FROM facts
GROUP BY 1 ORDER BY 2 DESC""")
sql("demand_heatmap_long", ("facts",), f"""
SELECT pickup_day_of_week, pickup_hour_of_day, count(*) AS trips, {MEAN_FARE} AS avg_fare
FROM facts GROUP BY 1, 2 ORDER BY 1, 2""")
sql("demand_heatmap", ("facts",), "SELECT pickup_hour_of_day, " + ", ".join(
    f"CAST(nullif(count(*) FILTER (pickup_day_of_week = {d}), 0) AS DOUBLE) AS dow_{d}" for d in range(7)
) + " FROM facts GROUP BY 1")
sql("zone_wet_lift_top", ("lifts",), """
SELECT pickup_zone, pickup_borough, round(lift, 3) AS avg_lift, observations, substr(pickup_zone, 1, 20) AS label
FROM lifts ORDER BY avg_lift DESC, pickup_zone, pickup_borough LIMIT 20""")
sql("zone_wet_lift_bottom", ("lifts",), """
SELECT pickup_zone, pickup_borough, round(lift, 3) AS avg_lift, observations
FROM lifts ORDER BY avg_lift, pickup_zone, pickup_borough LIMIT 20""")
sql("headline_top5", ("lifts",), """
SELECT pickup_zone, pickup_borough, round(lift * 100, 1) AS lift_pct, observations
FROM lifts ORDER BY lift DESC, pickup_zone, pickup_borough LIMIT 5""")
sql("revenue_wet_dry", ("mart",), """
SELECT pickup_zone, pickup_borough, is_wet_hour, CAST(sum(trips) AS BIGINT) AS trips, round(sum(revenue), 2) AS revenue
FROM mart GROUP BY 1, 2, 3 HAVING sum(trips) > 100 ORDER BY 2, 1, 3""")
sql("speed_wet_dry", ("mart",), """
SELECT is_wet_hour, count(*) AS cells, CAST(sum(trips) AS BIGINT) AS trips, round(avg(avg_speed_mph), 4) AS avg_speed_mph
FROM mart GROUP BY 1""")

# -- checks
sql("check_unique", ("hours",), """
SELECT 'weather_hour' AS check_name, count(*) AS violations
FROM (SELECT observed_hour_utc FROM hours GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'lineitem_order', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)""")


def _nulls(table: str, columns: tuple[str, ...]) -> str:
    return " + ".join(f"(SELECT CAST(count(*) > 0 AS BIGINT) FROM {table} WHERE {c} IS NULL)" for c in columns)


sql("check_not_null", ("mart", "raw_trips"), f"""
SELECT 'facts' AS check_name, {_nulls('facts', ('pickup_utc', 'pickup_local', 'pickup_hour_utc', 'duration_seconds',
                                                'total_amount', 'pickup_date_local'))} AS violations
UNION ALL SELECT 'weather', {_nulls('hours', ('observed_hour_utc',))}
UNION ALL SELECT 'mart', {_nulls('mart', ('pickup_zone', 'pickup_date_local', 'trips', 'revenue'))}
UNION ALL SELECT 'raw', {_nulls('raw_trips', ('tpep_pickup_datetime', 'tpep_dropoff_datetime', 'trip_distance',
                                              '"Airport_fee"'))}""")
sql("check_accepted_range", ("staged", "hours"), """
SELECT 'temperature' AS check_name, count(*) FILTER (NOT temperature_c BETWEEN -40 AND 55) AS violations FROM hours
UNION ALL SELECT 'valid_duration', count(*) FILTER (is_valid AND NOT duration_seconds BETWEEN 1 AND 86400) FROM staged
UNION ALL SELECT 'any_duration', count(*) FILTER (NOT duration_seconds BETWEEN 1 AND 86400) FROM staged""")
sql("check_no_future", ("facts",), """
SELECT 'facts' AS check_name, count(*) AS violations FROM facts WHERE pickup_utc > TIMESTAMP '2024-01-29 12:00:00'""")
sql("check_unmatched_weather", ("staged", "hours"), """
SELECT pickup_hour_utc, count(*) AS unmatched_trips FROM staged
WHERE is_valid AND pickup_hour_utc NOT IN (SELECT observed_hour_utc FROM hours)
  AND pickup_hour_utc BETWEEN (SELECT min(observed_hour_utc) FROM hours) AND (SELECT max(observed_hour_utc) FROM hours)
GROUP BY 1""")
sql("check_freshness", ("raw_trips", "bronze_weather"), """
SELECT source, latest, age_seconds,
       CASE WHEN age_seconds <= 86400 THEN 'pass' WHEN age_seconds <= 172800 THEN 'warn' ELSE 'error' END AS status
FROM (SELECT 'trips' AS source, max(tpep_pickup_datetime) AS latest,
             date_diff('second', max(tpep_pickup_datetime), TIMESTAMP '2024-02-01') AS age_seconds FROM raw_trips
      UNION ALL SELECT 'weather', max(observed_at_utc),
             date_diff('second', max(observed_at_utc), TIMESTAMP '2024-01-31') FROM bronze_weather)""")
sql("check_freshness_sla", ("messages",), """
SELECT workload, limit_seconds, latest, age_seconds, age_seconds <= limit_seconds AS is_met
FROM (SELECT max(event_utc) AS latest, date_diff('second', max(event_utc), TIMESTAMP '2024-01-31 00:10:00') AS age_seconds
      FROM messages),
     (VALUES ('receipts', 30::BIGINT), ('fraud', 5::BIGINT), ('dashboards', 3600::BIGINT)) AS sla(workload, limit_seconds)""")
sql("check_join_fanout", ("staged", "hours"), """
SELECT 'hour_weather' AS join_name, (SELECT count(*) FROM staged WHERE is_valid) AS rows_before,
       count(*) AS rows_after, count(*) - (SELECT count(*) FROM staged WHERE is_valid) AS rows_added
FROM (SELECT * FROM staged WHERE is_valid) s LEFT JOIN hours ON observed_hour_utc = pickup_hour_utc
UNION ALL
SELECT 'orders_lines', (SELECT count(*) FROM orders), count(*), count(*) - (SELECT count(*) FROM orders)
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")

# -- timestamp contract
sql("normalise_timestamps", ("normalised",), """
SELECT event_id, utc AS pickup_utc, local AS pickup_local, is_valid AS pickup_is_valid, reason AS pickup_reason
FROM normalised""")
sql("normalise_attach", ("normalised",), """
SELECT event_id, raw_time, utc AS raw_time_utc, local AS raw_time_local, is_valid AS raw_time_is_valid,
       reason AS raw_time_reason FROM normalised""")
sql("normalise_reason_counts", ("normalised",), "SELECT reason, count(*) AS rows FROM normalised GROUP BY 1")

# -- sources
sql("scan_union_by_name", (), """
SELECT *, 'customer.parquet' AS _ingested_from FROM customer
UNION ALL BY NAME SELECT *, 'supplier.parquet' AS _ingested_from FROM supplier""")
sql("landing_missing_months", (), """
SELECT strftime(l_shipdate, '%Y-%m') AS month FROM lineitem
EXCEPT SELECT strftime(o_orderdate, '%Y-%m') FROM orders""")
sql("padded_month_window", (), """
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month,
       CAST(date_trunc('month', o_orderdate) - INTERVAL 1 DAY AS DATE) AS start_date,
       CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS end_date
FROM orders""")
sql("hour_spine", (), """
SELECT hour_utc, strftime(hour_utc, '%Y-%m-%dT%H:%M') AS observed_at_raw,
       (SELECT count(*) FROM events WHERE date_trunc('hour', ts) = hour_utc) AS observations
FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS hour_utc
      FROM events)""")
_LINEITEM = (
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
)
sql("profile_table", (), " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS column_type, count(*) AS rows, count(*) - count({c}) AS nulls, "
    f"round(100::DOUBLE * (count(*) - count({c})) / count(*), 2) AS null_pct, "
    f"CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max, "
    + (f"round(avg({c}), 4)" if t in ("bigint", "int", "double") else "NULL::DOUBLE")
    + " AS mean FROM lineitem"
    for c, t in _LINEITEM))
sql("profile_table_approximate", (), " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS rows, count(DISTINCT {c}) AS distinct_values, true AS distinct_within, "
    + (f"round(stddev_samp({c}), 4)" if t in ("bigint", "int", "double") else "NULL::DOUBLE") + " AS std, "
    + ", ".join(f"{'true' if t in ('bigint', 'int', 'double') else 'NULL::BOOLEAN'} AS {q}_within" for q in ("q25", "q50", "q75"))
    + " FROM lineitem"
    for c, t in _LINEITEM))

# -- fleet
sql("fraud_features_sliding", ("features",), f"""
SELECT window_start, window_end, vehicle_id, trips, {r6('fare', 'miles')}, short_trips, {r6('fare_per_mile')}
FROM features""")
sql("fraud_repeated_short_trips", ("trip_windows",), """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, vehicle_id, zone_id, count(*) AS short_trips
FROM trip_windows WHERE miles < 6 GROUP BY window_start, vehicle_id, zone_id HAVING count(*) >= 2""")
sql("fraud_rule_hits", ("features",), """
SELECT window_start, window_end, vehicle_id, 'many_trips' AS rule FROM features WHERE trips > 3
UNION ALL SELECT window_start, window_end, vehicle_id, 'fare_far_above_distance' FROM features WHERE fare_per_mile > 100
UNION ALL SELECT window_start, window_end, vehicle_id, 'repeated_short_trips' FROM features WHERE short_trips > 1""")
sql("late_split", ("messages",), """
SELECT message_id, vehicle_id, event_utc, ingest_utc, date_diff('second', event_utc, ingest_utc) AS delay_seconds,
       CASE WHEN message_id % 10 > 5 THEN 'late' ELSE 'on_time' END AS lane FROM messages""")
sql("telemetry_downsample", ("messages",), """
SELECT vehicle_id, date_trunc('minute', event_utc) AS slot_utc,
       round(arg_min(reading, (event_utc, message_id)), 6) AS first_reading, round(avg(reading), 6) AS avg_reading,
       count(*) AS readings
FROM messages GROUP BY 1, 2""")
sql("retention_tiers", ("messages",), """
SELECT 'full' AS tier, vehicle_id, event_utc AS at_utc, round(reading, 6) AS reading, 1::BIGINT AS readings FROM messages
WHERE event_utc >= TIMESTAMP '2024-01-20 12:00:00'
UNION ALL
SELECT 'minute', vehicle_id, date_trunc('minute', event_utc), round(avg(reading), 6), count(*) FROM messages
WHERE event_utc >= TIMESTAMP '2024-01-10 12:00:00' AND event_utc < TIMESTAMP '2024-01-20 12:00:00' GROUP BY 1, 2, 3""")
sql("fleet_connectivity", ("seen",), """
SELECT count(*) AS vehicles, count(*) FILTER (silent_seconds <= 300) AS connected,
       round(100::DOUBLE * count(*) FILTER (silent_seconds <= 300) / count(*), 2) AS connected_pct FROM seen""")
sql("fleet_outages", ("seen",), "SELECT * FROM seen WHERE silent_seconds > 6 * 3600")
sql("dead_letter_split", ("messages",), """
SELECT message_id, vehicle_id, payload, CASE WHEN json_valid(payload) THEN k END AS k,
       CASE WHEN json_valid(payload) THEN 'accepted' ELSE 'dead_letter' END AS lane FROM messages""")
sql("current_commands", ("messages",), """
SELECT vehicle_id, version, zone_id, issued_utc, expires_utc FROM (
  SELECT *, event_utc AS issued_utc FROM messages WHERE event_utc <= TIMESTAMP '2024-01-30 12:00:00'
  QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY version DESC, message_id DESC) = 1)
WHERE NOT is_nacked AND expires_utc > TIMESTAMP '2024-01-30 12:00:00'""")
sql("receipts_once", ("raw_trips",), """
SELECT trip_id, 0 AS delivery, tpep_pickup_datetime AS ended_utc, trip_distance AS miles, total_amount
FROM raw_trips WHERE trip_id >= 0""")
sql("hotspot_candidates", ("messages", "lifts"), """
SELECT p.zone AS zone, p.zone_id, p.vehicle_id, p.at_utc, round(lift, 6) AS avg_lift, observations
FROM (SELECT vehicle_id, zone_id, event_utc AS at_utc, n_name AS zone FROM messages JOIN nation ON n_nationkey = zone_id
      QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY event_utc DESC, message_id DESC) = 1) p
JOIN lifts ON pickup_zone = p.zone WHERE lift > 0""")
sql("erase_tokens", (), """
SELECT o.* FROM orders o WHERE NOT EXISTS (
  SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)""")
sql("regional_rollup", (), """
SELECT r_name AS region, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue
FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2""")
sql("fleet_metrics", ("facts",), """
SELECT pickup_borough AS city, count(*) AS trips, round(sum(total_amount), 2) AS revenue,
       round(avg(trip_distance_miles), 4) AS avg_miles, quantile_cont(duration_seconds, 0.5) AS median_seconds,
       quantile_cont(duration_seconds, 0.9) AS p90_seconds FROM facts GROUP BY 1""")
sql("trip_length_distribution", ("facts",), """
SELECT floor(trip_distance_miles) AS from_miles, count(*) AS trips,
       round(100::DOUBLE * count(*) / (SELECT count(*) FROM facts), 4) AS share_pct FROM facts GROUP BY 1""")
sql("fleet_utilisation", ("fleet_trips",), """
SELECT vehicle_id, count(*) AS trips, CAST(sum(seconds) AS BIGINT) AS busy_seconds,
       date_diff('second', min(started_utc), max(started_utc + to_seconds(seconds))) AS span_seconds,
       round(100::DOUBLE * sum(seconds)
             / date_diff('second', min(started_utc), max(started_utc + to_seconds(seconds))), 2) AS utilisation_pct
FROM fleet_trips GROUP BY 1""")
sql("dq_run_drift", ("staged",), """
SELECT *, round((rows_in - rows_before) / rows_before::DOUBLE, 4) AS relative_change,
       ifnull((rows_in - rows_before) / rows_before::DOUBLE <= -0.05, false) AS is_alert
FROM (SELECT *, lag(rows_in) OVER (PARTITION BY layer ORDER BY run_date) AS rows_before FROM (
  SELECT CAST(pickup_local_raw AS DATE) AS run_date, 'bronze' AS layer, count(*) AS rows_in FROM staged GROUP BY 1
  UNION ALL
  SELECT CAST(pickup_local_raw AS DATE), 'gold', count(*) FILTER (is_valid) FROM staged GROUP BY 1))""")
