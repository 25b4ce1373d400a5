"""Shared SQL for DuckDB: the derived tables as common table expressions.

generated from the Spark code.
"""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: tuple[str, ...], sql: str) -> None:
    CTES[name] = (needs, sql.strip())


def _collect(name: str, seen: list[str]) -> None:
    for need in CTES[name][0]:
        _collect(need, seen)
    if name not in seen:
        seen.append(name)


def with_(*names: str) -> str:
    """``WITH`` clause that defines the named tables and what they need."""
    seen: list[str] = []
    for name in names:
        _collect(name, seen)
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in seen) + "\n"


cte("ev", (), """
SELECT event_id, ts, user_id, event_type, value, props,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
FROM events
""")

cte("trip_parts", ("ev",), """
SELECT *,
       CASE WHEN event_id % 19 = 0 THEN -value ELSE value END
         + CASE WHEN event_id % 401 = 0 THEN 1000::DOUBLE ELSE 0::DOUBLE END AS fare,
       CASE WHEN event_id % 97 = 0 THEN -60 WHEN event_id % 89 = 0 THEN 0
            WHEN event_id % 61 = 0 THEN 90000
            ELSE 60 + (event_id * 37 + user_id * 11) % 5400 END AS seconds,
       CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN k + 500.5::DOUBLE
            ELSE k / 8::DOUBLE END AS miles,
       k * 0.25::DOUBLE AS tip,
       CASE WHEN k > 90 THEN 6.5::DOUBLE ELSE 0::DOUBLE END AS tolls,
       CASE WHEN user_id % 4 = 0 THEN 0::DOUBLE ELSE 2.5::DOUBLE END AS charged,
       CASE WHEN user_id % 16 = 1 THEN NULL ELSE 2.5::DOUBLE END AS listed,
       CASE WHEN user_id % 13 = 0 THEN 1.75::DOUBLE END AS airport
FROM ev WHERE event_type <> 'error'
""")

cte("raw_trips", ("trip_parts",), """
SELECT CASE WHEN copy = 1 THEN -event_id - 1 ELSE event_id END AS trip_id,
       user_id % 2 + 1 AS "VendorID",
       ts AS tpep_pickup_datetime,
       CASE WHEN event_id % 53 <> 0 THEN ts + to_seconds(seconds) END AS tpep_dropoff_datetime,
       CASE WHEN event_id % 31 <> 0 THEN CAST(user_id % 8 AS DOUBLE) END AS passenger_count,
       miles - copy AS trip_distance,
       user_id % 26 AS "PULocationID",
       (user_id * 7 + event_id) % 26 AS "DOLocationID",
       fare AS fare_amount, 0.5::DOUBLE AS extra, 0.5::DOUBLE AS mta_tax, tip AS tip_amount,
       tolls AS tolls_amount, 0.25::DOUBLE AS improvement_surcharge,
       fare + 1.25::DOUBLE + tip + tolls + charged + coalesce(airport, 0::DOUBLE) AS total_amount,
       listed AS congestion_surcharge, airport AS "Airport_fee",
       user_id % 4 + 1 AS payment_type
FROM trip_parts, (VALUES (0), (1)) AS copies(copy)
WHERE copy = 0 OR event_id % 50 = 0
""")

cte("conformed", ("raw_trips",), """
SELECT trip_id, CAST("VendorID" AS INTEGER) AS vendor_id,
       tpep_pickup_datetime AS pickup_local_raw, tpep_dropoff_datetime AS dropoff_local_raw,
       CAST(passenger_count AS INTEGER) AS passenger_count, trip_distance AS trip_distance_miles,
       CAST("PULocationID" AS INTEGER) AS pickup_zone_id, CAST("DOLocationID" AS INTEGER) AS dropoff_zone_id,
       fare_amount, tip_amount, total_amount, CAST(payment_type AS INTEGER) AS payment_type
FROM raw_trips
""")

cte("timed", ("conformed",), """
SELECT *,
       (pickup_local_raw AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS pickup_utc,
       (dropoff_local_raw AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS dropoff_utc
FROM conformed
""")

cte("ranked", ("timed",), """
SELECT *,
       date_diff('second', pickup_utc, dropoff_utc) AS duration_seconds,
       row_number() OVER (
         PARTITION BY vendor_id, pickup_utc, dropoff_utc, pickup_zone_id, dropoff_zone_id, total_amount
         ORDER BY trip_distance_miles DESC NULLS LAST, trip_id) AS dupe_rank
FROM timed
""")

cte("flagged", ("ranked",), """
SELECT *,
       pickup_utc IS NULL AS dq_pickup_unparseable,
       dropoff_utc IS NULL AS dq_dropoff_unparseable,
       pickup_utc >= dropoff_utc AS dq_non_positive_duration,
       duration_seconds > 24 * 3600 AS dq_duration_exceeds_24h,
       NOT (pickup_utc >= TIMESTAMP '2024-01-02' AND pickup_utc < TIMESTAMP '2024-01-30') AS dq_pickup_out_of_range,
       fare_amount > 0 AND trip_distance_miles <= 0 AS dq_zero_distance_paid,
       trip_distance_miles > 500 AS dq_implausible_distance,
       passenger_count IS NULL OR passenger_count = 0 AS dq_no_passengers,
       total_amount < 0 AS dq_negative_total,
       pickup_zone_id IN (23, 24) OR dropoff_zone_id IN (23, 24) AS dq_unknown_zone,
       dupe_rank > 1 AS dq_duplicate_row
FROM ranked
""")

cte("staged", ("flagged",), """
SELECT *,
       NOT dq_pickup_unparseable AND NOT dq_dropoff_unparseable AND NOT dq_non_positive_duration
         AND NOT dq_duration_exceeds_24h AND NOT dq_pickup_out_of_range
         AND NOT dq_implausible_distance AND NOT dq_duplicate_row AS is_valid,
       (pickup_utc AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS pickup_local,
       date_trunc('hour', pickup_utc) AS pickup_hour_utc
FROM flagged
""")

cte("reasons", ("staged",), """
SELECT *,
       CASE WHEN is_valid THEN NULL
            WHEN is_valid IS NULL THEN 'dq_undetermined'
            ELSE array_to_string(list_filter([
              CASE WHEN dq_pickup_unparseable THEN 'dq_pickup_unparseable' END,
              CASE WHEN dq_dropoff_unparseable THEN 'dq_dropoff_unparseable' END,
              CASE WHEN dq_non_positive_duration THEN 'dq_non_positive_duration' END,
              CASE WHEN dq_duration_exceeds_24h THEN 'dq_duration_exceeds_24h' END,
              CASE WHEN dq_pickup_out_of_range THEN 'dq_pickup_out_of_range' END,
              CASE WHEN dq_implausible_distance THEN 'dq_implausible_distance' END,
              CASE WHEN dq_duplicate_row THEN 'dq_duplicate_row' END], lambda x: x IS NOT NULL), ',') END
         AS failure_reason
FROM staged
""")

cte("raw_weather", ("ev",), """
SELECT CASE WHEN id % 59 = 0 THEN 'not a date' ELSE strftime(hour, '%Y-%m-%dT%H:%M') END AS observed_at_raw,
       k / 4::DOUBLE - 5 AS temperature_2m, k / 4::DOUBLE - 7.5::DOUBLE AS apparent_temperature,
       CASE WHEN k <> 7 THEN rain END AS precipitation, CASE WHEN k <> 7 THEN rain END AS rain,
       CASE WHEN v >= 172 THEN v / 100 ELSE 0::DOUBLE END AS snowfall,
       CAST(n AS DOUBLE) AS wind_speed_10m, k % 4 AS weather_code,
       'test-events' AS source, 40.7128::DOUBLE AS latitude, -74.006::DOUBLE AS longitude
FROM (SELECT *, CASE WHEN v < 20 THEN 0::DOUBLE ELSE (v - 20) / 20 END AS rain
      FROM (SELECT date_trunc('hour', ts) AS hour, min(event_id) AS id, count(*) AS n,
                   arg_min(value, event_id) AS v, arg_min(k, event_id) AS k
            FROM ev WHERE event_type = 'error' GROUP BY 1))
""")

cte("bronze_weather", ("raw_weather",), """
SELECT *, TRY_CAST(replace(observed_at_raw, 'T', ' ') || ':00' AS TIMESTAMP) AS observed_at_utc,
       TRY_CAST(replace(observed_at_raw, 'T', ' ') || ':00' AS TIMESTAMP) AS observed_at_local,
       observed_at_raw <> 'not a date' AS observed_at_is_valid,
       CASE WHEN observed_at_raw = 'not a date' THEN 'unparseable' ELSE 'ok' END AS observed_at_reason
FROM raw_weather
""")

cte("hours", ("bronze_weather",), """
SELECT observed_at_utc, date_trunc('hour', observed_at_utc) AS observed_hour_utc,
       temperature_2m AS temperature_c, apparent_temperature AS apparent_temperature_c,
       precipitation AS precipitation_mm, snowfall AS snowfall_cm, wind_speed_10m AS wind_speed_kmh,
       weather_code, ifnull(precipitation, 0) >= 0.5 AS is_wet_hour, ifnull(snowfall, 0) > 0 AS is_snowing,
       CASE WHEN ifnull(precipitation, 0) = 0 THEN 'dry' WHEN precipitation >= 7.6 THEN 'heavy'
            WHEN precipitation >= 2.5 THEN 'moderate' WHEN precipitation >= 0.5 THEN 'light'
            ELSE 'trace' END AS precipitation_band
FROM bronze_weather WHERE observed_at_is_valid
""")

cte("zones", (), """
SELECT n_nationkey AS "LocationID", r_name AS "Borough", n_name AS "Zone",
       CASE WHEN n_nationkey % 5 = 0 THEN 'Airports' ELSE 'Yellow Zone' END AS service_zone
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
""")

cte("facts", ("staged", "hours", "zones"), """
SELECT s.trip_id, s.vendor_id, s.pickup_utc, s.pickup_local, s.pickup_hour_utc, s.duration_seconds,
       s.trip_distance_miles, s.passenger_count, s.fare_amount, s.tip_amount, s.total_amount,
       a."Zone" AS pickup_zone, a."Borough" AS pickup_borough, b."Zone" AS dropoff_zone, b."Borough" AS dropoff_borough,
       h.temperature_c, h.precipitation_mm, h.precipitation_band, h.is_wet_hour, h.is_snowing, h.wind_speed_kmh,
       CAST(hour(s.pickup_local) AS INTEGER) AS pickup_hour_of_day,
       CAST(dayofweek(s.pickup_local) AS INTEGER) AS pickup_day_of_week,
       CAST(s.pickup_local AS DATE) AS pickup_date_local
FROM (SELECT * FROM staged WHERE is_valid) s
LEFT JOIN hours h ON h.observed_hour_utc = s.pickup_hour_utc
LEFT JOIN zones a ON a."LocationID" = s.pickup_zone_id
LEFT JOIN zones b ON b."LocationID" = s.dropoff_zone_id
""")

cte("cells", ("facts",), """
SELECT pickup_zone, pickup_borough, pickup_date_local, pickup_hour_of_day, pickup_day_of_week,
       max(precipitation_band) AS precipitation_band, bool_or(is_wet_hour) AS is_wet_hour,
       avg(temperature_c) AS temperature_c, count(*) AS trips, sum(total_amount) AS revenue,
       avg(duration_seconds) AS avg_duration_seconds,
       avg(trip_distance_miles * 3600 / nullif(duration_seconds, 0)) FILTER (duration_seconds > 0) AS avg_speed_mph
FROM facts WHERE pickup_zone IS NOT NULL
GROUP BY ALL
""")

cte("baseline", ("cells",), """
SELECT pickup_zone, pickup_day_of_week, pickup_hour_of_day,
       sum(trips) FILTER (NOT is_wet_hour) / count(*) FILTER (NOT is_wet_hour)::DOUBLE AS dry_baseline_trips
FROM cells GROUP BY ALL
""")

cte("mart", ("baseline",), """
SELECT cells.*, dry_baseline_trips,
       CASE WHEN dry_baseline_trips > 0 THEN trips / dry_baseline_trips - 1 END AS demand_lift_vs_dry
FROM cells JOIN baseline USING (pickup_zone, pickup_day_of_week, pickup_hour_of_day)
""")

cte("lifts", ("mart",), """
SELECT pickup_zone, pickup_borough, avg(demand_lift_vs_dry) AS lift, count(*) AS observations
FROM mart WHERE is_wet_hour AND dry_baseline_trips > 0.5
GROUP BY ALL HAVING count(*) > 10
""")

cte("messages", ("ev",), """
SELECT event_id AS message_id, user_id AS vehicle_id, ts AS event_utc,
       ts + to_minutes(event_id % 10) AS ingest_utc, CAST((user_id + k) % 25 AS INTEGER) AS zone_id,
       value AS reading, CASE WHEN event_id % 20 = 0 THEN substr(props, 1, 4) ELSE props END AS payload, k,
       event_id AS version, ts + INTERVAL 6 HOUR AS expires_utc, event_id % 13 = 0 AS is_nacked
FROM ev
""")

cte("fleet_trips", ("ev",), """
SELECT event_id AS trip_id, user_id AS vehicle_id, ts AS started_utc, CAST((user_id + k) % 25 AS INTEGER) AS zone_id,
       value AS fare, k / 8::DOUBLE AS miles, 60 + (event_id * 37 + user_id * 11) % 5400 AS seconds
FROM ev WHERE event_type <> 'error'
""")

cte("trip_windows", ("fleet_trips",), """
SELECT *, time_bucket(INTERVAL 30 MINUTE, started_utc) - to_minutes(30 * back) AS window_start
FROM fleet_trips, (VALUES (0), (1)) AS slides(back)
""")

cte("features", ("trip_windows",), """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, vehicle_id, count(*) AS trips,
       sum(fare) AS fare, sum(miles) AS miles, count(*) FILTER (miles < 1) AS short_trips,
       CASE WHEN sum(miles) > 0 THEN sum(fare) / sum(miles) END AS fare_per_mile
FROM trip_windows GROUP BY window_start, vehicle_id
""")

cte("seen", ("messages",), """
SELECT vehicle_id, max(event_utc) AS last_seen_utc,
       date_diff('second', max(event_utc), TIMESTAMP '2024-01-30 12:00:00') AS silent_seconds
FROM messages WHERE event_utc <= TIMESTAMP '2024-01-30 12:00:00' GROUP BY vehicle_id
""")

cte("times", ("ev",), """
SELECT event_id, event_id % 20 AS form,
       CASE WHEN event_id % 20 IN (10, 15, 17) THEN date_trunc('minute', ts) WHEN event_id % 20 IN (11, 12) THEN date_trunc('day', ts)
            WHEN event_id % 20 = 16 THEN date_trunc('hour', ts) WHEN event_id % 20 = 18 THEN date_trunc('month', ts)
            ELSE date_trunc('second', ts) END AS s,
       CASE event_id % 20 WHEN 0 THEN NULL WHEN 1 THEN 'not a date' WHEN 2 THEN '2002-01-01 00:00:00'
            WHEN 3 THEN '2090-06-01 00:00:00' WHEN 4 THEN '2024-03-10 02:30:00' WHEN 5 THEN '2024-11-03 01:30:00'
            WHEN 6 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 7 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            WHEN 8 THEN strftime(ts, '%m/%d/%Y %I:%M:%S %p') WHEN 9 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')
            WHEN 10 THEN strftime(ts, '%b %d %Y %H:%M') WHEN 11 THEN strftime(ts, '%d %B %Y') WHEN 12 THEN strftime(ts, '%Y%m%d')
            WHEN 13 THEN strftime(ts, '%Y%m%dT%H%M%S') WHEN 14 THEN strftime(ts, '%m-%d-%Y %H:%M:%S')
            WHEN 15 THEN strftime(ts, '%-m/%-d/%y %-H:%M') WHEN 16 THEN strftime(ts, '%Y-%m-%dT%H') WHEN 17 THEN strftime(ts, '%Y.%m.%d %H:%M')
            WHEN 18 THEN strftime(ts, '%Y-%m') ELSE strftime(ts, '%a, %d %b %Y %H:%M:%S +0000') END AS raw_time
FROM ev
""")

cte("normalised", ("times",), """
SELECT event_id, raw_time,
       CASE WHEN form = 5 THEN TIMESTAMP '2024-11-03 05:30:00' WHEN form IN (9, 19) THEN s WHEN form >= 6 THEN s + INTERVAL 5 HOUR END AS utc,
       CASE WHEN form = 5 THEN TIMESTAMP '2024-11-03 01:30:00' WHEN form IN (9, 19) THEN s - INTERVAL 5 HOUR WHEN form >= 6 THEN s END AS local,
       form >= 5 AS is_valid,
       CASE form WHEN 0 THEN 'null' WHEN 1 THEN 'unparseable' WHEN 2 THEN 'out_of_plausible_range'
            WHEN 3 THEN 'out_of_plausible_range' WHEN 4 THEN 'nonexistent_local_time_dst_gap'
            WHEN 5 THEN 'ok_ambiguous_dst_fallback' ELSE 'ok' END AS reason
FROM times
""")
