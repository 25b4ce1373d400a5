"""Every job on the test tables by name: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import contract, timecols
from .functions.conditions import band_severity, is_snowing, is_wet, precipitation_band, short_label, speed_mph
from .operators import checks, joins, profile, ranking, rules
from .plans import fleet, insights, marts, reports, staging
from .sources import bindings, files, months
from .sources.bindings import Tables

Job = Callable[[Tables], DataFrame]
JOBS: dict[str, Job] = {}


def job(fn: Job) -> Job:
    JOBS[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, because a sum's last bits depend on the order of its rows."""
    return df.select(
        *[F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name for f in df.schema.fields]
    )


# -- staging and quality -------------------------------------------------------


@job
def trips_conformed(t: Tables) -> DataFrame:
    return t.conformed


@job
def dedupe_rank(t: Tables) -> DataFrame:
    timed = staging.add_utc(t.conformed, t.settings)
    ranked = ranking.duplicate_rank(
        timed, staging.DUPLICATE_KEY, "trip_distance_miles", ["trip_id"], settings=t.settings
    )
    return ranked.select("trip_id", F.col("_dupe_rank").cast("bigint").alias("dupe_rank"))


@job
def trips_flagged(t: Tables) -> DataFrame:
    return t.staged.select("trip_id", "duration_seconds", *[r.name for r in rules.TRIP_RULES])


@job
def trips_validity(t: Tables) -> DataFrame:
    return t.staged.select("trip_id", "pickup_utc", "dropoff_utc", "pickup_local", "pickup_hour_utc", "is_valid")


@job
def trips_quarantine(t: Tables) -> DataFrame:
    return rules.quarantine(t.staged).select("trip_id", "total_amount", "failure_reason")


@job
def dq_rule_counts(t: Tables) -> DataFrame:
    return rules.rule_counts(t.staged)


@job
def revenue_accounting(t: Tables) -> DataFrame:
    return rules.revenue_by_reason(t.staged)


@job
def dq_report_header(t: Tables) -> DataFrame:
    return reports.header(t.raw_trips, t.bronze_weather, t.settings)


@job
def dq_report_findings(t: Tables) -> DataFrame:
    return reports.findings(t.raw_trips, t.settings)


@job
def passenger_histogram(t: Tables) -> DataFrame:
    return profile.value_histogram(t.raw_trips, "passenger_count")


@job
def trip_extremes(t: Tables) -> DataFrame:
    return profile.extremes(
        t.raw_trips,
        {
            "longest_miles": "trip_distance", "highest_total": "total_amount",
            "highest_tip": "tip_amount", "most_passengers": "passenger_count",
        },
    )


@job
def duplicate_count(t: Tables) -> DataFrame:
    return ranking.duplicate_count(t.raw_trips, reports.RAW_DUPLICATE_KEY)


@job
def fare_reconciliation(t: Tables) -> DataFrame:
    return reports.reconciliation_by_vendor(t.raw_trips, t.settings)


@job
def fare_reconciliation_flags(t: Tables) -> DataFrame:
    return reports.reconciliation_flags(t.raw_trips, t.settings).select("trip_id", "fare_gap", "dq_total_mismatch")


@job
def fare_gap_histogram(t: Tables) -> DataFrame:
    paid = t.raw_trips.where(F.col("total_amount") > 0)
    return profile.top_histogram(paid, F.round(reports.fare_gap(), 2), "gap", 15)


# -- conditions ----------------------------------------------------------------


@job
def weather_bronze(t: Tables) -> DataFrame:
    return rounded(t.bronze_weather)


@job
def weather_hourly(t: Tables) -> DataFrame:
    return rounded(t.weather)


@job
def scalar_bands(t: Tables) -> DataFrame:
    mm = F.col("value") / 10.0 - 1.0
    depth = F.when(mm > 0, mm).otherwise(F.lit(0.0))
    return (
        t.events.withColumn("mm", F.when(F.col("event_id") % 11 != 0, depth))
        .select(
            "event_id",
            precipitation_band("mm").alias("band"),
            band_severity(precipitation_band("mm")).alias("severity"),
            is_wet("mm").alias("is_wet"),
            is_snowing("mm").alias("is_snowing"),
            F.round(speed_mph("value", F.col("event_id") % 900), 6).alias("speed_mph"),
            short_label("props", 4).alias("label"),
        )
    )


@job
def weather_json_flatten(t: Tables) -> DataFrame:
    """Hours to one payload per day, as the service serves them, and back."""
    columns = [n for n, _ in files.HOURLY_VARIABLES]
    hour = F.struct(F.col("observed_at_raw").alias("time"), *columns)
    # At most 24 hours a day: the hours are grouped already. An hour whose text is no date is a payload with its like.
    dated = F.to_date(F.try_to_timestamp(F.substring("observed_at_raw", 1, 10), F.lit("yyyy-MM-dd"))).isNotNull()
    alike = F.when(~dated, F.xxhash64("observed_at_raw", *columns))
    days = t.raw_weather.groupBy(F.substring("observed_at_raw", 1, 10).alias("_day"), alike.alias("_alike"), "latitude", "longitude").agg(
        F.array_sort(F.collect_list(hour)).alias("_h")
    )
    hourly_arrays = F.struct(*[F.col(f"_h.{c}").alias(c) for c in ("time", *columns)]).alias("hourly")
    payload = F.to_json(F.struct("latitude", "longitude", hourly_arrays), {"ignoreNullFields": "false"})
    return rounded(files.flatten_weather_json(days.select(payload.alias("payload")), "payload", "landed-json"))


@job
def weather_coalesce(t: Tables) -> DataFrame:
    station = bindings.observations(t.events, "error")
    model = bindings.observations(t.events, "view")
    return joins.primary_with_backfill(station, model, ["zone_id", "hour_utc"], ["temperature_c", "readings"])


# -- facts and mart ------------------------------------------------------------


@job
def dim_zones(t: Tables) -> DataFrame:
    return t.zones


@job
def join_zone_roles(t: Tables) -> DataFrame:
    joined = joins.attach_zone_roles(t.conformed, t.zones, t.settings)
    return joined.groupBy("pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough").agg(
        F.count(F.lit(1)).alias("trips")
    )


@job
def join_hour_weather(t: Tables) -> DataFrame:
    joined = joins.attach_hour_conditions(t.valid, t.weather, t.settings)
    return joined.select("trip_id", "pickup_hour_utc", "precipitation_band", "is_wet_hour", "wind_speed_kmh")


@job
def trip_facts(t: Tables) -> DataFrame:
    return marts.trip_facts(t.valid, t.weather, t.zones, t.settings, keep=("trip_id",))


@job
def zone_hour_demand(t: Tables) -> DataFrame:
    return rounded(t.mart)


@job
def dry_baseline(t: Tables) -> DataFrame:
    return rounded(marts.dry_baseline(marts.mart_cells(t.valid, t.weather, t.zones)))


@job
def max_band_by_severity(t: Tables) -> DataFrame:
    return marts.worst_band(marts.with_pickup_zone(marts.with_conditions(marts.trip_cells(t.valid), t.weather), t.zones))


@job
def scalar_time_parts(t: Tables) -> DataFrame:
    utc = timecols.local_to_utc("ts", t.settings.trip_source_tz, t.settings.zone_years)
    timed = timecols.computed_once(t.events, {"utc": utc})
    local = timecols.utc_to_local("utc", t.settings.reporting_tz, t.settings.zone_years)
    return timed.withColumn("local", local).select(
        "event_id", "utc", "local",
        timecols.hour_floor("utc").alias("hour_utc"),
        timecols.hour_of_day("local").alias("hour_of_day"),
        timecols.day_of_week("local").alias("day_of_week"),
        timecols.local_date("local").alias("date_local"),
        timecols.seconds_between(timecols.hour_floor("utc"), "utc").alias("seconds_into_hour"),
        timecols.iso_minutes("utc").alias("iso_minutes"),
    )


# -- insights ------------------------------------------------------------------


@job
def demand_by_band(t: Tables) -> DataFrame:
    return insights.demand_by_band(marts.with_conditions(marts.trip_cells(t.valid, ("pickup_hour_utc",)), t.weather))


@job
def demand_heatmap_long(t: Tables) -> DataFrame:
    return insights.demand_by_hour_of_week(marts.trip_cells(t.valid, ("pickup_day_of_week", "pickup_hour_of_day")))


@job
def demand_heatmap(t: Tables) -> DataFrame:
    return insights.demand_matrix(marts.trip_cells(t.valid, ("pickup_day_of_week", "pickup_hour_of_day")))


@job
def zone_wet_lift_top(t: Tables) -> DataFrame:
    return insights.top_wet_lift(t.mart, t.settings)


@job
def zone_wet_lift_bottom(t: Tables) -> DataFrame:
    return insights.bottom_wet_lift(t.mart, t.settings)


@job
def headline_top5(t: Tables) -> DataFrame:
    return insights.headline(t.mart, t.settings)


@job
def revenue_wet_dry(t: Tables) -> DataFrame:
    return insights.revenue_wet_dry(t.mart, t.settings)


@job
def speed_wet_dry(t: Tables) -> DataFrame:
    return insights.speed_wet_dry(t.mart)


# -- checks --------------------------------------------------------------------


def _together(*parts: DataFrame) -> DataFrame:
    return files.union_by_name(parts)


@job
def check_unique(t: Tables) -> DataFrame:
    """One key that is unique and one that is not."""
    return _together(
        checks.violation_count(checks.unique(t.weather, "observed_hour_utc"), "weather_hour"),
        checks.violation_count(checks.unique(t.table("lineitem"), "l_orderkey"), "lineitem_order"),
    )


@job
def check_not_null(t: Tables) -> DataFrame:
    """Columns with nulls, per table: each table is built once, the mart from the grouped facts."""
    fact_columns = ("pickup_utc", "pickup_local", "pickup_hour_utc", "duration_seconds", "total_amount", "pickup_date_local")
    cells = t.facts.groupBy(*marts.CELL).agg(
        *[F.count_if(checks.is_missing(c)).alias(f"_{c}") for c in fact_columns], F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("revenue"),
    )
    in_mart = "pickup_zone IS NOT NULL"
    mart_columns = ("pickup_zone", "pickup_date_local", "trips", "revenue")
    both = cells.agg(
        sum((F.coalesce(F.sum(f"_{c}"), F.lit(0)) > 0).cast("bigint") for c in fact_columns).alias("facts"),
        sum((F.count_if(checks.is_missing(c, in_mart)) > 0).cast("bigint") for c in mart_columns).alias("mart"),
    )
    return _together(
        rules.long_form(both, ["facts", "mart"], "check_name", "violations"),
        checks.violation_count(checks.not_null(t.weather, ["observed_hour_utc"]), "weather"),
        checks.violation_count(
            checks.not_null(t.raw_trips, ["tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "Airport_fee"]),
            "raw",
        ),
    )


@job
def check_accepted_range(t: Tables) -> DataFrame:
    """All ranges of a table in one pass over it."""
    return _together(
        checks.counted(t.weather, {"temperature": checks.is_outside("temperature_c", -40, 55)}),
        checks.counted(t.staged, {
            "valid_duration": checks.is_outside("duration_seconds", 1, 86_400, "is_valid"), "any_duration": checks.is_outside("duration_seconds", 1, 86_400),
        }),
    )


@job
def check_no_future(t: Tables) -> DataFrame:
    return checks.violation_count(checks.no_future(t.facts, "pickup_utc", timecols.ntz("2024-01-29 12:00:00")), "facts")


@job
def check_unmatched_weather(t: Tables) -> DataFrame:
    return checks.unmatched_hours(t.valid, t.weather, t.settings)


@job
def check_freshness(t: Tables) -> DataFrame:
    trips = checks.freshness(t.raw_trips, "tpep_pickup_datetime", timecols.ntz("2024-02-01 00:00:00"))
    hours = checks.freshness(t.bronze_weather, "observed_at_utc", timecols.ntz("2024-01-31 00:00:00"))
    return _together(
        trips.select(F.lit("trips").alias("source"), "*"), hours.select(F.lit("weather").alias("source"), "*")
    )


@job
def check_freshness_sla(t: Tables) -> DataFrame:
    return fleet.freshness_by_workload(t.messages, "event_utc", timecols.ntz("2024-01-31 00:10:00"))


@job
def check_join_fanout(t: Tables) -> DataFrame:
    """The hour join, which must add nothing, and a join on a repeated key, which adds rows."""
    hours = t.weather.withColumnRenamed("observed_hour_utc", "pickup_hour_utc")
    lines = t.table("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return _together(
        checks.join_fanout(t.valid, hours, ["pickup_hour_utc"]).select(F.lit("hour_weather").alias("join_name"), "*"),
        checks.join_fanout(t.table("orders"), lines, ["o_orderkey"]).select(F.lit("orders_lines").alias("join_name"), "*"),
    )


# -- timestamp contract --------------------------------------------------------


def _normalised(t: Tables) -> DataFrame:
    return contract.add_normalised(
        bindings.raw_times(t.events), "raw_time", t.settings.trip_source_tz, prefix="pickup", years=t.settings.zone_years
    )


@job
def normalise_timestamps(t: Tables) -> DataFrame:
    return _normalised(t).select("event_id", "pickup_utc", "pickup_local", "pickup_is_valid", "pickup_reason")


@job
def normalise_attach(t: Tables) -> DataFrame:
    times = bindings.raw_times(t.events)
    return contract.add_normalised(times, "raw_time", t.settings.trip_source_tz, years=t.settings.zone_years)


@job
def normalise_reason_counts(t: Tables) -> DataFrame:
    return contract.reason_counts(_normalised(t), "pickup_reason")


# -- sources -------------------------------------------------------------------


@job
def scan_union_by_name(t: Tables) -> DataFrame:
    """Two files whose columns differ, as one table with each row's file."""
    both = files.scan_union_by_name(t.spark, [f"{t.folder.rstrip('/')}/{n}.parquet" for n in ("customer", "supplier")])
    return both.withColumn("_ingested_from", F.regexp_extract("_ingested_from", r"([^/]+)$", 1))


@job
def landing_missing_months(t: Tables) -> DataFrame:
    requested = months.months_of(t.table("lineitem"), "l_shipdate")
    return months.missing_months(requested, months.months_of(t.table("orders"), "o_orderdate"))


@job
def padded_month_window(t: Tables) -> DataFrame:
    return months.padded_window(months.months_of(t.table("orders"), "o_orderdate"))


@job
def hour_spine(t: Tables) -> DataFrame:
    """Events of all types per hour, with the hours that have none."""
    bounds = t.events.agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    counted = t.events.groupBy(timecols.hour_floor("ts").alias("hour")).agg(F.count(F.lit(1)).alias("observations"))
    return months.fill_hours(months.hour_spine(bounds, "low", "high"), counted, "hour", "observations")


@job
def profile_table(t: Tables) -> DataFrame:
    return profile.profile_exact(t.table("lineitem"))


@job
def profile_table_approximate(t: Tables) -> DataFrame:
    """Sketches of the lines of each return flag, merged and held against the rows."""
    return profile.profile_verified(t.table("lineitem"), ["l_returnflag"])


# -- fleet ---------------------------------------------------------------------


@job
def fraud_features_sliding(t: Tables) -> DataFrame:
    return rounded(fleet.fraud_features(bindings.fleet_trips(t.events)))


@job
def fraud_repeated_short_trips(t: Tables) -> DataFrame:
    return fleet.repeated_short_trips(bindings.fleet_trips(t.events), short_miles=6.0)


@job
def fraud_rule_hits(t: Tables) -> DataFrame:
    return fleet.fraud_rule_hits(fleet.fraud_features(bindings.fleet_trips(t.events)))


@job
def late_split(t: Tables) -> DataFrame:
    laned = fleet.with_lane(t.messages)
    return laned.select("message_id", "vehicle_id", "event_utc", "ingest_utc", "delay_seconds", "lane")


@job
def telemetry_downsample(t: Tables) -> DataFrame:
    return rounded(fleet.downsample(t.messages, seconds=60))


@job
def retention_tiers(t: Tables) -> DataFrame:
    return rounded(fleet.retention_tiers(t.messages, t.as_of, full_days=10, minute_days=20))


@job
def fleet_connectivity(t: Tables) -> DataFrame:
    return fleet.connectivity(t.messages, t.as_of)


@job
def fleet_outages(t: Tables) -> DataFrame:
    return fleet.outages(t.messages, t.as_of)


@job
def dead_letter_split(t: Tables) -> DataFrame:
    return fleet.with_parse_lane(t.messages).select("message_id", "vehicle_id", "payload", "k", "lane")


@job
def current_commands(t: Tables) -> DataFrame:
    return fleet.current_commands(t.messages, t.as_of)


@job
def receipts_once(t: Tables) -> DataFrame:
    return fleet.receipts_once(bindings.receipt_deliveries(t.raw_trips))


@job
def hotspot_candidates(t: Tables) -> DataFrame:
    hot = fleet.hot_zones(t.mart, t.settings)
    return rounded(fleet.hotspot_candidates(fleet.last_positions(t.messages), t.zones, hot, t.settings))


@job
def erase_tokens(t: Tables) -> DataFrame:
    tokens = t.table("customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return fleet.erase_tokens(t.table("orders"), tokens, "o_custkey", t.settings)


@job
def regional_rollup(t: Tables) -> DataFrame:
    return fleet.regional_rollup(t.table("orders"), t.table("customer"), t.table("nation"), t.table("region"))


@job
def fleet_metrics(t: Tables) -> DataFrame:
    return fleet.city_metrics(t.valid, t.zones)


@job
def trip_length_distribution(t: Tables) -> DataFrame:
    return fleet.trip_length_distribution(t.valid)


@job
def fleet_utilisation(t: Tables) -> DataFrame:
    return fleet.utilisation(bindings.fleet_trips(t.events))


@job
def dq_run_metrics(t: Tables) -> DataFrame:
    return rules.run_metrics(t.staged, "2024-01")


@job
def dq_run_drift(t: Tables) -> DataFrame:
    return rules.run_drift(fleet.daily_runs(t.staged), threshold=0.05)


def bound(fn: Job) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Tables(spark, folder))

    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: bound(fn) for name, fn in JOBS.items()}
