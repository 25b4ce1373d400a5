"""Fleet jobs. Each works on a batch and, where marked, on a stream unchanged.

Groupings combine before their shuffle, so a vehicle that sends a third of all
messages is one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULTS, Settings
from ..functions.conditions import amount_parts, merged_parts, percent_of, sum_of_parts
from ..functions.timecols import add_seconds, floor_to, local_date, seconds_between
from ..operators.joins import attach
from ..operators.ranking import first_per_key
from .marts import trip_cells, with_pickup_zone

# Freshness limits per workload, in seconds.
FRESHNESS_SLA = (("receipts", 30), ("fraud", 5), ("dashboards", 3600))
LATE_AFTER_SECONDS = 300


# -- fraud ---------------------------------------------------------------------


def _windowed(df: DataFrame, time: str, length: str, slide: str, keys: list[str], *aggs: Column) -> DataFrame:
    grouped = df.groupBy(F.window(time, length, slide), *keys).agg(*aggs)
    rest = [c for c in grouped.columns if c != "window"]
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def fraud_features(
    trips: DataFrame, time: str = "started_utc", length: str = "1 hour", slide: str = "30 minutes", short_miles: float = 1.0
) -> DataFrame:
    """Batch or stream. Per vehicle and sliding window: trips, fare, miles, short trips."""
    return _windowed(
        trips, time, length, slide, ["vehicle_id"],
        F.count(F.lit(1)).alias("trips"),
        F.sum("fare").alias("fare"),
        F.sum("miles").alias("miles"),
        F.count_if(F.col("miles") < short_miles).alias("short_trips"),
    ).withColumn("fare_per_mile", F.when(F.col("miles") > 0, F.col("fare") / F.col("miles")))


def repeated_short_trips(
    trips: DataFrame, time: str = "started_utc", length: str = "1 hour", slide: str = "30 minutes",
    short_miles: float = 1.0, at_least: int = 2,
) -> DataFrame:
    """Batch or stream. Vehicles with several short trips from one zone in a window."""
    short = trips.where(F.col("miles") < short_miles)
    return _windowed(
        short, time, length, slide, ["vehicle_id", "zone_id"], F.count(F.lit(1)).alias("short_trips")
    ).where(F.col("short_trips") >= at_least)


def fraud_rule_hits(
    features: DataFrame, max_trips: int = 3, max_fare_per_mile: float = 100.0, max_short: int = 1
) -> DataFrame:
    """Batch or stream. One row per window, vehicle and rule that holds."""
    rules = F.array(
        F.when(F.col("trips") > max_trips, F.lit("many_trips")),
        F.when(F.col("fare_per_mile") > max_fare_per_mile, F.lit("fare_far_above_distance")),
        F.when(F.col("short_trips") > max_short, F.lit("repeated_short_trips")),
    )
    return features.select("window_start", "window_end", "vehicle_id", F.explode(F.array_compact(rules)).alias("rule"))


# -- telemetry -----------------------------------------------------------------


def with_lane(df: DataFrame, event: str = "event_utc", ingest: str = "ingest_utc", limit: int = LATE_AFTER_SECONDS) -> DataFrame:
    """Batch or stream. Delay in seconds and ``lane``: on_time or late.

    Decided per row from its own two times, so a batch and a stream agree and no
    late row is lost to a watermark.
    """
    delay = seconds_between(event, ingest)
    return df.withColumn("delay_seconds", delay).withColumn(
        "lane", F.when(F.col("delay_seconds") > limit, F.lit("late")).otherwise(F.lit("on_time"))
    )


def downsample(df: DataFrame, time: str = "event_utc", seconds: int = 60, slot: Column | None = None) -> DataFrame:
    """Batch. Per vehicle and slot: first and mean reading, and how many.

    ``message_id`` is the vehicle's running number and so gives the order.
    """
    first = F.min_by("reading", "message_id")
    return df.groupBy("vehicle_id", (slot if slot is not None else floor_to(time, seconds)).alias("slot_utc")).agg(
        first.alias("first_reading"), F.avg("reading").alias("avg_reading"), F.count(F.lit(1)).alias("readings")
    )


def retention_tiers(
    df: DataFrame, as_of: Column, full_days: int = 30, minute_days: int = 365, time: str = "event_utc"
) -> DataFrame:
    """Batch. Recent rows whole, older ones per minute, the oldest gone.

    The tiers are time ranges on the stored column, so each reads its own part of
    the files only.
    """
    day = 86_400
    hot_from, warm_from = add_seconds(as_of, -full_days * day), add_seconds(as_of, -minute_days * day)
    hot = df.where(F.col(time) >= hot_from).select(
        F.lit("full").alias("tier"), "vehicle_id", F.col(time).alias("at_utc"),
        F.col("reading"), F.lit(1).cast("bigint").alias("readings"),
    )
    aged = df.where((F.col(time) < hot_from) & (F.col(time) >= warm_from))
    warm = downsample(aged, time).select(
        F.lit("minute").alias("tier"), "vehicle_id", F.col("slot_utc").alias("at_utc"),
        F.col("avg_reading").alias("reading"), "readings",
    )
    return hot.unionByName(warm)


def last_seen(df: DataFrame, as_of: Column, time: str = "event_utc") -> DataFrame:
    """Batch. Per vehicle the last message up to ``as_of`` and its age."""
    seen = df.where(F.col(time) <= as_of).groupBy("vehicle_id").agg(F.max(time).alias("last_seen_utc"))
    return seen.withColumn("silent_seconds", seconds_between("last_seen_utc", as_of))


def connectivity(df: DataFrame, as_of: Column, within_seconds: int = 300) -> DataFrame:
    """Batch. One row: vehicles, how many reported lately, and their share."""
    connected = F.count_if(F.col("silent_seconds") <= within_seconds)
    total = F.count(F.lit(1))
    return last_seen(df, as_of).agg(
        total.alias("vehicles"), connected.alias("connected"), percent_of(connected, total).alias("connected_pct")
    )


def outages(df: DataFrame, as_of: Column, after_seconds: int = 6 * 3600) -> DataFrame:
    """Batch. Vehicles silent for longer than ``after_seconds``."""
    return last_seen(df, as_of).where(F.col("silent_seconds") > after_seconds)


def with_parse_lane(df: DataFrame, payload: str = "payload", schema: str = "k INT") -> DataFrame:
    """Batch or stream. Parsed payload and ``lane``: accepted or dead_letter."""
    struct = T.StructType.fromDDL(schema)
    fields = struct.fieldNames()
    parsed = F.from_json(
        F.col(payload), T.StructType([*struct.fields, T.StructField("_corrupt", T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )
    bad = F.col("_parsed").isNull() | F.col("_parsed._corrupt").isNotNull()
    return (
        df.withColumn("_parsed", parsed)
        .withColumn("lane", F.when(bad, F.lit("dead_letter")).otherwise(F.lit("accepted")))
        .withColumns({f: F.when(~bad, F.col(f"_parsed.`{f}`")) for f in fields})
        .drop("_parsed")
    )


# -- commands and receipts -----------------------------------------------------


def current_commands(commands: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Batch or stream. Per vehicle its highest version, unless that is nacked or, at ``as_of``, expired.

    A command is nacked only where that is known. A superseded command never comes back. Of rows with one version the one with the
    greatest ``message_id``, where there is one, and then the greatest values counts.
    """
    if as_of is not None:
        commands = commands.where(F.col("event_utc") <= as_of)
    order = [c for c in ("version", "message_id", "event_utc", "expires_utc", "zone_id", "is_nacked") if c in commands.columns]
    last = commands.groupBy("vehicle_id").agg(F.max(F.struct(*order)).alias("_last"))
    live = last.where(~F.coalesce(F.col("_last.is_nacked"), F.lit(False)))
    if as_of is not None:
        live = live.where(F.col("_last.expires_utc") > as_of)
    return live.select(
        "vehicle_id", "_last.version", "_last.zone_id", F.col("_last.event_utc").alias("issued_utc"), "_last.expires_utc"
    )


def receipts_once(deliveries: DataFrame) -> DataFrame:
    """Batch. One receipt per trip, the first delivery, however often it repeats."""
    return first_per_key(deliveries, ["trip_id"], "delivery")


# -- placement -----------------------------------------------------------------


def hot_zones(mart: DataFrame, settings: Settings = DEFAULTS, min_lift: float = 0.0) -> DataFrame:
    """Zones whose mean lift in wet hours is above ``min_lift``."""
    wet = mart.where(F.col("is_wet_hour") & (F.col("dry_baseline_trips") > settings.min_dry_baseline))
    return (
        wet.groupBy(F.col("pickup_zone").alias("zone"))
        .agg(F.avg("demand_lift_vs_dry").alias("avg_lift"), F.count(F.lit(1)).alias("observations"))
        .where((F.col("avg_lift") > min_lift) & (F.col("observations") > settings.min_observations))
    )


def last_positions(messages: DataFrame) -> DataFrame:
    """Batch or stream. Zone and time of each vehicle's last message, by its running number."""
    return messages.groupBy("vehicle_id").agg(
        F.max_by("zone_id", "message_id").alias("zone_id"), F.max_by("event_utc", "message_id").alias("at_utc")
    )


def hotspot_candidates(
    positions: DataFrame, zones: DataFrame, hot: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Batch or stream against static zones. Vehicles whose last zone is hot."""
    named = zones.select(F.col("LocationID").cast("int").alias("zone_id"), F.col("Zone").alias("zone"))
    # Zones and hot zones are both a row a zone, joined first; positions are a row a vehicle.
    return positions.join(named.join(hot, "zone"), "zone_id").select(*[c for c in positions.columns], *hot.columns)


# -- erasure and regions -------------------------------------------------------


def erase_tokens(df: DataFrame, tokens: DataFrame, key: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Batch or stream. Rows whose subject is not on the erasure list."""
    return attach(df, tokens.select(key).distinct(), [key], settings, how="left_anti")


def regional_rollup(orders: DataFrame, customers: DataFrame, nations: DataFrame, regions: DataFrame) -> DataFrame:
    """Batch. Orders and revenue per region and month; no id leaves the region.

    Orders are grouped per customer and month before the join, so the join sees
    each customer once a month, however many orders there are.
    """
    month = F.substring(F.col("o_orderdate").cast("string"), 1, 7)
    per_customer = orders.withColumns(amount_parts("o_totalprice", "_r")).groupBy(F.col("o_custkey").alias("c_custkey"), month.alias("month")).agg(
        F.count(F.lit(1)).alias("_n"), *merged_parts("_r")
    )
    located = per_customer.join(customers.select("c_custkey", "c_nationkey"), "c_custkey", "left")
    named = attach(located, nations.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), ["c_nationkey"])
    named = attach(named, regions.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")), ["n_regionkey"])
    return named.groupBy("region", "month").agg(
        F.sum("_n").cast("bigint").alias("orders"), sum_of_parts("_r").alias("revenue")
    )


# -- management ----------------------------------------------------------------


def freshness_by_workload(df: DataFrame, loaded_at: str, as_of: Column) -> DataFrame:
    """Batch. Each workload's limit against the age of the latest row."""
    limits = F.array(*[F.struct(F.lit(w).alias("workload"), F.lit(s).cast("bigint").alias("limit_seconds")) for w, s in FRESHNESS_SLA])
    latest = df.agg(F.max(loaded_at).alias("latest")).withColumn("age_seconds", seconds_between("latest", as_of))
    return latest.select("latest", "age_seconds", F.inline(limits)).withColumn(
        "is_met", F.coalesce(F.col("age_seconds") <= F.col("limit_seconds"), F.lit(False))
    )


def city_metrics(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Batch. Per city, the borough of the pickup zone: trips, revenue, mean miles, and exact duration quantiles, of valid trips.

    Trips are grouped by zone and duration before the join. Durations of valid trips are whole seconds up
    to a day, so a quantile weighs at most 86,400 values per city.
    """
    cells = with_pickup_zone(trip_cells(trips, ("pickup_zone_id", "duration_seconds")), zones)
    return cells.groupBy(F.col("pickup_borough").alias("city")).agg(
        F.sum("trips").alias("trips"),
        sum_of_parts("_total").alias("revenue"),
        F.round(F.try_divide(F.sum("_miles"), F.sum("_measured")), 4).alias("avg_miles"),
        F.percentile("duration_seconds", 0.5, F.col("trips")).alias("median_seconds"),
        F.percentile("duration_seconds", 0.9, F.col("trips")).alias("p90_seconds"),
    )


def trip_length_distribution(trips: DataFrame, bin_miles: float = 1.0) -> DataFrame:
    """Batch. Valid trips, or facts, per mile bin, with the share of all.

    The total is taken over the bins, of which a valid distance allows a few hundred.
    """
    low = F.floor(F.col("trip_distance_miles") / bin_miles) * bin_miles
    binned = trips.groupBy(low.cast("double").alias("from_miles")).agg(F.count(F.lit(1)).alias("trips"))
    total = F.sum("trips").over(Window.partitionBy())
    return binned.withColumn("share_pct", percent_of(F.col("trips"), total, 4))


def utilisation(trips: DataFrame) -> DataFrame:
    """Batch. Per vehicle: busy seconds over the seconds from first start to last end.

    Overlapping trips count in full, so the share may pass 100.
    """
    end = add_seconds("started_utc", F.col("seconds"))
    spans = trips.groupBy("vehicle_id").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("seconds").alias("busy_seconds"),
        F.min("started_utc").alias("_from"),
        F.max(end).alias("_to"),
    )
    span = seconds_between("_from", "_to")
    return spans.select(
        "vehicle_id", "trips", "busy_seconds", span.alias("span_seconds"),
        percent_of(F.col("busy_seconds"), span).alias("utilisation_pct"),
    )


def daily_runs(staged: DataFrame) -> DataFrame:
    """Batch. Rows in, passed and quarantined per layer and local day, as run metrics."""
    per_day = staged.groupBy(local_date("pickup_local_raw").alias("run_date")).agg(
        F.count(F.lit(1)).alias("_in"), F.count_if("is_valid").alias("_ok")
    )
    layers = F.array(
        F.struct(F.lit("bronze").alias("layer"), F.col("_in").alias("rows_in")),
        F.struct(F.lit("gold").alias("layer"), F.col("_ok").alias("rows_in")),
    )
    return per_day.select("run_date", F.inline(layers))
