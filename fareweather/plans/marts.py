"""Gold: trip facts and the zone-hour demand mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..functions.conditions import amount_parts, greatest_band, merged_parts, speed_mph
from ..functions.conditions import worst_band as most_severe
from ..functions.timecols import day_of_week, hour_of_day, local_date
from ..operators.joins import attach_hour_conditions, attach_zone_roles

# Columns of the two gold tables.
FACT_COLUMNS = (
    "vendor_id", "pickup_utc", "pickup_local", "pickup_hour_utc", "duration_seconds",
    "trip_distance_miles", "passenger_count", "fare_amount", "tip_amount", "total_amount",
    "pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough",
    "temperature_c", "precipitation_mm", "precipitation_band", "is_wet_hour", "is_snowing", "wind_speed_kmh",
    "pickup_hour_of_day", "pickup_day_of_week", "pickup_date_local",
)
CELL = ("pickup_zone", "pickup_borough", "pickup_date_local", "pickup_hour_of_day", "pickup_day_of_week")
WEATHER_ON_FACTS = (
    "observed_hour_utc", "temperature_c", "precipitation_mm", "precipitation_band",
    "is_wet_hour", "is_snowing", "wind_speed_kmh",
)


def add_time_parts(trips: DataFrame) -> DataFrame:
    """Local hour, day of week (Sunday 0) and date of the pickup."""
    return trips.withColumns(
        {
            "pickup_hour_of_day": hour_of_day("pickup_local"),
            "pickup_day_of_week": day_of_week("pickup_local"),
            "pickup_date_local": local_date("pickup_local"),
        }
    )


def trip_facts(
    trips: DataFrame, weather: DataFrame, zones: DataFrame, settings: Settings = DEFAULTS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per valid trip with its hour's conditions and both zones.

    ``trips`` are staged trips, all or valid only; ``keep`` names extra columns.
    """
    valid = trips.where("is_valid")
    hourly = attach_hour_conditions(valid, weather.select(*WEATHER_ON_FACTS), settings)
    zoned = attach_zone_roles(hourly, zones, settings)
    return add_time_parts(zoned).select(*keep, *FACT_COLUMNS)


# What trips are grouped by before any join: what the dimensions join on, and the local time.
TRIP_CELL = ("pickup_hour_utc", "pickup_zone_id", "pickup_date_local", "pickup_hour_of_day", "pickup_day_of_week")


def trip_cells(trips: DataFrame, keys: tuple[str, ...] = TRIP_CELL) -> DataFrame:
    """Valid trips grouped by ``keys``: their number and sums, which may be grouped further.

    Grouping comes before joining: a join then sees a row for each hour and zone, however many trips
    there were, and Spark drops the sums that a question doesn't use.
    """
    speed = speed_mph("trip_distance_miles", "duration_seconds")
    parts = {"_speed": speed, **amount_parts("total_amount", "_total")}
    return (
        add_time_parts(trips.where("is_valid")).withColumns(parts).groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("total_amount").alias("_revenue"),
            F.sum("duration_seconds").alias("_seconds"), F.count("duration_seconds").alias("_timed"),
            F.sum("_speed").alias("_speed"), F.count("_speed").alias("_paced"),
            F.sum("trip_distance_miles").alias("_miles"), F.count("trip_distance_miles").alias("_measured"),
            *merged_parts("_total"),
        )
    )


def with_conditions(cells: DataFrame, weather: DataFrame) -> DataFrame:
    """Cells with their hour's conditions; one row each, as an hour is observed once.

    Cells are few, so the join is left to the sizes that Spark finds as it runs.
    """
    return cells.join(weather.select(*WEATHER_ON_FACTS).withColumnRenamed("observed_hour_utc", "pickup_hour_utc"), "pickup_hour_utc", "left")


def with_pickup_zone(cells: DataFrame, zones: DataFrame) -> DataFrame:
    """Cells with the name and borough of their pickup zone."""
    named = zones.select(F.col("LocationID").cast("int").alias("pickup_zone_id"), F.col("Zone").alias("pickup_zone"), F.col("Borough").alias("pickup_borough"))
    return cells.join(named, "pickup_zone_id", "left")


def mart_cells(trips: DataFrame, weather: DataFrame, zones: DataFrame) -> DataFrame:
    """``observed_cells`` straight from valid trips, grouped before the joins; no trip is joined by itself."""
    joined = with_pickup_zone(with_conditions(trip_cells(trips), weather), zones).where(F.col("pickup_zone").isNotNull())
    warm = F.col("temperature_c").isNotNull()
    return joined.groupBy(*CELL).agg(
        greatest_band("precipitation_band").alias("precipitation_band"),
        F.bool_or("is_wet_hour").alias("is_wet_hour"),
        F.try_divide(F.sum(F.col("temperature_c") * F.col("trips")), F.sum(F.when(warm, F.col("trips")))).alias("temperature_c"),
        F.sum("trips").alias("trips"),
        F.sum("_revenue").alias("revenue"),
        F.try_divide(F.sum("_seconds"), F.sum("_timed")).alias("avg_duration_seconds"),
        F.try_divide(F.sum("_speed"), F.sum("_paced")).alias("avg_speed_mph"),
    )


def observed_cells(facts: DataFrame) -> DataFrame:
    """Trips, revenue, duration, speed and conditions per zone and local hour.

    ``precipitation_band`` is the greatest band name, not the worst band; see
    ``worst_band`` for that.
    """
    return (
        facts.where(F.col("pickup_zone").isNotNull())
        .groupBy(*CELL)
        .agg(
            greatest_band("precipitation_band").alias("precipitation_band"),
            F.bool_or("is_wet_hour").alias("is_wet_hour"),
            F.avg("temperature_c").alias("temperature_c"),
            F.count(F.lit(1)).alias("trips"),
            F.sum("total_amount").alias("revenue"),
            F.avg("duration_seconds").alias("avg_duration_seconds"),
            F.avg(speed_mph("trip_distance_miles", "duration_seconds")).alias("avg_speed_mph"),
        )
    )


def zone_hour_demand(facts: DataFrame) -> DataFrame:
    """Cells of stored facts with the dry baseline and the lift over it; see ``with_lift``."""
    return with_lift(observed_cells(facts))


def with_lift(cells: DataFrame) -> DataFrame:
    """Cells with the dry baseline of the same zone and hour of week, and the lift over it.

    The baseline is an average over a window of the already grouped cells: a
    window holds one cell per date and borough, whatever the number of trips.
    """
    same_hour_of_week = Window.partitionBy("pickup_zone", "pickup_day_of_week", "pickup_hour_of_day")
    baseline = F.avg(F.when(~F.col("is_wet_hour"), F.col("trips"))).over(same_hour_of_week)
    lift = (F.col("trips") - F.col("dry_baseline_trips")) / F.col("dry_baseline_trips")
    return cells.withColumn("dry_baseline_trips", baseline).withColumn(
        "demand_lift_vs_dry", F.when(F.col("dry_baseline_trips") > 0, lift)
    )


def dry_baseline(cells: DataFrame) -> DataFrame:
    """The baseline as its own table: one row per zone and hour of week."""
    return cells.groupBy("pickup_zone", "pickup_day_of_week", "pickup_hour_of_day").agg(
        F.avg(F.when(~F.col("is_wet_hour"), F.col("trips"))).alias("dry_baseline_trips")
    )


def worst_band(facts: DataFrame) -> DataFrame:
    """Per cell both the greatest band name and the band of greatest severity; facts, or trip cells with conditions and zone."""
    return (
        facts.where(F.col("pickup_zone").isNotNull())
        .groupBy(*CELL)
        .agg(
            greatest_band("precipitation_band").alias("max_band_name"),
            most_severe("precipitation_band").alias("worst_band"),
        )
    )
