"""Questions asked of the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..functions.conditions import amount_parts, mean_of_parts, short_label, sum_amount
from ..operators.profile import matrix


def _parts(trips: DataFrame) -> DataFrame:
    """Trip cells as they are, or facts as cells of one trip each."""
    return trips if "_total_exact" in trips.columns else trips.withColumns({"trips": F.lit(1).cast("bigint"), **amount_parts("total_amount", "_total")})


def _demand(trips: DataFrame, *keys: str) -> DataFrame:
    return _parts(trips).groupBy(*keys).agg(F.sum("trips").alias("trips"), mean_of_parts("_total").alias("avg_fare"))


def demand_by_band(trips: DataFrame) -> DataFrame:
    """Trips and mean total per precipitation band, busiest first; hours without a band count too.

    ``trips``: facts, or trip cells with conditions.
    """
    return _demand(trips, "precipitation_band").orderBy(F.desc("trips"), F.asc_nulls_last("precipitation_band"))


def demand_by_hour_of_week(trips: DataFrame) -> DataFrame:
    """Trips and mean total per local hour of the week, of facts or trip cells; needs no join."""
    return _demand(trips, "pickup_day_of_week", "pickup_hour_of_day").orderBy(
        F.asc_nulls_last("pickup_day_of_week"), F.asc_nulls_last("pickup_hour_of_day")
    )


def demand_matrix(trips: DataFrame) -> DataFrame:
    """Mean trips per hour of day (rows) and day of week (columns ``dow_0`` to ``dow_6``)."""
    per_hour = demand_by_hour_of_week(trips)
    return matrix(per_hour, "pickup_hour_of_day", "pickup_day_of_week", range(7), F.avg("trips"), "dow_")


def _wet_lift(mart: DataFrame, settings: Settings) -> DataFrame:
    """Mean lift per zone over its wet cells, where baseline and number of cells suffice."""
    return (
        mart.where(F.col("is_wet_hour") & (F.col("dry_baseline_trips") > settings.min_dry_baseline))
        .groupBy("pickup_zone", "pickup_borough")
        .agg(F.avg("demand_lift_vs_dry").alias("_lift"), F.count(F.lit(1)).alias("observations"))
        .where(F.col("observations") > settings.min_observations)
    )


def _ranked_lift(mart: DataFrame, settings: Settings, order: Column, top: int) -> DataFrame:
    return (
        _wet_lift(mart, settings)
        .select("pickup_zone", "pickup_borough", F.round("_lift", 3).alias("avg_lift"), "observations")
        .orderBy(order, F.asc("pickup_zone"), F.asc("pickup_borough"))
        .limit(top)
    )


def top_wet_lift(mart: DataFrame, settings: Settings = DEFAULTS, top: int = 20) -> DataFrame:
    """Zones that gain most in wet hours, with a label cut for a chart axis."""
    ranked = _ranked_lift(mart, settings, F.desc_nulls_last("avg_lift"), top)
    return ranked.withColumn("label", short_label("pickup_zone"))


def bottom_wet_lift(mart: DataFrame, settings: Settings = DEFAULTS, top: int = 20) -> DataFrame:
    """Zones that lose most in wet hours."""
    return _ranked_lift(mart, settings, F.asc_nulls_last("avg_lift"), top)


def headline(mart: DataFrame, settings: Settings = DEFAULTS, top: int = 5) -> DataFrame:
    """The strongest zones by unrounded lift, shown in percent."""
    return (
        _wet_lift(mart, settings)
        .orderBy(F.desc_nulls_last("_lift"), F.asc("pickup_zone"), F.asc("pickup_borough"))
        .limit(top)
        .select(
            "pickup_zone", "pickup_borough",
            F.round(F.col("_lift") * 100, 1).alias("lift_pct"), "observations",
        )
    )


def revenue_wet_dry(mart: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Trips and revenue per zone in wet, dry and unobserved hours, for busy zones."""
    return (
        mart.groupBy("pickup_zone", "pickup_borough", "is_wet_hour")
        .agg(F.sum("trips").alias("trips"), sum_amount("revenue").alias("revenue"))
        .where(F.col("trips") > settings.min_revenue_trips)
        .orderBy(
            F.asc_nulls_last("pickup_borough"), F.asc_nulls_last("pickup_zone"), F.asc_nulls_last("is_wet_hour")
        )
    )


def speed_wet_dry(mart: DataFrame) -> DataFrame:
    """Cells, trips and mean speed in wet, dry and unobserved hours."""
    return mart.groupBy("is_wet_hour").agg(
        F.count(F.lit(1)).alias("cells"),
        F.sum("trips").alias("trips"),
        F.round(F.avg("avg_speed_mph"), 4).alias("avg_speed_mph"),
    )
