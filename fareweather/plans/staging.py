"""Silver: conformed, typed, UTC-normalised, flagged. No row is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULTS, Settings
from ..functions.conditions import is_snowing, is_wet, precipitation_band, rounded_int
from ..functions import contract
from ..functions.timecols import computed_once, hour_floor, seconds_between, utc_to_local
from ..operators.ranking import duplicate_rank, plain_rank
from ..operators.rules import TRIP_RULES, add_flags, add_validity

# Raw column, conformed column and kind. Times stay as they are: the
# contract reads text, naive and zoned timestamps alike.
TRIP_COLUMNS = (
    ("VendorID", "vendor_id", "int"),
    ("tpep_pickup_datetime", "pickup_local_raw", "time"),
    ("tpep_dropoff_datetime", "dropoff_local_raw", "time"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance_miles", "double"),
    ("PULocationID", "pickup_zone_id", "int"),
    ("DOLocationID", "dropoff_zone_id", "int"),
    ("fare_amount", "fare_amount", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("total_amount", "total_amount", "double"),
    ("payment_type", "payment_type", "int"),
)

# A duplicate is a row equal to another in these columns.
DUPLICATE_KEY = (
    "vendor_id", "pickup_utc", "dropoff_utc", "pickup_zone_id", "dropoff_zone_id", "total_amount",
)


def _typed(raw: str, name: str, kind: str) -> str:
    """Whole numbers are rounded half to even; what is no number becomes null."""
    cast = {
        "int": f"try_cast(rint(try_cast(`{raw}` AS DOUBLE)) AS INT)",
        "double": f"try_cast(`{raw}` AS DOUBLE)",
        "time": f"`{raw}`",
    }
    return f"{cast[kind]} AS {name}"


# Columns that identify a raw row and so settle the order of equal duplicates: an id,
# or the file and row it was read from.
IDENTITY = ("trip_id", "_ingested_from", "_ingested_row")


def conform_trips(raw: DataFrame) -> DataFrame:
    """Cast and rename; identity columns that exist are kept."""
    return raw.selectExpr(*_ties(raw), *[_typed(*column) for column in TRIP_COLUMNS])


def add_utc(trips: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """``pickup_utc``, ``dropoff_utc`` by the contract: a skipped wall clock is null, not shifted."""
    tz, years = settings.trip_source_tz, settings.zone_years
    picked = contract.add_utc(trips, "pickup_local_raw", tz, "pickup_utc", years)
    timed = contract.add_utc(picked, "dropoff_local_raw", tz, "dropoff_utc", years)
    return computed_once(timed, {c: F.col(c) for c in ("pickup_utc", "dropoff_utc")})


def add_derived(trips: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return trips.withColumns(
        {
            "duration_seconds": seconds_between("pickup_utc", "dropoff_utc"),
            "pickup_local": utc_to_local("pickup_utc", settings.reporting_tz, settings.zone_years),
            "pickup_hour_utc": hour_floor("pickup_utc"),
        }
    )


def flag_ranked(ranked: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Derived columns, flags and validity on ranked trips.

    They follow the rank so that a filter on validity reaches below it: rules on
    the duplicate key itself are applied before the rank's shuffle.
    """
    return add_validity(add_flags(add_derived(ranked, settings), TRIP_RULES, settings))


def _ties(trips: DataFrame) -> list[str]:
    return [c for c in IDENTITY if c in trips.columns]


def stage_trips(conformed: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The silver table: every trip with rank, flags and validity."""
    timed = add_utc(conformed, settings)
    ranked = duplicate_rank(timed, DUPLICATE_KEY, "trip_distance_miles", _ties(timed), settings=settings)
    return flag_ranked(ranked, settings)


def valid_trips(conformed: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Valid trips straight from conformed ones, equal to ``stage_trips`` filtered.

    The filter keeps rank 1 only, so Spark cuts each duplicate group to one row
    before the shuffle and a hot group needs no other care. The valid window,
    padded by two days as zones lie up to 26 hours apart, is stated on a raw wall clock as
    well, where the file scan can use it.
    """
    if isinstance(conformed.schema["pickup_local_raw"].dataType, T.TimestampNTZType):
        conformed = conformed.where(
            f"pickup_local_raw >= timestamp_ntz'{settings.min_valid_ts} 00:00:00' - INTERVAL 2 DAY "
            f"AND pickup_local_raw < timestamp_ntz'{settings.max_valid_ts} 00:00:00' + INTERVAL 2 DAY"
        )
    timed = add_utc(conformed, settings)
    ranked = plain_rank(timed, DUPLICATE_KEY, "trip_distance_miles", _ties(timed), "_dupe_rank")
    return flag_ranked(ranked, settings).where("is_valid")


def bronze_weather(raw: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Raw hours with the contract's four ``observed_at_*`` columns."""
    return contract.add_normalised(raw, "observed_at_raw", settings.weather_source_tz, prefix="observed_at", years=settings.zone_years)


def stage_weather(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per observed UTC hour with wet and snow flags and the band."""
    mm = F.col("precipitation").try_cast("double")
    cm = F.col("snowfall").try_cast("double")
    return bronze.where("observed_at_is_valid").select(
        "observed_at_utc",
        hour_floor("observed_at_utc").alias("observed_hour_utc"),
        F.col("temperature_2m").try_cast("double").alias("temperature_c"),
        F.col("apparent_temperature").try_cast("double").alias("apparent_temperature_c"),
        mm.alias("precipitation_mm"),
        cm.alias("snowfall_cm"),
        F.col("wind_speed_10m").try_cast("double").alias("wind_speed_kmh"),
        rounded_int("weather_code").alias("weather_code"),
        is_wet(mm, settings).alias("is_wet_hour"),
        is_snowing(cm).alias("is_snowing"),
        precipitation_band(mm, settings).alias("precipitation_band"),
    )


__all__ = [
    "DUPLICATE_KEY", "IDENTITY", "TRIP_COLUMNS", "add_derived", "add_utc", "bronze_weather", "conform_trips",
    "flag_ranked", "stage_trips", "stage_weather", "valid_trips",
]
