"""Trips, weather, zones and fleet messages derived from the test tables.

The test tables hold no trips. These recipes give ``events`` the raw schemas that
the jobs expect, by one projection each: no join, no window and no draw of random
numbers, so they cost a scan at any size. Some rows get a defect by their id,
because the tables have none; no row is left out. ``FIXTURES.md`` lists the
recipes and what they cover.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.timecols import add_seconds, hour_floor, iso_minutes, ntz
from ..plans import marts, staging

SETTINGS = Settings(
    min_valid_ts="2024-01-02",
    max_valid_ts="2024-01-30",
    unknown_zones=(23, 24),
    min_dry_baseline=0.5,
    min_revenue_trips=100,
)
AS_OF = "2024-01-30 12:00:00"
WEATHER_EVENT = "error"


def props_number() -> Column:
    """The number in ``{"k": n}``."""
    return F.get_json_object("props", "$.k").cast("int")


def _every(n: int, id_column: str = "event_id") -> Column:
    return F.col(id_column) % n == 0


def raw_trips(events: DataFrame) -> DataFrame:
    """Trip records in the publisher's schema, with defects and duplicates."""
    parts = events.where(F.col("event_type") != WEATHER_EVENT).select(
        "event_id", "ts", "user_id", "value", props_number().alias("k")
    )
    computed = parts.selectExpr(
        "event_id", "ts", "user_id", "k",
        "CASE WHEN event_id % 19 = 0 THEN -value ELSE value END"
        " + CASE WHEN event_id % 401 = 0 THEN 1000D ELSE 0D END AS fare",
        "CASE WHEN event_id % 97 = 0 THEN -60L WHEN event_id % 89 = 0 THEN 0L WHEN event_id % 61 = 0 THEN 90000L"
        " ELSE 60 + (event_id * 37 + user_id * 11) % 5400 END AS seconds",
        "CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN k + 500.5D ELSE k / 8D END AS miles",
        "k * 0.25D AS tip",
        "CASE WHEN k > 90 THEN 6.5D ELSE 0D END AS tolls",
        # The congestion charge is in the column and not in the total for one vehicle
        # in four, and the other way round for one in sixteen.
        "CASE WHEN user_id % 4 = 0 THEN 0D ELSE 2.5D END AS charged",
        "CASE WHEN user_id % 16 <> 1 THEN 2.5D END AS listed",
        "CASE WHEN user_id % 13 = 0 THEN 1.75D END AS airport",
    )
    # One row in fifty is delivered twice, the copy with a shorter distance.
    copied = computed.selectExpr("*", "explode(CASE WHEN event_id % 50 = 0 THEN array(0, 1) ELSE array(0) END) AS copy")
    return copied.selectExpr(
        "CASE WHEN copy = 1 THEN -event_id - 1 ELSE event_id END AS trip_id",
        "user_id % 2 + 1 AS VendorID",
        "ts AS tpep_pickup_datetime",
        "CASE WHEN event_id % 53 <> 0 THEN timestampadd(SECOND, seconds, ts) END AS tpep_dropoff_datetime",
        "CASE WHEN event_id % 31 <> 0 THEN CAST(user_id % 8 AS DOUBLE) END AS passenger_count",
        "miles - copy AS trip_distance",
        "user_id % 26 AS PULocationID",
        "(user_id * 7 + event_id) % 26 AS DOLocationID",
        "fare AS fare_amount",
        "0.5D AS extra",
        "0.5D AS mta_tax",
        "tip AS tip_amount",
        "tolls AS tolls_amount",
        "0.25D AS improvement_surcharge",
        "fare + 1.25D + tip + tolls + charged + coalesce(airport, 0D) AS total_amount",
        "listed AS congestion_surcharge",
        "airport AS Airport_fee",
        "user_id % 4 + 1 AS payment_type",
    )


def raw_weather(events: DataFrame) -> DataFrame:
    """One raw row per hour that has a weather event; values come from its first event."""
    first = F.min_by("value", "event_id")
    hourly = (
        events.where(F.col("event_type") == WEATHER_EVENT)
        .groupBy(hour_floor("ts").alias("_hour"))
        .agg(
            first.alias("_v"),
            F.min("event_id").alias("_id"),
            F.count(F.lit(1)).alias("_n"),
            F.min_by(props_number(), "event_id").alias("_k"),
        )
    )
    v = F.col("_v")
    rain = F.when(v < 20, F.lit(0.0)).otherwise((v - 20) / 20)
    return hourly.select(
        F.when(_every(59, "_id"), F.lit("not a date")).otherwise(iso_minutes("_hour")).alias("observed_at_raw"),
        (F.col("_k") / 4.0 - 5.0).alias("temperature_2m"),
        (F.col("_k") / 4.0 - 7.5).alias("apparent_temperature"),
        F.when(F.col("_k") != 7, rain).alias("precipitation"),
        F.when(F.col("_k") != 7, rain).alias("rain"),
        F.when(v >= 172, v / 100).otherwise(F.lit(0.0)).alias("snowfall"),
        F.col("_n").cast("double").alias("wind_speed_10m"),
        (F.col("_k") % 4).cast("int").alias("weather_code"),
        F.lit("test-events").alias("source"),
        F.lit(40.7128).alias("latitude"),
        F.lit(-74.006).alias("longitude"),
    )


def zone_lookup(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Zones: one row per nation, its region as the borough."""
    n, r = nation.alias("n"), region.alias("r")
    return n.join(r, F.col("n.n_regionkey") == F.col("r.r_regionkey"), "left").select(
        F.col("n.n_nationkey").alias("LocationID"),
        F.col("r.r_name").alias("Borough"),
        F.col("n.n_name").alias("Zone"),
        F.when(F.col("n.n_nationkey") % 5 == 0, F.lit("Airports")).otherwise(F.lit("Yellow Zone")).alias("service_zone"),
    )


def raw_times(events: DataFrame) -> DataFrame:
    """Text timestamps, one of twenty forms per event; the expected reason is known by construction."""
    second = F.substring(F.col("ts").cast("string"), 1, 19)
    year, month, day, minute, clock = (F.substring(second, a, n) for a, n in ((1, 4), (6, 2), (9, 2), (12, 5), (12, 8)))
    hour = F.hour("ts")
    clock12 = F.lpad((F.pmod(hour + 11, F.lit(12)) + 1).cast("string"), 2, "0")
    slashed = F.concat(
        month, F.lit("/"), day, F.lit("/"), year,
        F.lit(" "), clock12, F.substring(second, 14, 6), F.when(hour < 12, F.lit(" AM")).otherwise(F.lit(" PM")),
    )
    iso = F.replace(second, F.lit(" "), F.lit("T"))
    names = "January February March April May June July August September October November December".split()
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.month("ts"))
    weekday = F.element_at(F.array(*[F.lit(d) for d in "Sun Mon Tue Wed Thu Fri Sat".split()]), F.dayofweek("ts"))
    bare = lambda c: c.cast("int").cast("string")
    forms: list[Column] = [
        F.lit(None).cast("string"),
        F.lit("not a date"),
        F.lit("2002-01-01 00:00:00"),
        F.lit("2090-06-01 00:00:00"),
        F.lit("2024-03-10 02:30:00"),
        F.lit("2024-11-03 01:30:00"),
        second,
        iso,
        slashed,
        F.concat(iso, F.lit("+00:00")),
        F.concat(F.left(name, F.lit(3)), F.lit(" "), day, F.lit(" "), year, F.lit(" "), minute),
        F.concat(day, F.lit(" "), name, F.lit(" "), year),
        F.concat(year, month, day),
        F.concat(year, month, day, F.lit("T"), F.replace(clock, F.lit(":"), F.lit(""))),
        F.concat(month, F.lit("-"), day, F.lit("-"), year, F.lit(" "), clock),
        F.concat(bare(month), F.lit("/"), bare(day), F.lit("/"), F.right(year, F.lit(2)), F.lit(" "), bare(F.left(clock, F.lit(2))), F.substring(clock, 3, 3)),
        F.substring(iso, 1, 13),
        F.concat(year, F.lit("."), month, F.lit("."), day, F.lit(" "), minute),
        F.substring(second, 1, 7),
        F.concat(weekday, F.lit(", "), day, F.lit(" "), F.left(name, F.lit(3)), F.lit(" "), year, F.lit(" "), clock, F.lit(" +0000")),
    ]
    raw = forms[-1]
    for i in range(len(forms) - 2, -1, -1):
        raw = F.when(F.col("event_id") % len(forms) == i, forms[i]).otherwise(raw)
    return events.select("event_id", raw.alias("raw_time"))


def fleet_messages(events: DataFrame) -> DataFrame:
    """Vehicle messages: event and arrival time, position, payload, command fields."""
    k = props_number()
    cut = F.substring(F.col("props"), 1, 4)
    return events.select(
        F.col("event_id").alias("message_id"),
        F.col("user_id").alias("vehicle_id"),
        F.col("ts").alias("event_utc"),
        add_seconds("ts", F.pmod(F.col("event_id"), F.lit(10)).cast("bigint") * 60).alias("ingest_utc"),
        F.pmod(F.col("user_id") + k, F.lit(25)).cast("int").alias("zone_id"),
        F.col("event_type").alias("message_type"),
        F.col("value").alias("reading"),
        k.alias("speed"),
        F.when(_every(20), cut).otherwise(F.col("props")).alias("payload"),
        F.col("event_id").alias("version"),
        add_seconds("ts", F.lit(21_600).cast("bigint")).alias("expires_utc"),
        _every(13).alias("is_nacked"),
    )


def fleet_trips(events: DataFrame) -> DataFrame:
    """Trip ends per vehicle, for fraud features and utilisation."""
    return events.where(F.col("event_type") != WEATHER_EVENT).select(
        F.col("event_id").alias("trip_id"),
        F.col("user_id").alias("vehicle_id"),
        F.col("ts").alias("started_utc"),
        F.pmod(F.col("user_id") + props_number(), F.lit(25)).cast("int").alias("zone_id"),
        F.col("value").alias("fare"),
        (props_number() / 8.0).alias("miles"),
        (60 + F.pmod(F.col("event_id") * 37 + F.col("user_id") * 11, F.lit(5400))).alias("seconds"),
    )


def receipt_deliveries(raw: DataFrame) -> DataFrame:
    """Trips as delivered: a repeated trip has its id again and a later delivery number."""
    is_copy = F.col("trip_id") < 0
    return raw.select(
        F.when(is_copy, -F.col("trip_id") - 1).otherwise(F.col("trip_id")).alias("trip_id"),
        F.when(is_copy, F.lit(1)).otherwise(F.lit(0)).alias("delivery"),
        F.col("tpep_pickup_datetime").alias("ended_utc"),
        F.col("trip_distance").alias("miles"),
        F.col("total_amount"),
    )


def observations(events: DataFrame, event_type: str, measure: str = "temperature_c") -> DataFrame:
    """Conditions per zone and hour, as one of several weather sources has them."""
    return (
        events.where(F.col("event_type") == event_type)
        .groupBy(F.pmod(F.col("user_id"), F.lit(25)).cast("int").alias("zone_id"), hour_floor("ts").alias("hour_utc"))
        .agg(F.round(F.avg("value"), 4).alias(measure), F.count(F.lit(1)).alias("readings"))
    )


# Schemas of the test tables that jobs read, so that no job runs to infer them.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}


@dataclass(frozen=True)
class Tables:
    """The test tables of one folder and everything derived from them, all lazy."""

    spark: SparkSession
    folder: str
    settings: Settings = SETTINGS

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder.rstrip('/')}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def raw_trips(self) -> DataFrame:
        return raw_trips(self.events)

    @cached_property
    def conformed(self) -> DataFrame:
        return staging.conform_trips(self.raw_trips)

    @cached_property
    def staged(self) -> DataFrame:
        """Every trip, flagged."""
        return staging.stage_trips(self.conformed, self.settings)

    @cached_property
    def valid(self) -> DataFrame:
        return staging.valid_trips(self.conformed, self.settings)

    @cached_property
    def raw_weather(self) -> DataFrame:
        return raw_weather(self.events)

    @cached_property
    def bronze_weather(self) -> DataFrame:
        return staging.bronze_weather(self.raw_weather, self.settings)

    @cached_property
    def weather(self) -> DataFrame:
        return staging.stage_weather(self.bronze_weather, self.settings)

    @cached_property
    def zones(self) -> DataFrame:
        return zone_lookup(self.table("nation"), self.table("region"))

    @cached_property
    def facts(self) -> DataFrame:
        return marts.trip_facts(self.valid, self.weather, self.zones, self.settings)

    @cached_property
    def mart(self) -> DataFrame:
        return marts.with_lift(marts.mart_cells(self.valid, self.weather, self.zones))

    @cached_property
    def messages(self) -> DataFrame:
        return fleet_messages(self.events)

    @property
    def as_of(self) -> Column:
        return ntz(AS_OF)
