import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareweather.functions.timecols import ntz
from fareweather.plans import build, insights
from fareweather.sources import files, months

RAW_TRIP = (
    "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, {pc}, "
    "trip_distance double, PULocationID long, DOLocationID long, fare_amount double, extra double, mta_tax double, "
    "tip_amount double, tolls_amount double, improvement_surcharge double, total_amount double, "
    "congestion_surcharge double, {fee} double, payment_type long"
)


def synthetic_trips():
    """Eighteen trips of our own, every 40 minutes, each total the sum of its parts."""
    start = datetime(2024, 1, 15, 9)
    zones = (4, 79, 107, 140, 138)
    rows = []
    for i in range(18):
        at, fare, tip = start + timedelta(minutes=40 * i), 6.0 + i, 0.25 * (i % 4)
        rows.append((
            i % 2 + 1, at, at + timedelta(minutes=12), i % 4 + 1, 0.75 + 0.5 * i, zones[i % 5], zones[(i + 2) % 5], fare, 0.5, 0.5,
            tip, 0.0, 0.3, fare + tip + 1.3, 2.5, 0.0, i % 2 + 1,
        ))
    return rows


ZONES = """LocationID,Borough,Zone,service_zone
4,Manhattan,East Park,Yellow Zone
79,Manhattan,East Hill,Yellow Zone
107,Manhattan,Grove,Yellow Zone
140,Manhattan,East Bank,Yellow Zone
138,Queens,North Field,Airports
264,Unknown,Unknown,N/A
"""


def synthetic_weather():
    """Thirty hours, the last three wet."""
    first = datetime(2024, 1, 15)
    return [
        ((first + timedelta(hours=i)).strftime("%Y-%m-%dT%H:%M"), 4.0 - 0.1 * i, 1.0, 0.0 if i < 27 else 2.25,
         0.0 if i < 27 else 2.0, 0.0, 7.5, 3 if i < 27 else 63, "own", 40.7, -74.0)
        for i in range(30)
    ]


WEATHER = (
    "observed_at_raw string, temperature_2m double, apparent_temperature double, precipitation double, rain double, "
    "snowfall double, wind_speed_10m double, weather_code long, source string, latitude double, longitude double"
)


@pytest.fixture
def landed(spark, tmp_path):
    rows = synthetic_trips()
    parts = {"a": (rows[:10], "passenger_count long", "Airport_fee"), "b": (rows[10:], "passenger_count double", "airport_fee")}
    for name, (part, pc, fee) in parts.items():
        part = [r[:3] + (float(r[3]) if "double" in pc else r[3],) + r[4:] for r in part]
        spark.createDataFrame(part, RAW_TRIP.format(pc=pc, fee=fee)).write.parquet(str(tmp_path / "raw" / name))
    spark.createDataFrame(synthetic_weather(), WEATHER).write.parquet(str(tmp_path / "raw" / "weather"))
    (tmp_path / "zones.csv").write_text(ZONES)
    return tmp_path


def run_build(spark, landed):
    return build.build_all(
        spark, [str(landed / "raw" / "a"), str(landed / "raw" / "b")], [str(landed / "raw" / "weather")],
        str(landed / "zones.csv"), str(landed / "tables"),
    )


def test_build_on_synthetic_data(spark, landed):
    tables = run_build(spark, landed)
    assert set(tables) == {name for names in build.TABLES.values() for name in names}
    assert {n: df.count() for n, df in tables.items()} == {
        "trips": 18, "weather": 30, "taxi_zones": 6, "stg_trips": 18, "stg_weather": 30, "fct_trips": 18,
        "agg_zone_hour_demand": 18, "dq_report_header": 1, "dq_report_findings": 14, "silver_trips_quarantine": 0, "dq_rule_counts": 13,
    }
    assert {r.violations for r in build.layer_checks(tables).collect()} == {0}
    facts = tables["fct_trips"]
    first = facts.orderBy("pickup_utc").first()
    assert first.pickup_utc == datetime(2024, 1, 15, 14) and first.pickup_zone == "East Park"
    assert (first.pickup_hour_of_day, first.pickup_day_of_week, first.duration_seconds) == (9, 1, 720)
    assert facts.where("precipitation_band is null").count() == 0
    # Nine in the morning to 20:20 in New York is 14:00 to 01:20 UTC: all dry.
    assert [tuple(r)[:2] for r in insights.demand_by_band(facts).collect()] == [("dry", 18)]
    build.register_views(tables)
    assert spark.sql("SELECT count(*) FROM agg_zone_hour_demand WHERE NOT is_wet_hour").first()[0] == 18
    assert run_build(spark, landed)["fct_trips"].count() == 18, "a second run replaces, it does not add"


def test_build_stops_on_a_repeated_hour(spark, landed):
    spark.createDataFrame(synthetic_weather()[:1], WEATHER).write.mode("append").parquet(str(landed / "raw" / "weather"))
    with pytest.raises(build.CheckFailed):
        run_build(spark, landed)


def test_a_failing_check_stops_gold_and_keeps_the_tables_before(spark, landed):
    run_build(spark, landed)
    before = {n: spark.read.parquet(str(landed / "tables" / "gold" / n)).count() for n in build.TABLES["gold"]}
    hot = list(synthetic_weather()[5])
    hot[0], hot[1] = "2024-01-17T00:00", 61.0
    spark.createDataFrame([tuple(hot)], WEATHER).write.mode("append").parquet(str(landed / "raw" / "weather"))
    more = spark.read.parquet(str(landed / "raw" / "a")).limit(1)
    more.write.mode("append").parquet(str(landed / "raw" / "a"))
    with pytest.raises(build.CheckFailed, match="stg_weather: temperature_c range in 1 rows"):
        run_build(spark, landed)
    assert spark.read.parquet(str(landed / "tables" / "silver" / "stg_weather")).count() == 30, "the table before stays"
    assert {n: spark.read.parquet(str(landed / "tables" / "gold" / n)).count() for n in build.TABLES["gold"]} == before
    assert not [p for p in (landed / "tables").rglob("*.new-*")]


def test_checks_as_of_a_time(spark, landed):
    paths = [str(landed / "raw" / "a"), str(landed / "raw" / "b")], [str(landed / "raw" / "weather")], str(landed / "zones.csv")
    with pytest.raises(build.CheckFailed, match="no_future in 1[0-9] rows"):
        build.build_all(spark, *paths, str(landed / "t1"), as_of=ntz("2024-01-15 18:00:00"))
    with pytest.raises(build.CheckFailed, match="too old"):
        build.build_all(spark, *paths, str(landed / "t2"), as_of=ntz("2024-03-01 00:00:00"))
    tables = build.build_all(spark, *paths, str(landed / "t3"), as_of=ntz("2024-01-16 12:00:00"))
    found = {r.check_name: r.violations for r in build.layer_checks(tables, as_of=ntz("2024-01-16 12:00:00")).collect()}
    assert set(found.values()) == {0} and {"trips freshness", "stg_trips.pickup_utc no_future"} <= set(found)


def test_quarantine_and_counts_are_tables(spark, landed):
    bad = spark.read.parquet(str(landed / "raw" / "a")).limit(3).withColumn("trip_distance", F.lit(900.0))
    bad.write.mode("append").parquet(str(landed / "raw" / "a"))
    tables = run_build(spark, landed)
    assert {r.failure_reason for r in tables["silver_trips_quarantine"].collect()} <= {"dq_implausible_distance", "dq_duplicate_row", "dq_implausible_distance,dq_duplicate_row"}
    counts = {r.rule: r.rows for r in tables["dq_rule_counts"].collect()}
    assert counts["dq_implausible_distance"] == 3 and counts["is_valid"] == tables["fct_trips"].count() == 21 - tables["silver_trips_quarantine"].count()


def test_months_land_and_build(spark, landed):
    for month, part in (("2024-01", "a"), ("2024-02", "b")):
        spark.read.parquet(str(landed / "raw" / part)).write.parquet(str(landed / "publisher" / f"trips_{month}"))
        spark.createDataFrame(synthetic_weather(), WEATHER).where(F.lit(month == "2024-01")).write.parquet(str(landed / "publisher" / f"weather_{month}"))
    build_ = lambda asked, **how: build.build_months(
        spark, asked, str(landed / "publisher" / "trips_{month}"), str(landed / "publisher" / "weather_{month}"), str(landed / "zones.csv"),
        str(landed / "landing"), str(landed / "tables"), **how)
    assert build_("2024-01")["stg_trips"].count() == 10
    assert build_("2024-01, 2024-02")["stg_trips"].count() == 18
    spark.read.parquet(str(landed / "raw" / "b")).write.mode("overwrite").parquet(str(landed / "publisher" / "trips_2024-01"))
    assert build_("2024-01")["stg_trips"].count() == 10, "landed before"
    assert build_("2024-01", force=True)["stg_trips"].count() == 8
    with pytest.raises(ValueError):
        build_("2024-13")


def test_plans_of_checks_build_a_table_once(spark, small):
    from fareweather import registry

    plan = lambda name: registry.queries()[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan("check_not_null").count("Window [row_number") == 1
    assert plan("check_accepted_range").count("Window [row_number") == 1


def test_spine_refuses_a_wrong_clock(spark):
    bounds = spark.sql("SELECT timestamp_ntz'2024-01-01 05:10:00' AS low, timestamp_ntz'9999-01-01 00:00:00' AS high")
    with pytest.raises(Exception, match="hour spine of 29"):
        months.hour_spine(bounds, "low", "high").count()
    none = spark.sql("SELECT cast(null AS timestamp_ntz) AS low, cast(null AS timestamp_ntz) AS high")
    assert months.hour_spine(none, "low", "high").count() == 0


def test_facts_prune_by_date(spark, landed):
    facts = run_build(spark, landed)["fct_trips"]
    plan = facts.where("pickup_date_local = date'2024-01-15'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date_local" in plan


def test_scan_widens_and_fills(spark, landed):
    df = files.scan_union_by_name(spark, [str(landed / "raw" / n) for n in "ab"], row="_ingested_row")
    assert df.schema["passenger_count"].dataType.simpleString() == "double"
    assert [c for c in df.columns if c.lower() == "airport_fee"] == ["Airport_fee"]
    assert df.select("_ingested_from", "_ingested_row").distinct().count() == 18
    a = spark.createDataFrame([(1, "x")], "k int, only_a string")
    b = spark.createDataFrame([(2**40, 1.5)], "K long, v float")
    both = files.union_by_name([a, b])
    assert both.dtypes == [("k", "bigint"), ("only_a", "string"), ("v", "float")]
    assert sorted(map(tuple, both.collect()), key=str) == sorted([(1, "x", None), (2**40, None, 1.5)], key=str)
    mixed = files.union_by_name([a, spark.createDataFrame([("t",)], "k string")])
    assert mixed.schema["k"].dataType.simpleString() == "string"


def test_weather_json(spark, tmp_path):
    names = [n for n, _ in files.HOURLY_VARIABLES]
    for day in (1, 2):
        hourly = {"time": [f"2024-01-0{day}T00:00", f"2024-01-0{day}T01:00"], **{n: [1, 2] for n in names}}
        hourly["precipitation"] = [None, 0.5]
        (tmp_path / f"d{day}.json").write_text(json.dumps({"latitude": 40.7, "longitude": -74.0, "hourly": hourly}))
    df = files.read_weather_json(spark, str(tmp_path), "archive")
    assert df.columns == ["observed_at_raw", *names, "source", "latitude", "longitude"]
    rows = df.orderBy("observed_at_raw").collect()
    assert [r.observed_at_raw for r in rows] == ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-02T00:00", "2024-01-02T01:00"]
    assert (rows[0].precipitation, rows[1].precipitation, rows[1].weather_code, rows[0].source) == (None, 0.5, 2, "archive")


def test_months(spark):
    assert months.parse_months("2024-01, 2024-12") == ["2024-01", "2024-12"]
    for bad in ("2024-1", "202401", "2024-13", "", "2024-01,x"):
        with pytest.raises(ValueError):
            months.parse_months(bad)
    asked = months.month_frame(spark, ["2024-01", "2024-12", "bad", "2024-02"])
    got = {r.month: (r.start_date, r.end_date) for r in months.padded_window(asked).collect()}
    assert got == {
        "2024-01": (date(2023, 12, 31), date(2024, 2, 1)),
        "2024-12": (date(2024, 11, 30), date(2025, 1, 1)),
        "2024-02": (date(2024, 1, 31), date(2024, 3, 1)),
    }
    landed = months.month_frame(spark, ["2024-01"])
    assert sorted(r.month for r in months.missing_months(asked, landed).collect()) == ["2024-02", "2024-12", "bad"]
    assert months.missing_months(asked, landed, force=True).count() == 4


def test_landing_keeps_or_replaces(spark, tmp_path):
    path = str(tmp_path / "landing")
    files.land_month(spark.range(3), path, "2024-01")
    files.land_month(spark.range(5), path, "2024-01")
    assert spark.read.parquet(path).count() == 3
    files.land_month(spark.range(5), path, "2024-01", force=True)
    assert spark.read.parquet(path).count() == 5


def test_append_by_region_and_day(spark, tmp_path):
    path = str(tmp_path / "lake")
    df = spark.createDataFrame([(1, "EU"), (2, "US")], "id int, area string").withColumn("at", ntz("2024-03-09 23:59:00"))
    files.append_by_region_and_day(df, path, "area", "at")
    files.append_by_region_and_day(df, path, "area", "at")
    assert (tmp_path / "lake" / "region=EU" / "year=2024" / "month=3" / "day=9").is_dir()
    assert spark.read.parquet(path).where("region = 'EU'").count() == 2


@pytest.mark.parametrize("session", ["UTC", "America/New_York"])
def test_hour_spine_has_no_hole(spark, zone, session):
    zone(session)
    bounds = spark.range(1).select(ntz("2024-03-09 20:10:00").alias("a"), ntz("2024-03-10 06:59:00").alias("b"))
    rows = months.hour_spine(bounds, "a", "b").orderBy("hour_utc").collect()
    assert len(rows) == 11 and rows[6].hour_utc == datetime(2024, 3, 10, 2) and rows[6].observed_at_raw == "2024-03-10T02:00"
    counted = spark.range(1).select(ntz("2024-03-10 02:00:00").alias("h"), F.lit(4).cast("bigint").alias("n"))
    filled = months.fill_hours(months.hour_spine(bounds, "a", "b"), counted, "h", "n").collect()
    assert sum(r.n for r in filled) == 4 and len(filled) == 11
