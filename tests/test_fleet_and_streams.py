from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareweather.functions.timecols import ntz
from fareweather.plans import fleet
from fareweather.sources import bindings
from fareweather.sources.bindings import Tables
from fareweather.streaming import fleet_streams as streams


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def landed(df, path, parts=3):
    """A batch as several files, as a stream would find them."""
    df.repartition(parts).write.parquet(str(path))
    return str(path)


@pytest.fixture
def as_stream(spark, tmp_path):
    def make(df, name="in", parts=3, files_per_batch=100):
        path = landed(df, tmp_path / name, parts)
        return streams.read_parquet_stream(spark, path, df.schema, files_per_batch)

    return make


def collect_stream(spark, stream, tmp_path, mode, name):
    query = streams.write_memory(stream, name, mode, str(tmp_path / f"cp_{name}"))
    query.awaitTermination(240)
    return spark.table(name)


def test_fraud_windows_batch_equals_stream(spark, small, tmp_path, as_stream):
    trips = bindings.fleet_trips(Tables(spark, small).events)
    batch = fleet.fraud_features(trips)
    out = collect_stream(spark, streams.fraud_features(as_stream(trips)), tmp_path, "complete", "features")
    keep = ["window_start", "window_end", "vehicle_id", "trips", "short_trips"]
    assert rows(out.select(keep)) == rows(batch.select(keep))
    assert rows(out.select("vehicle_id", F.round("fare", 4).alias("fare"))) == rows(
        batch.select("vehicle_id", F.round("fare", 4).alias("fare"))
    )


def test_append_mode_emits_closed_windows(spark, small, tmp_path, as_stream):
    """With one event far in the future every real window is closed and emitted."""
    trips = bindings.fleet_trips(Tables(spark, small).events)
    sentinel = trips.limit(1).withColumn("started_utc", ntz("2025-01-01 00:00:00")).withColumn("vehicle_id", F.lit(-1).cast("bigint"))
    first = landed(trips, tmp_path / "in", 1)
    stream = streams.read_parquet_stream(spark, first, trips.schema, 1)
    sentinel.write.mode("append").parquet(first)
    out = tmp_path / "out"
    hits = streams.fraud_rule_hits(stream)
    streams.write_parquet(hits, str(out), str(tmp_path / "cp")).awaitTermination(240)
    got = spark.read.parquet(str(out)).where("vehicle_id >= 0")
    assert rows(got) == rows(fleet.fraud_rule_hits(fleet.fraud_features(trips)))


def test_downsample_batch_equals_stream(spark, small, tmp_path, as_stream):
    messages = Tables(spark, small).messages
    out = collect_stream(spark, streams.downsample(as_stream(messages), 3600), tmp_path, "complete", "slots")
    fix = [F.round("avg_reading", 6).alias("avg_reading"), "vehicle_id", "slot_utc", "first_reading", "readings"]
    assert rows(out.select(fix)) == rows(fleet.downsample(messages, seconds=3600).select(fix))


@pytest.mark.parametrize("session", ["UTC", "America/New_York"])
def test_stream_times_ignore_the_session(spark, zone, tmp_path, as_stream, session):
    zone(session)
    at = datetime(2024, 3, 10, 2, 30)
    df = spark.createDataFrame([(1, 1, at, 2.0)], "message_id long, vehicle_id long, event_utc timestamp_ntz, reading double")
    name = "z_" + session.replace("/", "_")
    out = collect_stream(spark, streams.downsample(as_stream(df, parts=1)), tmp_path, "complete", name)
    assert [r.slot_utc for r in out.collect()] == [at]


def test_receipts_exactly_once(spark, small, tmp_path, as_stream):
    deliveries = bindings.receipt_deliveries(Tables(spark, small).raw_trips)
    out = collect_stream(spark, streams.receipts_once(as_stream(deliveries, parts=1)), tmp_path, "append", "receipts")
    ids = [r.trip_id for r in out.collect()]
    once = fleet.receipts_once(deliveries)
    assert len(ids) == len(set(ids)) == once.count() < deliveries.count()
    assert {r.delivery for r in once.collect()} == {0}
    assert rows(fleet.receipts_once(once.unionByName(deliveries))) == rows(once), "stable on repeat"


def test_current_commands(spark, tmp_path, as_stream):
    t0 = datetime(2024, 1, 1, 12)
    make = lambda v, ver, zone, nack=False, ago=1, ttl=10: (
        v, ver, zone, t0 - timedelta(minutes=ago), t0 - timedelta(minutes=ago) + timedelta(minutes=ttl), nack)
    df = spark.createDataFrame(
        [make(1, 1, 5), make(1, 3, 7, nack=True), make(1, 2, 6), make(1, 2, 6), make(2, 9, 1, ago=11), make(2, 8, 2),
         make(3, 1, 1, ago=10), make(4, 1, 1, ago=-1), make(5, 1, 3), make(5, 2, 4)],
        "vehicle_id int, version int, zone_id int, event_utc timestamp_ntz, expires_utc timestamp_ntz, is_nacked boolean",
    )
    as_of = ntz("2024-01-01 12:00:00")
    assert {r.vehicle_id: r.version for r in fleet.current_commands(df, as_of).collect()} == {5: 2}, "a nacked or expired version brings none back"
    out = collect_stream(spark, streams.current_commands(as_stream(df)), tmp_path, "complete", "commands")
    assert {r.vehicle_id: r.version for r in out.collect()} == {2: 9, 3: 1, 4: 1, 5: 2}


def test_lanes_keep_every_row(spark, small, tmp_path, as_stream):
    messages = Tables(spark, small).messages
    for name, fn, lanes in (("late", fleet.with_lane, ("on_time", "late")), ("dead", fleet.with_parse_lane, ("accepted", "dead_letter"))):
        out = {lane: str(tmp_path / name / lane) for lane in lanes}
        streams.write_lanes(fn(as_stream(messages, f"in_{name}", 3, 1)), out, str(tmp_path / f"cp_{name}")).awaitTermination(240)
        batch = fn(messages)
        for lane, path in out.items():
            got = spark.read.parquet(path).drop("run", "batch")
            assert rows(got) == rows(batch.where(F.col("lane") == lane)) and got.count() > 0, lane


def test_late_limit_is_exclusive(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, at, at + timedelta(seconds=s)) for i, s in enumerate((0, 300, 301, -5))],
                               "i int, event_utc timestamp_ntz, ingest_utc timestamp_ntz")
    assert [r.lane for r in fleet.with_lane(df).orderBy("i").collect()] == ["on_time", "on_time", "late", "on_time"]


def test_hotspots_batch_and_stream(spark, tmp_path, as_stream):
    messages = spark.createDataFrame(
        [(1, 10, datetime(2024, 1, 1, 1), 1), (1, 11, datetime(2024, 1, 1, 2), 2), (2, 10, datetime(2024, 1, 1, 1), 3), (3, 99, datetime(2024, 1, 1, 1), 4)],
        "vehicle_id int, zone_id int, event_utc timestamp_ntz, message_id long",
    )
    zones = spark.createDataFrame([(10, "B", "ten", "s"), (11, "B", "eleven", "s")], "LocationID int, Borough string, Zone string, service_zone string")
    hot = spark.createDataFrame([("ten", 0.3, 12)], "zone string, avg_lift double, observations long")
    batch = fleet.hotspot_candidates(fleet.last_positions(messages), zones, hot)
    assert [(r.vehicle_id, r.zone) for r in batch.collect()] == [(2, "ten")]
    out = collect_stream(spark, streams.hotspot_candidates(as_stream(messages), zones, hot), tmp_path, "append", "hotspots")
    assert sorted(r.vehicle_id for r in out.collect()) == [1, 2]


def test_connectivity_and_outages(spark):
    as_of = datetime(2024, 1, 2)
    ago = {1: 10, 2: 300, 3: 301, 4: 90_000}
    df = spark.createDataFrame([(v, as_of - timedelta(seconds=s)) for v, s in ago.items()] + [(3, as_of + timedelta(seconds=5))],
                               "vehicle_id int, event_utc timestamp_ntz")
    r = fleet.connectivity(df, ntz("2024-01-02 00:00:00")).collect()[0]
    assert (r.vehicles, r.connected, r.connected_pct) == (4, 2, 50.0)
    assert [r.vehicle_id for r in fleet.outages(df, ntz("2024-01-02 00:00:00")).collect()] == [4]
    none = fleet.connectivity(df.where("false"), ntz("2024-01-02 00:00:00")).collect()[0]
    assert (none.vehicles, none.connected_pct) == (0, 0.0)


def test_retention(spark):
    as_of = datetime(2024, 6, 1)
    at = lambda days, sec=0: as_of - timedelta(days=days) + timedelta(seconds=sec)
    df = spark.createDataFrame(
        [(1, 1, at(1), 1.0), (2, 1, at(30), 2.0), (3, 1, at(31, 1), 3.0), (4, 1, at(31, 2), 5.0), (5, 1, at(365), 7.0), (6, 1, at(366), 9.0)],
        "message_id long, vehicle_id int, event_utc timestamp_ntz, reading double",
    )
    got = sorted((r.tier, r.reading, r.readings) for r in fleet.retention_tiers(df, ntz("2024-06-01 00:00:00")).collect())
    assert got == [("full", 1.0, 1), ("full", 2.0, 1), ("minute", 4.0, 2), ("minute", 7.0, 1)]


def test_erasure_and_freshness(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, who string")
    gone = spark.createDataFrame([("b",), ("b",), (None,)], "who string")
    assert sorted(r.id for r in fleet.erase_tokens(df, gone, "who").collect()) == [1, 3]
    at = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0),)], "t timestamp_ntz")
    met = {r.workload: r.is_met for r in fleet.freshness_by_workload(at, "t", ntz("2024-01-01 00:00:20")).collect()}
    assert met == {"receipts": True, "fraud": False, "dashboards": True}


def test_utilisation_and_lengths(spark):
    t0 = datetime(2024, 1, 1)
    trips = spark.createDataFrame([(1, t0, 600), (1, t0 + timedelta(seconds=1800), 600), (2, t0, 0)], "vehicle_id int, started_utc timestamp_ntz, seconds long")
    got = {r.vehicle_id: (r.trips, r.busy_seconds, r.span_seconds, r.utilisation_pct) for r in fleet.utilisation(trips).collect()}
    assert got == {1: (2, 1200, 2400, 50.0), 2: (1, 0, 0, 0.0)}
    miles = spark.createDataFrame([(0.4,), (0.6,), (1.0,), (2.5,)], "trip_distance_miles double")
    bins = {r.from_miles: (r.trips, r.share_pct) for r in fleet.trip_length_distribution(miles).collect()}
    assert bins == {0.0: (2, 50.0), 1.0: (1, 25.0), 2.0: (1, 25.0)}


def test_a_late_first_delivery_is_kept(spark, tmp_path, as_stream):
    at = datetime(2024, 1, 1, 12)
    rows = [(1, at), (2, at.replace(hour=15)), (2, at.replace(hour=15)), (3, at.replace(hour=9)), (1, at)]
    df = spark.createDataFrame(rows, "trip_id int, ended_utc timestamp_ntz")
    query = streams.write_memory(streams.receipts_once(as_stream(df, parts=5)), "late_receipts", "append", str(tmp_path / "c"))
    query.awaitTermination()
    assert sorted(r.trip_id for r in spark.table("late_receipts").collect()) == [1, 2, 3]
