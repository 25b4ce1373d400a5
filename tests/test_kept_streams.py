"""Streams that lose no row, and whose state stays bounded."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareweather.functions.timecols import ntz
from fareweather.plans import fleet
from fareweather.sources import bindings
from fareweather.sources.bindings import Tables
from fareweather.streaming import fleet_streams, kept


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def read(spark, path, *drop):
    return spark.read.parquet(str(path)).drop("run", "batch", *drop)


def files_in_order(df, path, parts):
    """Each part as one file, so that a stream of one file a batch reads them in order."""
    for i, part in enumerate(parts):
        df.where(part).coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


@pytest.fixture
def trips(spark, small):
    """Trips in three files, the later ones first, and a vehicle whose clock is a day fast in the first."""
    own = bindings.fleet_trips(Tables(spark, small).events).where("vehicle_id > 0")
    fast = own.orderBy(F.desc("started_utc"), "trip_id").limit(1).withColumn("started_utc", F.col("started_utc") - F.expr("INTERVAL 9 DAYS")).withColumns({"trip_id": F.lit(-1).cast("bigint"), "vehicle_id": F.lit(-1).cast("bigint")})
    return own.unionByName(fast.select(own.columns))


def test_every_trip_is_in_windows_or_late(spark, trips, tmp_path):
    path = files_in_order(trips, tmp_path / "in", ["trip_id < 0 or trip_id % 3 = 0", "trip_id >= 0 and trip_id % 3 = 1", "trip_id >= 0 and trip_id % 3 = 2"])
    out = tmp_path / "out"
    for _ in range(2):  # a run that finds nothing new changes nothing
        stream = fleet_streams.read_parquet_stream(spark, path, trips.schema, 1)
        kept.keep_fraud_features(stream, str(out), str(tmp_path / "cp")).awaitTermination(240)
    late, closed = (read(spark, out / kind) for kind in ("late", "closed"))
    still = spark.read.parquet(str(max((out / "open").glob("run=*/batch=*"))))  # the last snapshot
    assert late.count() > 0 and closed.count() > 0
    windows = closed.select("trips").unionAll(still.select("trips")).agg(F.sum("trips")).first()[0]
    assert windows / 2 + late.count() == trips.count()  # a trip is in two windows of an hour each half hour
    # Closed windows are those of the batch job over what wasn't late, each once.
    on_time = trips.join(late.select("trip_id"), "trip_id", "left_anti")
    batch = fleet.fraud_features(on_time)
    keep = ["window_start", "window_end", "vehicle_id", "trips", "short_trips"]
    assert rows(closed.unionByName(still, allowMissingColumns=True).select(keep)) == rows(batch.select(keep))
    assert closed.select("window_start", "vehicle_id").distinct().count() == closed.count()
    # State is one snapshot of open windows and the one before it.
    assert len(list((out / "open").glob("run=*/batch=*"))) <= 2


def test_a_batch_that_runs_again_repeats_nothing(spark, trips, tmp_path):
    path = files_in_order(trips, tmp_path / "in", ["trip_id % 2 = 0", "trip_id % 2 != 0"])
    out, calls = tmp_path / "out", []
    real = kept.Snapshots.finish

    def failing(self, *snapshots):
        calls.append(self.batch)
        if len(calls) == 2:
            raise RuntimeError("lost before it was done")
        real(self, *snapshots)

    kept.Snapshots.finish = failing
    try:
        start = lambda: kept.keep_slots(
            fleet_streams.read_parquet_stream(spark, path, messages.schema, 1), str(out), str(tmp_path / "cp"), 3600, watermark_seconds=86_400 * 400)
        messages = trips.select(F.col("trip_id").alias("message_id"), "vehicle_id", F.col("started_utc").alias("event_utc"), F.col("fare").alias("reading"))
        path = files_in_order(messages, tmp_path / "messages", ["message_id % 2 = 0", "message_id % 2 != 0"])
        with pytest.raises(Exception, match="lost before"):
            start().awaitTermination(240)
        start().awaitTermination(240)
    finally:
        kept.Snapshots.finish = real
    assert calls == [0, 1, 1]
    last = max((out / "open").glob("run=*/batch=*"))
    still = spark.read.parquet(str(last))
    expected = fleet.downsample(messages, seconds=3600)
    assert read(spark, out / "late").count() == 0
    got = still.select("vehicle_id", F.col("window_start").alias("slot_utc"), "first.reading", "readings")
    assert rows(got) == rows(expected.select("vehicle_id", "slot_utc", F.col("first_reading").alias("reading"), "readings"))


def test_a_new_checkpoint_overwrites_nothing(spark, trips, tmp_path):
    path = files_in_order(trips, tmp_path / "in", ["true"])
    for run in ("a", "b"):
        stream = fleet.with_lane(fleet_streams.read_parquet_stream(spark, path, trips.schema), "started_utc", "started_utc")
        fleet_streams.write_lanes(stream, {"on_time": str(tmp_path / "lane"), "late": str(tmp_path / "other")}, str(tmp_path / run)).awaitTermination(240)
    assert spark.read.parquet(str(tmp_path / "lane")).count() == 2 * trips.count()
    stream = fleet.with_lane(fleet_streams.read_parquet_stream(spark, path, trips.schema), "started_utc", "started_utc")
    with pytest.raises(Exception, match="no folder for lane"):
        fleet_streams.write_lanes(stream, {"late": str(tmp_path / "other")}, str(tmp_path / "c")).awaitTermination(240)


@pytest.mark.parametrize("bits", [kept.FILTER_BITS, 64])
def test_receipts_of_bounded_state(spark, small, tmp_path, bits):
    """No first delivery is lost and none repeats: within a batch, over batches, over runs; also where the filter is full."""
    deliveries = bindings.receipt_deliveries(Tables(spark, small).raw_trips)
    path = files_in_order(deliveries, tmp_path / "in", ["delivery = 0 and trip_id % 2 = 0", "delivery = 1", "delivery = 0", "trip_id % 5 = 0"])
    once = fleet.receipts_once(deliveries)
    for run in ("a", "b"):  # the second reads all once more
        stream = fleet_streams.read_parquet_stream(spark, path, deliveries.schema, 1)
        kept.land_receipts(stream, str(tmp_path / "out"), str(tmp_path / run), bits, 4).awaitTermination(240)
        got = read(spark, tmp_path / "out" / "receipts")
        assert got.count() == got.select("trip_id").distinct().count() == once.count()
    words = spark.read.parquet(str(max((tmp_path / "out" / "filter").glob("run=*/batch=*"))))
    assert words.count() <= bits // 64 and len(list((tmp_path / "out" / "filter").glob("run=*/batch=*"))) <= 2


def test_expired_commands_leave_by_themselves(spark, tmp_path):
    t0 = datetime(2024, 1, 1, 12)
    make = lambda v, ver, zone, nack=False, at=0, ttl=10: (v, ver, zone, t0 + timedelta(minutes=at), t0 + timedelta(minutes=at + ttl), nack)
    schema = "vehicle_id int, version int, zone_id int, event_utc timestamp_ntz, expires_utc timestamp_ntz, is_nacked boolean"
    steps = [
        [make(1, 1, 5), make(2, 1, 5), make(2, 2, 6, ttl=3), make(3, 4, 1), make(3, 3, 2), make(4, 1, 1), make(5, 1, 8), make(6, 1, 1, nack=None)],
        [make(4, 2, 1, nack=True, at=1), make(5, 2, 9, at=2, ttl=90), make(2, 1, 5, at=2)],
        [make(9, 1, 1, at=12)],  # the watermark is 12:07: the second version of vehicle 2 has expired
        [make(9, 2, 1, at=40)],  # and all of the first
        [make(9, 3, 2, at=41)],
    ]
    path = tmp_path / "in"
    for step in steps:
        spark.createDataFrame(step, schema).coalesce(1).write.mode("append").parquet(str(path))
    stream = fleet_streams.read_parquet_stream(spark, str(path), spark.read.parquet(str(path)).schema, 1)
    query = fleet_streams.write_memory(kept.command_changes(stream), "changes", "append", str(tmp_path / "cp"))
    query.awaitTermination(240)
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(sizes) >= 6 and sizes[-1] == 2, sizes
    changes = spark.table("changes")
    said = {(r.vehicle_id, r.version, r.change) for r in changes.collect()}
    assert {(2, 2, "current"), (2, 2, "expired"), (4, 1, "current"), (4, 2, "withdrawn"), (1, 1, "expired"), (6, 1, "expired"), (5, 2, "current")} <= said
    assert not any(v == 2 and ver == 1 for v, ver, _ in said) and not any(v == 3 and ver == 3 for v, ver, _ in said)
    # The changes add up to the batch's answer as of the watermark.
    every = spark.createDataFrame([x for step in steps for x in step], schema)
    batch = fleet.current_commands(every, ntz("2024-01-01 12:41:00")).where("expires_utc > timestamp_ntz'2024-01-01 12:41:00'")
    now = kept.current_of_changes(changes)
    assert {(r.vehicle_id, r.version, r.zone_id) for r in now.collect()} == {(r.vehicle_id, r.version, r.zone_id) for r in batch.collect()} == {(5, 2, 9), (9, 3, 2)}
