"""The fleet jobs as streams.

The columns of a stream are those of the batch. Spark's watermark needs a
``timestamp``, so the stream carries ``event_ts`` next to the naive ``event_utc``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..config import DEFAULTS, Settings
from ..functions.timecols import as_instant, from_instant
from ..plans import fleet

WATERMARK = "5 minutes"


def read_parquet_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """Files landing in a folder, a bounded number per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def with_event_time(stream: DataFrame, time: str, watermark: str = WATERMARK) -> DataFrame:
    return stream.withColumn("event_ts", as_instant(time)).withWatermark("event_ts", watermark)


def _naive_bounds(windowed: DataFrame) -> DataFrame:
    return windowed.withColumns({c: from_instant(c) for c in ("window_start", "window_end")})


def fraud_features(trips: DataFrame, watermark: str = WATERMARK, **windows) -> DataFrame:
    """Sliding features; state is dropped once the watermark passes a window."""
    timed = with_event_time(trips, "started_utc", watermark)
    return _naive_bounds(fleet.fraud_features(timed, time="event_ts", **windows))


def fraud_rule_hits(trips: DataFrame, watermark: str = WATERMARK, **rules) -> DataFrame:
    return fleet.fraud_rule_hits(fraud_features(trips, watermark), **rules)


def downsample(messages: DataFrame, seconds: int = 60, watermark: str = WATERMARK) -> DataFrame:
    """Tumbling slots per vehicle, with the columns of the batch job."""
    timed = with_event_time(messages, "event_utc", watermark)
    first = F.min_by("reading", "message_id")
    slots = timed.groupBy(F.window("event_ts", f"{seconds} seconds"), "vehicle_id").agg(
        first.alias("first_reading"), F.avg("reading").alias("avg_reading"), F.count(F.lit(1)).alias("readings")
    )
    return slots.select(
        "vehicle_id", from_instant("window.start").alias("slot_utc"), "first_reading", "avg_reading", "readings"
    )


def receipts_once(deliveries: DataFrame) -> DataFrame:
    """First delivery of each trip, however late it comes and however often it repeats.

    No watermark, as one would drop a first delivery behind it. State is a trip's id for
    good and so grows with the trips: run it with the RocksDB state store, which keeps it
    on disk and in checkpoints.
    """
    return deliveries.dropDuplicates(["trip_id"])


def current_commands(commands: DataFrame) -> DataFrame:
    """Latest command per vehicle, one state row each; expiry is judged when read."""
    return fleet.current_commands(commands)


def hotspot_candidates(
    messages: DataFrame, zones: DataFrame, hot: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Each position against the static hot zones."""
    positions = messages.select("vehicle_id", "zone_id", F.col("event_utc").alias("at_utc"))
    return fleet.hotspot_candidates(positions, zones, hot, settings)


def write_lanes(stream: DataFrame, lanes: dict[str, str], checkpoint: str) -> StreamingQuery:
    """One stream to several Parquet folders by its ``lane`` column.

    Each lane's folder holds one subfolder per run and micro-batch, overwritten when the
    batch runs again, so a restart neither loses nor repeats a row; a stream with a new checkpoint is
    a new run and leaves what others wrote. A row of a lane that has no folder stops the stream.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = batch.persist()
        try:
            unknown = batch.where(~F.coalesce(F.col("lane").isin(list(lanes)), F.lit(False))).select("lane").first()
            if unknown is not None:
                raise ValueError(f"no folder for lane {unknown.lane!r}")
            for lane, path in lanes.items():
                part = batch.where(F.col("lane") == lane)
                part.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}/batch={batch_id}")
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append rows exactly once."""
    return (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def write_memory(stream: DataFrame, name: str, mode: str, checkpoint: str) -> StreamingQuery:
    """Into an in-memory view, for tests and small state tables."""
    return (
        stream.writeStream.outputMode(mode).format("memory").queryName(name)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
