"""Streams that lose nothing and whose state is bounded: late rows go to a lane of their own, windows are kept as a table,
receipts are told apart by a fixed number of bits.

Each micro-batch reads the snapshot that the one before wrote and writes its own, in folders named by
the stream's run and the batch. A batch that runs again finds the same snapshot and overwrites its own folders,
so a crash neither loses nor repeats a row. A stream with a new checkpoint is a new run, which writes beside the folders
of earlier runs and takes up their last snapshot. ``done`` is written last and makes a batch count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.timecols import add_seconds, as_instant, epoch_micros, from_instant
from ..operators.ranking import first_per_key
from ..sources.files import file_system

WATERMARK_SECONDS = 300


class Snapshots:
    """Folders ``<folder>/<kind>/run=<number>-<query>/batch=<id>`` of one batch, and of the last one before that is done."""

    def __init__(self, spark: SparkSession, folder: str, run: str, batch: int):
        self.spark, self.folder, self.batch = spark, folder.rstrip("/"), batch
        self.fs, self.at = file_system(spark, folder)
        done = self._listed(f"{self.folder}/done")
        mine = [r for r in done if r.endswith(f"-{run}")] or [r for r in self._listed(f"{self.folder}/started") if r.endswith(f"-{run}")]
        if mine:
            self.run = mine[0]
        else:
            self.run = f"run={len(self._listed(f'{self.folder}/started')):06}-{run}"
            self.fs.mkdirs(self.at(f"{self.folder}/started/{self.run}"))
        before = [(r, b) for r in done if r <= self.run for b in self._listed(f"{self.folder}/done/{r}")]
        before = [(r, b) for r, b in before if r < self.run or b < self._name(batch)]
        self.before = max(before, default=None)

    def _name(self, batch: int) -> str:
        return f"batch={batch:012}"

    def _listed(self, path: str) -> list[str]:
        if not self.fs.exists(self.at(path)):
            return []
        return sorted(x.getPath().getName() for x in self.fs.listStatus(self.at(path)))

    def path(self, kind: str) -> str:
        return f"{self.folder}/{kind}/{self.run}/{self._name(self.batch)}"

    def write(self, kind: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """This batch's rows of a kind, written and read back."""
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path(kind))
        return self.spark.read.schema(df.schema).parquet(self.path(kind))

    def last(self, kind: str, schema: str) -> DataFrame:
        """The snapshot that the last batch wrote; empty at the very first."""
        if self.before is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet("/".join((self.folder, kind, *self.before)))

    def earlier(self, kind: str, schema: str) -> DataFrame:
        """Rows of a kind from all batches that were done before this one."""
        path = f"{self.folder}/{kind}"
        if self.before is None or not self.fs.exists(self.at(path)):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, run STRING, batch STRING").parquet(path)
        mine = self.run.removeprefix("run=")
        return rows.where((F.col("run") < mine) | ((F.col("run") == mine) & (F.col("batch") < self._name(self.batch).removeprefix("batch="))))

    def finish(self, *snapshots: str) -> None:
        """Mark the batch as done; snapshots older than the one it was made from are removed."""
        self.fs.mkdirs(self.at(self.path("done")))
        kept = {(self.run, self._name(self.batch)), self.before}
        for kind in snapshots:
            for r in self._listed(f"{self.folder}/{kind}"):
                for b in self._listed(f"{self.folder}/{kind}/{r}"):
                    if (r, b) not in kept:
                        self.fs.delete(self.at(f"{self.folder}/{kind}/{r}/{b}"), True)


def started(stream: DataFrame, folder: str, checkpoint: str, write: Callable[[DataFrame, Snapshots], None]) -> StreamingQuery:
    """Run ``write`` on every micro-batch with its snapshots."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = batch.persist()
        try:
            write(batch, Snapshots(spark, folder, run, batch_id))
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# -- windows -------------------------------------------------------------------


@dataclass(frozen=True)
class Measure:
    """A column of a window: what rows add up to, how such sums merge, and its type."""

    name: str
    of_rows: Column
    merge: Callable[[str], Column]
    kind: str


def fraud_measures(short_miles: float = 1.0) -> tuple[Measure, ...]:
    return (
        Measure("trips", F.count(F.lit(1)), F.sum, "bigint"), Measure("fare", F.sum("fare"), F.sum, "double"),
        Measure("miles", F.sum("miles"), F.sum, "double"), Measure("short_trips", F.count_if(F.col("miles") < short_miles), F.sum, "bigint"),
    )


def slot_measures() -> tuple[Measure, ...]:
    return (
        Measure("first", F.min(F.struct("message_id", "reading")), F.min, "struct<message_id: bigint, reading: double>"),
        Measure("total", F.sum("reading"), F.sum, "double"), Measure("known", F.count("reading"), F.sum, "bigint"),
        Measure("readings", F.count(F.lit(1)), F.sum, "bigint"),
    )


def keep_windows(
    stream: DataFrame, folder: str, checkpoint: str, time: str, keys: dict[str, str], measures: Sequence[Measure],
    finish: Callable[[DataFrame], DataFrame], length: int, slide: int, watermark_seconds: int = WATERMARK_SECONDS,
) -> StreamingQuery:
    """Windows over a stream, each written to ``<folder>/closed`` once, when the watermark passes its end.

    The watermark is a value kept from batch to batch: the latest time seen less ``watermark_seconds``. Rows
    behind the one that a batch starts with go to ``<folder>/late``, whole. All others are in the windows they
    belong to, closed or still in ``<folder>/open``, which holds one row for each open window and key: so every row
    is in exactly one of late and windows, even after a vehicle whose clock is fast has moved the watermark.
    A row without a time is late. ``keys``: names and types.
    """
    spans = {"window_start": "timestamp_ntz", "window_end": "timestamp_ntz"}
    schema = ", ".join(f"`{c}` {t}" for c, t in ({**spans, **keys} | {m.name: m.kind for m in measures}).items())

    def write(batch: DataFrame, at: Snapshots) -> None:
        mark = at.last("watermark", "mark timestamp_ntz").first()
        before = mark.mark if mark else None
        late = F.col(time).isNull() if before is None else F.col(time).isNull() | (F.col(time) < F.lit(before).cast("timestamp_ntz"))
        at.write("late", batch.where(late))
        timed = batch.where(~late)
        grouped = timed.groupBy(F.window(time, f"{length} seconds", f"{slide} seconds").alias("w"), *keys).agg(*[m.of_rows.alias(m.name) for m in measures])
        new = grouped.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys, *[m.name for m in measures])
        merged = at.last("open", schema).unionByName(new).groupBy(*spans, *keys).agg(*[m.merge(m.name).cast(m.kind).alias(m.name) for m in measures])
        latest = timed.agg(F.max(time)).first()[0]
        after = max((x for x in (before, latest and latest - pd.Timedelta(seconds=watermark_seconds).to_pytimedelta()) if x is not None), default=None)
        closed = F.lit(False) if after is None else F.col("window_end") <= F.lit(after).cast("timestamp_ntz")
        # One pass over the merged windows; what is open and what is closed are read from it.
        every = at.write("merged", merged.withColumn("closed", closed))
        at.write("closed", finish(every.where("closed").drop("closed")))
        at.write("open", every.where("not closed").drop("closed"))
        at.write("watermark", at.spark.createDataFrame([(after,)], "mark timestamp_ntz"))
        at.finish("open", "watermark", "merged")

    return started(stream, folder, checkpoint, write)


def _features(windows: DataFrame) -> DataFrame:
    return windows.withColumn("fare_per_mile", F.when(F.col("miles") > 0, F.col("fare") / F.col("miles")))


def keep_fraud_features(
    trips: DataFrame, folder: str, checkpoint: str, length: int = 3600, slide: int = 1800, short_miles: float = 1.0, watermark_seconds: int = WATERMARK_SECONDS,
) -> StreamingQuery:
    """``fleet.fraud_features`` of closed windows, and late trips for the batch job."""
    return keep_windows(trips, folder, checkpoint, "started_utc", {"vehicle_id": "bigint"}, fraud_measures(short_miles), _features, length, slide, watermark_seconds)


def _slots(windows: DataFrame) -> DataFrame:
    mean = F.try_divide("total", "known")
    return windows.select("vehicle_id", F.col("window_start").alias("slot_utc"), F.col("first.reading").alias("first_reading"), mean.alias("avg_reading"), "readings")


def keep_slots(messages: DataFrame, folder: str, checkpoint: str, seconds: int = 60, watermark_seconds: int = WATERMARK_SECONDS) -> StreamingQuery:
    """``fleet.downsample`` of closed slots, and late messages for the batch job."""
    return keep_windows(messages, folder, checkpoint, "event_utc", {"vehicle_id": "bigint"}, slot_measures(), _slots, seconds, seconds, watermark_seconds)


# -- receipts ------------------------------------------------------------------

#: Bits of the filter and looks into it per trip; at ten bits a trip one new trip in a hundred is looked up in vain.
FILTER_BITS = 1 << 26
LOOKS = 4
BUCKETS = 64


def _looks(key: Column, bits: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(k)), F.lit(bits)) for k in range(LOOKS)])


def land_receipts(deliveries: DataFrame, folder: str, checkpoint: str, bits: int = FILTER_BITS, buckets: int = BUCKETS) -> StreamingQuery:
    """The first delivery of every trip to ``<folder>/receipts``, however late it comes and however often it repeats.

    The stream holds no state. A filter of ``bits`` bits, kept as a table of words, tells which trips can't have
    landed: most of a batch. The others are looked up among the landed ids, of which only the buckets that
    they fall in are read. A full filter makes more look-ups and no wrong receipt. A delivery without a trip id is one receipt.
    """

    def write(batch: DataFrame, at: Snapshots) -> None:
        bucket = F.pmod(F.xxhash64("trip_id"), F.lit(buckets)).cast("int")
        first = at.write("first", first_per_key(batch, ["trip_id"], "delivery").withColumn("bucket", bucket))
        words = at.last("filter", "word bigint, mask bigint")
        asked = first.select(F.col("trip_id").alias("t"), F.col("bucket").alias("b"), F.explode(_looks(F.col("trip_id"), bits)).alias("bit"))
        asked = asked.withColumns({"word": F.shiftright("bit", 6), "one": F.expr("shiftleft(1L, cast(bit % 64 as int))")})
        seen = asked.join(words, "word").where(F.col("mask").bitwiseAND(F.col("one")) != 0)
        maybe = at.write("maybe", seen.groupBy("t", "b").agg(F.count_distinct("bit").alias("hits")).join(
            asked.groupBy("t", "b").agg(F.count_distinct("bit").alias("all")).withColumnsRenamed({"t": "t2", "b": "b2"}), F.col("t").eqNullSafe(F.col("t2"))
        ).where(F.col("hits") == F.col("all")).select("t", "b"))
        some = [r.b for r in maybe.select("b").distinct().collect()]  # BUCKETS numbers at most
        landed = at.earlier("receipts", "trip_id BIGINT, bucket INT").where(F.col("bucket").isin(some)).select(F.col("trip_id").alias("l"))
        known = maybe.join(landed, F.col("t").eqNullSafe(F.col("l")), "left_semi").select("t")
        new = first.join(known, F.col("trip_id").eqNullSafe(F.col("t")), "left_anti")
        at.write("receipts", new, ["bucket"])
        added = asked.select("word", F.col("one").alias("mask"))
        at.write("filter", words.unionByName(added).groupBy("word").agg(F.bit_or("mask").alias("mask")))
        at.finish("filter", "first", "maybe")

    return started(deliveries.withColumn("trip_id", F.col("trip_id").cast("bigint")), folder, checkpoint, write)


# -- commands ------------------------------------------------------------------

_COMMAND_STATE = "version bigint, message_id bigint, event_us bigint, expires_us bigint, zone_id int, is_nacked boolean, latest_us bigint, shown boolean"
_CHANGE = "vehicle_id bigint, version bigint, zone_id int, issued_us bigint, expires_us bigint, change string"
_FOREVER = (1 << 63) - 1


def _ordered(command: tuple) -> tuple:
    """Commands in order of version, then message, times and zone; what is unknown is least."""
    return tuple((x is not None, x if x is not None else 0) for x in command)


def _command_changes(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    now_us = state.getCurrentWatermarkMs() * 1000
    held = state.get if state.exists else None
    command, latest, shown = (held[:6], held[6], held[7]) if held else (None, -_FOREVER, False)
    out = []
    if not state.hasTimedOut:
        before = command
        for batch in batches:
            for row in batch[["version", "message_id", "event_us", "expires_us", "zone_id", "is_nacked"]].astype(object).where(lambda x: x.notna(), None).itertuples(index=False):
                new = tuple(int(x) if i < 5 and x is not None else x for i, x in enumerate(row))
                latest = max(latest, _FOREVER if new[3] is None else new[3])
                if command is None or _ordered(new) > _ordered(command):
                    command = new
        if command != before:
            live = not command[5] and (command[3] is not None and command[3] > now_us)
            if live or shown:
                out.append((*key, command[0], command[4], command[2], command[3], "current" if live else "withdrawn"))
            shown = live
    if shown and command[3] <= now_us:
        out.append((*key, command[0], command[4], command[2], command[3], "expired"))
        shown = False
    if latest <= now_us:
        state.remove()  # every command seen of this vehicle has expired
    else:
        state.update((*command, latest, shown))
        wake = command[3] if shown else latest
        if wake != _FOREVER:
            state.setTimeoutTimestamp(max(wake // 1000 + 1, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame(out, columns=["vehicle_id", "version", "zone_id", "issued_us", "expires_us", "change"])


def command_changes(commands: DataFrame, watermark_seconds: int = WATERMARK_SECONDS) -> DataFrame:
    """Changes of the current command per vehicle: ``current``, ``withdrawn`` (a newer one is nacked or has expired) or ``expired``.

    A timer at the command's expiry tells of it and, once all commands seen of a vehicle have expired, ends its
    state, so state holds vehicles with a command that may still count. A superseded command stays away until then;
    after that, only one that expires later than all before it and was still on its way could be taken for new. A
    command without expiry never counts as current, as in the batch job.
    """
    timed = commands.withColumn("event_ts", as_instant("event_utc")).withWatermark("event_ts", f"{watermark_seconds} seconds")
    message = F.col("message_id") if "message_id" in commands.columns else F.lit(None)
    flat = timed.select(
        F.col("vehicle_id").cast("bigint").alias("vehicle_id"), F.col("version").cast("bigint").alias("version"), message.cast("bigint").alias("message_id"),
        epoch_micros("event_utc").alias("event_us"), epoch_micros("expires_utc").alias("expires_us"), F.col("zone_id").cast("int").alias("zone_id"),
        F.coalesce(F.col("is_nacked"), F.lit(False)).alias("is_nacked"), "event_ts",
    )
    changes = flat.groupBy("vehicle_id").applyInPandasWithState(_command_changes, _CHANGE, _COMMAND_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    naive = lambda c: from_instant(F.timestamp_micros(c))
    return changes.select("vehicle_id", "version", "zone_id", naive("issued_us").alias("issued_utc"), naive("expires_us").alias("expires_utc"), "change")


def current_of_changes(changes: DataFrame) -> DataFrame:
    """The commands that count now, from all changes so far: per vehicle the last change, if it is ``current``."""
    rank = F.when(F.col("change") == "current", 0).otherwise(1)
    last = changes.groupBy("vehicle_id").agg(F.max(F.struct("version", rank.alias("ended"), "zone_id", "issued_utc", "expires_utc")).alias("c"))
    return last.where("c.ended = 0").select("vehicle_id", "c.version", "c.zone_id", "c.issued_utc", "c.expires_utc")
