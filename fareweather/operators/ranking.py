"""Duplicate ranks and counts.

``duplicate_rank`` keeps every row and numbers the rows of each duplicate group. Most rows are a
group of one: a first pass over the keys alone finds the key hashes that repeat and keeps them as a
bitmap of bounded size; a row whose bit isn't set has rank 1 and is not shuffled. The others, those that repeat
and few that share a bit, are ranked by a window. In groups of very many rows, those equal in all columns are
one row with a number before that, combined before any shuffle, and are spread over tasks when they are written out
again; such a group of unlike rows may be cut into ranges that several tasks rank. All ways give the same ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULTS, Settings
from ..sources.files import rows_in_files
from ..sources.shared import cut

#: Bits of the map of repeated key hashes; it is broadcast as at most a 64th of them in rows.
MARKS = 1 << 26
#: Equal rows that one task writes out at a time.
EQUAL_ROWS = 100_000

# A range partitioner samples each slice on the driver, so their number is bounded;
# beyond it slices only grow.
_MAX_SLICES = 20_000


def rank_order(by: str, ties: Sequence[str]) -> list[Column]:
    """Highest first, unknown last, then the tie-breakers."""
    return [F.desc_nulls_last(by), *[F.asc_nulls_last(t) for t in ties]]


def plain_rank(df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[str], name: str) -> DataFrame:
    """``row_number`` per group, for groups that fit a task.

    A following filter ``name <= k`` lets Spark keep only k rows per group before
    the shuffle, so under such a filter hot groups are harmless.
    """
    window = Window.partitionBy(*keys).orderBy(*rank_order(by, ties))
    return df.withColumn(name, F.row_number().over(window))


def _bit(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(MARKS))


def _word(hashed: Column) -> Column:
    return F.shiftright(_bit(hashed), 6)


def repeat_marks(df: DataFrame, keys: Sequence[str], many: int = EQUAL_ROWS) -> DataFrame:
    """The map of key hashes that occur more than once: ``_word`` and its 64 bits, ``_mask``, and in ``_many`` those of more
    than ``many`` rows. A null key is a key."""
    counted = df.select(F.xxhash64(*keys).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    one = F.expr(f"shiftleft(1L, cast(pmod(_h, {MARKS}) % 64 as int))")
    return counted.groupBy(_word(F.col("_h")).alias("_word")).agg(
        F.bit_or(one).alias("_mask"), F.bit_or(F.when(F.col("n") > many, one).otherwise(F.lit(0).cast("bigint"))).alias("_many")
    )


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Hashes (``_group``) and sizes (``n``) of groups with more than ``hot_rows`` rows, or None.

    There are at most rows / hot_rows of them.
    """
    counted = df.select(F.xxhash64(*keys).alias("_group")).groupBy("_group").agg(F.count(F.lit(1)).alias("n"))
    found = cut(counted.where(F.col("n") > hot_rows))
    return None if found.isEmpty() else found


def slices_for(hot: DataFrame, hot_rows: int) -> int:
    """How many slices hold about ``hot_rows`` rows each."""
    rows = hot.agg(F.sum("n")).collect()[0][0]
    return int(min(_MAX_SLICES, max(2, rows // max(hot_rows, 1))))


def _first_places(distinct: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    """Unlike rows with a number ``_m`` each: ``_first``, how many rows of their group come before."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return distinct.withColumn("_first", F.coalesce(F.sum("_m").over(before), F.lit(0)))


def _first_places_split(distinct: DataFrame, keys: Sequence[str], order: list[Column], slices: int) -> DataFrame:
    """The same where one group may span many tasks.

    Rows are range-partitioned by (group, order), so a hot group spreads over
    consecutive slices. The slice number is stored with the rows; what comes before a row is what comes
    before it within (group, slice) plus the group's rows in earlier slices.
    """
    sliced = cut(distinct.repartitionByRange(slices, *keys, *order).withColumn("_slice", F.spark_partition_id()))
    within = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per hot group and slice. A struct of the keys, because a key may be null.
    offsets = (
        sliced.groupBy(*keys, "_slice").agg(F.sum("_m").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(F.struct(*keys).alias("_key"), F.col("_slice").alias("_part"), "_before")
    )
    numbered = sliced.withColumn("_in", F.coalesce(F.sum("_m").over(within), F.lit(0)))
    same = F.struct(*keys).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_part"))
    joined = numbered.join(offsets, same)
    return joined.withColumn("_first", F.col("_in") + F.col("_before")).drop("_slice", "_key", "_part", "_before", "_in")


def _written_out(placed: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Each row as often as it was there, ranks ascending, a bounded number of equal rows in a task."""
    tasks = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = placed.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_m") - 1) / EQUAL_ROWS))))
    dealt = chunks.repartition(tasks, "_chunk", *columns)
    start = F.col("_chunk") * EQUAL_ROWS
    last = F.least(start + EQUAL_ROWS, F.col("_m"))
    return dealt.withColumn("_k", F.explode(F.sequence(start + 1, last))).select(*columns, (F.col("_first") + F.col("_k")).cast("int").alias(name))


def rank_large_groups(df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[str], name: str, settings: Settings) -> DataFrame:
    """Ranks of rows that share their key with very many others."""
    order = rank_order(by, ties)
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_m"))
    hot = hot_groups(distinct, keys, settings.hot_group_rows) if settings.look_for_hot_groups else None
    if hot is None:
        return _written_out(_first_places(distinct, keys, order), name, df.columns)
    slices = slices_for(hot, settings.hot_group_rows)
    grouped = distinct.withColumn("_group", F.xxhash64(*keys))
    usual = _first_places(grouped.join(hot, "_group", "left_anti").drop("_group"), keys, order)
    split = _first_places_split(grouped.join(hot, "_group", "left_semi").drop("_group"), keys, order, slices)
    return _written_out(usual.unionByName(split), name, df.columns)


def duplicate_rank(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    ties: Sequence[str],
    name: str = "_dupe_rank",
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Rank of each row within its duplicate group, 1 for the row to keep.

    Only rows whose key may repeat are shuffled. Building the plan runs no job, unless ``settings`` say that
    groups of many unlike rows shall be looked for. Where the footers of a few files tell that there are
    too few rows to be worth a pass over the keys, all are ranked by one window.
    """
    rows = rows_in_files(df)
    if rows is not None and rows <= settings.task_rows:
        return plain_rank(df, keys, by, ties, name)
    hashed = F.xxhash64(*keys)
    marked = df.withColumns({"_word": _word(hashed), "_at": (_bit(hashed) % 64).cast("int")})
    marked = marked.join(F.broadcast(repeat_marks(df, keys, EQUAL_ROWS)), "_word", "left")
    repeats, many = (F.coalesce(F.expr(f"(shiftright({m}, _at) & 1L) = 1L"), F.lit(False)) for m in ("_mask", "_many"))
    unique = marked.where(~repeats).select(*df.columns, F.lit(1).alias(name))
    few = plain_rank(marked.where(repeats & ~many).select(*df.columns), keys, by, ties, name)
    large = rank_large_groups(marked.where(many).select(*df.columns), keys, by, ties, name, settings)
    return unique.unionByName(few).unionByName(large)


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their group, as one row ``duplicates``.

    Needs no rank: rows minus groups, combined before the shuffle.
    """
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the least ``order`` per key, by an aggregate instead of a window.

    ``order`` must be unique within a key, or its equals must be the same row. The
    aggregate combines before the shuffle, so a key repeated very often costs no
    more than any other.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    picked = df.groupBy(*keys).agg(F.min(order).alias(order), *[F.min_by(c, order).alias(c) for c in rest])
    return picked.select(*df.columns)
