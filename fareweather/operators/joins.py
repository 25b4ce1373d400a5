"""Enrichment joins that keep every left row.

The hour key and the zone keys are few and hot: a shuffle join on them would send
most trips to few tasks. The dimension is therefore broadcast when its size is
known to be small. Otherwise a frequency sketch of the facts finds the hot keys, and only these
are dealt over tasks, as many as their share of the rows asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULTS, Settings


def sized_for_broadcast(dim: DataFrame, settings: Settings = DEFAULTS) -> tuple[DataFrame, bool]:
    """The dimension and whether it is known to be small: its rows are counted and their bytes added up, as far as the limit."""
    varying = [F.octet_length(F.col(f"`{f.name}`").cast("string")) for f in dim.schema.fields if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))]
    width = F.lit(8 * len(dim.columns))
    for w in varying:
        width = width + F.coalesce(w, F.lit(0))
    some = dim.limit(settings.broadcast_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return dim, some.rows <= settings.broadcast_rows and some.bytes <= settings.broadcast_bytes


def hot_keys(facts: DataFrame, on: list[str], tasks: int, most: int = DEFAULTS.hot_keys) -> DataFrame:
    """Hashes of keys (``_key``) that hold more than one task's share of the rows, and ``_salts``, how many shares.

    By a sketch of frequent items, which combines before its shuffle: at most ``most`` rows, found as the plan
    runs. A sketch's count may be somewhat low, so a key just above its share may be missed, and never a hot one.
    """
    hashed = facts.select(F.xxhash64(*on).alias("_k"))
    sketched = hashed.agg(F.expr(f"approx_top_k(_k, {most}, {8 * most})").alias("top"), F.count(F.lit(1)).alias("rows"))
    each = sketched.select("rows", F.inline("top").alias("_key", "n"))
    shares = F.ceil(F.col("n") * tasks / F.col("rows")).cast("int")
    return each.select("_key", shares.alias("_salts")).where("_salts > 1")


def salted_join(facts: DataFrame, dim: DataFrame, on: list[str], how: str, tasks: int, most: int = DEFAULTS.hot_keys) -> DataFrame:
    """Equi-join in which rows of a hot key go to as many tasks as its share, and only its dimension row is repeated.

    A fact's salt is a hash of its own values (but maps, which have no hash), so a
    task that runs again gives the same rows. ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``.
    """
    hot = hot_keys(facts, on, tasks, most)
    hashed: list[Column] = [F.col(f"`{f.name}`") for f in facts.schema.fields if '"map"' not in f.dataType.json()]
    with_share = facts.withColumn("_key", F.xxhash64(*on)).join(F.broadcast(hot), "_key", "left")
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*hashed), F.col("_salts")).cast("int")).otherwise(F.lit(0))
    salted = with_share.withColumn("_salt", salt).drop("_key", "_salts")
    shared = dim.withColumn("_key", F.xxhash64(*on)).join(F.broadcast(hot), "_key", "left")
    repeated = shared.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_key", "_salts")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def _join_sized(
    facts: DataFrame, dim: DataFrame, small: bool, on: list[str], settings: Settings, how: str
) -> DataFrame:
    if small:
        return facts.join(F.broadcast(dim), on, how)
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if facts.isStreaming:  # a stream can't be looked at first
        return facts.join(dim, on, how)
    return salted_join(facts, dim, on, how, tasks, settings.hot_keys)


def attach(
    facts: DataFrame, dim: DataFrame, on: list[str], settings: Settings = DEFAULTS, how: str = "left"
) -> DataFrame:
    """Join ``facts`` to ``dim`` on equally named columns."""
    dim, small = sized_for_broadcast(dim, settings)
    return _join_sized(facts, dim, small, on, settings, how)


def attach_hour_conditions(trips: DataFrame, weather: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Left join on the UTC hour; a trip without an observed hour keeps nulls."""
    dim = weather.withColumnRenamed("observed_hour_utc", "pickup_hour_utc").where("pickup_hour_utc IS NOT NULL")
    return attach(trips, dim, ["pickup_hour_utc"], settings)


def attach_zone_roles(
    trips: DataFrame, zones: DataFrame, settings: Settings = DEFAULTS, roles: tuple[str, ...] = ("pickup", "dropoff")
) -> DataFrame:
    """The zone dimension once per role: ``{role}_zone`` and ``{role}_borough`` for ``{role}_zone_id``."""
    dim, small = sized_for_broadcast(
        zones.where("LocationID IS NOT NULL").select(F.col("LocationID").cast("int").alias("_id"), "Zone", "Borough"),
        settings,
    )
    for role in roles:
        named = dim.select(
            F.col("_id").alias(f"{role}_zone_id"),
            F.col("Zone").alias(f"{role}_zone"),
            F.col("Borough").alias(f"{role}_borough"),
        )
        trips = _join_sized(trips, named, small, [f"{role}_zone_id"], settings, "left")
    return trips


def primary_with_backfill(
    primary: DataFrame, backfill: DataFrame, keys: list[str], measures: list[str]
) -> DataFrame:
    """Full outer join where the primary source wins, value by value.

    ``filled_from`` says where a row came from: ``primary``, ``backfill`` or
    ``both``. Keys are matched null-safely so that no unmatched row is lost.
    """
    same = None
    for k in keys:
        term = F.col(f"p.{k}").eqNullSafe(F.col(f"b.{k}"))
        same = term if same is None else same & term
    p = primary.withColumn("_p", F.lit(True)).alias("p")
    b = backfill.withColumn("_b", F.lit(True)).alias("b")
    source = (
        F.when(F.col("p._p").isNull(), F.lit("backfill"))
        .when(F.col("b._b").isNull(), F.lit("primary"))
        .otherwise(F.lit("both"))
    )
    return p.join(b, same, "full").select(
        *[F.coalesce(F.col(f"p.{c}"), F.col(f"b.{c}")).alias(c) for c in [*keys, *measures]],
        source.alias("filled_from"),
    )
