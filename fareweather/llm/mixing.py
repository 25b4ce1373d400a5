"""Mixing sources to target weights by Pareto order sampling.

Sources get word targets by weight. A document is expected in the mix as often as its
source's target exceeds the source's size; whole copies are certain, and the rest is
an inclusion probability. Documents are ranked by random odds divided by inclusion
odds, and each source takes the first of them until its target is met. Sums along
the ranks are made of sums of slices, so a source may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, cut, fresh, table, text_or_empty

#: Weights by source, in order of name, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix by words of all documents.
SHARE = 1.5
#: Most copies of a document.
MOST = 2
#: Slices of a source's ranks.
SLICES = 1 << 14
SEED = "mix-1"


def words(text: Column) -> Column:
    """Runs of other characters than white space."""
    return F.regexp_count(text_or_empty(text), F.lit(f"[^{SPACE[1:-1]}]+")).cast("long")


def draw(key: Column, text: Column, seed: str = SEED) -> Column:
    """A number between 0 and 1, neither included, that key and text alone decide."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")), F.md5(text_or_empty(text).cast("binary"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") + F.lit(0.5)) / float(1 << 48)


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per source: source, source_size, target.

    ``sizes`` holds source and size, one row per document. All sources together get
    ``share`` of all sizes by weight, none more than ``most`` times its own size; what is
    over goes to the others by weight. Sources under the level share it by weight, so
    the level is found by one pass in the order of limit by weight. The window is
    over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weighed = per_source.withColumn("weight", F.get(F.array(*map(F.lit, weights)), (place % len(weights)).cast("int")).cast("double"))
    weighed = weighed.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("cap").over(order), F.lit(0.0))
    level = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(order), F.lit(0.0)))
    # The limits before the first source that stays under its level are met in full; later levels are lower.
    first = F.max(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level"))).over(whole)
    return weighed.withColumn("level", level).withColumn("at", first).select(
        "source", "source_size", F.least("cap", F.coalesce(F.col("at") * F.col("weight"), F.col("cap"))).alias("target")
    )


def _odds_rank(target: Column, source_size: Column, u: Column) -> Column:
    """Random odds by inclusion odds, brought to the range from 0 to 1. Without a rest of
    the target the rank plays no part."""
    p = target / source_size - F.floor(target / source_size)
    q = (u / (1 - u)) / (p / (1 - p))
    return F.when(p > 0, q / (1 + q)).otherwise(u)


def cuts(documents: DataFrame, by_source: DataFrame) -> DataFrame:
    """Per source the last rank that gets one more copy: source, copies, cut_rank, cut_key.

    ``documents``: source, size, u and a key that settles equal ranks. A document is taken
    if at least half of it is within the rest of its source's target. Documents equal in rank
    and key are one unit and share its fate.
    """
    placed = documents.where("size > 0").join(by_source.where("source_size > 0").withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    copies = F.floor(F.col("target") / F.col("source_size"))
    ranked = placed.select(
        "source", "size", "key", copies.alias("copies"), (F.col("target") - copies * F.col("source_size")).alias("rest"),
        _odds_rank(F.col("target"), F.col("source_size"), F.col("u")).alias("rank"),
    ).withColumn("slice", F.floor(F.col("rank") * SLICES).cast("int"))
    slices = ranked.groupBy("source", "copies", "rest", "slice").agg(F.sum("size").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    summed = slices.withColumn("before", before)
    # The slice in which the rest ends; all before it are taken, all after it are not.
    last = summed.where("before < rest and before + size >= rest").select(F.col("source").alias("s"), F.col("slice").alias("at"), "before")
    units = ranked.join(last, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("at"))).groupBy("source", "slice", "before", "rest", "rank", "key").agg(F.sum("size").alias("size"))
    within = Window.partitionBy("source", "slice").orderBy("rank", "key").rowsBetween(Window.unboundedPreceding, -1)
    taken = units.withColumn("sum", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))).where("sum + size / 2 <= rest")
    ends = taken.groupBy("source").agg(F.max(F.struct("rank", "key")).alias("end")).select(F.col("source").alias("e"), "end")
    # With none taken there, the end is where the slice begins.
    starts = last.select(F.col("s").alias("b"), (F.col("at") / float(SLICES)).alias("start"))
    per = by_source.where("source_size > 0").withColumn("copies", F.floor(F.col("target") / F.col("source_size")))
    joined = per.join(ends, F.col("source").eqNullSafe(F.col("e")), "left").join(starts, F.col("source").eqNullSafe(F.col("b")), "left")
    return joined.select("source", "source_size", "target", "copies", F.coalesce(F.col("end.rank"), F.col("start"), F.lit(-1.0)).alias("cut_rank"), F.coalesce(F.col("end.key"), F.lit("")).alias("cut_key"))


def _narrow(documents: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    t = F.col(text)
    return documents.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words(t).alias("size"), draw(F.col(doc_id), t).alias("u"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("key"),
    )


def _decided(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows with source, size, u and key, and how often each is taken."""
    e = ends.select(F.col("source").alias("s"), "source_size", "target", "copies", "cut_rank", "cut_key")
    joined = rows.join(e, F.col("source").eqNullSafe(F.col("s")), "left")
    rank = _odds_rank(F.col("target"), F.col("source_size"), F.col("u"))
    more = (F.col("target") > F.col("copies") * F.col("source_size")) & (F.struct(rank, "key") <= F.struct("cut_rank", "cut_key"))
    return joined.withColumn("taken", F.when(F.col("size") > 0, F.col("copies") + F.when(more, 1).otherwise(0)).otherwise(0).cast("long"))


def plan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (words the mix takes), copies.

    A null text and an empty one have size 0 and are never taken. A null source is a source,
    the last. Repeated rows with one id and text are taken alike; with a null id, texts
    are told apart. A source without words has target 0. An empty table gives an empty result.
    """
    rows = cut(_narrow(documents, doc_id, text, source))
    by_source = cut(targets(rows, weights, share, most))
    done = _decided(rows, cut(cuts(rows, by_source)))
    zero = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind)
    return done.select("doc_id", "size", zero("source_size", "long").alias("source_size"), zero("target", "double").alias("target"), (F.col("size") * F.col("taken")).alias("taken"), F.col("taken").cast("int").alias("copies"))


def mix(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: the rows of ``documents``, each as often as it is taken, in its own columns."""
    rows = cut(_narrow(documents, doc_id, text, source))
    ends = cut(cuts(rows, cut(targets(rows, weights, share, most))))
    names = ("size", "u", "key", "taken", "copy", "cut_source", "cut_copies", "cut_size", "cut_target", "cut_rank", "cut_key")
    n = dict(zip(names, fresh(documents, *names)))
    e = ends.select(F.col("source").alias(n["cut_source"]), F.col("source_size").alias(n["cut_size"]), F.col("target").alias(n["cut_target"]), F.col("copies").alias(n["cut_copies"]), F.col("cut_rank").alias(n["cut_rank"]), F.col("cut_key").alias(n["cut_key"]))
    # Sources without words have no row here, and their documents no words: nothing is taken.
    wide = documents.join(e, F.col(source).eqNullSafe(F.col(n["cut_source"])))
    rank = _odds_rank(F.col(n["cut_target"]), F.col(n["cut_size"]), draw(F.col(doc_id), F.col(text)))
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    more = (F.col(n["cut_target"]) > F.col(n["cut_copies"]) * F.col(n["cut_size"])) & (F.struct(rank, key) <= F.struct(n["cut_rank"], n["cut_key"]))
    has_words = text_or_empty(F.col(text)).rlike(f"[^{SPACE[1:-1]}]")
    times = F.when(has_words, F.col(n["cut_copies"]) + F.when(more, 1).otherwise(0)).otherwise(0).cast("int")
    return wide.withColumn(n["copy"], F.explode(F.array_repeat(F.lit(0), times))).select(*[documents[c] for c in documents.columns])


def op5_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    return plan(table(spark, folder, "documents"))


#: The same by plain sums over whole sources.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, coalesce(doc_id::VARCHAR, '') AS k,
         (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([3, 1, 2])[1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)]::DOUBLE AS w
  FROM d GROUP BY source
), l AS (
  SELECT *, source_size * 2::DOUBLE AS cap,
         (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size * 2::DOUBLE) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
  FROM s WINDOW o AS (ORDER BY source_size * 2::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least(cap, coalesce((SELECT max(level) FROM l m WHERE m.cap >= m.level * m.w) * w, cap)) AS target FROM l
), p AS (
  SELECT d.*, source_size, target, floor(target / source_size) AS copies, target / source_size - floor(target / source_size) AS p
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), r AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) ELSE u END AS q FROM p
), c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY source, q, k) AS unit
  FROM r
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * CASE WHEN size = 0 THEN 0 ELSE copies + CASE WHEN p > 0 AND upto - unit / 2 <= target - copies * source_size THEN 1 ELSE 0 END END)::BIGINT AS taken,
       CASE WHEN size = 0 THEN 0 ELSE copies + CASE WHEN p > 0 AND upto - unit / 2 <= target - copies * source_size THEN 1 ELSE 0 END END::INTEGER AS copies
FROM c
"""

QUERIES = {"op5_pareto_mix": op5_pareto_mix}
ORACLES = {"op5_pareto_mix": ORACLE}
