"""Chat formatting: logged conversations that are snapshots of longer ones collapse, the rest is rendered.

A conversation logged after every turn leaves many snapshots, each the beginning of the
next. A rolling hash of each beginning, by its number of turns, tells if a whole
conversation is the beginning of a longer one; an anti-join keeps those that aren't.
The rolling hash is the exclusive or of hashes that know their turn's place, so it is
summed up over blocks of turns first: no conversation has to fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Turns are summed up in blocks of so many turn numbers.
BLOCK = 256
#: Turns of a rendered row at most.
SEGMENT = 256
# Marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _turns(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct turns with a block number. A turn without a number comes first; a missing role is
    "unknown" and a missing text empty."""
    plain = rows.select(
        F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    slim = plain.withColumn("h", F.xxhash64("role", "text"))
    return slim.dropDuplicates(["conv", "turn", "h"]).withColumn("block", F.floor(F.coalesce(F.col("turn"), F.lit(-(1 << 62))) / BLOCK))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def numbered(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every turn with its place in its conversation (from 1), the number of its conversation's turns,
    and the rolling hashes h1 and h2 of the turns up to it."""
    turns = cut(_turns(rows, conv_id, turn, role, text))
    in_block = Window.partitionBy("conv", "block").orderBy(F.asc_nulls_first("turn"), "h")
    sizes = turns.groupBy("conv", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv")
    starts = sizes.select("conv", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("turns"))
    starts = starts.withColumnsRenamed({"conv": "c", "block": "b"})
    placed = turns.withColumn("in_block", F.row_number().over(in_block)).join(starts, _same(F.col("conv"), F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")
    placed = placed.withColumn("place", F.col("before") + F.col("in_block")).withColumns({
        "x1": F.xxhash64("place", "role", "text"), "x2": F.xxhash64(F.lit(1), "text", "role", "place"),
    })
    upto = in_block.rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumns({"y1": F.bit_xor("x1").over(upto), "y2": F.bit_xor("x2").over(upto)})
    sums = running.groupBy("conv", "block").agg(F.bit_xor("x1").alias("z1"), F.bit_xor("x2").alias("z2"))
    carried = sums.select(F.col("conv").alias("c"), F.col("block").alias("b"), F.coalesce(F.bit_xor("z1").over(before), F.lit(0)).alias("w1"), F.coalesce(F.bit_xor("z2").over(before), F.lit(0)).alias("w2"))
    done = running.join(carried, _same(F.col("conv"), F.col("c")) & (F.col("block") == F.col("b")))
    return done.select("conv", "place", "turns", "role", "text", F.col("y1").bitwiseXOR(F.col("w1")).alias("h1"), F.col("y2").bitwiseXOR(F.col("w2")).alias("h2"))


def maximal(places: DataFrame) -> DataFrame:
    """The conversations that begin no longer one; of equal conversations the one of the smallest id."""
    ends = places.where("place = turns").groupBy("turns", "h1", "h2").agg(F.min("conv").alias("conv"))
    beginnings = places.where("place < turns").select(F.col("place").alias("turns"), "h1", "h2").distinct()
    return ends.join(beginnings, ["turns", "h1", "h2"], "left_anti").select("conv")


def rendered(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per segment of a kept conversation: conv_id, segment (from 0), turns (of the conversation), text.

    Turns go by their number, those without one first, equal numbers by a hash of role and text; a turn
    logged twice in one conversation is one. Each is rendered with its role between marks. A
    conversation of up to SEGMENT turns is one row, a longer one several in order. Rows with
    a null id are one conversation, which is kept unless it begins another or equals one with
    an id. An empty table gives an empty result; other columns play no part.
    """
    places = cut(numbered(rows, conv_id, turn, role, text))
    kept = maximal(places).withColumnRenamed("conv", "k")
    turns = places.join(kept, _same(F.col("conv"), F.col("k")), "left_semi")
    one = F.concat(F.lit(OPEN), F.col("role"), F.lit("\n"), F.col("text"), F.lit(CLOSE))
    segments = turns.groupBy("conv", F.floor((F.col("place") - 1) / SEGMENT).cast("int").alias("segment"), "turns").agg(
        F.array_sort(F.collect_list(F.struct("place", one.alias("one")))).alias("all")
    )
    return segments.select(F.col("conv").alias("conv_id"), "segment", F.col("turns").cast("long").alias("turns"), F.array_join(F.col("all.one"), "").alias("text"))


def op2_snapshot_collapse(spark: SparkSession, folder: str) -> DataFrame:
    return rendered(table(spark, folder, "conversations"))


#: The same by comparing lists of turns.
ORACLE = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST) AS all_turns FROM t GROUP BY conv_id),
f AS (SELECT all_turns, min(conv_id) AS conv_id FROM c GROUP BY all_turns),
p AS (SELECT DISTINCT md5(all_turns[1:k]::VARCHAR) AS h, k FROM (SELECT all_turns, unnest(range(1, len(all_turns))) AS k FROM f)),
m AS (SELECT conv_id, all_turns FROM f WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = len(f.all_turns) AND p.h = md5(f.all_turns::VARCHAR))),
s AS (SELECT conv_id, all_turns, unnest(range(0, (len(all_turns) + 255) // 256)) AS segment FROM m)
SELECT conv_id, segment::INTEGER AS segment, len(all_turns)::BIGINT AS turns,
       array_to_string([('<|im_start|>' || x.r || chr(10) || x.t || '<|im_end|>' || chr(10)) FOR x IN all_turns[segment * 256 + 1:segment * 256 + 256]], '') AS text
FROM s
"""

QUERIES = {"op2_snapshot_collapse": op2_snapshot_collapse}
ORACLES = {"op2_snapshot_collapse": ORACLE}
