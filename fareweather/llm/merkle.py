"""A Merkle manifest of the documents: one root for the table, and for each document the proof that leads to it.

Slot pivot: a level's nodes are numbered, sixteen consecutive ones are the children of one parent,
and conditional aggregates spread them over sixteen columns, one for each slot. The
columns in a row, hashed, are the parent; the columns without a node's own are its
siblings. Proofs go down again from the root: what leads from a parent to the root is
made once for its sixteen children. All of it is built-in functions.

Leaves are numbered without a window over a source: one range shuffle sorts all of them,
each task numbers its own run, and the runs before are added up.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

#: Children of a parent.
FANOUT = 16
#: Nodes of a level, with their children, in a file of the checkpoint folder; about 2 MB.
FILE_NODES = 2_048
#: Columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    """A value with its number of UTF-8 bytes before it; ``-`` for none."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    return _hash(*[_field(columns[c]) for c in FIELDS])


def _lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _cut_small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of at most ``rows`` rows written to no more files than these fill: a small level isn't spread over all tasks of a shuffle."""
    return cut(df.coalesce(max(1, -(-rows // FILE_NODES))))


def _leaves(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, source, its leaf and, where its text is tampered with, the leaf of that."""
    own = {c: F.col(c) for c in FIELDS}
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = leaf(own | {"text": _lower_ascii(F.col("text").cast("string"))})
    return documents.select("doc_id", "source", leaf(own).alias("leaf"), F.when(touched, other).alias("tampered"))


def _numbered(leaves: DataFrame) -> DataFrame:
    """Every leaf with ``g``, its source's place among the sources, ``i``, its place in its source,
    and ``total``, its source's leaves; all places from 0. Also ``groups``, the number of sources.

    Rows of one id go by their leaf; equal rows by where they were read, which changes no result.
    """
    # The last key spreads rows that are equal in all else.
    ties = [F.asc_nulls_first(c) for c in ("source", "doc_id")] + [F.col("leaf"), F.col("_at")]
    read = leaves.withColumn("_at", F.monotonically_increasing_id())
    run = read.repartitionByRange(*ties).sortWithinPartitions(*ties).drop("_at")
    run = cut(run.withColumn("n", F.monotonically_increasing_id()))
    run = run.withColumn("slice", F.shiftright("n", 33))  # the high bits are the task's number
    # From here on one row for each source and slice.
    parts = cut(run.groupBy("source", "slice").agg(F.min("n").alias("at"), F.count("*").alias("rows")))
    of_source = Window.partitionBy("source")
    before = of_source.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({
        "before": F.coalesce(F.sum("rows").over(before), F.lit(0)), "total": F.sum("rows").over(of_source), "first": F.min("at").over(of_source),
    })
    # Sources are numbered as leaves are: within the slice they begin in, after those of slices before.
    begins = parts.where("at = first").select("source", "slice", F.row_number().over(Window.partitionBy("slice").orderBy("first")).alias("k"))
    each = begins.groupBy("slice").agg(F.count("*").alias("sources"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row a task of the sort
    each = each.select("slice", F.coalesce(F.sum("sources").over(earlier), F.lit(0)).alias("earlier"), F.sum("sources").over(Window.partitionBy()).alias("groups"))
    groups = begins.join(each, "slice").select(F.col("source").alias("s"), (F.col("earlier") + F.col("k") - 1).alias("g"), "groups")
    parts = parts.join(groups, F.col("source").eqNullSafe(F.col("s"))).select("s", F.col("slice").alias("p"), "at", "before", "total", "g", "groups")
    found = run.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("p")))
    return found.select("g", (F.col("n") - F.col("at") + F.col("before")).alias("i"), "total", "groups", "doc_id", "leaf", "tampered")


def _slots() -> list[str]:
    return [f"c{k}" for k in range(FANOUT)]


def _pivot(nodes: DataFrame) -> DataFrame:
    """Parents of nodes (g, i, total, digest): g, i, total of parents, the children's columns, and the digest."""
    slot = F.col("i") % FANOUT
    children = [F.max(F.when(slot == k, F.col("digest"))).alias(c) for k, c in enumerate(_slots())]
    spread = nodes.groupBy("g", F.floor(F.col("i") / FANOUT).alias("i")).agg(F.max("total").alias("total"), *children)
    parents = F.ceil(F.col("total") / FANOUT).cast("long")
    return spread.withColumn("total", parents).withColumn("digest", F.sha2(F.concat_ws("", *_slots()), 256))


def _levels(nodes: DataFrame) -> tuple[list[DataFrame], list[int], DataFrame]:
    """The pivoted levels from the lowest, each of groups with more than one node below it, the most rows each may have, and each
    group's top: g, depth, digest. One level is a sixteenth of the one below."""
    most, rows, groups = nodes.agg(F.coalesce(F.max("total"), F.lit(0)), F.count("*"), F.count_if(F.col("i") == 0)).first()
    levels, sizes, tops, depth = [], [], nodes.where("total = 1").select("g", F.lit(0).alias("depth"), "digest"), 0
    while most > 1:
        sizes.append(rows := rows // FANOUT + groups)  # a group's last parent may have few children
        levels.append(_cut_small(_pivot(nodes.where("total > 1")), rows))
        nodes, most, depth = levels[-1].select("g", "i", "total", "digest"), -(-most // FANOUT), depth + 1
        tops = tops.unionAll(nodes.where("total = 1").select("g", F.lit(depth).alias("depth"), "digest"))
    return levels, sizes, tops


def _siblings(k: Column) -> Column:
    """The columns left and right of slot ``k``, each in a row."""
    left = [F.when(k > j, F.col(c)) for j, c in enumerate(_slots())]
    right = [F.when(k < j, F.col(c)) for j, c in enumerate(_slots())]
    return F.struct(F.concat_ws("", *left).alias("l"), F.concat_ws("", *right).alias("r"))


def _down(levels: list[DataFrame], sizes: list[int], tops: DataFrame) -> DataFrame:
    """What leads from the lowest level's parents, and from tops of depth 0, to the root: g, i, depth, path, subroot, root.

    ``tops``: g, depth, path, subroot, root. A path has the siblings of each level from the lowest, left and right.
    """
    ends = tops.select("g", F.lit(0).cast("long").alias("i"), "depth", "path", "subroot", "root")
    above = ends.where(F.col("depth") == len(levels))
    for level in range(len(levels) - 1, 0, -1):
        spread = levels[level].drop("total", "digest").join(above.drop("depth"), ["g", "i"])
        slot = F.explode(F.sequence(F.lit(0), F.lit(FANOUT - 1))).alias("k")
        child = spread.select("*", slot).where(F.element_at(F.array(*_slots()), F.col("k") + 1).isNotNull())
        child = child.select(
            "g", (F.col("i") * FANOUT + F.col("k")).alias("i"), F.lit(level).alias("depth"),
            F.concat(F.array(_siblings(F.col("k"))), F.col("path")).alias("path"), "subroot", "root",
        )
        above = _cut_small(child.unionAll(ends.where(F.col("depth") == level)), sizes[level - 1])
    return above


def _folded(digest: Column, path: Column) -> Column:
    return F.aggregate(path, digest, lambda own, side: _hash(side["l"], own, side["r"]))


def manifest(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Any column may be null; a null id comes first in its source and is never tampered with,
    a null source is the first of all. Rows of one id are leaves each, ordered by their hash. A lone leaf is
    its source's subroot and a lone subroot the root; their proof is the hash of nothing. An
    empty table gives an empty result. Columns beside the five play no part.
    """
    leaves = cut(_numbered(_leaves(documents)))
    levels, sizes, tops = _levels(leaves.select("g", "i", "total", F.col("leaf").alias("digest")))
    # The sources' subroots are the leaves of one more tree.
    number = leaves.agg(F.max("groups")).first()[0] or 0
    tops = _cut_small(tops, number)
    roots = tops.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("i"), F.lit(number).cast("long").alias("total"), "digest")
    upper, upper_sizes, top = _levels(roots)
    nothing = F.array().cast("array<struct<l:string,r:string>>")
    top = top.select("g", "depth", nothing.alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    if upper:
        over = _proofs(roots, upper, upper_sizes, top)
    else:
        over = top.select(F.col("g").alias("i"), "path", "root")
    named = tops.join(over.withColumnRenamed("i", "g"), "g").select("g", "depth", "path", F.col("digest").alias("subroot"), "root")
    above = _cut_small(named, number) if levels else named
    done = leaves.withColumn("k", (F.col("i") % FANOUT).cast("int")).withColumn("parent", F.floor(F.col("i") / FANOUT))
    alone = done.where("total = 1").join(above.where("depth = 0").drop("depth"), "g")
    if levels:
        low = _down(levels, sizes, above).where("depth > 0").drop("depth").withColumnRenamed("i", "parent")
        spread = levels[0].drop("total", "digest").withColumnRenamed("i", "parent").join(low, ["g", "parent"])
        many = done.where("total > 1").join(spread, ["g", "parent"])
        many = many.withColumn("path", F.concat(F.array(_siblings(F.col("k"))), F.col("path")))
        every = many.select(*_PROVED).unionAll(alone.select(*_PROVED))
    else:
        every = alone.select(*_PROVED)
    proof = F.array_join(F.transform("path", lambda side: F.concat(side["l"], side["r"])), "")
    folded = every.withColumn("folded_root", _folded(F.coalesce("tampered", "leaf"), F.col("path"))).withColumn("proof_sha256", F.sha2(proof, 256))
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_PROVED = ("doc_id", "leaf", "tampered", "path", "subroot", "root")


def _proofs(nodes: DataFrame, levels: list[DataFrame], sizes: list[int], tops: DataFrame) -> DataFrame:
    """Per node of one tree: i, path, root."""
    low = _down(levels, sizes, tops).drop("depth", "subroot").withColumnRenamed("i", "parent")
    spread = levels[0].drop("total", "digest").withColumnRenamed("i", "parent").join(low, ["g", "parent"])
    own = nodes.select("g", "i", F.floor(F.col("i") / FANOUT).alias("parent")).join(spread, ["g", "parent"])
    path = F.concat(F.array(_siblings((F.col("i") % FANOUT).cast("int"))), F.col("path"))
    return own.select("i", path.alias("path"), "root")


def op11_slot_pivot_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest(table(spark, folder, "documents"))


#: The same with each level as one list, and one step of a recursion for each level.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS i,
         sha256(concat(F(doc_id::VARCHAR), F(source), F(lang), F(n_chars::VARCHAR), F(text))) AS leaf,
         sha256(concat(F(doc_id::VARCHAR), F(source), F(lang), F(n_chars::VARCHAR),
                F(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')))) AS other,
         xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]),
           lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT FOR x IN range(8)]),
             lambda c, e: xor(c >> 1, (c & 1) * 3988292384))), 4294967295) % 5 = 0 AS touched
  FROM documents
), t AS (
  SELECT source, 0 AS lvl, list(leaf ORDER BY i) AS nodes FROM d GROUP BY source
  UNION ALL
  SELECT source, lvl + 1, [sha256(array_to_string(nodes[16 * j + 1:16 * j + 16], '')) FOR j IN range(0, (len(nodes) + 15) // 16)] FROM t WHERE len(nodes) > 1
), tops AS (
  SELECT source, lvl AS depth, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM t WHERE len(nodes) = 1
), u AS (
  SELECT 0 AS lvl, list(subroot ORDER BY g) AS nodes FROM tops HAVING count(*) > 0
  UNION ALL
  SELECT lvl + 1, [sha256(array_to_string(nodes[16 * j + 1:16 * j + 16], '')) FOR j IN range(0, (len(nodes) + 15) // 16)] FROM u WHERE len(nodes) > 1
), steps AS (
  SELECT source, lvl, nodes, NULL::BIGINT AS g FROM t WHERE len(nodes) > 1
  UNION ALL
  SELECT source, depth + u.lvl, u.nodes, g FROM tops, u WHERE len(u.nodes) > 1
), f AS (
  SELECT d.i AS id, d.source, 0 AS lvl, d.i AS pos, '' AS proof, CASE WHEN touched THEN other ELSE leaf END AS own FROM d
  UNION ALL
  SELECT f.id, f.source, f.lvl + 1, p // 16, proof || array_to_string(nodes[p - p % 16 + 1:p], '') || array_to_string(nodes[p + 2:p - p % 16 + 16], ''),
         sha256(array_to_string(nodes[p - p % 16 + 1:p], '') || own || array_to_string(nodes[p + 2:p - p % 16 + 16], ''))
  FROM (SELECT f.*, s.nodes, CASE WHEN s.g IS NOT NULL AND f.lvl = tops.depth THEN s.g ELSE f.pos END AS p
        FROM f JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.lvl = f.lvl JOIN tops ON tops.source IS NOT DISTINCT FROM f.source) f
), ends AS (SELECT id, source, max_by(proof, lvl) AS proof, max_by(own, lvl) AS own FROM f GROUP BY id, source)
SELECT d.doc_id, d.leaf, tops.subroot, r.root, sha256(ends.proof) AS proof_sha256, ends.own AS folded_root, ends.own = r.root AS verified
FROM d JOIN ends ON ends.id = d.i AND ends.source IS NOT DISTINCT FROM d.source
  JOIN tops ON tops.source IS NOT DISTINCT FROM d.source, (SELECT nodes[1] AS root FROM u WHERE len(nodes) = 1) r
"""


def _spelled(sql: str) -> str:
    """The SQL with each F(x), a value with its size before it, written out."""

    def field(m):
        x = m[1]
        return f"coalesce(octet_length(encode({x}))::VARCHAR || ':' || {x}, '-')"

    return re.sub(r"\bF\(((?:[^()]|\([^()]*\))*)\)", field, sql)


QUERIES = {"op11_slot_pivot_manifest": op11_slot_pivot_manifest}
ORACLES = {"op11_slot_pivot_manifest": _spelled(ORACLE)}
