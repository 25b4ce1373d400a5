"""N-gram Jaccard join by T-occurrence search over inverted lists.

Two texts link when their sets of word shingles share enough. With a threshold t, a set
of n shingles must share T = t * n with any partner, and 2t / (1 + t) * n with one that isn't
smaller. Each set's shingles are put in one order for all, the rarest first. The lists of
its first n - T + K shingles are its short lists, the others its long ones: a partner
occurs in at least K of the short lists (DivideSkip), of the larger set by the first T and
of the smaller one by the second. A set's short lists are sorted runs, merged by a heap that skips what can't
occur K times any more; the long ones are probed by binary search in the candidate's
sorted set, until the overlap is reached or out of reach. The result is exact.

Hot groups: equal sets are one class. Then every list links its classes to its first one
only; what this joins needs no further pairs, so a large group of near copies costs
its size, not its square. The full search is left for lists that still hold
classes of several groups. Long runs are cut by a hash of the class, so no heap holds a whole list.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import blake2b
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, giving_back, let_go, table, text_or_empty
from .components import components
from .words import Words, blocks, in_blocks

#: Least number of short lists that partners share, K.
OCCURRENCES = 3
#: Counters of the shingles' frequencies; a shingle's order goes by its counter and then its hash.
COUNTERS = 1 << 14
#: Bits of the map of texts whose whole sets are looked at.
MARKS = 1 << 23
#: Classes of a run, about; a longer list is cut into several.
RUN = 4096
#: Shingles probed between two looks at whether a pair is settled.
PROBES = 64
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str], width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its shingles, of words in lower case (A-Z only).
    A text of fewer words is one shingle; one without words has none."""
    for a, b in blocks(texts):
        words = Words(texts[a:b], lower=True)
        each = pd.util.hash_array(np.array(words.distinct, dtype=object), categorize=False) if len(words.distinct) else np.empty(0, np.uint64)
        h = each[words.codes] if len(words.codes) else each
        for i in range(b - a):
            own = h[words.bounds[i]:words.bounds[i + 1]]
            k = min(width, len(own))
            if not k:
                yield np.empty(0, np.int64)
                continue
            n = len(own) - k + 1
            mix = np.full(n, k, np.uint64)
            for j in range(k):
                mix = _mixed(mix * _MIX[0] + own[j:j + n])
            yield np.unique(mix.view(np.int64))


def least_overlap(n, percent: int):
    """Overlap that a set of n shingles has with any partner at least."""
    return -(-percent * n // 100)


def short_lists(n, percent: int):
    """Number of a set's short lists."""
    need = least_overlap(n, percent)
    return n - need + np.minimum(OCCURRENCES, need)


def first_lists(n: Column, percent: int) -> Column:
    """Number of a set's short lists towards partners that aren't smaller."""
    need = F.ceil(n * (2 * percent) / (100 + percent))
    return n - need + F.least(F.lit(OCCURRENCES), F.ceil(n * percent / 100))


def _halves(s: np.ndarray) -> np.ndarray:
    return np.frombuffer(blake2b(s.tobytes(), digest_size=16).digest(), np.int64)


def _digests(rows: DataFrame, width: int) -> DataFrame:
    """Per row: id, tk, n and two halves of a digest of its set (c is null); and how often shingles of
    each counter c occur, n, over the rows of a task."""
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in in_blocks(batches, "t"):
            n, halves = [], []
            for s in shingle_sets(batch["t"].tolist(), width):
                n.append(len(s))
                halves.append(_halves(s))
                np.add.at(total, s & (COUNTERS - 1), 1)
            d = np.array(halves).reshape(-1, 2)
            yield pd.DataFrame({"id": batch["id"].astype("Int64").array, "tk": batch["tk"].array, "n": n, "d1": d[:, 0], "d2": d[:, 1], "c": pd.array([None] * len(n), "Int32")})
        used = np.flatnonzero(total)
        none = pd.array([None] * len(used), "Int64")
        yield pd.DataFrame({"id": none, "tk": none, "n": total[used], "d1": none, "d2": none, "c": pd.array(used, "Int32")})

    return rows.mapInPandas(giving_back(digest), "id bigint, tk bigint, n bigint, d1 bigint, d2 bigint, c int")


def _short(rows: DataFrame, width: int, percent: int, counts: np.ndarray) -> DataFrame:
    """Per row with a shingle: id, tk, n, its digest, and the shingles of its short lists."""
    def chosen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_blocks(batches, "t"):
            n, halves, short = [], [], []
            for s in shingle_sets(batch["t"].tolist(), width):
                order = np.lexsort((s, counts[s & (COUNTERS - 1)]))[:int(short_lists(len(s), percent))]
                n.append(len(s))
                halves.append(_halves(s))
                short.append(s[order])
            d = np.array(halves).reshape(-1, 2)
            out = pd.DataFrame({"id": batch["id"].astype("Int64").array, "tk": batch["tk"].array, "n": n, "d1": d[:, 0], "d2": d[:, 1], "short": pd.Series(short, dtype=object)})
            yield out[out["n"] > 0]

    return rows.mapInPandas(giving_back(chosen), "id bigint, tk bigint, n bigint, d1 bigint, d2 bigint, short array<bigint>")


def _bit() -> Column:
    return F.pmod(F.xxhash64("i", "tk"), F.lit(MARKS))


def _marked(texts: DataFrame) -> np.ndarray:
    """A bitmap of hashed texts (i, tk): MARKS bits at most, whatever their number. One without its bit
    isn't among them."""
    found = texts.select(F.floor(_bit() / 64).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(i, tk), {MARKS}) % 64 as int))").alias("m"))
    found = found.groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
    out = np.zeros(MARKS // 64, np.int64)
    out[found["w"].to_numpy(dtype=np.int64)] = found["m"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def _may_link(n: Column, m: Column, percent: int) -> Column:
    """If two sets of these sizes can link at all."""
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent)


@contextmanager
def _bucketed(rows: DataFrame, *keys: str) -> Iterator[DataFrame]:
    """The rows as a table in the warehouse, bucketed and sorted by ``keys`` while it is needed, so that
    joins on them move the other side only."""
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"jaccard_sets_{uuid.uuid4().hex}"
    try:
        rows.repartition(buckets, *keys).dropDuplicates(list(keys)).write.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name, format="parquet")
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _needed(n: Column, percent: int) -> Column:
    """Short lists that a set of n shingles shares with any partner at least."""
    return F.least(F.lit(OCCURRENCES), F.ceil(n * percent / 100))


def overlaps(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """If two sorted sets share enough: the smaller one's shingles are probed in the larger by binary search, in steps, until it is settled."""
    if len(a) > len(b):
        a, b = b, a
    need, shared = -(-percent * (len(a) + len(b)) // (100 + percent)), 0
    for at in range(0, len(a), PROBES):
        some = a[at:at + PROBES]
        place = np.searchsorted(b, some)
        shared += int(np.count_nonzero(b[np.minimum(place, len(b) - 1)] == some))
        left = len(a) - at - len(some)
        if shared >= need or shared + left < need:
            break
    return shared >= need


def _verified(pairs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of classes whose sets share enough. ``reps``: a text (i, tk) of each class."""
    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.loc[[overlaps(a, b, percent) for a, b in zip(batch["a"], batch["b"])], ["u", "v"]]

    for node, name in (("u", "a"), ("v", "b")):
        pairs = pairs.join(reps.select(F.col("c").alias(node), F.col("i").alias(f"i_{name}"), F.col("tk").alias(f"tk_{name}")), node)
    for name in ("a", "b"):  # sets come last, so that each moves once
        pairs = pairs.join(sets.select(F.col("i").alias(f"i_{name}"), F.col("tk").alias(f"tk_{name}"), F.col("s").alias(name)), [f"i_{name}", f"tk_{name}"]).drop(f"i_{name}", f"tk_{name}")
    return pairs.select("u", "v", "a", "b").mapInPandas(giving_back(probe), "u bigint, v bigint")


def _shared_lists(classes: DataFrame, percent: int) -> DataFrame:
    """Entries (s, c, lead, n, at, early) of the short lists that may lead somewhere: of more than one class, and an early one of some."""
    # Rows of few and small columns: n, the place and if the list is an early one are one number.
    packed = F.shiftleft("n", 32) + F.shiftleft("at", 1) + F.when(F.col("at") < first_lists(F.col("n"), percent), 1).otherwise(0)
    lists = classes.select("c", "n", F.posexplode("short").alias("at", "s")).select("s", "c", packed.alias("packed"))
    # One shuffle serves the sums and the join. A text has many shingles on its lists and each but
    # once, so even a list of all texts is a small part of the rows.
    lists = lists.repartition("s")
    first = lists.groupBy("s").agg(F.min("c").alias("lead"), F.max("c").alias("last"), F.max(F.col("packed") % 2).alias("any")).where("lead < last and any = 1")
    return lists.join(first.select("s", "lead"), "s").select(
        "s", "c", "lead", F.shiftright("packed", 32).alias("n"), (F.shiftright("packed", 1) % (1 << 31)).cast("int").alias("at"), (F.col("packed") % 2 == 1).alias("early"))


def _linked(rows: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes (id, tk, n, d1, d2: the digest of its set) per row of ``rows`` (id, tk, t); classes of
    equal sets (d1, d2, c), c being their number; and links (u, v) of classes."""
    passed = cut(_digests(rows, width))
    nodes = passed.where("c is null").drop("c")
    counts = np.zeros(COUNTERS, np.int64)
    for c, n in passed.where("c is not null").groupBy("c").agg(F.sum("n")).collect():
        counts[c] = n
    marked_rows = rows.withColumn("i", _row_key())
    alike = _short(rows, width, percent, counts).withColumn("i", _row_key()).groupBy("d1", "d2").agg(
        F.min(F.struct("i", "tk")).alias("rep"), F.first("n").alias("n"), F.first("short").alias("short"))
    classes = _numbered(cut(alike.select("d1", "d2", "rep.i", "rep.tk", "n", "short")))
    del passed, alike
    shared = cut(_shared_lists(classes, percent))
    let_go(rows.sparkSession)  # the lists
    # The sets of all classes on enough such lists, made anew from the texts rather than carried through the sorts above.
    wanted = shared.groupBy("c").agg(F.count("*").alias("occurs"), F.max("n").alias("n")).where(F.col("occurs") >= _needed(F.col("n"), percent)).select("c")
    reps = cut(classes.select("c", "i", "tk").join(wanted, "c"))
    marked = _marked(reps)

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_blocks(batches, "t"):
            bit = batch["bit"].to_numpy()
            some = batch[(marked[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1]
            yield pd.DataFrame({"i": some["i"].array, "tk": some["tk"].array, "s": pd.Series(list(shingle_sets(some["t"].tolist(), width)), dtype=object)})

    asked = marked_rows.select("i", "tk", "t", _bit().alias("bit")).mapInPandas(giving_back(whole), "i bigint, tk bigint, s array<bigint>").where(F.size("s") > 0)
    with _bucketed(asked, "i", "tk") as sets:
        let_go(rows.sparkSession)
        stars = shared.where(F.col("c") != F.col("lead")).groupBy(F.col("c").alias("u"), F.col("lead").alias("v")).agg(F.count("*").alias("occurs"), F.max("n").alias("n"))
        stars = stars.where(F.col("occurs") >= _needed(F.col("n"), percent)).select("u", "v")
        near = cut(_verified(stars, reps, sets, percent))
        let_go(rows.sparkSession)
        rest = cut(_unlike(shared, components(near), percent))
        let_go(rows.sparkSession)
        links = cut(near.unionAll(_verified(rest, reps, sets, percent)))
    return nodes, classes.select("d1", "d2", "c"), links


def _numbered(classes: DataFrame) -> DataFrame:
    """Classes with a number ``c``: the smallest id that has the set, so that a list's first class is the one of the smallest id, as
    copies are often later than what they were copied from. Where an id has the smallest of several classes, the others get a hash."""
    several = classes.groupBy("i").agg(F.count("*").alias("sets"), F.min(F.struct("d1", "d2")).alias("of")).where("sets > 1").select(F.col("i").alias("k"), "of")
    own = F.col("of").isNull() | (F.col("of") == F.struct("d1", "d2"))
    return classes.join(several, F.col("i") == F.col("k"), "left").withColumn("c", F.when(own, F.col("i")).otherwise(F.xxhash64("i", "tk", "d1", "d2"))).drop("k", "of")


def _row_key() -> Column:
    """The id, never null. One that is as small as this stands for may have the same text only, so nothing is mixed up."""
    return F.coalesce("id", F.lit(-(1 << 63)).cast("bigint"))


def _rows(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = documents.select(F.col(doc_id).cast("long").alias("id"), text_or_empty(F.col(text)).alias("t"))
    return rows.withColumn("tk", F.xxhash64("t"))


def joined(documents: DataFrame, width: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id.

    Texts link when the overlap is at least ``percent`` hundredths of the union. A null or empty text
    has no shingle and links with nothing; a row with a null id links with nothing and has no
    component. Rows of one id are one document, linked by the texts of each. An empty table gives an
    empty result.
    """
    rows = _rows(documents, doc_id, text)
    nodes, classes, links = _linked(rows.where("id is not null"), width, percent)
    placed = cut(nodes.join(classes, ["d1", "d2"], "left").select("id", "n", "c"))
    own = placed.where("c is not null").select("id", "c").distinct()
    least = own.groupBy("id").agg(F.min("c").alias("v")).withColumnRenamed("id", "k")
    of_one = own.join(least, F.col("id") == F.col("k")).where("c != v").select(F.col("c").alias("u"), "v")
    done = components(links.unionAll(of_one)).withColumnsRenamed({"id": "u", "component": "v"})
    # The smallest id of each class, and of each component of classes.
    small = placed.where("c is not null").groupBy("c").agg(F.min("id").alias("class_id")).join(done, F.col("c") == F.col("u"), "left").select("c", F.coalesce("v", "c").alias("v"), "class_id")
    small = cut(small)
    ids = small.groupBy("v").agg(F.min("class_id").alias("component"))
    named = cut(small.join(ids, "v").select(F.col("c").alias("k"), "component"))
    out = placed.join(named, F.col("c") == F.col("k"), "left").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    none = _digests(rows.where("id is null"), width).where("c is null").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return out.unionAll(none)


def merge_skip(runs: list[list[int]], need: int) -> Iterator[tuple[int, list[int]]]:
    """What occurs in at least ``need`` of the sorted runs, with the runs that have it. A heap holds the runs' heads;
    where the least head occurs too rarely, need - 1 heads are taken off and jump to the next one left, by binary search."""
    at = [0] * len(runs)
    heap = [(run[0], k) for k, run in enumerate(runs) if run]
    heapify(heap)
    while len(heap) >= need:
        least, among = heap[0][0], []
        while heap and heap[0][0] == least:
            among.append(heappop(heap)[1])
        if len(among) >= need:
            yield least, among
            jump = least + 1
        else:
            while heap and len(among) < need - 1:
                among.append(heappop(heap)[1])
            if not heap:
                return
            jump = heap[0][0]  # whatever is smaller is in need - 1 runs at most
        for k in among:
            run = runs[k]
            at[k] = bisect_left(run, jump, at[k])
            if at[k] < len(run):
                heappush(heap, (run[at[k]], k))


def _unlike(shared: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes not yet in one group that occur together in enough short lists."""
    placed = shared.select("s", "c", "n", "at", "early").join(groups.withColumnRenamed("id", "c"), "c", "left").select("s", "c", "n", "at", "early", F.coalesce("component", "c").alias("g"))
    mixed = placed.groupBy("s").agg(F.min("g").alias("low"), F.max("g").alias("high")).where("low < high").select("s")
    # A set's shingles on no such list are in no set of another group that shares a later one of its
    # short lists. So of a set's shingles up to a shared one only ``rank`` + 1 can be shared. Entries from which
    # a set can't reach the overlap that it needs with any partner go before lists are put together.
    rank = F.row_number().over(Window.partitionBy("c").orderBy("at")) - 1
    open_ = placed.join(mixed, "s", "left_semi").withColumn("rank", rank).withColumn("left", F.col("n") - F.col("at") - 1)
    open_ = cut(open_.where(F.col("rank") + 1 + F.col("left") >= F.ceil(F.col("n") * percent / 100)))
    longest = open_.groupBy("s").count().agg(F.max("count")).first()[0] or 0
    part = F.pmod(F.xxhash64("c"), F.lit(-(-longest // RUN) or 1)).alias("part")
    entry = F.struct("c", "n", "g", "rank", "left")
    runs = open_.groupBy("s", part).agg(F.sort_array(F.collect_list(entry)).alias("run"))
    runs = runs.select("s", "part", *[F.col(f"run.{x}").alias(f"{x}_run") for x in ("c", "n", "g", "rank", "left")])
    asks = open_.where("early").select("s", F.col("c").alias("v"), "n", "g", "rank", "left")
    found = asks.join(runs.where(F.size("c_run") > 0), "s").drop("s")

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if (row.v, row.part) != now:
                    out += _candidates(held, percent)
                    now, held = (row.v, row.part), []
                held.append(row)
            yield pd.DataFrame(out, columns=["u", "v"], dtype=np.int64)
        yield pd.DataFrame(_candidates(held, percent), columns=["u", "v"], dtype=np.int64)

    return found.repartition("v", "part").sortWithinPartitions("v", "part").mapInPandas(giving_back(merged), "u bigint, v bigint")


def _candidates(rows: list, percent: int) -> list[tuple[int, int]]:
    """One class against parts of its short lists: (u, v) of what occurs in enough of them and may yet share enough."""
    if not rows:
        return []
    v, m, h = rows[0].v, rows[0].n, rows[0].g
    runs, lefts = [], []
    for row in rows:
        n, left = row.n_run, np.minimum(row.left_run, row.left)
        after = (n > m) | ((n == m) & (row.c_run > v))
        overlap = -(-(n + m) * percent // (100 + percent))
        some = after & (row.g_run != h) & (m * 100 >= n * percent) & (np.minimum(row.rank_run, row.rank) + 1 + left >= overlap)
        runs.append(row.c_run[some].tolist())
        lefts.append(dict(zip(runs[-1], zip(left[some].tolist(), overlap[some].tolist()))))
    need = int(min(OCCURRENCES, -(-m * percent // 100)))
    out = []
    for u, among in merge_skip(runs, need):
        left, overlap = min(lefts[k][u] for k in among)
        if len(among) + left >= overlap:  # what may still follow the last shared short list
            out.append((u, v))
    return out


def one_of_each(documents: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents``, of each group of linked texts one row: the one of the smallest id, of those with one id
    the one whose text has the smallest hash. Rows of one id whose texts don't link all stay; so do texts
    without words. A row without an id comes after those with one."""
    nodes, classes, links = _linked(_rows(documents, doc_id, text), width, percent)
    done = components(links).withColumnsRenamed({"id": "u", "component": "v"})
    of = cut(classes.join(done, F.col("c") == F.col("u"), "left").select("d1", "d2", F.coalesce("v", "c").alias("v")))
    texts = cut(nodes.join(of, ["d1", "d2"]).groupBy("id", "tk", "v").agg(F.count("*").alias("rows")))
    place = F.struct(F.col("id").isNull().alias("x"), F.col("id").alias("y"), F.col("tk").alias("z"))
    stays = texts.groupBy("v").agg(F.min(place).alias("stays")).withColumnRenamed("v", "w")
    judged = cut(texts.join(stays, F.col("v") == F.col("w")).select("id", "tk", "rows", (place == F.col("stays")).alias("kept")))
    gone = judged.where("not kept").select(F.col("id").alias("gone_id"), F.col("tk").alias("gone_tk"))
    more = judged.where("kept and rows > 1").select(F.col("id").alias("gone_id"), F.col("tk").alias("gone_tk"))

    def same(rows: DataFrame, others: DataFrame) -> Column:
        return rows[doc_id].cast("long").eqNullSafe(others["gone_id"]) & (F.xxhash64(text_or_empty(rows[text])) == others["gone_tk"])

    left = documents.join(gone, same(documents, gone), "left_anti")
    single = left.join(more, same(left, more), "left_anti")
    return single.unionAll(left.join(more, same(left, more), "left_semi").dropDuplicates([doc_id, text]))


def op7_occurrence_join(spark: SparkSession, folder: str) -> DataFrame:
    return joined(table(spark, folder, "documents"))


#: The same by comparing all pairs that share a shingle.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)] END) AS shingles FROM w
), e AS (SELECT doc_id, unnest(shingles) AS x FROM s),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT u, v FROM p JOIN s a ON a.doc_id = u JOIN s b ON b.doc_id = v WHERE 100 * shared >= 85 * (len(a.shingles) + len(b.shingles) - shared)
), r AS (
  SELECT u AS doc_id, v AS reached FROM l UNION SELECT r.doc_id, l.v FROM r JOIN l ON l.u = r.reached
)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, least(s.doc_id, coalesce(m.c, s.doc_id)) AS component_id
FROM s LEFT JOIN (SELECT doc_id, min(reached) AS c FROM r GROUP BY doc_id) m ON m.doc_id = s.doc_id
"""

QUERIES = {"op7_occurrence_join": op7_occurrence_join}
ORACLES = {"op7_occurrence_join": ORACLE}
