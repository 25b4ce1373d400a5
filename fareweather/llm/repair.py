"""Conversation structure repair by the cheapest edits, found by a Viterbi search that lets go of its past.

A conversation is in order if its roles are an optional system turn and then user and assistant in turn,
ended by the assistant. Turns are kept, given the other role or deleted, and turns are put in.
The search has one survivor for each state (nothing yet, after system, after user, after assistant).
Survivors are leaves of a tree of back pointers whose nodes count their references: what
no survivor comes from is freed, and once all survivors share an ancestor the edits up
to it are final, are written out. A survivor carries the hash of its repaired turns, so no text is held: memory is one
small node for each undecided edit and survivor. Equally cheap ways compare by their whole undecided edits, whose order
is kept up from turn to turn.

Turns reach a search in order, from Spark's sort, so a conversation may have any length. The hash of
a whole repaired conversation is one chain of bytes, so its turns pass through one task;
what may come from anywhere in it, repeated turns, is found by aggregates before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

#: Costs of the edits, and of a turn that stays although its text is cut off.
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Role by the state that follows it.
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: From a state, the state after a turn of the user or the assistant.
NEXT = (USER, USER, ASSISTANT, USER)
PER_CONVERSATION = "conv_key string, cost bigint, audit string, repaired_sha256 string"
PER_EDIT = "conv_key string, place bigint, at bigint, edit string, role string"


class Node:
    """An edit. ``refs`` counts the edits that follow it and the survivors that end in it."""

    __slots__ = ("before", "edit", "role", "at", "refs")

    def __init__(self, before: Node | None, edit: str, role: str | None, at):
        self.before, self.edit, self.role, self.at, self.refs = before, edit, role, at, 0
        if before is not None:
            before.refs += 1

    def release(self) -> None:
        node = self
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            before, node.before = node.before, None
            node = before


class Survivor:
    """The cheapest way to a state. Audits compare by ``rank``, and those of equal rank by ``tail``, their last edits.
    ``hash`` is that of the turns repaired this way, without those in ``told``, which the last turn added."""

    __slots__ = ("cost", "node", "rank", "tail", "hash", "begun", "told")

    def __init__(self, cost: int, node: Node, rank: int, tail: str, hash_, begun: bool, told: tuple):
        self.cost, self.node, self.rank, self.tail, self.hash, self.begun, self.told = cost, node, rank, tail, hash_, begun, told

    def order(self) -> tuple:
        return self.cost, self.rank, self.tail


class Repair:
    """The search over one conversation. ``turn()`` takes its turns in order, ``end()`` gives (cost, audit, sha256 of the
    repaired turns). ``sink`` gets (at, edit, role) of each edit once it is final."""

    def __init__(self, sink: list | None = None):
        self.root = Node(None, "", None, None)
        self.root.refs = 1
        self.survivors = {NOTHING: Survivor(0, self.root, 0, "", hashlib.sha256(), False, ())}
        self.audit: list[str] = []
        self.sink = sink
        self._insertions(self.survivors)
        self._settle(self.survivors)

    def _offer(self, found: dict[int, Survivor], state: int, cost: int, old: Survivor, edit: str, role: str | None, text: str, at) -> bool:
        """Take an edit into ``found`` if nothing cheaper, or equal and earlier in the alphabet, leads to the state.
        Of two audits to one state at one cost none begins the other, so their order is that of whatever follows."""
        held = found.get(state)
        if held is not None and held.order() <= (cost, old.rank, old.tail + edit):
            return False
        node = Node(old.node, edit, role, at)
        node.refs += 1
        told = old.told if edit == "D" else (*old.told, (role, text))
        found[state] = Survivor(cost, node, old.rank, old.tail + edit, old.hash, old.begun, told)
        if held is not None:
            held.node.release()
        return True

    def _insertions(self, found: dict[int, Survivor]) -> None:
        changed = True
        while changed:  # every round adds to a cost, so a cycle never pays
            changed = False
            for state, old in list(found.items()):
                if found[state] is old:
                    to = NEXT[state]
                    changed |= self._offer(found, to, old.cost + INSERT, old, "I", ROLES[to], "", None)

    def _settle(self, found: dict[int, Survivor]) -> None:
        """Hash what the last turn added, and number the audits in their order. One that begins another shares its number,
        as what follows will tell them apart."""
        rank, head = -1, None
        for x in sorted(found.values(), key=lambda x: (x.rank, x.tail)):
            if head is None or x.rank != head[0] or not x.tail.startswith(head[1]):
                rank, head = rank + 1, (x.rank, x.tail)
            x.rank, x.tail = rank, x.tail[len(head[1]):]
            if x.told:
                x.hash = x.hash.copy()
                for role, text in x.told:
                    if x.begun:
                        x.hash.update(b"\n")
                    x.hash.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
                    x.begun = True
                x.told = ()

    def turn(self, role: str, text: str, gone: bool, cut_off: bool, at=None) -> None:
        """``gone``: the turn must be deleted. ``cut_off``: staying costs extra. ``at``: what the sink gets for it."""
        found: dict[int, Survivor] = {}
        extra, initial = CUT_OFF if cut_off else 0, role[:1]
        for state, old in self.survivors.items():
            self._offer(found, state, old.cost + DELETE, old, "D", None, "", at)
            if gone:
                continue
            to = NEXT[state]
            if initial == "s" and state == NOTHING:
                self._offer(found, SYSTEM, old.cost + extra, old, "K", role, text, at)
            if initial == ("u" if to == USER else "a"):
                self._offer(found, to, old.cost + extra, old, "K", role, text, at)
            else:
                self._offer(found, to, old.cost + extra + REROLE, old, "R", ROLES[to], text, at)
        self._insertions(found)
        for old in self.survivors.values():
            old.node.release()
        # Whatever follows nothing or a system turn can follow the assistant, but for a system turn; deleting that costs DELETE.
        if ASSISTANT in found:
            for state, lead in ((SYSTEM, 0), (NOTHING, DELETE)):
                if state in found and found[state].cost > found[ASSISTANT].cost + lead:
                    found.pop(state).node.release()
        self._settle(found)
        self.survivors = found
        self._decide()

    def _decide(self) -> None:
        """Write out the edits that all survivors share: those after the root that have one reference."""
        if self.root.refs > 1 or any(x.node is self.root for x in self.survivors.values()):
            return
        path = self._path(next(iter(self.survivors.values())).node)
        ends = {id(x.node) for x in self.survivors.values()}
        while self.root.refs == 1 and id(self.root) not in ends:
            self._write(path.pop())

    def _path(self, node: Node) -> list[Node]:
        """The undecided edits up to a node, the last first."""
        path = []
        while node is not self.root:
            path.append(node)
            node = node.before
        return path

    def _write(self, node: Node) -> None:
        self.audit.append(node.edit)
        if self.sink is not None:
            self.sink.append((node.at, node.edit, node.role))
        self.root, node.before = node, None

    def undecided(self) -> int:
        return len(self._path(next(iter(self.survivors.values())).node))

    def end(self) -> tuple[int, str, str]:
        last = min((self.survivors[s] for s in (NOTHING, ASSISTANT) if s in self.survivors), key=Survivor.order)
        path = self._path(last.node)
        while path:
            self._write(path.pop())
        return last.cost, "".join(self.audit), last.hash.hexdigest()


def _edits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of conversation and place, to one row for each conversation."""
    search, now, done = None, None, []
    for batch in batches:
        for conv, role, text, gone, cut_off in zip(*(batch[c].tolist() for c in ("conv_key", "role", "text", "gone", "cut_off"))):
            if search is None or conv != now:
                if search is not None:
                    done.append((now, *search.end()))
                search, now = Repair(), conv
            search.turn(role, text, gone, cut_off)
        yield pd.DataFrame(done, columns=["conv_key", "cost", "audit", "repaired_sha256"])
        done = []
    if search is not None:
        yield pd.DataFrame([(now, *search.end())], columns=["conv_key", "cost", "audit", "repaired_sha256"])


def _each_edit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same, to one row for each edit, written as soon as it is final."""
    search, now, place, sink = None, None, 0, []

    def final() -> list[tuple]:
        nonlocal place
        out = [(now, place + k, *x) for k, x in enumerate(sink, 1)]
        place += len(sink)
        sink.clear()
        return out

    for batch in batches:
        done = []
        for conv, role, at, gone, cut_off in zip(*(batch[c].tolist() for c in ("conv_key", "role", "at", "gone", "cut_off"))):
            if search is None or conv != now:
                if search is not None:
                    search.end()
                    done += final()
                search, now, place = Repair(sink), conv, 0
            search.turn(role, "", gone, cut_off, at)
        yield _placed(done + final())
    if search is not None:
        search.end()
        yield _placed(final())


def _placed(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_key", "place", "at", "edit", "role"])
    return out.assign(at=out["at"].astype("Int64"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as they are logged after faults: some dropped, emptied, without sentence ends, repeated, or of the
    wrong role, by a hash of conversation and turn. A missing id, turn, role or text counts as one space; a null turn stays null."""
    one = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.concat(one["conv_id"], F.lit(":"), one["turn"]).cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), one["role"].alias("role"), one["text"].alias("text"), fault.alias("fault"),
    ).where("fault != 0")
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def faults(rows: DataFrame) -> DataFrame:
    """Every row (conv_id, turn, role, text) with its place in a total order, and its first fault: blank, duplicate, truncated or none.

    Rows go by turn, those without one first, equal turns by role and a hash of the text. Of rows
    equal in all of these one is the first.
    """
    placed = cut(rows.withColumns({
        "at": F.monotonically_increasing_id(), "h": F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256),
    }))
    # The least place of each role and text. A null turn is the first of all.
    place = F.struct(F.col("turn").isNotNull().alias("numbered"), F.coalesce("turn", F.lit(0)).alias("turn"), "at")
    first = placed.groupBy("conv_id", "h").agg(F.min(place).alias("first")).withColumnsRenamed({"conv_id": "c", "h": "k"})
    joined = placed.withColumn("place", place).join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h") == F.col("k")))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(last == "", F.lit("blank"))
        .when(F.col("place") != F.col("first"), F.lit("duplicate"))
        .when(~last.isin(".", "!", "?"), F.lit("truncated"))
        .otherwise(F.lit("none"))
    )
    return joined.select("conv_id", "turn", "role", "text", "at", fault.alias("fault"))


def illegal_pairs(rows: DataFrame) -> DataFrame:
    """Per conv_id, how many neighbours' role initials don't follow each other.

    A task counts within its own run of the sorted rows; between runs the last row of one meets the
    first of the next. So a conversation may spread over many tasks.
    """
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("h"), F.col("at")]
    slim = rows.select("conv_id", "turn", "role", F.xxhash64("text").alias("h"), "at")
    run = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    run = run.select(_key().alias("conv_key"), F.substring("role", 1, 1).alias("initial"), F.spark_partition_id().alias("slice"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = first = last = slice_ = None
        bad = 0
        for batch in batches:
            done = []
            for conv, initial, part in zip(batch["conv_key"].tolist(), batch["initial"].tolist(), batch["slice"].tolist()):
                if now is None or conv != now or part != slice_:
                    if now is not None:
                        done.append((now, slice_, first, last, bad))
                    now, slice_, first, last, bad = conv, part, initial, initial, 0
                    continue
                bad += last + initial not in ("su", "ua", "au")
                last = initial
            yield pd.DataFrame(done, columns=["conv_key", "slice", "first", "last", "bad"])
        if now is not None:
            yield pd.DataFrame([(now, slice_, first, last, bad)], columns=["conv_key", "slice", "first", "last", "bad"])

    runs = run.mapInPandas(count, "conv_key string, slice int, first string, last string, bad bigint")
    # One row for each conversation and run from here on.
    ends = F.array_sort(F.collect_list(F.struct("slice", "first", "last")))
    each = runs.groupBy("conv_key").agg(F.sum("bad").alias("bad"), ends.alias("ends"))
    meet = F.zip_with(F.slice("ends", F.lit(1), F.size("ends") - 1), F.slice("ends", F.lit(2), F.size("ends")), lambda a, b: F.when(F.concat(a["last"], b["first"]).isin("su", "ua", "au"), 0).otherwise(1))
    return each.select("conv_key", (F.col("bad") + F.aggregate(meet, F.lit(0).cast("long"), lambda x, y: x + y)).alias("illegal"))


def _key():
    """The id as text, empty for none: a join key that is never null."""
    return F.coalesce(F.col("conv_id").cast("string"), F.lit(""))


def _in_order(found: DataFrame) -> DataFrame:
    """Rows with faults, each conversation in one task in its order."""
    marked = found.select(
        _key().alias("conv_key"), "turn", "role", "text", F.xxhash64("text").alias("h"), "at",
        F.col("fault").isin("blank", "duplicate").alias("gone"), (F.col("fault") == "truncated").alias("cut_off"),
    )
    return marked.repartition("conv_key").sortWithinPartitions("conv_key", F.asc_nulls_first("turn"), "role", "h", "at")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, role, text, and the edit that each turn comes from. Places ascend, with gaps
    where turns were deleted. Conversations of which nothing is left have no row."""
    found = cut(faults(rows))
    edits = _in_order(found).select("conv_key", "role", "at", "gone", "cut_off").mapInPandas(_each_edit, PER_EDIT).where("edit != 'D'")
    texts = found.select(F.col("at").alias("row_at"), "text")
    joined = edits.join(texts, F.col("at") == F.col("row_at"), "left")
    return joined.select(
        F.when(F.col("conv_key") != "", F.col("conv_key")).cast("long").alias("conv_id"), "place", "role", F.coalesce("text", F.lit("")).alias("text"), "edit",
    )


def repaired(rows: DataFrame, original: DataFrame) -> DataFrame:
    """Per conv_id of ``original``: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, for its ``rows``.

    An audit has an edit's initial for each row and each turn put in: Keep, Rerole, Delete, Insert; of equally
    cheap ones the first in ASCII. Rows with a null id are one conversation. A conversation
    without rows has zeros, an empty audit and the hash of nothing. Empty tables give an empty result.
    """
    found = cut(faults(rows))
    counts = found.groupBy("conv_id").agg(
        F.min("turn").alias("low"), F.max("turn").alias("high"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    turns = found.where("turn is not null").select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count("*").alias("distinct_turns"))
    edits = _in_order(found).select("conv_key", "role", "text", "gone", "cut_off").mapInPandas(_edits, PER_CONVERSATION)
    per = lambda df: df.withColumn("conv_key", _key()).drop("conv_id")
    ids = original.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("conv_key", _key())
    out = ids.join(per(counts), "conv_key", "left").join(per(turns), "conv_key", "left").join(illegal_pairs(found), "conv_key", "left").join(edits, "conv_key", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("distinct_turns"), F.lit(0)).cast("long")
    return out.select(
        "conv_id", gaps.alias("gaps"), *[zero(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_survivor_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return repaired(damaged(conversations), conversations)


#: The same by a table of the four states, each with its cost and its audit so far.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')]),
           lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT FOR x IN range(8)]),
             lambda c, e: xor(c >> 1, (c & 1) * 3988292384))), 4294967295) % 20 AS hit
  FROM conversations
), g AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM d, range(2) copies(k) WHERE hit <> 0 AND (k = 0 OR hit = 3)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
  FROM g
), p AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS again FROM o),
f AS (
  SELECT conv_id, turn, role, text, n, before, role[1] AS ini, last = '' AS blank, last <> '' AND again > 1 AS dup,
         last <> '' AND again = 1 AND last NOT IN ('.', '!', '?') AS cut_off FROM p
), v AS (
  SELECT conv_id, 0 AS n, {'c': 0, 'a': ''} AS e, {'c': 1000000000, 'a': ''} AS s, {'c': 5, 'a': 'I'} AS u, {'c': 10, 'a': 'II'} AS z FROM (SELECT DISTINCT conv_id FROM f)
  UNION ALL
  SELECT conv_id, n, e, s, u, list_sort([z, {'c': u.c + 5, 'a': u.a || 'I'}])[1]
  FROM (SELECT conv_id, n, e, s, list_sort([u, {'c': e.c + 5, 'a': e.a || 'I'}, {'c': s.c + 5, 'a': s.a || 'I'}, {'c': z.c + 5, 'a': z.a || 'I'}])[1] AS u, z
  FROM (SELECT v.conv_id, f.n, {'c': v.e.c + 2, 'a': v.e.a || 'D'} AS e,
    list_sort([{'c': v.s.c + 2, 'a': v.s.a || 'D'}, {'c': v.e.c + x + CASE WHEN ini = 's' THEN 0 ELSE 1000000000 END, 'a': v.e.a || 'K'}])[1] AS s,
    list_sort([{'c': v.u.c + 2, 'a': v.u.a || 'D'}, {'c': v.e.c + x + ru, 'a': v.e.a || ku}, {'c': v.s.c + x + ru, 'a': v.s.a || ku}, {'c': v.z.c + x + ru, 'a': v.z.a || ku}])[1] AS u,
    list_sort([{'c': v.z.c + 2, 'a': v.z.a || 'D'}, {'c': v.u.c + x + CASE WHEN ini = 'a' THEN 0 ELSE 1 END, 'a': v.u.a || CASE WHEN ini = 'a' THEN 'K' ELSE 'R' END}])[1] AS z
  FROM v JOIN (SELECT *, CASE WHEN blank OR dup THEN 1000000000 WHEN cut_off THEN 5 ELSE 0 END AS x, CASE WHEN ini = 'u' THEN 0 ELSE 1 END AS ru,
    CASE WHEN ini = 'u' THEN 'K' ELSE 'R' END AS ku FROM f) f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.n = v.n + 1))
), best AS (
  SELECT conv_id, list_sort([e, z])[1] AS b FROM v QUALIFY n = max(n) OVER (PARTITION BY conv_id)
), edits AS (
  SELECT conv_id, k, b.a[k] AS edit, len(replace(b.a[1:k], 'I', '')) AS n FROM (SELECT *, unnest(range(1, len(b.a) + 1)) AS k FROM best)
), kept AS (
  SELECT x.conv_id, x.k, x.edit, f.role, f.text, row_number() OVER (PARTITION BY x.conv_id ORDER BY k) AS q,
         first_value(x.edit = 'K' AND f.ini = 's') OVER (PARTITION BY x.conv_id ORDER BY k) AS sys
  FROM edits x LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM x.conv_id AND f.n = x.n AND x.edit <> 'I' WHERE x.edit <> 'D'
), said AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (q - CASE WHEN sys THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY k) AS all_turns
  FROM kept GROUP BY conv_id
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
         count(*) FILTER (cut_off) AS truncated, count(*) FILTER (n > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id
)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit,
       sha256(coalesce(all_turns, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM i.conv_id
  LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM i.conv_id
"""

QUERIES = {"op13_survivor_viterbi": op13_survivor_viterbi}
ORACLES = {"op13_survivor_viterbi": ORACLE}
