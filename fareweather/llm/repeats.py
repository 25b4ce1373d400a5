"""Substring dedup: windows of words that an earlier document has are found in compressed full-text indexes.

A window is named by the least hash of the runs of eight words in it, so equal windows have one name,
and neighbouring windows mostly share theirs: a document is a sequence of stretches, each of one
name. Names in one document only are dropped. The stretches of the other names are dealt into shards by name;
equal stretches are one entry with the smallest id they occur in. A shard is indexed: suffixes sorted by
prefix doubling, the Burrows-Wheeler transform in a wavelet matrix over bits packed with their ranks, and the least
id of each set of suffixes that agree in a whole window. Then its stretches are streamed, all in lockstep: backward
search by one word after the other, the last word given up at a window's length, so the interval is that of the
longest match up to a window. It is reported where its least id is smaller than the stretch's own.

Names of very many different stretches (near copies by the thousand) would outgrow a shard. Their windows are told by
128-bit hashes and an aggregate instead, which combines before its shuffle.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_folder, table, text_or_empty
from .words import Words, in_blocks

#: Words of a window.
WINDOW = 50
#: Words of the runs whose hashes name a window.
RUN = 8
#: Windows of a stretch at most. Longer ones, as of one word again and again, are several.
STRETCH = 64
#: Words of a shard, about.
SHARD_WORDS = 600_000
#: Different stretches of a name in a shard at most.
MOST_STRETCHES = 4_000
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def _word_hashes(words: Words) -> np.ndarray:
    """Hash of each word of a block, in order."""
    if not words.distinct:
        return np.empty(0, np.uint64)
    return pd.util.hash_array(np.array(words.distinct, dtype=object), categorize=False)[words.codes]


def _run_hashes(h: np.ndarray, length: int, odd: np.uint64 = _ODD[0]) -> np.ndarray:
    """Hash of each run of ``length`` items, by doubling."""
    out, done, part, size, factor = np.zeros(len(h) + 1, np.uint64), 0, h, 1, int(odd)
    while True:
        by = np.uint64(factor)  # the odd number to the power of size
        if length & size:  # the run so far, and the next ``size`` items after it
            n = len(h) - done - size + 1
            out, done = out[:n] * by + part[done:done + n], done + size
        if done == length:
            return _mixed(out)
        n = len(h) - 2 * size + 1
        part, size, factor = part[:n] * by + part[size:size + n], 2 * size, factor * factor % (1 << 64)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        h, size = np.minimum(h[:-size], h[size:]), 2 * size
    return np.minimum(h[:len(h) - (width - size)], h[width - size:])


def stretches(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text of a block the first window of each stretch, and the stretches' names. Windows go to the last whole one."""
    nothing = np.empty(0, np.int32), np.empty(0, np.int64)
    h = _word_hashes(words)
    if len(h) < WINDOW:
        for _ in range(len(words)):
            yield nothing
        return
    names = _least(_run_hashes(h, RUN), WINDOW - RUN + 1).view(np.int64)
    for a, b in zip(words.bounds[:-1], words.bounds[1:]):
        own = names[a:max(a, b - WINDOW + 1)]
        if not len(own):
            yield nothing
            continue
        begins = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]))
        if np.diff(begins).max() > STRETCH:
            begins = np.concatenate([np.arange(x, y, STRETCH) for x, y in zip(begins[:-1], begins[1:])] + [[len(own)]])
        yield begins[:-1].astype(np.int32), own[begins[:-1]]


def _split(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _scanned(rows: DataFrame) -> DataFrame:
    """Per row: doc_id, tk (a hash of its text), n_words, sha (of its words), begins and names of its stretches."""
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_blocks(batches, "t"):
            texts = batch["t"].tolist()
            words = Words(texts)
            begins, names = zip(*stretches(words))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64").array, "tk": batch["tk"].array, "n_words": words.counts, "sha": [_sha(_split(t)) for t in texts],
                "begins": pd.Series(begins, dtype=object), "names": pd.Series(names, dtype=object),
            })

    return rows.mapInPandas(scan, "doc_id bigint, tk bigint, n_words bigint, sha string, begins array<int>, names array<bigint>")


def _sliced(texts: DataFrame) -> DataFrame:
    """Rows (doc_id, tk, t, of: array of first window, windows, name) to one row for each stretch with its words."""
    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_blocks(batches, "t"):
            out = []
            for doc_id, tk, text, of in zip(batch["doc_id"].tolist(), batch["tk"].tolist(), batch["t"].tolist(), batch["of"].tolist()):
                words = _split(text)
                for x in of:
                    content = b" ".join(words[x["begin"]:x["begin"] + x["windows"] + WINDOW - 1])
                    out.append((x["name"], hashlib.blake2b(content, digest_size=16).digest(), doc_id, tk, x["begin"], x["windows"], content.decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(out, columns=["name", "digest", "doc_id", "tk", "begin", "windows", "content"])

    return texts.mapInPandas(cut_out, "name bigint, digest binary, doc_id bigint, tk bigint, begin int, windows int, content string")


class WaveletMatrix:
    """Symbols as one packed vector of bits for each of their bits, with the number of ones before each word."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        self.bits = max(1, int(kinds - 1).bit_length())
        self.words, self.ones, self.zeros = [], [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level) & 1 == 1
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate((packed, np.zeros(8 + -len(packed) % 8, np.uint8))).view(np.uint64)
            self.words.append(packed)
            self.ones.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed[:-1]), dtype=np.int64))))
            self.zeros.append(len(bit) - int(bit.sum()))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def places(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the symbols before ``at`` that equal ``symbols`` end in the last level's order."""
        for level in range(self.bits):
            word, rest = at >> 6, (at & 63).astype(np.uint64)
            ones = self.ones[level][word] + np.bitwise_count(self.words[level][word] & ((np.uint64(1) << rest) - np.uint64(1)))
            at = np.where((symbols >> (self.bits - 1 - level)) & 1 == 1, self.zeros[level] + ones, at - ones)
        return at


class Index:
    """Full-text index of sequences of numbers from 0, each with an id. ``window`` is the length that intervals stand for at most."""

    def __init__(self, sequences: list[np.ndarray], ids: np.ndarray, window: int = WINDOW):
        lengths = np.array([len(s) for s in sequences])
        longest = int(lengths.max()) + 1
        ends = np.cumsum(lengths + 1) - 1
        kinds = max(int(s.max(initial=-1)) for s in sequences) + 2
        # Symbol 0 ends each sequence; in the order of suffixes the ends are all different.
        text = np.zeros(int(ends[-1]) + 1, np.int64)
        owner = np.repeat(np.arange(len(sequences)), lengths + 1)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = np.concatenate(sequences) + 1
        rank = np.where(inside, text + len(sequences), owner)
        self._agree = {}
        step, order = 1, None
        while step < longest:
            rank = self._doubled(rank, step)
            step *= 2
            if step <= window:
                half = rank, step
        order = np.empty(len(text), np.int64)
        order[rank] = np.arange(len(text))
        self.window, self.text, self.ends, self.lengths = window, text, ends, lengths
        counts = np.bincount(text, minlength=kinds)
        self.matrix = WaveletMatrix(text[order - 1], kinds)
        every = np.arange(kinds)
        self.shift = np.cumsum(counts) - counts - self.matrix.places(every, np.zeros(kinds, np.int64))
        # Neighbouring suffixes that agree in a whole window, and in a window but for its last word.
        whole, shorter = (self._same(order, *half, length) for length in (window, window - 1))
        begins = np.flatnonzero(~whole)
        self.set_of = np.cumsum(~whole) - 1
        self.least_of = np.minimum.reduceat(ids[owner][order], begins)
        wide = np.flatnonzero(~shorter)
        group = np.cumsum(~shorter) - 1
        self.low, self.high = wide[group], np.append(wide[1:], len(text))[group]

    @staticmethod
    def _doubled(rank: np.ndarray, step: int) -> np.ndarray:
        """Ranks of suffixes by twice ``step`` items."""
        after = np.zeros(len(rank), np.int64)
        after[:-step] = rank[step:] + 1
        both = rank * (len(rank) + int(rank.max()) + 2) + after
        order = np.argsort(both, kind="stable")
        new = np.concatenate(([0], np.cumsum(both[order[1:]] != both[order[:-1]])))
        out = np.empty(len(rank), np.int64)
        out[order] = new
        return out

    @staticmethod
    def _same(order: np.ndarray, rank: np.ndarray, step: int, length: int) -> np.ndarray:
        """If a suffix agrees with the one before it in ``length`` items: in the first and in the last ``step`` of them."""
        last = np.minimum(order + (length - step), len(rank) - 1)
        first, then = rank[order], rank[last]
        return np.concatenate(([False], (first[1:] == first[:-1]) & (then[1:] == then[:-1])))

    def extended(self, low: np.ndarray, high: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches with a symbol before them; empty where there are none."""
        both = self.matrix.places(np.concatenate((symbols, symbols)), np.concatenate((low, high))) + np.tile(self.shift[symbols], 2)
        return both[:len(low)], both[len(low):]

    def earlier(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The index's own sequences streamed against it, from their ends: (sequences, places) of the windows that
        a sequence of an id smaller than ``ids`` has."""
        active = np.argsort(-self.lengths, kind="stable")
        low, high = np.zeros(len(active), np.int64), np.full(len(active), len(self.text))
        for done in range(int(self.lengths.max())):
            keep = np.searchsorted(-self.lengths[active], -done, side="left")
            active, low, high = active[:keep], low[:keep], high[:keep]
            if done >= self.window:  # the last word goes
                low, high = self.low[low], self.high[low]
            low, high = self.extended(low, high, self.text[self.ends[active] - 1 - done])
            if done + 1 >= self.window:
                found = self.least_of[self.set_of[low]] < ids[active]
                yield active[found], self.lengths[active[found]] - 1 - done


HITS = "name bigint, digest binary, places array<int>"


def _indexed(shard: pd.DataFrame) -> pd.DataFrame:
    """A shard's stretches (name, digest, least, content) with the places of windows that an earlier document has."""
    shard = shard.sort_values(["name", "least", "digest"], ignore_index=True)
    words = Words(shard["content"].tolist())
    ids = shard["least"].to_numpy(np.int64)
    index = Index([words.of(i) for i in range(len(words))], ids)
    found = [[] for _ in range(len(words))]
    for sequences, places in index.earlier(ids):
        for i, place in zip(sequences.tolist(), places.tolist()):
            found[i].append(place)
    some = [i for i, x in enumerate(found) if x]
    return pd.DataFrame({"name": shard["name"].iloc[some].array, "digest": shard["digest"].iloc[some].array, "places": pd.Series([found[i] for i in some], dtype=object)})


def _by_hash(heads: DataFrame) -> DataFrame:
    """The same for names of very many stretches, window by window."""
    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_blocks(batches, "content"):
            words = Words(batch["content"].tolist())
            h = _word_hashes(words)
            if len(h) < WINDOW:
                continue
            a, b = (_run_hashes(h, WINDOW, odd).view(np.int64) for odd in _ODD)
            counts = words.counts - WINDOW + 1
            row = np.repeat(np.arange(len(words)), counts)
            place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            at = words.bounds[:-1][row] + place
            yield pd.DataFrame({
                "name": batch["name"].to_numpy()[row], "digest": batch["digest"].to_numpy()[row], "least": batch["least"].to_numpy()[row], "place": place, "a": a[at], "b": b[at],
            })

    every = heads.select("name", "digest", "least", "content").mapInPandas(windows, "name bigint, digest binary, least bigint, place int, a bigint, b bigint")
    every = stored(every)
    first = every.groupBy("a", "b").agg(F.min("least").alias("first"), F.max("least").alias("last")).where("first < last").drop("last")
    hit = every.join(first, ["a", "b"]).where("least > first")
    return hit.groupBy("name", "digest").agg(F.collect_list("place").alias("places"))


def stored(df: DataFrame) -> DataFrame:
    """The rows as Parquet in the shared folder, smaller there than a checkpoint."""
    path = f"{shared_folder(df.sparkSession)}/repeats-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _repeated(heads: DataFrame) -> DataFrame:
    """Per stretch (name, digest) the places of windows that an earlier document has, where there are any."""
    sizes = heads.groupBy("name").agg(F.count("*").alias("kinds"), F.sum(F.col("windows") + WINDOW).alias("words"))
    sizes = cut(sizes.where("kinds > 1"))  # one stretch alone has no other to be found in
    large = F.col("kinds") > MOST_STRETCHES
    words = sizes.agg(F.coalesce(F.sum(F.when(~large, F.col("words"))), F.lit(0))).first()[0]
    shards = max(1, math.ceil(words / SHARD_WORDS))
    dealt = heads.join(sizes.where(~large).select("name"), "name").withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards)))
    hits = dealt.select("shard", "name", "digest", "least", "content").groupBy("shard").applyInPandas(_indexed, HITS)
    if sizes.where(large).isEmpty():
        return hits
    return hits.unionByName(_by_hash(heads.join(sizes.where(large).select("name"), "name")))


def _kept(texts: DataFrame) -> DataFrame:
    """Rows (doc_id, t, spans) to doc_id, sha (of all words), n_removed, kept_sha256."""
    def without(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_blocks(batches, "t"):
            out = []
            for doc_id, text, spans in zip(batch["doc_id"].tolist(), batch["t"].tolist(), batch["spans"].tolist()):
                words = _split(text)
                begins = np.zeros(len(words) + 1, np.int64)
                for x in spans:
                    begins[x["begin"] + (np.arange(x["windows"]) if x["places"] is None else np.asarray(x["places"]))] = 1
                upto = np.concatenate((np.zeros(WINDOW, np.int64), np.cumsum(begins)))
                covered = upto[WINDOW:] > upto[:-WINDOW]  # by a window that begins up to there
                left = [w for w, gone in zip(words, covered.tolist()) if not gone]
                out.append((doc_id, _sha(words), len(words) - len(left), _sha(left)))
            yield pd.DataFrame(out, columns=["doc_id", "sha", "n_removed", "kept"])

    return texts.mapInPandas(without, "doc_id bigint, sha string, n_removed bigint, kept string")


def removed_spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Per row of the table (doc_id, tk, n_words, sha, least: the smallest id with the same words), and per document that is
    the first with its words the windows that earlier ones have: doc_id, tk, and of the ``windows`` from word ``begin``
    on those at ``places``, or all where that is null."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("t")).withColumn("tk", F.xxhash64("t"))
    scanned = stored(_scanned(rows))
    # Equal sequences of words are one document, that of the smallest id; the others lose all.
    equal = scanned.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= WINDOW)).groupBy("sha").agg(F.min(F.struct("doc_id", "tk")).alias("first"))
    equal = cut(equal.select("sha", F.col("first.doc_id").alias("least"), F.col("first.tk").alias("least_tk")))
    every = scanned.drop("begins", "names").join(equal.drop("least_tk"), "sha", "left")
    leads = scanned.join(equal.select("sha", F.col("least").alias("doc_id"), F.col("least_tk").alias("tk")), ["sha", "doc_id", "tk"])
    begins = F.col("begins")
    ends = F.concat(F.slice(begins, F.lit(2), F.size(begins)), F.array((F.col("n_words") - (WINDOW - 1)).cast("int")))
    each = F.arrays_zip(begins.alias("begin"), F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda x: x["b"] - x["a"]).alias("windows"), F.col("names").alias("name"))
    runs = leads.select("doc_id", "tk", F.inline(each))
    # Written, so that a name of very many runs can be split in the join.
    shared = cut(runs.groupBy("name").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("name"))
    of = runs.join(shared, "name").groupBy("doc_id", "tk").agg(F.collect_list(F.struct("begin", "windows", "name")).alias("of"))
    # Rows of one id and text are one here.
    sliced = stored(_sliced(rows.join(of, ["doc_id", "tk"]).dropDuplicates(["doc_id", "tk"])))
    heads = stored(sliced.groupBy("name", "digest").agg(F.min("doc_id").alias("least"), F.first("windows").alias("windows"), F.first("content").alias("content")))
    hits = cut(_repeated(heads))
    members = sliced.drop("content").join(heads.select("name", "digest", "least"), ["name", "digest"])
    # Another document's stretch as a whole, or single windows in the first document that has the stretch.
    whole = members.where("doc_id > least").select("doc_id", "tk", "begin", "windows", F.lit(None).cast("array<int>").alias("places"))
    parts = members.where("doc_id = least").join(hits, ["name", "digest"]).select("doc_id", "tk", "begin", "windows", "places")
    return every, whole.unionAll(parts)


def deduplicated(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256.

    A null or empty text has no words. Rows with a null id lose nothing and take nothing from others. Rows
    of one id are documents each, and take nothing from each other. A text of fewer words than a window loses
    nothing. An empty table gives an empty result; other columns play no part.
    """
    every, spans = removed_spans(documents, doc_id, text)
    found = spans.groupBy("doc_id", "tk").agg(F.collect_list(F.struct("begin", "windows", "places")).alias("spans"))
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("t")).withColumn("tk", F.xxhash64("t"))
    some = cut(_kept(rows.join(found, ["doc_id", "tk"]).dropDuplicates(["doc_id", "tk"])).dropDuplicates(["doc_id", "sha"]))
    out = every.join(some, ["doc_id", "sha"], "left")
    copy = F.col("doc_id") > F.col("least")
    n = F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    kept = F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha"))
    return out.select("doc_id", "n_words", n.cast("long").alias("n_removed"), kept.alias("kept_sha256"))


def op12_fm_index_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicated(table(spark, folder, "documents"))


#: The same by comparing all windows.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
  SELECT r, doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50)
), f AS (SELECT h, min(doc_id) AS least FROM w GROUP BY h),
g AS (
  SELECT r, list_distinct(flatten(list(range(i, i + 50)))) AS gone FROM w JOIN f USING (h) WHERE doc_id > least GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN words ELSE list_select(words, list_filter(range(1, len(words) + 1), lambda x: NOT list_contains(gone, x))) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""

QUERIES = {"op12_fm_index_dedup": op12_fm_index_dedup}
ORACLES = {"op12_fm_index_dedup": ORACLE}
