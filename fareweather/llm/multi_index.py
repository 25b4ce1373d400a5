"""Approximate nearest neighbours by an inverted multi-index.

Each half of a vector is quantised by a codebook of its own, so a few centroids make up
many cells. A query walks through pairs of centroids by the sum of its two distances,
with a heap, until the cells walked hold enough entries, and ranks these by their
distance in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table
from .vectors import matrix, usable

NEIGHBOURS = 10
#: Centroids of each half at most.
CENTROIDS = 32
#: Codebooks are fitted on so many vectors at most, those with the smallest hashes.
SAMPLE = 8192
#: A query's cells hold at least so many entries, and at least this share of all. Vectors without
#: clusters need about half of all for a recall of 0.94; clustered ones need far less.
LEAST_ENTRIES = 2000
SHARE = 0.5
#: Entries of a part of the index, and queries of a block, about.
PART = 4096
SEED = 3


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances to centroids."""
    return (x * x).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1)[None] - 2 * x @ centroids.T


def codebook(x: np.ndarray, centroids: int, steps: int = 15) -> np.ndarray:
    """Centroids by repeated means, beginning from random rows."""
    random = np.random.default_rng(SEED)
    c = x[random.permutation(len(x))[:centroids]].copy()
    for _ in range(steps):
        near = np.argmin(_nearest(x, c), axis=1)
        for k in range(len(c)):
            if (near == k).any():
                c[k] = x[near == k].mean(axis=0)
    return c


def walk(first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells (first * number of second + second) by summed distance, until they hold ``enough`` entries."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a], second[b]
    heap, seen, held, cells = [(x[0] + y[0], 0, 0)], {(0, 0)}, 0, []
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(second) + int(b[j])
        if counts[cell]:
            cells.append(cell)
            held += int(counts[cell])
        for u, v in ((i + 1, j), (i, j + 1)):
            if u < len(x) and v < len(y) and (u, v) not in seen:
                seen.add((u, v))
                heapq.heappush(heap, (x[u] + y[v], u, v))
    return cells


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors as the codebooks see them: of very large ones no square may be infinite."""
    return np.clip(vectors, -1e150, 1e150)


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances of every row of ``q`` to every row of ``x``."""
    out = np.empty((len(q), len(x)))
    for k in range(0, len(q), 64):
        d = x[None] - q[k:k + 64, None]
        top = np.abs(d).max(axis=2, initial=0.0)
        plain = np.sqrt((d * d).sum(axis=2))
        if np.isfinite(plain).all() and (plain > 1e-150).all():
            out[k:k + 64] = plain
        else:  # squares too large or too small
            s = np.where(top > 0, top, 1)
            out[k:k + 64] = np.where((plain > 1e-150) & np.isfinite(plain), plain, top * np.sqrt(((d / s[:, :, None]) ** 2).sum(axis=2)))
    return out


def _best(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The nearest entries in a part for each query in it, from the cells that the query walks."""
    if not len(queries) or not len(entries):
        return pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
    ids, x, cell = entries["id"].to_numpy(), matrix(entries["v"]), entries["cell"].to_numpy()
    own, q = queries["id"].to_numpy(), matrix(queries["v"])
    walked = [frozenset(c) for c in queries["cells"]]
    out = []
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in own]
    for c in np.unique(cell):
        rows, some = np.flatnonzero(cell == c), np.array([k for k, w in enumerate(walked) if c in w], dtype=np.int64)
        for at in range(0, len(rows), 512):
            part = rows[at:at + 512]
            if not len(some):
                continue
            d = distances(q[some], x[part])
            for k, line in zip(some, d):
                other = ids[part] != own[k]
                line, names = line[other], ids[part][other]
                if len(line) > NEIGHBOURS:
                    keep = np.lexsort((names, line))[:NEIGHBOURS]
                    line, names = line[keep], names[keep]
                found[k].append((line, names))
    for k, lists in enumerate(found):
        if lists:
            line, names = np.concatenate([a for a, _ in lists]), np.concatenate([b for _, b in lists])
            keep = np.lexsort((names, line))[:NEIGHBOURS]
            out.append(pd.DataFrame({"query_id": own[k], "vec_id": names[keep], "score": line[keep]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})


def search(vectors: DataFrame, is_query, vec_id: str = "vec_id", vector: str = "embedding", share: float = SHARE, least: int = LEAST_ENTRIES) -> DataFrame:
    """Per query and neighbour: query_id, rank, vec_id, score (the distance), nearest first.

    ``is_query`` tells from the id column which rows are queries; every row is an entry, and a query
    isn't its own neighbour. Vectors that are null or zero or hold null or non-finite components,
    and null ids, take no part. Vectors of different lengths are never neighbours. Of several rows of
    one id the smallest vector counts. Equal scores go by the smaller id. A query with fewer
    entries than asked for gets all; an empty table gives an empty result.
    """
    schema = "query_id bigint, vec_id bigint, score double"
    rows = cut(usable(vectors, vec_id, vector).groupBy("id").agg(F.min("v").alias("v")).withColumn("size", F.size("v")))
    parts = [_found(rows.where(F.col("size") == size), total, is_query, share, least, schema) for size, total in sorted(map(tuple, rows.groupBy("size").count().collect()))]
    found = rows.sparkSession.createDataFrame([], schema)
    for p in parts:
        found = found.unionAll(p)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= NEIGHBOURS).select("query_id", "rank", "vec_id", "score")


def _found(rows: DataFrame, total: int, is_query, share: float, least: int, schema: str) -> DataFrame:
    sample = _scaled(matrix(rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toPandas()["v"]))
    half = sample.shape[1] // 2
    centroids = max(1, min(CENTROIDS, len(sample) // 8))
    books = codebook(sample[:, :half], centroids), codebook(sample[:, half:], centroids)
    wide = len(books[1])

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            v = _scaled(matrix(batch["v"]))
            batch["cell"] = (np.argmin(_nearest(v[:, :half], books[0]), axis=1) * wide + np.argmin(_nearest(v[:, half:], books[1]), axis=1)).astype(np.int32)
            yield batch

    index = cut(rows.select("id", "v").mapInPandas(placed, "id bigint, v array<double>, cell int"))
    # One number per cell, of which there are at most CENTROIDS squared.
    counts = np.zeros(len(books[0]) * wide, np.int64)
    for c, n in index.groupBy("cell").count().collect():
        counts[c] = n
    # Cells in order fill parts of about PART entries; a cell larger than that is dealt over several.
    split = np.maximum(1, -(-counts // PART))
    first, at, held = np.zeros(len(counts), np.int64), 0, 0
    for c in np.flatnonzero(counts):
        if held and held + counts[c] > PART:
            at, held = at + 1, 0
        first[c] = at
        if split[c] > 1:
            at, held = at + split[c], 0
        else:
            held += counts[c]
    first_of, split_of = F.lit(",".join(map(str, first))), F.lit(",".join(map(str, split)))
    place = lambda column: F.get(F.split(column, ",").cast("array<int>"), F.col("cell"))
    enough = max(least, int(np.ceil(share * total)))
    queries = index.where(is_query(F.col("id")))
    query_blocks = max(1, -(-queries.count() // PART))

    def walks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            v = _scaled(matrix(batch["v"]))
            a, b = _nearest(v[:, :half], books[0]), _nearest(v[:, half:], books[1])
            for k in range(len(batch)):
                cells = np.array(walk(a[k], b[k], counts, enough), dtype=np.int64)
                spread = np.repeat(cells, split[cells])
                part = first[spread] + (np.arange(len(spread)) - np.repeat(np.cumsum(split[cells]) - split[cells], split[cells]))
                order = np.argsort(part, kind="stable")
                starts = np.flatnonzero(np.diff(part[order], prepend=-1))
                yield pd.DataFrame({
                    "id": batch["id"].iloc[k], "v": [batch["v"].iloc[k]] * len(starts), "part": part[order][starts].astype(np.int32),
                    "cells": [x.astype(np.int32) for x in np.split(spread[order], starts[1:])],
                })

    asked = queries.select("id", "v").mapInPandas(walks, "id bigint, v array<double>, part int, cells array<int>")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(query_blocks)).cast("int"))
    entries = index.withColumn("part", (place(first_of) + F.pmod(F.xxhash64("id", F.lit(2)), place(split_of).cast("long"))).cast("int"))
    entries = entries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def ranked(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        return _best(queries, entries)

    return asked.groupBy("part", "block").cogroup(entries.groupBy("part", "block")).applyInPandas(ranked, schema)


def op4_inverted_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "embeddings"), lambda i: i % 100 == 0)


QUERIES = {"op4_inverted_multi_index": op4_inverted_multi_index}
