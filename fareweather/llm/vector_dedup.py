"""Embedding near-dedup: tile products of vectors quantised to 8 bits, with error bounds.

Every vector is unit length, then a scale times whole numbers from -127 to 127, plus an
error whose length is kept. A product of two quantised vectors is exact in whole
numbers, and the lengths of the errors bound how far it is from the cosine. Only
pairs whose bound reaches the threshold are computed in full precision.

Equal vectors are one row with a count. Rows are cut into blocks, and every pair of blocks
is one tile, unless the angles to a few pivots prove that no pair of it can link. A
tile returns, for each of its rows, the number of links and one link towards the
smallest id that it reaches in the tile, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .components import components
from .vectors import matrix, usable

THRESHOLD = 0.95
#: Rows of a block, about.
BLOCK = 4096
#: Rows of a tile that are multiplied at a time.
STRIP = 512
#: Vectors to whose angles blocks are compared: those with the smallest hashes.
PIVOTS = 64
#: Allowance for rounding in double precision.
SLACK = 1e-9


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers from -127 to 127, scales, and lengths of the errors, of unit vectors."""
    scale = np.abs(unit).max(axis=1) / 127 if unit.size else np.zeros(len(unit))
    whole = np.rint(unit / scale[:, None]).astype(np.int8) if len(unit) else unit.astype(np.int8)
    error = np.sqrt(((unit - whole * scale[:, None]) ** 2).sum(axis=1)) * (1 + SLACK) + 1e-15
    return whole, scale, error


def _units(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that no square is too large or too small
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the pairs of unit vectors with a cosine of at least ``threshold``."""
    qa, sa, ea = quantised(a)
    qb, sb, eb = quantised(b)
    # Products of 8-bit numbers add up exactly in single precision up to 2^24, that is 1,040 components.
    kind = np.float32 if a.shape[1] <= 1040 else np.float64
    fb = qb.astype(kind).T
    la, lb = np.sqrt((qa.astype(np.float64) ** 2).sum(axis=1)) * sa, np.sqrt((qb.astype(np.float64) ** 2).sum(axis=1)) * sb
    out_i, out_j = [], []
    for at in range(0, len(a), STRIP):
        some = slice(at, at + STRIP)
        product = qa[some].astype(kind) @ fb
        # Least product of each row that any column's scale and error could bring to the threshold.
        bound = la[some] * eb.max() + lb.max() * ea[some] + ea[some] * eb.max() + SLACK
        least = (threshold - bound) / (sa[some] * sb.max())
        least = np.where(least > 0, least, (threshold - bound) / (sa[some] * sb.min()))
        i, j = np.nonzero(product >= (least * (1 - 1e-6) - 1e-6).astype(kind)[:, None])
        i += at
        near = product[i - at, j] * (sa[i] * sb[j]) + la[i] * eb[j] + lb[j] * ea[i] + ea[i] * eb[j] + SLACK >= threshold
        i, j = i[near], j[near]
        # Full precision, for the pairs that may reach the threshold.
        for k in range(0, len(i), 200_000):
            x, y = i[k:k + 200_000], j[k:k + 200_000]
            true = np.einsum("ij,ij->i", a[x], b[y]) >= threshold
            out_i.append(x[true])
            out_j.append(y[true])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *out_i]), np.concatenate([none, *out_j])


def least_reached(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the links (i, j) reach."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
        if not len(i):
            break
    while (label != label[label]).any():
        label = label[label]
    return label


def _tile(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    rows = rows.sort_values(["block", "id"], ignore_index=True)
    unit = _units(matrix(rows["v"]))
    ids, counts, block = rows["id"].to_numpy(), rows["n"].to_numpy(), rows["block"].to_numpy()
    first = np.flatnonzero(block == rows["low"].iloc[0])
    second = np.flatnonzero(block == rows["high"].iloc[0])
    links, pairs_i, pairs_j = np.zeros(len(rows), np.int64), [], []
    same = rows["low"].iloc[0] == rows["high"].iloc[0]
    label = np.arange(len(rows))
    for at in range(0, len(first), STRIP):
        i, j = linked_pairs(unit[first[at:at + STRIP]], unit[second], threshold)
        i, j = first[at + i], second[j]
        if same:
            i, j = i[i != j], j[i != j]
        np.add.at(links, i, counts[j])
        if not same:
            np.add.at(links, j, counts[i])
        # Links within what is joined already tell nothing new.
        far = label[i] != label[j]
        pairs_i, pairs_j = label[i[far]], label[j[far]]
        if len(pairs_i):
            pairs = np.unique(np.stack((np.minimum(pairs_i, pairs_j), np.maximum(pairs_i, pairs_j))), axis=1)
            label = least_reached(len(rows), pairs[0], pairs[1])[label]
    told = np.flatnonzero((links > 0) | (label != np.arange(len(rows))))
    smallest = pd.Series(ids).groupby(label).transform("min").to_numpy()
    return pd.DataFrame({"id": ids[told], "links": links[told], "to": smallest[told]})


def _pivots(rows: DataFrame) -> np.ndarray:
    some = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).toPandas()
    return _units(matrix(some["v"])) if len(some) else np.zeros((0, 1))


def deduplicated(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Vectors that are null or zero or hold null or non-finite components link with nothing, as do
    those with a null id; they are kept. Vectors of different lengths never link. Rows of one
    id are one vector each to its links, and one in the result's numbers: equal vectors of one id
    count as one, different ones of one id all count. An empty table gives an empty result.
    """
    rows = usable(vectors, vec_id, vector).distinct()
    # Of equal vectors the smallest id stands for all; -0.0 and 0.0 are equal.
    classes = rows.groupBy(F.transform("v", lambda x: x + F.lit(0.0)).alias("v")).agg(F.min("id").alias("id"), F.count("*").alias("n"))
    classes = cut(classes.withColumn("size", F.size("v")))
    links = _links(classes, threshold, block)
    joined = components(links.select(F.col("id").alias("u"), F.col("to").alias("v")))
    n_links = links.groupBy("id").agg(F.sum("links").alias("links"))
    per_class = classes.join(n_links, "id", "left").join(joined, "id", "left").select(
        F.col("v").alias("class_v"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"),
    )
    # An id with several vectors belongs to all their components.
    members = rows.select("id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v")).join(per_class, F.col("v") == F.col("class_v")).select("id", "n_links", "component")
    per_id = members.groupBy("id").agg(F.sum("n_links").alias("n_links"), F.min("component").alias("component"))
    asked = vectors.select(F.col(vec_id).alias("vec_id"))
    done = asked.join(per_id, asked["vec_id"] == per_id["id"], "left")
    component = F.coalesce("component", F.col("vec_id").cast("long"))
    return done.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.coalesce(component == F.col("vec_id"), F.lit(True))).alias("kept"))


def _links(classes: DataFrame, threshold: float, block: int) -> DataFrame:
    """Per class and tile: id, links (rows linked there) and a smaller id that it reaches there."""
    schema = "id bigint, links bigint, to bigint"
    parts = []
    # Vectors of one length at a time; tables have one length as a rule.
    for size, total in sorted(map(tuple, classes.groupBy("size").count().collect())):
        parts.append(_tiles(classes.where(F.col("size") == size), total, threshold, block, schema))
    if not parts:
        return classes.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return cut(out)


def _tiles(classes: DataFrame, total: int, threshold: float, block: int, schema: str) -> DataFrame:
    pivots = _pivots(classes)
    blocks = max(1, -(-total // block))
    by_pivot = blocks >= 2 * len(pivots)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"p": np.argmax(_units(matrix(batch["v"])) @ pivots.T, axis=1)})

    # While there are many blocks, each holds rows of one nearest pivot; one that is nearest to
    # many rows has more blocks, so that none is larger than the others.
    per_pivot = np.ones(max(1, len(pivots)), np.int64)
    if by_pivot:
        for p, n in classes.select("v").mapInPandas(nearest, "p int").groupBy("p").count().collect():
            per_pivot[p] = max(1, -(-n // block))
    first = np.cumsum(per_pivot) - per_pivot

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Block of each row, by its nearest pivot while there are blocks enough, and its angles."""
        for batch in batches:
            angles = np.arccos(np.clip(_units(matrix(batch["v"])) @ pivots.T, -1, 1))
            spread = batch["hash"].to_numpy()
            near = np.argmin(angles, axis=1)
            number = first[near] + spread % per_pivot[near] if by_pivot else spread % blocks
            batch["block"] = number.astype(np.int32)
            batch["angles"] = list(angles.astype(np.float32))
            yield batch[["id", "v", "n", "block", "angles"]]

    hashed = classes.select("id", "v", "n", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 31)).alias("hash"))
    rows = hashed.mapInPandas(placed, "id bigint, v array<double>, n bigint, block int, angles array<float>")
    # The least and greatest angle of each block to each pivot; two blocks further apart than
    # the threshold's angle at any pivot have no link.
    spans = rows.select("block", F.posexplode("angles").alias("pivot", "angle")).groupBy("block", "pivot").agg(F.min("angle").alias("low"), F.max("angle").alias("high"))
    ranges = spans.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pivot", "low", "high"))).alias("r")).select("block", F.col("r.low").alias("low"), F.col("r.high").alias("high")).toPandas()
    ranges = ranges.sort_values("block", ignore_index=True)
    low, high, names = np.array(ranges["low"].tolist()), np.array(ranges["high"].tolist()), ranges["block"].to_numpy()
    reach = float(np.arccos(np.clip(threshold, -1, 1))) + 1e-4  # angles are kept in single precision

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A copy of each row for every tile in which it may link."""
        for batch in batches:
            angles = np.array(batch["angles"].tolist(), dtype=np.float64)
            own = np.searchsorted(names, batch["block"].to_numpy())
            for k in range(0, len(batch), 2048):
                a = angles[k:k + 2048]
                may = np.ones((len(a), len(names)), bool)
                for p in range(a.shape[1]):
                    may &= (a[:, p, None] >= low[None, :, p] - reach) & (a[:, p, None] <= high[None, :, p] + reach)
                i, other = np.nonzero(may)
                part = batch.iloc[k + i]
                mine, theirs = names[own[k + i]], names[other]
                yield pd.DataFrame({"id": part["id"].to_numpy(), "v": part["v"].to_numpy(), "n": part["n"].to_numpy(), "block": mine, "low": np.minimum(mine, theirs), "high": np.maximum(mine, theirs)})

    copies = rows.mapInPandas(dealt, "id bigint, v array<double>, n bigint, block int, low int, high int")

    def tile(_key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if rows["low"].iloc[0] != rows["high"].iloc[0] and rows["block"].nunique() < 2:
            return pd.DataFrame({"id": [], "links": [], "to": []}).astype("int64")
        return _tile(rows, threshold)

    return copies.groupBy("low", "high").applyInPandas(tile, schema)


def op6_quantised_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicated(table(spark, folder, "embeddings"))


QUERIES = {"op6_quantised_dedup": op6_quantised_dedup}
