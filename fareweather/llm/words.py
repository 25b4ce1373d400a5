"""Blocks of texts as numbered words, and learning from a bounded sample of labelled rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, text_or_empty

#: Texts of a block of about so many characters are read together.
BLOCK_CHARS = 1_500_000


def blocks(texts: list[str], most: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts that make up blocks; a text longer than a block is one by itself."""
    start = chars = 0
    for i, t in enumerate(texts):
        if chars and chars + len(t) > most:
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)


def in_blocks(batches: Iterator[pd.DataFrame], text: str) -> Iterator[pd.DataFrame]:
    """The rows of batches in smaller ones, each a block of texts, so that what a task makes of one
    stays small."""
    for batch in batches:
        for a, b in blocks(batch[text].tolist()):
            yield batch.iloc[a:b]


class Words:
    """Words between white space of several texts: ``distinct`` ones, and for text i their
    numbers in order, ``codes[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, texts: list[str], lower: bool = False):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        split = [(r.lower() if lower else r).split() for r in raw]
        self.counts = np.array([len(w) for w in split], dtype=np.int64)
        self.bounds = np.concatenate(([0], np.cumsum(self.counts)))
        self.codes, distinct = pd.factorize(np.array([x for w in split for x in w], dtype=object))
        self.distinct: list[bytes] = list(distinct)

    def __len__(self) -> int:
        return len(self.counts)

    def of(self, i: int) -> np.ndarray:
        return self.codes[self.bounds[i]:self.bounds[i + 1]]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text, the sum of a value of its words."""
        total = np.concatenate(([0.0], np.cumsum(values[self.codes], dtype=np.float64)))
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, most: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """At most ``most`` distinct rows (d, t, y) with a label of 0 or 1, however many rows an id has: those with the smallest
    hashes of their id, the held-out fifth left out."""
    known = labels.select(F.col(doc_id).alias("d"), F.col(label).cast("int").alias("y")).where("d is not null and y in (0, 1)").where(~held_out(F.col("d")))
    chosen = known.distinct().orderBy(F.xxhash64("d"), "d", "y").limit(most)
    rows = documents.select(F.col(doc_id).alias("d"), text_or_empty(F.col(text)).alias("t")).join(F.broadcast(chosen), "d").select("d", "t", "y")
    return rows.distinct().orderBy(F.xxhash64("d"), "d", "y", F.xxhash64("t"), "t").limit(most)


def sparse_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` from each bound to the next."""
    total = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)))
    return total[bounds[1:]] - total[bounds[:-1]]
