"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Pairs of features interact through low-rank vectors. A score takes time linear in
the features present: the sum over pairs is half of the square of the sum less the
sum of the squares.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, held_out, table, text_or_empty
from .words import Words, blocks, labelled_sample, sparse_sums

#: At most so many labelled rows are learnt from.
SAMPLE_ROWS = 4000
#: A score from here on predicts label 1.
CUT = 0.3
BUCKETS = 1 << 14
RANK = 8
EPOCHS = 8
RATE = 0.1
PENALTY = 1e-4
SEED = 11
#: Steps of each structure statistic; its step is a feature.
STEPS = 16

#: Structure statistics, with the scale on which they are cut into steps.
STATISTICS = ("words", "characters", "mean word", "distinct words", "upper words", "marked words", "lone marks", "digits", "repeats", "lines", "distinct lines", "longest run")


def _word_traits(distinct: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per distinct word: its bucket, that of its tail of marks, and its traits."""
    n = len(distinct)
    bucket, tail, traits = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros((n, 5))
    for i, raw in enumerate(distinct):
        word = raw.decode("utf-8", "replace")
        core = word.rstrip("!#$%&*+-./:;<=>?@^_|~,\"'()[]{}")
        end = word[len(core):]
        bucket[i] = zlib.crc32(core.lower().encode("utf-8", "surrogatepass")) % BUCKETS
        tail[i] = BUCKETS + zlib.crc32(end.encode()) % 256
        traits[i] = (len(word), len(core) > 1 and core.isupper(), len(end) > 1, not core, sum(c.isdigit() for c in core) if not core.isalpha() else 0)
    return bucket, tail, traits


def _stepped(values: np.ndarray) -> np.ndarray:
    """The step of each statistic: shares in even steps, counts by their logarithm."""
    return np.clip(values, 0, STEPS - 1).astype(np.int64)


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text the numbers and values of its features; an empty text has structure alone."""
    for a, b in blocks(texts):
        words = Words(texts[a:b])
        bucket, tail, traits = _word_traits(words.distinct)
        sums = [words.sums(traits[:, j]) for j in range(traits.shape[1])] if len(words.distinct) else [np.zeros(len(words))] * 5
        for i, text in enumerate(texts[a:b]):
            codes = words.of(i)
            n = max(1, len(codes))
            lines = [x for x in text.split("\n") if x.strip()]
            kinds = np.unique(codes)
            repeats = float((codes[1:] == codes[:-1]).sum()) if len(codes) > 1 else 0.0
            longest = max((len(x) for x in lines), default=0)
            stats = np.array([
                np.log2(1 + len(codes)), np.log2(1 + len(text)) * 0.9, sums[0][i] / n, STEPS * len(kinds) / n * 0.999,
                STEPS * sums[1][i] / n, STEPS * sums[2][i] / n, STEPS * sums[3][i] / n, STEPS * min(1.0, sums[4][i] / n),
                STEPS * repeats / n, np.log2(1 + len(lines)) * 1.5, STEPS * len(set(lines)) / max(1, len(lines)) * 0.999, np.log2(1 + longest),
            ])
            structure = BUCKETS + 256 + np.arange(len(stats)) * STEPS + _stepped(stats)
            hashed = np.unique(bucket[kinds]) if len(kinds) else np.empty(0, np.int64)
            ends, many = np.unique(tail[codes], return_counts=True) if len(codes) else (np.empty(0, np.int64), np.empty(0))
            index = np.concatenate((hashed, ends, structure))
            value = np.concatenate((np.full(len(hashed), 1 / np.sqrt(max(1, len(hashed)))), many / n, np.full(len(structure), 1 / np.sqrt(len(structure)))))
            yield index, value.astype(np.float32)


WIDTH = BUCKETS + 256 + len(STATISTICS) * STEPS


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows:
            return np.empty(0)
        bounds = np.concatenate(([0], np.cumsum([len(i) for i, _ in rows])))
        index, value = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
        return 1 / (1 + np.exp(-np.clip(self._sum(index, value, bounds)[0], -30, 30)))

    def _sum(self, index, value, bounds):
        vx = self.factors[index] * value[:, None]
        sums = sparse_sums(vx, bounds)
        pairs = 0.5 * (sums**2 - sparse_sums(vx**2, bounds)).sum(axis=1)
        return self.bias + sparse_sums(self.weights[index] * value, bounds) + pairs, vx, sums


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> Machine:
    """Adaptive gradient steps on the log loss. Without rows every score is a half; with
    labels of one kind all scores lean that way."""
    random = np.random.default_rng(SEED)
    machine = Machine(0.0, np.zeros(WIDTH), random.normal(0, 0.05, (WIDTH, RANK)))
    if not len(rows):
        machine.factors[:] = 0
        return machine
    rate_w, rate_v, rate_b = np.full(WIDTH, 1e-6), np.full((WIDTH, RANK), 1e-6), 1e-6
    share = (y.sum() + 1) / (len(y) + 2)
    machine.bias = float(np.log(share / (1 - share)))
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(order), 128):
            some = order[at:at + 128]
            bounds = np.concatenate(([0], np.cumsum([len(rows[i][0]) for i in some])))
            index, value = np.concatenate([rows[i][0] for i in some]), np.concatenate([rows[i][1] for i in some]).astype(np.float64)
            raw, vx, sums = machine._sum(index, value, bounds)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[some]) / len(some)
            each = np.repeat(error, np.diff(bounds))
            used, place = np.unique(index, return_inverse=True)
            grad_w = np.bincount(place, each * value) + PENALTY * machine.weights[used]
            inner = (np.repeat(sums, np.diff(bounds), axis=0) - vx) * (each * value)[:, None]
            grad_v = np.stack([np.bincount(place, inner[:, f], len(used)) for f in range(RANK)], axis=1) + PENALTY * machine.factors[used]
            rate_w[used] += grad_w**2
            rate_v[used] += grad_v**2
            rate_b += error.sum() ** 2
            machine.weights[used] -= RATE * grad_w / np.sqrt(rate_w[used])
            machine.factors[used] -= 0.3 * RATE * grad_v / np.sqrt(rate_v[used])
            machine.bias -= RATE * error.sum() / np.sqrt(rate_b)
    return Machine(machine.bias, machine.weights.astype(np.float32), machine.factors.astype(np.float32))


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE_ROWS, doc_id: str = "doc_id", text: str = "text") -> Machine:
    """Fitted on the driver from the features of at most ``most`` labelled rows, never their
    texts; the features are made by Spark."""
    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(features(batch["t"].tolist()))
            yield pd.DataFrame({"d": batch["d"], "y": batch["y"], "i": [i.astype("<i4").tobytes() for i, _ in found], "v": [v.tobytes() for _, v in found]})

    rows = labelled_sample(documents, labels, label, most, doc_id, text).mapInPandas(numbered, "d bigint, y int, i binary, v binary").toPandas()
    rows = rows.sort_values(["d", "y", "i", "v"])
    found = [(np.frombuffer(i, "<i4").astype(np.int64), np.frombuffer(v, np.float32)) for i, v in zip(rows["i"], rows["v"])]
    return fit(found, rows["y"].to_numpy(dtype=np.float64))


def _score(machine: Machine, texts: list[str]) -> np.ndarray:
    out, held = [], []
    for row in features(texts):
        held.append(row)
        if len(held) == 256:
            out.append(machine.scores(held))
            held = []
    return np.concatenate([*out, machine.scores(held)])


def scored(documents: DataFrame, machine: Machine, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    A null text scores as an empty one, by its structure alone. Repeated rows score alike.
    A null id counts as an empty text for held_out. An empty table gives an empty result.
    """
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"d": batch["d"].astype("Int64"), "score": _score(machine, batch["t"].tolist())})

    rows = documents.select(F.col(doc_id).cast("long").alias("d"), text_or_empty(F.col(text)).alias("t"))
    done = rows.mapInPandas(score, "d bigint, score double")
    return done.select(F.col("d").alias("doc_id"), held_out(F.col("d")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """The rows whose text is predicted to be of label 1, in the table's own columns."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        scores = pd.Series(_score(machine, texts.tolist()))
        give_back()
        return scores

    return documents.where(score(text_or_empty(F.col(text))) >= CUT)


def op8_factorisation_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return scored(documents, train(documents, table(spark, folder, "labels")))


QUERIES = {"op8_factorisation_quality": op8_factorisation_quality}
