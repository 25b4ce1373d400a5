"""Toxicity by weak supervision.

Many voters, words and word beginnings of a lexicon and patterns of writing, vote or
abstain. A generative model of the votes estimates how often each voter is right and
which voters depend on each other; its posterior labels train a linear classifier,
which also judges texts on which no voter votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, table, text_or_empty
from .words import Words, blocks, labelled_sample, sparse_sums

#: At most so many labelled rows are learnt from.
SAMPLE_ROWS = 8000
#: A score from here on predicts label 1.
CUT = 0.5
#: Lengths of word beginnings that are looked at.
BEGINNINGS = (4, 5, 6)
#: Least rows of the sample in which a voter votes or a feature stands.
LEAST_ROWS = 4
#: Correlation within a class from which voters count as dependent.
DEPENDENT = 0.25
#: Voters of the lexicon at most.
VOTERS = 400
#: The share of toxic rows among those of a term of the lexicon, at the lower end of its interval.
SURE = 0.5
#: Other rows of such a term at most, by its toxic ones.
STRAY = 0.03
#: Standard deviations from chance of a feature of the classifier.
BEYOND = 5.0
#: Share of the union of their terms that copies and near copies have in common.
COPY = 0.8
#: Seeded minima of a row's terms; rows that agree in under half of them aren't compared.
MINIMA = 32
EPOCHS = 20
RATE = 0.5
PENALTY = 1e-3
SEED = 5
EDGE = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def terms(words: Words) -> tuple[list[list[str]], list[bool]]:
    """Per distinct word its terms, the word in lower case and its beginnings, and if it shouts."""
    found, loud = [], []
    for raw in words.distinct:
        core = raw.strip(EDGE).decode("utf-8", "replace")
        low = core.lower()
        found.append([f"={low}", *(f"^{low[:n]}" for n in BEGINNINGS if len(low) >= n)] if low else [])
        loud.append(len(core) > 2 and core.isupper())
    return found, loud


def patterns(text: str, words: int, shouted: float) -> list[int]:
    """Votes of the patterns of writing: 1 toxic, -1 not, 0 none. The share of shouted words,
    marks of excitement, and insults by address or by masked letters."""
    low = text.lower()
    marks = text.count("!") + text.count("?!")
    stars = sum(1 for w in low.split("*")[1:-1] if w == "")
    return [
        1 if words and shouted / words > 0.9 and marks > words else 0,
        1 if marks > 3 * max(1, words) else 0,
        1 if any(x in low for x in ("shut up", "i hate you", "go to hell", "kill yourself", "you are a ")) else 0,
        1 if stars > 3 and words < 20 else 0,
        -1 if words >= 5 and not marks else 0,
    ]


PATTERNS = 5


def _logit(x):
    return np.log(x / (1 - x))


@dataclass
class Labeller:
    """A generative model of votes: the share of toxic texts, for each voter how often a text that
    it votes on is toxic, and the correlations of voters within a class. Abstaining tells nothing."""

    share: float
    accuracy: np.ndarray
    correlation: np.ndarray

    def posterior(self, voted: np.ndarray) -> np.ndarray:
        """Chance of toxic of each row of ``voted`` (row x voter, 0 or 1). Votes that depend on
        each other share one voice: each counts one over those it goes with in its row."""
        voices = voted / np.maximum(1.0, voted @ self.correlation)
        odds = _logit(self.share) + voices @ (_logit(self.accuracy) - _logit(self.share))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def label_model(voted: np.ndarray, lexicon: int, share: float, steps: int = 20) -> Labeller:
    """Estimated by expectation and maximisation from the votes alone. The first ``lexicon`` voters
    begin as right in nine of ten rows, the others as they agree with those; ``share`` is
    the share of toxic rows, which is held. What voters have in common within a class after a
    first estimate is their correlation; the estimate is then made again with it.
    """
    n, voters = voted.shape
    votes = voted.sum(axis=0)
    start = np.full(voters, 0.9)
    any_term = voted[:, :lexicon].any(axis=1).astype(float)
    start[lexicon:] = (voted[:, lexicon:].T @ any_term + share) / (votes[lexicon:] + 1)
    start = np.clip(start, 0.01, 0.98)
    model = Labeller(share, start.copy(), np.eye(voters))
    for turn in range(2):
        for _ in range(steps):
            p = model.posterior(voted)
            # The beginning counts as much as the rows seen, which keeps the classes' meaning.
            model.accuracy = np.clip((voted.T @ p + (votes + 3) * start) / (2 * votes + 3), 0.01, 0.98)
        if turn == 0 and n:
            p = model.posterior(voted)
            common = np.zeros((voters, voters))
            for part in (1 - p, p):
                left = (voted - (voted.T @ part) / max(part.sum(), 1e-9)) * np.sqrt(part)[:, None]
                common += left.T @ left
            spread = np.sqrt(np.clip(np.diag(common), 1e-9, None))
            correlation = np.clip(common / spread[:, None] / spread[None, :], 0, 1)
            correlation[correlation < DEPENDENT] = 0
            np.fill_diagonal(correlation, 1)
            model.correlation = correlation
    return model


@dataclass
class Classifier:
    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)
    shape: tuple = (0.0,) * PATTERNS

    def scores(self, texts: list[str]) -> np.ndarray:
        out = []
        for a, b in blocks(texts):
            words = Words(texts[a:b])
            found, loud = terms(words)
            # A word counts by the sum of its terms' weights, once a text.
            weight = np.array([sum(self.weights.get(t, 0.0) for t in x) for x in found] or [0.0])
            shouted = words.sums(np.array(loud, dtype=float)) if found else np.zeros(len(words))
            for i, text in enumerate(texts[a:b]):
                codes = words.of(i)
                votes = patterns(text, len(codes), shouted[i])
                hit = codes[weight[codes] != 0] if len(codes) else codes
                out.append(self.bias + weight[np.unique(hit)].sum() + sum(w * v for w, v in zip(self.shape, votes)))
        return 1 / (1 + np.exp(-np.clip(np.array(out), -30, 30)))


def _numbered(rows: pd.DataFrame) -> tuple[list[np.ndarray], list[str]]:
    """The terms of each row by number, and the terms."""
    known: dict[str, int] = {}
    per = [np.array([known.setdefault(t, len(known)) for t in x.split("\n")], dtype=np.int32) for x in rows["terms"]]
    return per, list(known)


def _gathered(rows: pd.DataFrame) -> tuple[list[np.ndarray], list[str], np.ndarray]:
    """The terms of the sample by number, those of enough rows only, and the patterns' votes."""
    per, names = _numbered(rows)
    enough = np.bincount(np.concatenate(per), minlength=len(names)) >= LEAST_ROWS
    enough &= np.array([bool(x) for x in names])
    new = np.cumsum(enough) - 1
    per = [new[found[enough[found]]] for found in per]
    return per, [t for t, k in zip(names, enough) if k], np.array([list(map(int, v.split(","))) for v in rows["votes"]])


def _lexicon(per: list[np.ndarray], names: list[str], y: np.ndarray) -> np.ndarray:
    """Terms that mark toxic rows among the labelled ones: the voters of the lexicon."""
    toxic, other = np.zeros(len(names)), np.zeros(len(names))
    for found, label in zip(per, y):
        (toxic if label else other)[found] += 1
    seen = np.maximum(1, toxic + other)
    sure = toxic / seen
    # The lower end of what the share of toxic rows may be.
    z = 1.64
    low = (sure + z * z / (2 * seen) - z * np.sqrt(sure * (1 - sure) / seen + z * z / (4 * seen**2))) / (1 + z * z / seen)
    good = np.flatnonzero((toxic >= LEAST_ROWS) & (low >= SURE) & (other <= STRAY * toxic))
    good = good[np.argsort(-toxic[good] * low[good], kind="stable")]
    # A word and its beginnings that stand in the same rows are one voter.
    sign = np.random.default_rng(SEED).integers(1, 1 << 62, len(per), dtype=np.uint64)
    rows_of = np.zeros(len(names), np.uint64)
    for found, x in zip(per, sign):
        rows_of[found] ^= x
    first = np.sort(np.unique(rows_of[good], return_index=True)[1])
    return good[first][:VOTERS]


def _families(rows: pd.DataFrame) -> pd.DataFrame:
    """One row of each group of copies and near copies of one label, so that the words of a much copied
    text don't look like marks of its label. Seeded minima of the terms find rows that may share
    COPY of them with one kept before; the terms themselves decide."""
    if not len(rows):
        return rows
    per, names = _numbered(rows)
    flat, starts = np.concatenate(per), np.concatenate(([0], np.cumsum([len(x) for x in per])))[:-1]
    random = np.random.default_rng(SEED)
    minima = np.stack([np.minimum.reduceat(random.integers(0, 1 << 32, len(names), dtype=np.uint32)[flat], starts) for _ in range(MINIMA)], axis=1)
    labels, kept, of_row = rows["y"].to_numpy(), np.zeros(len(rows), dtype=bool), np.zeros(len(names), dtype=bool)
    for label in np.unique(labels):
        of_label = np.flatnonzero(labels == label)
        first, n = np.empty(len(of_label), np.int64), 0
        seen = np.empty((len(of_label), MINIMA), np.uint32)
        for i in of_label:
            maybe = first[:n][(seen[:n] == minima[i]).sum(axis=1) * 2 >= MINIMA]
            of_row[per[i]] = True
            shared = [(np.count_nonzero(of_row[per[k]]), len(per[i]) + len(per[k])) for k in maybe]
            of_row[per[i]] = False
            if not any(both >= COPY * (total - both) for both, total in shared):
                first[n], seen[n], n = i, minima[i], n + 1
        kept[first[:n]] = True
    return rows.loc[kept].reset_index(drop=True)


def fit(rows: pd.DataFrame) -> Classifier:
    """From rows of terms, votes and labels. Labels choose the lexicon's terms and the share of toxic
    rows; the classifier itself sees posterior labels. Without a toxic row none is found."""
    rows = _families(rows)
    y = rows["y"].to_numpy(dtype=np.int64)
    if not len(rows) or not y.sum() or y.all():
        return Classifier(bias=float(np.log((y.sum() + 0.1) / (len(y) - y.sum() + 1))) if len(rows) else -3.0)
    per, names, votes = _gathered(rows)
    lexicon = _lexicon(per, names, y)
    where = np.full(len(names), -1)
    where[lexicon] = np.arange(len(lexicon))
    voted = np.zeros((len(rows), len(lexicon) + PATTERNS), np.float32)
    for i, found in enumerate(per):
        voted[i, where[found][where[found] >= 0]] = 1
    voted[:, len(lexicon):] = votes != 0
    model = label_model(voted, len(lexicon), float(np.clip(y.mean(), 0.005, 0.5)))
    p = model.posterior(voted)
    # Features of the classifier: terms that go with the posterior beyond chance.
    seen, toxic = np.zeros(len(names)), np.zeros(len(names))
    for found, chance in zip(per, p):
        seen[found] += 1
        toxic[found] += chance
    mean = p.mean()
    z = (toxic - seen * mean) / np.sqrt(np.maximum(seen, 1) * max(mean * (1 - mean), 1e-9))
    kept = np.abs(z) >= BEYOND
    new = np.cumsum(kept) - 1
    per = [new[found[kept[found]]] for found in per]
    names = [t for t, k in zip(names, kept) if k]
    # The linear classifier: log loss against the posterior, adaptive steps.
    random = np.random.default_rng(SEED)
    weights, shape, bias = np.zeros(len(names)), np.zeros(PATTERNS), float(np.log(y.mean() / (1 - y.mean())))
    square_w, square_s, square_b = np.full(len(names), 1e-3), np.full(PATTERNS, 1e-3), 1e-3
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(order), 64):
            some = order[at:at + 64]
            bounds = np.concatenate(([0], np.cumsum([len(per[i]) for i in some])))
            index = np.concatenate([per[i] for i in some])
            raw = bias + sparse_sums(weights[index], bounds) + votes[some] @ shape
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - p[some]) / len(some)
            used, place = np.unique(index, return_inverse=True)
            grad = np.bincount(place, np.repeat(error, np.diff(bounds)), len(used)) + PENALTY * weights[used]
            grad_s = votes[some].T @ error
            square_w[used] += grad**2
            square_s += grad_s**2
            square_b += error.sum() ** 2
            weights[used] -= RATE * grad / np.sqrt(square_w[used])
            shape -= RATE * 0.2 * grad_s / np.sqrt(square_s)
            bias -= RATE * error.sum() / np.sqrt(square_b)
    return Classifier(float(bias), {t: float(w) for t, w in zip(names, weights)}, tuple(map(float, shape)))


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", most: int = SAMPLE_ROWS, doc_id: str = "doc_id", text: str = "text") -> Classifier:
    """Fitted on the driver from the terms of at most ``most`` labelled rows."""
    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            texts = batch["t"].tolist()
            for a, b in blocks(texts):
                words = Words(texts[a:b])
                found, loud = terms(words)
                shouted = words.sums(np.array(loud, dtype=float)) if found else np.zeros(len(words))
                for i in range(b - a):
                    codes = np.unique(words.of(i))
                    here = sorted({t for c in codes for t in found[c]})
                    out.append(("\n".join(here), ",".join(map(str, patterns(texts[a + i], len(words.of(i)), shouted[i])))))
            yield pd.DataFrame({"d": batch["d"], "y": batch["y"], "terms": [x for x, _ in out], "votes": [v for _, v in out]})

    sample = labelled_sample(documents, labels, label, most, doc_id, text)
    rows = sample.mapInPandas(told, "d bigint, y int, terms string, votes string").toPandas()
    return fit(rows.sort_values(["d", "y", "terms"]).reset_index(drop=True))


def scored(documents: DataFrame, classifier: Classifier, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    A null text scores as an empty one: no term and no vote, so the classifier's bias.
    Repeated rows score alike. A null id counts as an empty text for held_out. An empty
    table gives an empty result.
    """
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"d": batch["d"].astype("Int64"), "score": classifier.scores(batch["t"].tolist())})

    rows = documents.select(F.col(doc_id).cast("long").alias("d"), text_or_empty(F.col(text)).alias("t"))
    done = rows.mapInPandas(score, "d bigint, score double")
    return done.select(F.col("d").alias("doc_id"), held_out(F.col("d")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op10_weak_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return scored(documents, train(documents, table(spark, folder, "labels")))


QUERIES = {"op10_weak_toxicity": op10_weak_toxicity}
