"""Toxicity by a counterfactually regularised linear classifier.

Features of a text are the words and word beginnings (three to six letters) it holds, anywhere in the whole
text. Logistic regression learns their weights from labelled documents. For sentences of the
labelled documents that name a group, the group's term is swapped for another one; the squared
change of the score is added to the loss, so that the mere mention of a group does not move the
score. Group terms are thereby features like all others, but cost what they shift.

Learning uses a bounded sample (``PER_CLASS`` documents of each class, ``FEATURES`` features,
``SENTENCES`` sentences per group term's text); scoring is a projection over all rows.

Defined results: null and empty texts get the score of a text without features; repeated rows get
equal scores; with labels of one class only, or none, all scores are the share of label 1 (0 without
any). Neither labels, lang, source nor doc_id are inputs of a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptloom.llm.labelled import sample

PER_CLASS = 6000
FEATURES = 2000
SENTENCES = 4
THRESHOLD = 0.7
# Terms for groups of people that a neutral text may name.
GROUP_TERMS = (
    "women", "men", "girls", "boys", "gay", "lesbian", "straight", "transgender", "christian",
    "muslim", "jewish", "hindu", "buddhist", "atheist", "black", "white", "asian", "latino",
    "african", "european", "american", "arab", "german", "french", "spanish", "immigrant",
    "refugee", "disabled", "deaf", "blind", "old", "young",
)
WORDS = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6)


def features(text: str | None) -> set[str]:
    """Words, and word beginnings with a mark before them."""
    found = set(WORDS.findall((text or "").lower()))
    return found.union(*({"^" + w[:k] for w in found if len(w) > k} for k in PREFIXES))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), 200):
            part, names, ys = batch.slice(start, 200), [], []
            for text, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                found = features(text)
                names += found
                ys += [y] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ys, pa.int32())], names=["name", "y"])


def choose_features(rows: DataFrame, limit: int) -> tuple[list[str], int, int]:
    """The features whose share differs most between the classes, and the class sizes."""
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones or not zeros:
        return [], ones, zeros
    # distance of the two shares in units of their spread
    p, q = (F.col("with1") + 0.5) / (ones + 1.0), (F.col("with0") + 0.5) / (zeros + 1.0)
    spread = F.sqrt(p * (1 - p) / ones + q * (1 - q) / zeros)
    best = (
        rows.mapInArrow(_counts, "name string, y int")
        .groupBy("name")
        .agg(F.sum("y").alias("with1"), F.sum(1 - F.col("y")).alias("with0"))
        .where("with1 + with0 >= 3")
        .orderBy(F.abs((p - q) / spread).desc(), "name")
        .limit(limit)
    )
    return [r["name"] for r in best.select("name").collect()], ones, zeros


def sentences_with_groups(text: str, terms: tuple[str, ...], limit: int = SENTENCES) -> list[tuple[str, str]]:
    """Sentences that name a group, each with a copy in which another group is named."""
    if not terms:
        return []
    named = re.compile(r"\b(" + "|".join(map(re.escape, terms)) + r")\b", re.IGNORECASE)
    pairs = []
    for sentence in re.split(r"(?<=[.!?])\s+", text):
        found = named.search(sentence)
        if found:
            at = terms.index(found[1].lower())
            other = terms[(at + 1 + len(pairs)) % len(terms)]
            pairs.append((sentence, sentence[: found.start()] + other + sentence[found.end() :]))
            if len(pairs) == limit:
                break
    return pairs


class Model:
    """Weights of features; ``score`` is the probability of label 1."""

    def __init__(self, names: list[str], weights: np.ndarray, bias: float):
        self.weight = dict(zip(names, weights.tolist()))
        self.bias = bias

    def score(self, text: str | None) -> float:
        weight = self.weight
        z = self.bias + sum([weight[f] for f in sorted(features(text) & weight.keys())])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    @property
    def groups_moved(self) -> float:
        """The largest difference that naming one group in place of another makes to the log-odds."""
        moved = [sum(self.weight.get(f, 0.0) for f in features(t)) for t in GROUP_TERMS]
        return max(moved) - min(moved)


def _flat(rows: list[list[int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return at, np.array([i for r in rows for i in r], dtype=np.int64)


def fit(
    names: list[str], rows: list[list[int]], y: np.ndarray, pairs: list[tuple[list[int], list[int]]],
    ridge: float = 1e-3, fairness: float = 10.0, steps: int = 300,
) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of features, classes weighted alike, with the swap penalty (Adam)."""
    n, k = len(rows), len(names)
    at, index = _flat(rows, k)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    left_at, left = _flat([a for a, _ in pairs], k)
    right_at, right = _flat([b for _, b in pairs], k)
    w, bias = np.zeros(k), 0.0
    m, v = np.zeros(k + 1), np.zeros(k + 1)

    def scores(where, what, size):
        return 1 / (1 + np.exp(-np.clip(np.bincount(where, w[what], minlength=size) + bias, -30, 30)))

    for step in range(1, steps + 1):
        error = share * (scores(at, index, n) - y)
        grad = np.append(np.bincount(index, error[at], minlength=k) + ridge * w, error.sum())
        if pairs:
            a, b = scores(left_at, left, len(pairs)), scores(right_at, right, len(pairs))
            pull = 2 * fairness * (a - b) / len(pairs)
            down_a, down_b = pull * a * (1 - a), pull * b * (1 - b)
            grad[:k] += np.bincount(left, down_a[left_at], minlength=k) - np.bincount(right, down_b[right_at], minlength=k)
            grad[k] += (down_a - down_b).sum()
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w -= move[:k]
        bias -= move[k]
    return w, float(bias)


def train(
    docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, label: str = "toxic",
    per_class: int = PER_CLASS, limit: int = FEATURES, terms: tuple[str, ...] = GROUP_TERMS,
) -> Model:
    rows = sample(docs, labels, label, folds, held_out, per_class)
    names, ones, zeros = choose_features(rows, limit)
    if not names:
        share = ones / (ones + zeros) if ones + zeros else 0.0
        return Model([], np.zeros(0), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    place = rows.sparkSession.sparkContext.broadcast({name: i for i, name in enumerate(names)})

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = place.value
        for batch in batches:
            xs, ys, lefts, rights = [], [], [], []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                xs.append(sorted(known[f] for f in features(text) & known.keys()))
                ys.append(y)
                pairs = sentences_with_groups(text, terms)
                lefts.append([sorted(known[f] for f in features(a) & known.keys()) for a, _ in pairs])
                rights.append([sorted(known[f] for f in features(b) & known.keys()) for _, b in pairs])
            many = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(xs, pa.list_(pa.int32())), pa.array(ys, pa.int32()), pa.array(lefts, many), pa.array(rights, many)],
                names=["x", "y", "l", "r"],
            )

    got = rows.mapInArrow(index, "x array<int>, y int, l array<array<int>>, r array<array<int>>").toArrow()
    x, y = got["x"].to_pylist(), np.array(got["y"].to_pylist(), dtype=np.float64)
    pairs = [p for l, r in zip(got["l"].to_pylist(), got["r"].to_pylist()) for p in zip(l, r)]
    return Model(names, *fit(names, x, y, pairs))


def score_column(model: Model, text: Column) -> Column:
    shared = model

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([shared.score(t.as_py()) for t in texts], pa.float64())

    return run(F.coalesce(text, F.lit("")))
