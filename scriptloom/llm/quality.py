"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text's terms are the shapes of its words (letters, capitals and digits run together, other signs
as they are), pairs of shapes, and bands of whole-text measures such as the share of different
words. Terms are hashed to ``TERMS`` columns, damped by their logarithm and weighted by rarity; a
truncated singular value decomposition of the labelled documents gives ``DIMS`` latent directions.
The labelled vectors (at most 2 * ``PER_CLASS``, so of a fixed size) are broadcast, the exact cosines
of every document with all of them are computed block by block, and the ``NEIGHBOURS`` nearest vote
with weights that grow with their similarity. The two classes may be sampled unevenly; votes are
weighted back to equal classes.

Defined results: null and empty texts have a vector like any other text (that of the measures);
repeated rows get equal scores; with labels of one class only the score is that label, without any
labels 0. Neither labels, lang, source nor doc_id are inputs of a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptloom.llm.labelled import sample

PER_CLASS = 3000
TERMS = 1024
DIMS = 48
NEIGHBOURS = 25
SHARPNESS = 12.0
THRESHOLD = 0.7
BLOCK = 256

SMALL = re.compile(r"[^\W\d_A-Z]+")
CAPITAL = re.compile(r"[A-Z]+")
DIGIT = re.compile(r"\d+")
LETTERS = re.compile(r"[^\W\d_]+")
_column: dict[str, int] = {}


def column(term: str) -> int:
    known = _column.get(term)
    if known is None:
        if len(_column) > 200_000:
            _column.clear()
        known = _column[term] = zlib.crc32(term.encode()) % TERMS
    return known


def band(name: str, value: float, steps: int) -> list[str]:
    """Terms for all steps that a value from 0 to 1 has climbed, so near values share terms."""
    return [f"{name}>{i}" for i in range(int(min(max(value, 0.0), 1.0) * steps) + 1)]


def measures(text: str, words: list[str]) -> list[str]:
    n, chars = max(1, len(words)), max(1, len(text))
    lines = [line for line in text.split("\n") if line.strip()]
    top = Counter(words).most_common(1)[0][1] if words else 0
    pairs = set(zip(words, words[1:]))
    return (
        band("different", len(set(words)) / n * min(1.0, math.sqrt(n) / 10), 10)
        + band("pairs", len(pairs) / max(1, n - 1), 10)
        + band("top", top / n, 10)
        + band("lines", len(set(lines)) / max(1, len(lines)), 10)
        + band("letters", sum(map(len, LETTERS.findall(text))) / chars, 10)
        + band("long", math.log10(1 + n) / 5, 10)
        + band("wide", sum(map(len, words)) / n / 20, 10)
        + band("stops", (text.count(". ") + text.count(".\n")) * 5 / n, 5)
    )


def vector(text: str | None) -> np.ndarray:
    """Damped term counts of a whole text, of length 1 (before rarity weights)."""
    text = text or ""
    words = text.split()
    shape = DIGIT.sub("0", CAPITAL.sub("A", SMALL.sub("a", text))).split()
    counts = Counter(s[:12] for s in shape)
    counts.update(f"{a[:6]} {b[:6]}" for a, b in zip(shape, shape[1:]))
    out = np.zeros(TERMS)
    n = max(1, len(shape))
    for term, count in counts.items():
        out[column(term)] += math.log1p(100 * count / n)
    own = np.zeros(TERMS)
    for term in measures(text, words):
        own[column("=" + term)] += 1.0
    # shapes and measures count alike
    return out / max(1e-9, np.linalg.norm(out)) + own / max(1e-9, np.linalg.norm(own))


class Model:
    """Rarity weights, latent directions, and the labelled vectors with their votes."""

    def __init__(self, rarity: np.ndarray, basis: np.ndarray, known: np.ndarray, votes: np.ndarray, prior: float):
        self.rarity, self.basis, self.known, self.votes, self.prior = rarity, basis, known, votes, prior

    def latent(self, vectors: np.ndarray) -> np.ndarray:
        flat = (vectors * self.rarity) @ self.basis
        return (flat / np.maximum(1e-9, np.linalg.norm(flat, axis=1, keepdims=True))).astype(np.float32)

    def score(self, vectors: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(vectors), self.prior)
        cosines = self.latent(vectors) @ self.known.T
        k = min(NEIGHBOURS, len(self.known))
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        similar = np.take_along_axis(cosines, nearest, axis=1).astype(np.float64)
        weight = np.exp(SHARPNESS * (similar - similar.max(axis=1, keepdims=True)))
        votes = self.votes[nearest]
        weight = weight * votes[:, :, 1]
        return (weight * votes[:, :, 0]).sum(axis=1) / weight.sum(axis=1)


def train(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, label: str = "quality",
    per_class: int = PER_CLASS,
) -> Model:
    rows = sample(docs, labels, label, folds, held_out, per_class)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [vector(t).astype("<f4").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1)], names=["v", "y"])

    got = rows.mapInArrow(vectors, "v binary, y int").toArrow()
    y = np.array(got["y"].to_pylist(), dtype=np.float64)
    if not len(y) or y.min() == y.max():
        nothing = np.zeros((0, DIMS), dtype=np.float32)
        return Model(np.ones(TERMS), np.zeros((TERMS, DIMS)), nothing, np.zeros((0, 2)), float(y[0]) if len(y) else 0.0)
    x = np.frombuffer(b"".join(got["v"].to_pylist()), dtype="<f4").reshape(-1, TERMS).astype(np.float64)
    rarity = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 0.3
    weighted = x * rarity
    _, directions = np.linalg.eigh(weighted.T @ weighted)
    basis = directions[:, ::-1][:, :DIMS].copy()
    model = Model(rarity, basis, np.zeros((0, DIMS)), np.zeros((0, 2)), 0.0)
    model.known = model.latent(x)
    each = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * len(y)
    model.votes = np.stack((y, each), axis=1)
    return model


def score_column(spark, model: Model, text: Column) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for start in range(0, len(texts), BLOCK):
            out.append(shared.value.score(np.stack([vector(t.as_py()) for t in texts.slice(start, BLOCK)])))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return run(F.coalesce(text, F.lit("")))
