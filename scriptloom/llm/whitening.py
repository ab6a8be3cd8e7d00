"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The fit list X holds each different integer vector once, centred. From a start direction v the
alternating products u = Xv and v = X'u, each made orthogonal to all earlier ones, turn X into a small
bidiagonal matrix B (X V = U B). The SVD of B gives the singular values of X, hence the deviations, and
V times its right vectors gives the components.

The long vectors u stay with the rows: u = Xw for a short w, so a row's entry is its product with w
and is neither stored nor collected. One job per step gives all sums that the step needs: the products of
the new Xw with every earlier u, its own length, and X'(Xw). What the first of these takes off is
taken off w; if that was not small, the step is run again with the new w. Jobs send the driver a few
rows of ``dimension`` numbers, whatever the size of the table.

The steps end when the components that are asked for have settled and what is left of X outside V
cannot hold a larger one, at the latest after ``dimension`` steps. A direction that ends early (repeated
eigenvalues, dependent columns) goes on from a new one orthogonal to V.

Sums over the fit list are integers of any size. Entries are centred as integers before they become
doubles, so a large common offset costs no digits.

Defined results: vectors that are null, hold null or non-finite entries or entries that pass 2^62 once
scaled, or have another length than most are dropped; repeated rows and null ids stay rows; components
without deviation (fewer different vectors than dimensions, constant columns) are left out, so one
different vector alone gives no components; a deviation that passes 64 bits is null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptloom.session import counted_stage, stage_table

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 4096
GATHER = 8  # partial sums that reach the driver
LARGEST = float(1 << 62)
SETTLED = 1e-13  # error of a component that ends the steps
WHITENED = (
    "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
)


@dataclass(frozen=True)
class Fit:
    """Integer mean and rest: sums = n * floor + rest. ``components`` are columns."""

    n: int
    floor: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float


# --- bidiagonalisation ------------------------------------------------------------------------

Products = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float, np.ndarray]]


def without(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``x`` made orthogonal to the columns of ``basis``; twice, so that rounding leaves nothing."""
    for _ in range(2):
        x = x - basis @ (basis.T @ x)
    return x


def settled(left: np.ndarray, values: np.ndarray, beta: float, rest: float, wanted: int) -> bool:
    """Whether the first ``wanted`` triplets stand and nothing outside can come before them."""
    if len(values) < wanted + 1 or values[0] <= 0:
        return False
    squares = values**2
    error = beta * np.abs(left[-1, :wanted]) * values[:wanted]
    gap = np.minimum.reduce(
        [squares[:wanted] - squares[1 : wanted + 1], np.append(np.inf, -np.diff(squares[:wanted]))]
    )
    return bool(rest < squares[wanted - 1] / 2 and (error <= SETTLED * np.maximum(gap, 0)).all())


def bidiagonal(
    products: Products, dimension: int, total: float, rows: int, wanted: int, seed: int = 13
) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (columns) and singular values, largest first.

    ``products(W, w)``: the products of Xw with each column of XW, with itself, and X'Xw. ``total`` is
    the sum of all squares of X.
    """
    random = np.random.default_rng(seed)
    small = 8 * np.finfo(float).eps * max(rows, dimension) ** 0.5 * dimension * total**0.5
    v = np.zeros((dimension, 0))
    w_all, g_all = np.zeros((dimension, 0)), np.zeros((dimension, 0))
    b = np.zeros((dimension, dimension))
    place = []  # the row of B that step j's u stands for, or None
    direction, beta = None, 0.0
    for step in range(dimension):
        if direction is None:
            direction = without(random.standard_normal(dimension), v)
            beta = 0.0
        direction = direction / np.linalg.norm(direction)
        v = np.column_stack((v, direction))
        w = direction.copy()
        if beta:
            w -= beta * w_all[:, -1]
            b[place[-1], step] = beta
        for _ in range(4):
            shared, square, back = products(w_all, w)
            w = w - w_all @ shared
            back = back - g_all @ shared
            square -= float(shared @ shared)
            if np.linalg.norm(shared) <= 1e-9 * max(square, 0) ** 0.5 or square <= small**2:
                break
        if square <= small**2:  # Xv lies in the span of the earlier u
            place.append(None)
            direction = None
            continue
        alpha = square**0.5
        place.append(w_all.shape[1])
        b[place[-1], step] = alpha
        w_all, g_all = np.column_stack((w_all, w / alpha)), np.column_stack((g_all, back / alpha))
        direction = without(g_all[:, -1] - alpha * direction, v)
        beta = float(np.linalg.norm(direction))
        if beta <= small:
            direction = None
        used = b[: w_all.shape[1], : step + 1]
        if step + 1 < dimension and step >= wanted:
            left, values, _ = np.linalg.svd(used, full_matrices=False)
            rest = max(0.0, total - float((used**2).sum()))
            if settled(left, values, beta if direction is not None else 0.0, rest, wanted):
                break
    used = b[: max(1, w_all.shape[1]), : v.shape[1]]
    _, values, right = np.linalg.svd(used, full_matrices=False)
    keep = values > small
    return v @ right[keep].T, values[keep]


# --- distributed sums -------------------------------------------------------------------------


def summed(blocks: DataFrame, run: Callable[[np.ndarray], np.ndarray], size: int, dimension: int) -> np.ndarray:
    """The sum over all blocks (rows by dimension) of a vector of ``size`` numbers."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for raw in batch.column(0):
                total += run(np.frombuffer(raw.as_py(), dtype="<f8").reshape(-1, dimension))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for raw in batch.column(0):
                total += np.frombuffer(raw.as_py(), dtype="<f8")
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    parts = blocks.mapInArrow(partial, "sums binary").repartition(GATHER).mapInArrow(gather, "sums binary")
    return np.sum([np.frombuffer(r["sums"], dtype="<f8") for r in parts.collect()] or [np.zeros(size)], axis=0)


def products_of(blocks: DataFrame, dimension: int) -> Products:
    def products(earlier: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        count = earlier.shape[1]
        both = np.column_stack((earlier, w))

        def run(z: np.ndarray) -> np.ndarray:
            u = z @ both
            new = u[:, -1]
            return np.concatenate((new @ u, new @ z))

        sums = summed(blocks, run, count + 1 + dimension, dimension)
        return sums[:count], float(sums[count]), sums[count + 1 :]

    return products


def exact_sums(rows: DataFrame, dimension: int) -> list[int]:
    """Sums of each component of integer vectors, of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dimension
        for batch in batches:
            x = integers(batch.column(0), dimension)
            safe = len(x) * int(max(abs(int(x.min(initial=0))), int(x.max(initial=0)))) < 1 << 62
            sums = x.sum(axis=0) if safe else x.astype(object).sum(axis=0)
            total = [t + int(s) for t, s in zip(total, sums)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dimension), pa.int32()), pa.array(total, pa.decimal128(38, 0))], names=["i", "x"]
        )

    sums = rows.select("x").mapInArrow(run, "i int, x decimal(38,0)").groupBy("i").agg(F.sum("x").alias("x"))
    found = {r["i"]: int(r["x"]) for r in sums.collect()}  # one row per dimension
    return [found.get(i, 0) for i in range(dimension)]


# --- the operator -----------------------------------------------------------------------------


def integers(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimension)


def usable_rows(vectors: DataFrame, id_column: str, vector_column: str, scale: int, offset: int):
    """(vec_id, x) with integer vectors, written once; their number and the dimension."""
    v = F.transform(vectors[vector_column].cast("array<double>"), lambda c: c * float(scale))
    rows = vectors.select(vectors[id_column].cast("long").alias("vec_id"), v.alias("v"))
    fits = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = rows.where(F.col("v").isNotNull() & fits)
    dimension = rows.agg(F.mode(F.size("v"), deterministic=True)).first()[0] or 0
    x = F.transform("v", lambda c: F.floor(c).cast("long") + F.lit(offset).cast("long"))
    return counted_stage(rows.where(F.size("v") == dimension).select("vec_id", x.alias("x")))[0], dimension


def centred_blocks(distinct: DataFrame, dimension: int, n: int, floor: np.ndarray, rest: np.ndarray) -> DataFrame:
    """Blocks of centred rows as doubles, each entry off by half a unit in the last place at most."""
    share = np.array([int(r) / n for r in rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), BLOCK_ROWS):
                z = (integers(batch.column(0).slice(start, BLOCK_ROWS), dimension) - floor) - share
                yield pa.RecordBatch.from_arrays([pa.array([z.tobytes()], pa.binary())], names=["z"])

    return stage_table(distinct.select("x").mapInArrow(run, "z binary"))


def fit(rows: DataFrame, dimension: int, components: int = COMPONENTS) -> Fit | None:
    """Components of the different vectors of ``rows`` (x); None without any."""
    distinct, counts = counted_stage(rows.select("x").distinct())
    n = counts["rows"]
    if not n:
        return None
    sums = exact_sums(distinct, dimension)
    floor = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.int64)
    blocks = centred_blocks(distinct, dimension, n, floor, rest)
    total = float(summed(blocks, lambda z: np.array([np.einsum("ij,ij->", z, z)]), 1, dimension)[0])
    wanted = min(components, dimension)
    if not total:
        return Fit(n, floor, rest, np.zeros((dimension, 0)), np.zeros(0), 0.0, 0.0)
    axes, values = bidiagonal(products_of(blocks, dimension), dimension, total, n, wanted)
    axes, variances = axes[:, :wanted], values[:wanted] ** 2 / n
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    kept = axes.shape[1]
    scaled = axes / np.sqrt(variances)

    def moments(z: np.ndarray) -> np.ndarray:
        y = z @ scaled
        return np.concatenate(((y.T @ y).ravel(), y.sum(axis=0)))

    found = summed(blocks, moments, kept * kept + kept, dimension) / n
    means = found[kept * kept :]
    covariance = found[: kept * kept].reshape(kept, kept) - np.outer(means, means)
    error = float(np.abs(covariance - np.eye(kept)).max(initial=0))
    return Fit(n, floor, rest, axes, variances, total / n, error)


def deviations(x: np.ndarray, fitted: Fit) -> list[int | None]:
    """Per row the exact sum of (n * x - S)^2; None if it passes 64 bits."""
    apart = x - fitted.floor
    widest = (int(np.abs(apart).max(initial=0)) + 1) * fitted.n
    if widest * widest * max(1, x.shape[1]) < 1 << 62:
        return (((apart * fitted.n) - fitted.rest) ** 2).sum(axis=1).tolist()
    exact = ((apart.astype(object) * fitted.n - fitted.rest.astype(object)) ** 2).sum(axis=1)
    return [int(s) if s < 1 << 63 else None for s in exact]


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE,
    offset: int = OFFSET, components: int = COMPONENTS,
) -> DataFrame:
    """Per row: vec_id, n, deviation, whitened and explained (one entry per component), identity_error."""
    spark = vectors.sparkSession
    rows, dimension = usable_rows(vectors, id_column, vector_column, scale, offset)
    fitted = fit(rows, dimension, components) if dimension else None
    if fitted is None:
        return spark.createDataFrame([], WHITENED)
    shared = spark.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        scaled = known.components / np.sqrt(known.variances)
        share = np.array([int(r) / known.n for r in known.rest])
        explained = (known.variances / known.trace if known.trace else known.variances).tolist()
        lists = pa.list_(pa.float64())
        for batch in batches:
            x = integers(batch.column(1), dimension)
            y = ((x - known.floor) - share) @ scaled
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([known.n] * len(x), pa.int64()),
                    pa.array(deviations(x, known), pa.int64()),
                    pa.array(y.tolist(), lists),
                    pa.array([explained] * len(x), lists),
                    pa.array([known.identity_error] * len(x), pa.float64()),
                ],
                names=[part.split()[0] for part in WHITENED.split(", ")],
            )

    return rows.select("vec_id", "x").mapInArrow(run, WHITENED)
