"""Exact top-k inner products over integer vectors.

Vectors are packed into blocks in descending order of length. Lengths and products are taken after
a rotation by the singular directions of all vectors, so that a few first coordinates hold most of
a product. For a block of queries and a block of vectors:

- the block is skipped if by Cauchy-Schwarz no query can reach its threshold: its length times the
  longest vector's length stays below;
- else products of the first coordinates are taken, and a pair is dropped if these plus the product
  of the lengths of what is left stay below the threshold;
- what remains is computed exactly in integers.

A query's threshold is its k-th best score in the block of the longest vectors. Every pair of blocks
is a row of its own, so the queries' work spreads over all tasks; a pair gives k rows per query at
most. Rotation and thresholds only decide what is computed, never a score.

Defined results: null ids, vectors that are null, of another length than most, or hold null or
non-finite components take no part; equal scores go to the smaller id; an id that occurs in several
rows counts once, with its best score, and is never its own neighbour; no usable vectors: no rows.
Vectors with a component that passes 2^53 once scaled take no part; a score that passes 64 bits is
compared exactly and returned as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptloom.llm.vectors import QUERY_EVERY, best_per_query, first_best, is_query, matrix, usable
from scriptloom.session import stage_table

SCALE = 64
BLOCK_ROWS = 4096
QUERY_ROWS = 512
FIRST = 24  # rotated coordinates that are multiplied before the bound is looked at
LARGEST = float(1 << 53)
SCORE = pa.decimal128(38, 0)
SLACK = 1e-6  # for rounding in the rotation, relative to the product of the lengths


def directions(rows: DataFrame, dimension: int) -> np.ndarray:
    """Singular directions of all integer vectors, strongest first, from their summed products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for batch in batches:
            x = matrix(batch.column(0), dimension)
            total += x.T @ x
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "x"]
        )

    sums = rows.select("v").mapInArrow(run, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    total = np.zeros((dimension, dimension))
    for row in sums.collect():  # dimension^2 rows at most
        total[row["i"], row["j"]] = row["x"]
    return np.linalg.eigh((total + total.T) / 2)[1][:, ::-1].copy()


def packed(ids: np.ndarray, vectors: np.ndarray) -> tuple[bytes, bytes, float]:
    longest = float(np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
    kind = "<i4" if np.abs(vectors).max(initial=0) < 1 << 31 else "<i8"
    return ids.astype("<i8").tobytes(), vectors.astype(kind).tobytes(), longest


def unpacked(ids: bytes, vectors: bytes, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, dtype="<i8")
    kind = "<i4" if len(vectors) == 4 * dimension * len(found) else "<i8"
    return found, np.frombuffer(vectors, dtype=kind).reshape(-1, dimension)


class Side:
    """One block as doubles, as rotated first coordinates, and the lengths of what is left."""

    def __init__(self, ids: bytes, vectors: bytes, rotation: np.ndarray):
        dimension = len(rotation)
        self.ids, self.ints = unpacked(ids, vectors, dimension)
        self.real = self.ints.astype(np.float64)
        first = min(FIRST, dimension)
        turned = self.real @ rotation
        self.first = turned[:, :first]
        self.left = np.sqrt((turned[:, first:] ** 2).sum(axis=1))
        self.length = np.sqrt((self.real**2).sum(axis=1))


def products(a: Side, b: Side) -> np.ndarray:
    """All inner products, exact: in doubles while sums stay below 2^53, else in integers."""
    most = a.length.max(initial=0) * b.length.max(initial=0)
    if most < 2**52:
        return np.rint(a.real @ b.real.T).astype(np.int64)
    kind = exact_kind(a, b)
    return a.ints.astype(kind) @ b.ints.astype(kind).T


def exact_kind(a: Side, b: Side) -> type:
    """64-bit integers where no sum on the way can pass them, else integers of any size."""
    most = a.length.max(initial=0) * b.length.max(initial=0) * max(1, a.ints.shape[1])
    return np.int64 if most < 2**62 else object


def as_scores(scores: np.ndarray) -> pa.Array:
    if scores.dtype == object:
        return pa.array([Decimal(int(s)) for s in scores], SCORE)
    return pa.array(scores.astype(np.int64)).cast(SCORE)


def block_best(queries: Side, others: Side, threshold: np.ndarray, k: int):
    """(places of queries, ids, scores) of the k best of each query that reach its threshold."""
    lengths = queries.length[:, None] * others.length[None, :]
    bound = queries.first @ others.first.T
    bound += queries.left[:, None] * others.left[None, :]
    bound += SLACK * (1 + lengths)
    may = (bound >= threshold[:, None]) & (queries.ids[:, None] != others.ids[None, :])
    share = may.mean() if may.size else 0
    whole = products(queries, others) if share > 0.05 else None
    kind = exact_kind(queries, others)
    out: tuple[list, list, list] = ([], [], [])
    for i in np.flatnonzero(may.any(axis=1)):
        at = np.flatnonzero(may[i])
        scores = whole[i, at] if whole is not None else others.ints[at].astype(kind) @ queries.ints[i].astype(kind)
        if len(at) > 4 * k:
            border = -np.partition(-scores, k - 1)[k - 1]
            # ids that occur more than once could fill the k places
            if len(np.unique(others.ids[at[scores >= border]])) >= k:
                at, scores = at[scores >= border], scores[scores >= border]
        best = first_best(scores, others.ids[at], k)
        out[0].append(np.full(len(best), i))
        out[1].append(others.ids[at[best]])
        out[2].append(scores[best])
    return tuple(np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in out)


def top_products(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    every: int = QUERY_EVERY, k: int = 20, scale: int = SCALE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query row."""
    spark = vectors.sparkSession
    rows, _, dimension = usable(vectors, id_column, vector_column, zero=True)
    if not dimension:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = rows.where(F.forall("v", lambda x: F.abs(x.cast("double") * scale) < LARGEST))
    ints = rows.select("vec_id", F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    rotation = directions(ints, dimension)
    count = ints.count()
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(-(-count // BLOCK_ROWS), 4 * slots))
    squared = F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, seq, held, part = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            row = packed(np.concatenate(ids), np.concatenate(found))
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.float64())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip((part, seq, *row), kinds)],
                names=["part", "seq", "ids", "vectors", "longest"],
            )

        for batch in batches:
            for start in range(0, len(batch), BLOCK_ROWS):
                some = batch.slice(start, BLOCK_ROWS)
                if ids and held + len(some) > BLOCK_ROWS:
                    yield close()
                    ids, found, held, seq = [], [], 0, seq + 1
                part = some.column(0)[0].as_py()
                ids.append(some.column(1).to_numpy())
                found.append(matrix(some.column(2), dimension).astype(np.int64))
                held += len(some)
        if ids:
            yield close()

    blocks = stage_table(
        ints.select("vec_id", "v", squared.alias("squared"))
        .repartitionByRange(parts, F.col("squared").desc(), "vec_id")
        .sortWithinPartitions(F.col("squared").desc(), "vec_id")
        .select(F.spark_partition_id().alias("part"), "vec_id", "v")
        .mapInArrow(pack, "part int, seq int, ids binary, vectors binary, longest double")
    )
    top = blocks.orderBy(F.col("longest").desc(), "part", "seq").limit(1).first()  # one block
    if top is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    last_part, last_seq = blocks.agg(F.max("part"), F.max("seq")).first()
    shared = spark.sparkContext.broadcast((rotation, top["ids"], top["vectors"]))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, top_ids, top_vectors = shared.value
        longest = Side(top_ids, top_vectors, turn)
        for batch in batches:
            for start in range(0, len(batch), QUERY_ROWS):
                some = batch.slice(start, QUERY_ROWS)
                ids, found, _ = packed(some.column(0).to_numpy(), matrix(some.column(1), dimension).astype(np.int64))
                queries = Side(ids, found, turn)
                threshold = np.full(len(queries.ids), -np.inf)
                open_to_all = np.full(len(queries.ids), -np.inf)
                of, _, scores = block_best(queries, longest, open_to_all, k)
                for i in range(len(queries.ids)):  # by row: a repeated query has results for each copy
                    own = scores[of == i]
                    if len(own) >= k:
                        threshold[i] = np.sort(own)[-k]
                # a block below this length reaches no query's threshold
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(queries.length > 0, threshold / queries.length, -np.inf)
                kinds = (pa.binary(), pa.binary(), pa.binary(), pa.float64())
                row = (ids, found, threshold.astype("<f8").tobytes(), float(need.min()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, kinds)], names=["q_ids", "q_vectors", "threshold", "need"]
                )

    asked = stage_table(
        ints.where(is_query(every)).mapInArrow(ask, "q_ids binary, q_vectors binary, threshold binary, need double")
    )
    # each block of queries against each block of vectors, met by the block's number
    spread = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(last_part)))).withColumn(
        "seq", F.explode(F.sequence(F.lit(0), F.lit(last_seq)))
    )
    pairs = spread.hint("shuffle_merge").join(blocks, ["part", "seq"]).where(
        F.col("longest") * (1 + SLACK) + SLACK >= F.col("need")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = shared.value[0]
        held, others = None, None
        for batch in batches:
            for i in range(len(batch)):
                part, seq, q_ids, q_vectors, threshold, ids, found = (batch.column(c)[i].as_py() for c in range(7))
                if held != (part, seq):
                    held, others = (part, seq), Side(ids, found, turn)
                queries = Side(q_ids, q_vectors, turn)
                at, *best = block_best(queries, others, np.frombuffer(threshold, dtype="<f8"), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries.ids[at]), pa.array(best[0]), as_scores(best[1])],
                    names=["query_id", "vec_id", "score"],
                )

    found = pairs.select("part", "seq", "q_ids", "q_vectors", "threshold", "ids", "vectors").mapInArrow(
        meet, "query_id long, vec_id long, score decimal(38,0)"
    )
    return best_per_query(found, k).withColumn("score", F.expr("try_cast(score AS bigint)"))
