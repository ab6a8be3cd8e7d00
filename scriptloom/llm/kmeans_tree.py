"""Approximate nearest neighbours by inner product with a hierarchical k-means tree.

The tree is grown on a bounded sample (``SAMPLE`` vectors chosen by a hash of their id): nodes are
split by k-means into ``BRANCH`` children until they hold ``LEAF_SAMPLE`` sampled vectors. Every
vector of the table is put into the leaf it reaches. A query goes down best-bin-first: a priority
queue holds the open nodes by the inner product with their centre, the best one is opened next,
and leaves are visited in the order they come out.

How many leaves are visited is calibrated: ``CALIBRATION`` queries are compared with every row, and
the visits are widened until these leaves hold ``RECALL`` of their true neighbours. In the worst case
that is all leaves, and the search is exact. A query whose leaves hold too few different ids for k
neighbours goes on to the next ones.

A leaf is dealt in chunks of twice the mean leaf (65,536 rows at most) by a hash of the id, so that
a leaf of many equal vectors is no single task. A chunk's vectors come first and its queries
stream by, so a task holds one chunk and one batch. Scores are exact inner products in doubles.

Defined results: null ids, vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part; equal scores go to the smaller id; an id that occurs in several
rows counts once, with its best score, and is never its own neighbour; no usable vectors: no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptloom.llm.vectors import QUERY_EVERY, best_per_query, first_best, is_query, matrix, usable
from scriptloom.session import stage_table

SAMPLE = 20_000
BRANCH = 8
LEAF_SAMPLE = 96
CALIBRATION = 256
RECALL = 0.96
CHUNK_MOST = 65_536
CHUNK_LEAST = 256
SHAPE = "query_id long, vec_id long, score double"


def k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centres and each point's centre; fewer centres if points repeat."""
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        near = np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)
        used = np.unique(near)
        centres = np.stack([points[near == c].mean(axis=0) for c in used])
    near = np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)
    return centres, near


class Tree:
    """``children[n]`` are the nodes below n (none: a leaf), ``leaf[n]`` its number."""

    def __init__(self, points: np.ndarray, branch: int = BRANCH, leaf_sample: int = LEAF_SAMPLE):
        rng = np.random.default_rng(11)
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = [[]]
        self.leaf: list[int] = [-1]
        self.leaves = 0
        self._below: dict[int, np.ndarray] = {}
        open_nodes = [(0, points)]
        while open_nodes:
            node, inside = open_nodes.pop()
            parts = []
            if len(inside) > leaf_sample:
                centres, near = k_means(inside, branch, rng)
                parts = [(c, inside[near == i]) for i, c in enumerate(centres) if (near == i).any()]
            if len(parts) < 2:  # few vectors, or all alike
                self.leaf[node] = self.leaves
                self.leaves += 1
                continue
            self._below[node] = np.stack([c for c, _ in parts])
            for _, part in parts:
                self.children[node].append(len(self.children))
                open_nodes.append((len(self.children), part))
                self.children.append([])
                self.leaf.append(-1)

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down to the nearest centre."""
        out = np.zeros(len(vectors), dtype=np.int32)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node not in self._below:
                out[rows] = self.leaf[node]
                continue
            centres = self._below[node]
            near = np.argmin((centres**2).sum(axis=1) - 2 * vectors[rows] @ centres.T, axis=1)
            todo += [(child, rows[near == i]) for i, child in enumerate(self.children[node])]
        return out

    def visit(self, query: np.ndarray, most: int, ids: dict[int, int] | None = None, least: int = 0) -> list[int]:
        """The first ``most`` leaves, best bin first, and more until they hold ``least`` of ``ids`` (by leaf)."""
        queue, order, held = [(0.0, 0)], [], 0
        while queue and (len(order) < most or held < least):
            _, node = heapq.heappop(queue)
            if node not in self._below:
                order.append(self.leaf[node])
                held += ids.get(self.leaf[node], 0) if ids else 0
                continue
            for score, child in zip((self._below[node] @ query).tolist(), self.children[node]):
                heapq.heappush(queue, (-score, child))
        return order


def _placed(rows: DataFrame, tree, kind: str, dimension: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = matrix(batch.column(1), dimension)
            raw = found.astype(kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tree.value.place(found)), pa.array([r.tobytes() for r in raw], pa.binary())],
                names=["vec_id", "leaf", "raw"],
            )

    return rows.mapInArrow(run, "vec_id long, leaf int, raw binary")


def calibrated_visits(index: DataFrame, tree: Tree, kind: str, dimension: int, every: int, k: int, recall: float) -> int:
    """Leaves to visit so that ``recall`` of the true neighbours of some queries lie in them."""
    chosen = (
        index.where(is_query(every)).groupBy("vec_id").agg(F.min("raw").alias("raw"))
        .orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).collect()
    )
    if not chosen or tree.leaves < 2:
        return tree.leaves
    ids = np.array([r["vec_id"] for r in chosen])
    queries = np.stack([np.frombuffer(r["raw"], dtype=kind) for r in chosen]).astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            other = batch.column(0).to_numpy()
            leaf = batch.column(1).to_numpy()
            vectors = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=kind).reshape(-1, dimension)
            order = np.argsort(other, kind="stable")
            other, leaf, vectors = other[order], leaf[order], vectors[order]
            scores = queries @ vectors.astype(np.float64).T
            scores[ids[:, None] == other[None, :]] = -np.inf
            near = scores >= id_border(scores, id_starts(other), k)[:, None]
            near &= scores > -np.inf
            out = ([], [], [], [])
            for i in np.flatnonzero(near.any(axis=1)):
                at = np.flatnonzero(near[i])
                at = at[first_best(scores[i, at], other[at], k)]
                for column, values in zip(out, (np.full(len(at), i), other[at], scores[i, at], leaf[at])):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in out], names=["query_id", "vec_id", "score", "leaf"]
                )

    found = index.select("vec_id", "leaf", "raw").mapInArrow(run, SHAPE + ", leaf int").where("score > double('-inf')")
    leaf_of = found.groupBy("query_id", "vec_id").agg(F.max(F.struct("score", "leaf")).alias("s")).select(
        "query_id", "vec_id", "s.score", "s.leaf"
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    true = leaf_of.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "leaf").collect()
    ranks = []
    orders = [{leaf: i for i, leaf in enumerate(tree.visit(q, tree.leaves))} for q in queries]
    for row in true:  # k rows for each calibration query
        ranks.append(orders[row["query_id"]][row["leaf"]])
    if not ranks:
        return tree.leaves
    held = np.cumsum(np.bincount(ranks, minlength=tree.leaves)) / len(ranks)
    return int(np.argmax(held >= recall)) + 1


def id_starts(ids: np.ndarray) -> np.ndarray:
    """Where each id begins in sorted ids."""
    return np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))


def id_border(scores: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Per row the k-th best score of different ids; columns are sorted by id, ids begin at ``starts``."""
    best = scores if len(starts) == scores.shape[1] else np.maximum.reduceat(scores, starts, axis=1)
    n = min(k, len(starts))
    return -np.partition(-best, n - 1, axis=1)[:, n - 1]


def _search(kind: str, dimension: int, k: int):
    """Chunks in rows (leaf, chunk, is_query, id, raw), sorted: vectors first, then queries."""

    def answers(ids, starts, vectors, query_ids, queries) -> Iterator[pa.RecordBatch]:
        step = max(1, 4_000_000 // max(1, len(ids)))
        for start in range(0, len(queries), step):
            some, some_ids = queries[start : start + step], query_ids[start : start + step]
            scores = some @ vectors.T
            own = some_ids[:, None] == ids[None, :]
            scores[own] = -np.inf
            border = id_border(scores, starts, k)
            # Products of matrices may differ in the last bit between equal vectors: what comes
            # close to the border is computed again, row by row.
            near = scores >= (border - 1e-9 * (1 + np.abs(border)))[:, None]
            near &= ~own
            out = ([], [], [])
            for i in range(len(some)):
                at = np.flatnonzero(near[i])
                if not len(at):
                    continue
                exact = (vectors[at] * some[i]).sum(axis=1)
                best = first_best(exact, ids[at], k)
                out[0].append(np.full(len(best), some_ids[i]))
                out[1].append(ids[at[best]])
                out[2].append(exact[best])
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in out], names=["query_id", "vec_id", "score"]
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, raws, vectors = None, [], [], None
        for batch in batches:
            if not len(batch):
                continue
            leaf, chunk, asks, row_id = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            raw = batch.column(4).to_pylist()
            same = (leaf[1:] == leaf[:-1]) & (chunk[1:] == chunk[:-1]) & (asks[1:] == asks[:-1])
            starts = np.concatenate(([0], np.flatnonzero(~same) + 1))
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(batch)]):
                key = (int(leaf[start]), int(chunk[start]))
                if key != held:
                    held, ids, raws, vectors = key, [], [], None
                if not asks[start]:
                    ids.append(row_id[start:end])
                    raws += raw[start:end]
                    continue
                if not raws and vectors is None:
                    continue  # queries of a chunk that got no vectors
                if vectors is None:
                    vectors = np.frombuffer(b"".join(raws), dtype=kind).reshape(-1, dimension).astype(np.float64)
                    all_ids, raws = np.concatenate(ids), []
                    order = np.argsort(all_ids, kind="stable")
                    all_ids, vectors = all_ids[order], vectors[order]
                    starts_of_ids = id_starts(all_ids)
                queries = np.frombuffer(b"".join(raw[start:end]), dtype=kind).reshape(-1, dimension)
                yield from answers(all_ids, starts_of_ids, vectors, row_id[start:end], queries.astype(np.float64))

    return run


def nearest(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    every: int = QUERY_EVERY, k: int = 20, recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for every query row."""
    spark = vectors.sparkSession
    rows, kind, dimension = usable(vectors, id_column, vector_column, zero=False)
    if not dimension:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    tree = Tree(matrix(sample["v"], dimension))
    shared = spark.sparkContext.broadcast(tree)
    index = stage_table(_placed(rows, shared, kind, dimension))
    sizes = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}  # a row per leaf
    mean = sum(sizes.values()) / max(1, len(sizes))
    chunk_rows = int(min(CHUNK_MOST, max(CHUNK_LEAST, 2 * mean)))
    chunks = [-(-sizes.get(leaf, 0) // chunk_rows) for leaf in range(tree.leaves)]
    # an id that lies in several leaves counts in one of them
    placed = index.groupBy("vec_id").agg(F.min("leaf").alias("leaf"))
    ids_in = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
    visits = calibrated_visits(index, tree, kind, dimension, every, k, recall)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for start in range(0, len(batch), 64):
                out: tuple[list, ...] = ([], [], [], [])
                part = batch.slice(start, 64)
                for vec_id, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    # k others and the query's own id
                    for leaf in own.visit(np.frombuffer(raw, dtype=kind).astype(np.float64), visits, ids_in, k + 1):
                        for chunk in range(chunks[leaf]):
                            for column, value in zip(out, (leaf, chunk, vec_id, raw)):
                                column.append(value)
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, kinds)], names=["leaf", "chunk", "id", "raw"]
                )

    asked = (
        index.where(is_query(every)).select("vec_id", "raw")
        .mapInArrow(ask, "leaf int, chunk int, id long, raw binary")
        .select("leaf", "chunk", F.lit(True).alias("asks"), "id", "raw")
    )
    of_leaf = F.element_at(F.array(*map(F.lit, chunks)), F.col("leaf") + 1)
    held = index.select(
        "leaf", F.pmod(F.xxhash64("vec_id"), of_leaf).cast("int").alias("chunk"),
        F.lit(False).alias("asks"), F.col("vec_id").alias("id"), "raw",
    )
    found = (
        held.unionByName(asked)
        .repartition("leaf", "chunk")
        .sortWithinPartitions("leaf", "chunk", "asks")
        .mapInArrow(_search(kind, dimension, k), SHAPE)
    )
    return best_per_query(found, k)
