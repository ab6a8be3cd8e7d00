"""Hard negatives by Four-Russians scoring: table look-ups in place of multiplications.

An anchor's components are cut into groups of eight. For each group a table holds the sums of all
256 subsets of its components. The vectors it is scored against are kept as bit planes: for each bit
of their two's complement integers and each group of eight components one byte. That byte picks
the subset sum of the components which have this bit, so from the highest plane down

    score = 2 * score + sum over groups of table[group][byte]      (the sign plane counts negative)

is the exact integer inner product, without a product taken.

Vectors are packed once into blocks of planes in a stage table. Anchors are taken in waves of at most
``WAVE_BYTES``; a wave is broadcast and meets every block where it lies, so no vector is shuffled
for an anchor. Two passes score each pair of an anchor and a vector once at most: rows of the anchor's label
give its positives, then rows of other labels are scored against the window of each positive. A
task keeps the best few of each anchor while it goes through its blocks.

Defined results: null ids, null labels, null vectors, vectors with null or non-finite components or
components that pass 2^53 once scaled, and vectors of another length than most take no part; ids
that occur in several rows count once, with the row of the highest label, then vector; equal scores
go to the smaller id; an anchor without positives, or a positive without negatives, gives no rows; a
score that passes 64 bits is compared exactly and returned as null. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptloom.llm.vectors import matrix
from scriptloom.session import checkpoint_dir, counted_stage, stage_table

SCALE = 256
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
LOW_PERCENT = 80  # a negative's score is at least so many hundredths of the positive's
BLOCK_ROWS = 2048
TABLE_ANCHORS = 128  # anchors of one table
TABLES_HELD = 8
WAVE_BYTES = 32 << 20
LARGEST = float(1 << 53)
SCORE = pa.decimal128(38, 0)
BLOCK = "n int, planes int, ids binary, labels binary, bits binary"
FOUND = "anchor_id long, positive_id long, positive_score decimal(38,0), vec_id long, score decimal(38,0)"
RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


# --- scoring ----------------------------------------------------------------------------------


def bit_planes(ints: np.ndarray) -> np.ndarray:
    """Bytes [plane, group, row] of two's complement integers, the highest (sign) plane first."""
    most = max(int(ints.max(initial=0)), -1 - int(ints.min(initial=-1)))
    count = most.bit_length() + 1
    return np.stack(
        [np.packbits((ints >> b & 1).astype(np.uint8), axis=1).T for b in range(count - 1, -1, -1)]
    )


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Sums [group, byte, anchor] of the components that the bits of a byte choose."""
    n, dimension = anchors.shape
    groups = -(-dimension // 8)
    padded = np.zeros((n, groups * 8), dtype=anchors.dtype)
    padded[:, :dimension] = anchors
    parts = padded.T.reshape(groups, 8, n)
    sums = np.zeros((groups, 256, n), dtype=anchors.dtype)
    for bit in range(8):  # the byte's lowest bit stands for the last component
        sums[:, 1 << bit : 2 << bit] = sums[:, : 1 << bit] + parts[:, None, 7 - bit]
    return sums


def number_kind(longest: int, planes: int) -> type:
    """The narrowest integers that hold all sums of anchors whose components' sizes sum to ``longest``."""
    widest = longest << (planes + 1)
    return np.int32 if widest < 1 << 31 else np.int64 if widest < 1 << 63 else object


def scores(tables: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Exact inner products [row, anchor]."""
    planes, groups, n = bits.shape
    total = np.zeros((n, tables.shape[2]), dtype=tables.dtype)
    for plane in range(planes):
        total += total
        for group in range(groups):
            chosen = np.take(tables[group], bits[plane, group], axis=0)
            if plane:
                total += chosen
            else:
                total -= chosen
    return total


def first_of_groups(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores of each group, ties to the smaller id."""
    order = np.lexsort((ids, -score, group))
    sorted_group = group[order]
    start = np.concatenate(([True], sorted_group[1:] != sorted_group[:-1])) if len(order) else np.zeros(0, bool)
    at = np.arange(len(order))
    return order[at - np.maximum.accumulate(np.where(start, at, 0)) < k]


class Best:
    """The k best (score, id) of each group so far."""

    def __init__(self, k: int):
        self.k, self.parts, self.held, self.kept = k, [], 0, 0

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        at = first_of_groups(group, score, ids, self.k)
        if len(at):
            self.parts.append((group[at], score[at], ids[at]))
            self.held += len(at)
            if self.held > 2 * self.kept + 100_000:
                self.rows()

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        wide = any(p[1].dtype == object for p in self.parts)
        group, ids = (np.concatenate([p[i] for p in self.parts]) for i in (0, 2))
        score = np.concatenate([p[1].astype(object if wide else np.int64) for p in self.parts])
        at = first_of_groups(group, score, ids, self.k)
        self.parts = [(group[at], score[at], ids[at])]
        self.held = self.kept = len(at)
        return self.parts[0]


def as_scores(values: np.ndarray) -> pa.Array:
    if values.dtype == object:
        return pa.array([Decimal(int(v)) for v in values], SCORE)
    return pa.array(values.astype(np.int64)).cast(SCORE)


# --- blocks -----------------------------------------------------------------------------------


def packed(ids: np.ndarray, labels: np.ndarray, ints: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((ids, labels))
    planes = bit_planes(ints[order])
    columns = (len(ids), len(planes), ids[order].tobytes(), labels[order].tobytes(), planes.tobytes())
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    names = [part.split()[0] for part in BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(columns, kinds)], names=names)


def pack_blocks(rows: DataFrame, dimension: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                ids, labels = (part.column(i).to_numpy() for i in range(2))
                yield packed(ids, labels, matrix(part.column(2), dimension).astype(np.int64))

    return stage_table(rows.select("vec_id", "label", "v").mapInArrow(run, BLOCK))


@dataclass(frozen=True)
class Block:
    ids: np.ndarray
    labels: np.ndarray
    bits: np.ndarray


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for n, planes, ids, labels, bits in zip(*(batch.column(i) for i in range(5))):
            yield Block(
                np.frombuffer(ids.as_py(), dtype=np.int64),
                np.frombuffer(labels.as_py(), dtype=np.int64),
                np.frombuffer(bits.as_py(), dtype=np.uint8).reshape(planes.as_py(), -1, n.as_py()),
            )


@dataclass(frozen=True)
class Wave:
    """Anchors of one wave; those of one label lie together."""

    ids: np.ndarray
    labels: np.ndarray
    ints: np.ndarray

    def parts(self) -> Iterator[slice]:
        for start in range(0, len(self.ids), TABLE_ANCHORS):
            yield slice(start, start + TABLE_ANCHORS)


class Tables:
    """Tables of the anchors in use: a few parts at a time, rebuilt where a block needs wider numbers."""

    def __init__(self, wave: Wave):
        self.wave = wave
        self.longest = {
            part.start: max(sum(abs(x) for x in row) for row in wave.ints[part].tolist()) for part in wave.parts()
        }
        self.built: dict[int, tuple[type, np.ndarray]] = {}

    def of(self, part: slice, planes: int) -> np.ndarray:
        kind = number_kind(self.longest[part.start], planes)
        held = self.built.get(part.start)
        if held is None or held[0] is not kind:
            if len(self.built) >= TABLES_HELD:
                self.built.clear()
            held = self.built[part.start] = (kind, subset_sums(self.wave.ints[part].astype(kind)))
        return held[1]


def find_positives(wave: Wave, batches: Iterator[pa.RecordBatch], k: int) -> Best:
    """The best rows of each anchor's own label, its own row left out."""
    best, tables = Best(k), Tables(wave)
    for block in blocks_of(batches):
        for part in wave.parts():
            labels = wave.labels[part]
            low = np.searchsorted(block.labels, labels.min(), "left")
            high = np.searchsorted(block.labels, labels.max(), "right")
            if low == high:
                continue
            found = scores(tables.of(part, len(block.bits)), block.bits[:, :, low:high])
            may = block.labels[low:high, None] == labels[None, :]
            may &= block.ids[low:high, None] != wave.ids[part][None, :]
            row, anchor = np.nonzero(may)
            best.add(anchor + part.start, found[row, anchor], block.ids[low:high][row])
    return best


def find_negatives(
    wave: Wave, slots: tuple[np.ndarray, np.ndarray, np.ndarray], batches: Iterator[pa.RecordBatch], k: int
) -> Best:
    """The best rows of other labels in the window of each positive; groups are places in ``slots``.

    ``slots``: anchor, lowest and highest score of each positive, those of one anchor together.
    """
    best, tables = Best(k), Tables(wave)
    owner, low, high = slots
    for block in blocks_of(batches):
        for part in wave.parts():
            mine = np.arange(*np.searchsorted(owner, (part.start, part.stop)))
            if not len(mine):
                continue
            found = scores(tables.of(part, len(block.bits)), block.bits)
            other = block.labels[:, None] != wave.labels[part][None, :]
            for slot in mine:
                column = owner[slot] - part.start
                score = found[:, column]
                at = np.flatnonzero((score >= low[slot]) & (score <= high[slot]) & other[:, column])
                if len(at):
                    at = at[np.lexsort((block.ids[at], -score[at]))[:k]]
                    best.add(np.full(len(at), slot), score[at], block.ids[at])
    return best


# --- the operator -----------------------------------------------------------------------------


def usable_rows(vectors: DataFrame, label: Column, id_column: str, vector_column: str, scale: int):
    """(vec_id, label, v) with integer components as doubles, one row for each id; the dimension."""
    v = F.transform(vectors[vector_column].cast("array<double>"), lambda x: x * float(scale))
    rows = vectors.select(
        vectors[id_column].cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("v")
    )
    fits = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & fits)
    dimension = rows.agg(F.mode(F.size("v"), deterministic=True)).first()[0] or 0
    once = rows.where(F.size("v") == dimension).groupBy("vec_id").agg(F.max(F.struct("label", "v")).alias("row"))
    floors = F.transform("row.v", lambda x: F.floor(x).cast("double"))
    return once.select("vec_id", F.col("row.label").alias("label"), floors.alias("v")), dimension


def wave_of(rows: DataFrame, dimension: int) -> Wave:
    """The rows of one wave (bounded by ``WAVE_BYTES`` and the evenness of the hash) on the driver."""
    table = rows.select("vec_id", "label", "v").orderBy("label", "vec_id").toArrow()
    ids, labels = (table.column(i).to_numpy() for i in range(2))
    return Wave(ids, labels, matrix(table.column(2), dimension).astype(np.int64))


def ranked(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, label: Column | None = None, id_column: str = "vec_id", vector_column: str = "embedding",
    scale: int = SCALE, every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT, wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``label`` is a column of ``vectors`` (default: the one of that name). Anchors are the rows whose id
    is divisible by ``every``.
    """
    spark = vectors.sparkSession
    rows, dimension = usable_rows(
        vectors, vectors["label"] if label is None else label, id_column, vector_column, scale
    )
    if not dimension:
        return spark.createDataFrame([], RESULT)
    is_anchor = F.col("vec_id") % every == 0
    rows, counts = counted_stage(rows, anchors=F.count_if(is_anchor))
    blocks = pack_blocks(rows, dimension)
    waves = -(-counts["anchors"] * dimension * 8 // wave_bytes)
    folder = f"{checkpoint_dir(spark)}/negatives-{uuid.uuid4().hex}"
    result = spark.createDataFrame([], RESULT)
    for number in range(waves):
        mine = rows.where(is_anchor & (F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == number))
        wave_result(blocks, wave_of(mine, dimension), positives, negatives, low_percent).write.mode(
            "append"
        ).parquet(folder)
        result = spark.read.schema(RESULT).parquet(folder)
    return result


def wave_result(blocks: DataFrame, wave: Wave, positives: int, negatives: int, low_percent: int) -> DataFrame:
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(wave)
    names = [part.split()[0] for part in FOUND.split(", ")]

    def emit(best: Best, describe: Callable) -> pa.RecordBatch:
        group, score, ids = best.rows()
        return pa.RecordBatch.from_arrays([*describe(group), pa.array(ids), as_scores(score)], names=names)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = find_positives(shared.value, batches, positives)
        nothing = lambda group, kind: pa.nulls(len(group), kind)
        yield emit(best, lambda g: (pa.array(shared.value.ids[g]), nothing(g, pa.int64()), nothing(g, SCORE)))

    chosen = ranked(blocks.mapInArrow(first_pass, FOUND), positives).select("anchor_id", "vec_id", "score").toArrow()
    # positives * anchors of the wave at most
    place = {int(a): i for i, a in enumerate(wave.ids)}
    listed = sorted(
        (place[a], -int(s), p) for a, p, s in zip(*(chosen.column(i).to_pylist() for i in range(3)))
    )
    owner = np.array([x[0] for x in listed], dtype=np.int64)
    score = np.array([-x[1] for x in listed], dtype=object)
    if all(abs(s) < 1 << 62 for s in score):
        score = score.astype(np.int64)
    low = np.array([-(-low_percent * int(s) // 100) for s in score], dtype=score.dtype)
    ids = np.array([x[2] for x in listed], dtype=np.int64)
    slots = spark.sparkContext.broadcast((owner, low, score, ids))

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, low, high, ids = slots.value
        best = find_negatives(shared.value, (owner, low, high), batches, negatives)
        yield emit(
            best, lambda g: (pa.array(shared.value.ids[owner[g]]), pa.array(ids[g]), as_scores(high[g]))
        )

    return ranked(blocks.mapInArrow(second_pass, FOUND), negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.expr("try_cast(positive_score AS bigint)").alias("positive_score"),
        F.expr("try_cast(score AS bigint)").alias("negative_score"),
    )
