"""Near-duplicates by SimHash: 64-bit fingerprints of word shingles, linked at few differing bits.

A fingerprint has eight bytes. If at most three bits differ, at most three bytes differ, so two
linked fingerprints share at least five bytes at their positions. The inverted index is built at
that guaranteed count: it has one list for each choice of five positions and their five bytes (56
entries per fingerprint), so whatever meets in a list shares five positional bytes or more, and
no pair below the count is ever formed. In a list the bits are verified; at most three bytes are
left open, so a list holds at most 2^24 fingerprints.

Copies collapse first: the index holds different fingerprints only. A list gives the star edges of
its own components, never its pairs, so what leaves it is linear in its length. Long lists are not
compared in pairs either: each of the 2324 ways to flip up to three of 24 bits is looked up in a
table of the list's members, which is linear too and finds the same links.

Defined results: null and empty texts have fingerprint zero and link like any other; repeated
doc_ids share nothing but their number; a null doc_id is smaller than none (a component of null
ids only has a null id). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptloom.llm.components import components
from scriptloom.session import stage_table

SEED = 42
SHINGLE = 3
BITS = 3  # fingerprints link at so many differing bits or fewer
FIVES = list(combinations(range(8), 5))
PAIRS_UP_TO = 1500  # longer lists are searched by flipped bits; the links are the same
LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))


def shingle_hashes(text: str | None, width: int, seed: int = SEED) -> np.ndarray:
    """The hashes of a text's word shingles in order; fewer words than ``width`` are one shingle."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return np.zeros(0, dtype="<u8")
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, seed) for s in shingles), dtype="<u8")


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles, repeats included."""
    hashes = shingle_hashes(text, width, seed)
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, width: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit integer."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint(t.as_py(), width) for t in texts), dtype=np.uint64, count=len(texts))
        return pa.array(found.view(np.int64))

    return run(F.coalesce(text, F.lit("")))


def _flips() -> np.ndarray:
    """All ways to flip one to BITS of 24 bits."""
    return np.array(
        [sum(1 << i for i in c) for k in range(1, BITS + 1) for c in combinations(range(24), k)],
        dtype=np.int64,
    )


def _join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of members a and b in place: labels fall to the smallest member that is reached."""
    while len(a):
        x, y = label[a], label[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def list_components(members: np.ndarray, open_bytes: tuple[int, int, int]) -> np.ndarray:
    """For each of a list's sorted, different fingerprints the index of its component's first one."""
    n = len(members)
    label = np.arange(n)
    if n <= PAIRS_UP_TO:
        for start in range(0, n, 256):
            apart = np.bitwise_count(members[start : start + 256, None] ^ members[None, :])
            a, b = np.nonzero(apart <= BITS)
            later = b > a + start
            _join_labels(label, a[later] + start, b[later])
        return label
    # the three bytes that the list leaves open, as one number of 24 bits
    rest = np.zeros(n, dtype=np.int64)
    for k, position in enumerate(open_bytes):
        byte = (members >> np.uint64(8 * position)) & np.uint64(255)
        rest |= byte.astype(np.int64) << (8 * k)
    place = np.full(1 << 24, -1, dtype=np.int32)
    place[rest] = np.arange(n)
    every = np.arange(n)
    for flip in _flips():
        other = place[rest ^ flip]
        met = other > every
        _join_labels(label, every[met], other[met].astype(np.int64))
    return label


def star_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of the lists in rows (five, key, fp) that come sorted; a list may span batches."""
    names = ["a", "b"]
    held_key, held = None, []

    def close() -> pa.RecordBatch | None:
        if held_key is None:
            return None
        members = np.unique(np.concatenate(held))
        if len(members) < 2:
            return None
        opened = tuple(p for p in range(8) if p not in FIVES[held_key[0]])
        label = list_components(members, opened)
        linked = np.flatnonzero(label != np.arange(len(members)))
        return pa.RecordBatch.from_arrays(
            [pa.array(members[linked].view(np.int64)), pa.array(members[label[linked]].view(np.int64))],
            names=names,
        )

    for batch in batches:
        five, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        fp = fp.view(np.uint64)
        if not len(fp):
            continue
        change = np.flatnonzero((five[1:] != five[:-1]) | (key[1:] != key[:-1])) + 1
        starts = np.concatenate(([0], change))
        ends = np.append(change, len(fp))
        for start, end in zip(starts.tolist(), ends.tolist()):
            now = (int(five[start]), int(key[start]))
            if now != held_key:
                if held_key is not None and (len(held) > 1 or len(held[0]) > 1):
                    out = close()
                    if out is not None and out.num_rows:
                        yield out
                held_key, held = now, []
            held.append(fp[start:end].copy() if end - start > 1 or end == len(fp) else fp[start:end])
    out = close()
    if out is not None and out.num_rows:
        yield out


def fingerprint_components(fingerprints: DataFrame) -> DataFrame:
    """``node``, ``root`` for the different fingerprints (column fp) that have a link."""
    fp = F.col("fp")
    byte = [F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]

    def key(five: tuple[int, ...]) -> Column:
        total = F.lit(0).cast("long")
        for k, position in enumerate(five):
            total = total.bitwiseOR(F.shiftleft(byte[position], 8 * k))
        return total

    entries = F.array(
        *(F.struct(F.lit(i).cast("int").alias("five"), key(five).alias("key")) for i, five in enumerate(FIVES))
    )
    index = (
        fingerprints.select("fp")
        .select("fp", F.explode(entries).alias("e"))
        .select("e.five", "e.key", "fp")
        .repartition("five", "key")
        .sortWithinPartitions("five", "key")
    )
    return components(index.mapInArrow(star_edges, "a long, b long"))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = SHINGLE
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    prints = stage_table(
        docs.select(
            docs[id_column].cast("long").alias("doc_id"),
            fingerprint_column(docs[text_column], width).alias("fp"),
        )
    )
    return prints.join(component_ids(prints).select("fp", "component_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def component_ids(prints: DataFrame) -> DataFrame:
    """``fp``, ``root`` and ``component_id`` for every different fingerprint of rows (doc_id, fp)."""
    first = stage_table(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = fingerprint_components(first)
    named = first.join(roots, first["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return named.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id")


def new_names(df: DataFrame, *bases: str) -> list[str]:
    """Column names that ``df`` has not yet."""
    own = {c.lower() for c in df.columns}
    return [next(n for n in (b, *(f"{b}_{i}" for i in range(len(own) + 1))) if n not in own) for b in bases]


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, one of each component: that of the smallest doc_id, all columns kept.

    Rows are staged once with a number of their own, so that of repeated rows exactly one stays.
    """
    fp, row = new_names(docs, "fp", "row")
    staged = stage_table(
        docs.withColumn(fp, fingerprint_column(docs[text_column], width)).withColumn(row, F.monotonically_increasing_id())
    )
    prints = staged.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row")
    )
    classes = component_ids(prints.select("doc_id", "fp"))
    # the first row of each fingerprint, then of each component, before anything is joined
    firsts = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    kept = (
        firsts.join(classes.select("fp", "root"), "fp")
        .groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias("kept_row"))
    )
    return staged.join(kept, staged[row] == kept["kept_row"], "left_semi").select(*docs.columns)
