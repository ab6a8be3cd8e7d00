"""Rows to learn from: a bounded sample of labelled documents outside the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptloom.session import stage_table


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the doc_id as text, modulo the number of folds; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int
) -> DataFrame:
    """(text, y) of at most ``per_class`` labelled documents of each class, chosen by a hash of doc_id.

    Rows without label, id or text, and those of the held-out fold, are never used. A doc_id that
    occurs more than once has one of its texts used.
    """
    known = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .withColumn("rank", F.xxhash64("doc_id"))
    )
    some = known.where("y = 1").orderBy("rank").limit(per_class).unionByName(
        known.where("y = 0").orderBy("rank").limit(per_class)
    )
    chosen = stage_table(some.select("doc_id", "y"))  # 2 * per_class ids at most
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return stage_table(
        texts.where("text IS NOT NULL")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.max(F.struct("text", "y")).alias("row"))
        .select("row.text", "row.y")
    )
