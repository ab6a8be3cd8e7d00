"""Helpers for the two vector searches: usable vectors, packed rows, best rows per query."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERY_EVERY = 20  # rows whose id is divisible by it are the queries


def usable(vectors: DataFrame, id_column: str, vector_column: str, zero: bool) -> tuple[DataFrame, str, int]:
    """(vec_id, v) without unusable rows, the number kind of ``v``, and the dimension.

    Unusable: null ids, null vectors, null or non-finite components, lengths other than the most
    common one, and, unless ``zero``, vectors of zeros.
    """
    single = isinstance(vectors.schema[vector_column].dataType.elementType, T.FloatType)
    v = vectors[vector_column].cast("array<float>" if single else "array<double>")
    rows = vectors.select(vectors[id_column].cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    keep = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite
    if not zero:
        keep = keep & F.exists("v", lambda x: x != 0)
    rows = rows.where(keep)
    dimension = rows.agg(F.mode(F.size("v"), deterministic=True)).first()[0] or 0
    return rows.where(F.size("v") == dimension), "<f4" if single else "<f8", dimension


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """A list column of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def first_best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties to the smaller id, each id once with its best score."""
    order = np.lexsort((ids, -scores))
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:k]]


def best_per_query(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): an id counts once; ties to the smaller id."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return once.withColumn("rank", place).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def is_query(every: int = QUERY_EVERY) -> Column:
    return F.col("vec_id") % every == 0
