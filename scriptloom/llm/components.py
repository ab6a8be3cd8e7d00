"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step regroups edges around the smallest neighbour of a node; stars stay linear in the number
of edges. Minima are pre-aggregated before the shuffle, and a node with very many edges meets its
minimum in a join that adaptive execution can split. The driver sees one sum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptloom.session import stage_table


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """Link every larger (large) or not larger (small) neighbour of a node to its smallest one."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = both.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("low")
    )
    met = both.join(lowest, F.col("a") == F.col("node"))
    if large:
        out = met.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            lowest.select(F.col("node").alias("a"), F.col("low").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node it reaches) for every node of ``edges`` (a, b).

    Loops and repeated edges are allowed, nulls are not. No edges: no rows.
    """
    ordered = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    current = stage_table(ordered)
    before = None
    while True:
        # Equal sums of hashes of the edges: the stars no longer change.
        mark = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark == before or not mark[0]:
            break
        before = mark
        current = stage_table(_step(_step(current, large=True), large=False))
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionByName(roots)
