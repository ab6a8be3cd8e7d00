"""Compute a costly column once per row, however often it is used."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row.

    An expression written inside a lambda is evaluated once per element; bound here it is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """``df.filter(condition)`` for conditions on costly columns.

    Catalyst moves a filter below the projections it reads from, which writes out and evaluates
    their expressions again, each use of a stage multiplying the one below. As the explode of one
    or no element, the condition stays where its columns are already computed.
    """
    one = F.when(condition, F.array(F.lit(True)))
    return df.select("*", F.explode(one).alias("_kept")).drop("_kept")


def sealed(df: DataFrame) -> DataFrame:
    """The same rows as output of a generator, so that filters and joins put on them later are
    not moved into the projections below. All columns are then computed."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def elements(values: Column) -> Column:
    """``values`` to explode. On a plain column Catalyst would add a filter on its size and move
    that down; an expression it leaves alone."""
    return F.when(F.size(values) > 0, values)


def built_once(build: Callable[[], list[tuple[str, Column]]]):
    """Keep the columns a function builds, as long as the same JVM runs.

    Columns name their inputs and are not tied to a DataFrame, so they can be used again; building
    the large ones takes thousands of calls into the JVM.
    """
    kept: dict[int, list[tuple[str, Column]]] = {}

    def columns() -> list[tuple[str, Column]]:
        jvm = id(SparkContext._gateway)
        if jvm not in kept:
            kept.clear()
            kept[jvm] = build()
        return kept[jvm]

    return columns


def with_each(df: DataFrame, columns: list[tuple[str, Column]]) -> DataFrame:
    """Add the columns one after the other; each may use those before it."""
    for name, column in columns:
        df = df.withColumn(name, column)
    return df
