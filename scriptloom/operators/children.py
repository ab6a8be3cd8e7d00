"""Child tables of the catalog: one row per list element. Each is an explode, with no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptloom.functions.binding import elements


def arguments(catalog: DataFrame) -> DataFrame:
    """One row per routine argument; ``position`` counts from 1."""
    return catalog.select("script_id", F.posexplode(elements(F.col("arguments"))).alias("pos", "argument")).select(
        "script_id", (F.col("pos") + 1).cast("bigint").alias("position"), "argument.*"
    )


def view_columns(catalog: DataFrame) -> DataFrame:
    """One row per written view column. A script names no types, so all read as STRING."""
    return catalog.select("script_id", F.posexplode(elements(F.col("view_columns"))).alias("pos", "column")).select(
        "script_id",
        (F.col("pos") + 1).cast("bigint").alias("position"),
        "column.name",
        F.lit("STRING").alias("type"),
        F.lit("NULLABLE").alias("mode"),
        "column.description",
    )


def clustering(catalog: DataFrame) -> DataFrame:
    return catalog.select("script_id", F.posexplode(elements(F.col("clustering"))).alias("pos", "name")).select(
        "script_id", (F.col("pos") + 1).cast("bigint").alias("position"), "name"
    )


def options(catalog: DataFrame) -> DataFrame:
    """One row per option written in a script, values as text."""
    return catalog.select("script_id", F.explode(elements(F.col("options"))).alias("name", "value"))


def list_options(catalog: DataFrame) -> DataFrame:
    """One row per element of each list-valued option."""
    lists = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.col(path).alias("elements"))
            for name, path in (
                ("imported_libraries", "imported_libraries"),
                ("packages", "python_options.packages"),
                ("py_file_uris", "spark_options.py_file_uris"),
                ("jar_uris", "spark_options.jar_uris"),
                ("file_uris", "spark_options.file_uris"),
                ("archive_uris", "spark_options.archive_uris"),
            )
        ]
    )
    return catalog.select("script_id", F.inline(lists)).select(
        "script_id", "name", F.posexplode(elements(F.col("elements"))).alias("pos", "value")
    ).select("script_id", "name", (F.col("pos") + 1).cast("bigint").alias("position"), "value")


def pair_options(catalog: DataFrame) -> DataFrame:
    """One row per key of each map-valued option (labels, properties, context)."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.col(path).alias("entries"))
            for name, path in (
                ("labels", "labels"),
                ("properties", "spark_options.properties"),
                ("user_defined_context", "remote_function_options.user_defined_context"),
            )
        ]
    )
    return catalog.select("script_id", F.inline(pairs)).select(
        "script_id", "name", F.explode(elements(F.col("entries"))).alias("key", "value")
    )
