"""Session helpers: a local session for tests and the bench, and the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session. On a cluster, use the session the cluster gives you."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("scriptloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SCRIPTLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``checkpoint()`` writes to.

    The cluster names it in ``spark.checkpoint.dir``. Where neither that setting nor a
    ``setCheckpointDir`` call named one, a session whose tasks all run in this process (tests)
    gets a folder of its own; any other session is an error, as its executors would each write
    to a disk of their own.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="scriptloom-"))
        current = context.getCheckpointDir()
    return current


def stage_table(df: DataFrame) -> DataFrame:
    """Write the rows to a table in the checkpoint folder and read them from there.

    Cuts the plan and the lineage, outlives lost executors, and unlike ``checkpoint()`` is
    columnar: a later step reads only the columns it uses and Spark knows the true size.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted_stage(df: DataFrame, **counts) -> tuple[DataFrame, dict]:
    """``stage_table`` with aggregates taken while the rows are written."""
    observed, seen = _observed(df, counts)
    return stage_table(observed), seen.get


def bucket_count(spark: SparkSession) -> int:
    """As many as there are shuffle partitions, so that a join of buckets with a shuffle deals one side."""
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), most)


def bucketed_stage(df: DataFrame, key: str, **counts) -> tuple[DataFrame, dict]:
    """``counted_stage`` with the rows in buckets by ``key``, as many as there are shuffle partitions.

    Stages with buckets by the two sides of a join or by the key of an aggregate need no exchange.
    Rows that come partitioned by ``key`` are written as they lie, one file for each bucket.
    """
    spark = df.sparkSession
    buckets = bucket_count(spark)
    name = f"stage_{uuid.uuid4().hex}"
    observed, seen = _observed(df, counts)
    writer = observed.write.bucketBy(buckets, key).option("path", f"{checkpoint_dir(spark)}/{name}")
    writer.saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # only the name: the files of a table with a path stay
    return table, seen.get


def _observed(df: DataFrame, counts: dict[str, Column]) -> tuple[DataFrame, Observation]:
    seen = Observation()
    named = [column.alias(name) for name, column in counts.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *named), seen
