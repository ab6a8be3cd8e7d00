"""The work of the corpora is cut by rows."""

from pyspark.sql import functions as F

from scriptloom.functions import body as bodies
from scriptloom.plans import queries
from scriptloom.sources import corpora
from scriptloom.streaming import catalogs


def test_tasks_grow_in_number_with_the_orders(spark, tmp_path, monkeypatch):
    orders = spark.range(300).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(corpora, "ROWS_A_TASK", 20)
    for corpus in (corpora.order_scripts, corpora.mixed_bodies):
        tasks = corpus(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) == 15
        assert max(row["count"] for row in tasks) <= 2 * 20


def test_files_of_the_stream_grow_with_the_corpus(spark, tmp_path, monkeypatch):
    """The corpus is written twice, in as many files as it has tasks, and taken in by several batches."""
    orders = spark.range(300).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    folders, follow = [], catalogs.follow

    def noted(files, folder, state, once):
        folders.append(folder)
        return follow(files, folder, state, once)

    monkeypatch.setattr(catalogs, "follow", noted)
    monkeypatch.setattr(corpora, "ROWS_A_TASK", 20)
    objects, rejects = queries._followed(spark, str(tmp_path))
    assert len(spark.read.parquet(folders[0].removesuffix("out") + "in").inputFiles()) == 30
    assert spark.read.parquet(folders[0]).select("batch").distinct().count() > 1
    assert objects.count() + rejects.count() == 300
