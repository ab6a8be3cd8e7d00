"""From raw documents to token ids: filter, deduplicate, mix, encode.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; each is written and read again
before the next one. All but the last return the columns of ``docs``. Rows with null or empty text,
repeated rows and null ids pass through each stage as its operator defines.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptloom.llm import bpe, mixing, quality, simhash, toxicity
from scriptloom.session import stage_table
from scriptloom.sources.corpora import read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    model = toxicity.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(model, docs["text"]) < toxicity.THRESHOLD)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' votes call good."""
    model = quality.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return docs.where(quality.score_column(spark, model, docs["text"]) >= quality.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as the mix takes it; half a document or more counts as one."""
    row, copy = simhash.new_names(docs, "row", "copy")
    numbered = stage_table(docs.withColumn(row, F.monotonically_increasing_id()))
    taken = mixing.mix_sources(numbered, carry=(row,)).select(
        F.col(row).alias("taken_row"),
        F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + 0.5).cast("int").alias("times"),
    ).where("times > 0")
    chosen = numbered.join(taken, numbered[row] == taken["taken_row"])
    return chosen.select(
        *(numbered[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), taken["times"])).alias(copy)
    ).drop(copy)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document with their digests."""
    return bpe.encode_decode(docs, TOKENIZER, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("BPE encoding and decoding", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
