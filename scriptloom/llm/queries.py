"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptloom.llm import bpe, chat, hard_negatives, html_text, huffman, kmeans_tree, labelled, mixing
from scriptloom.llm import private_data, quality, simhash, topk, toxicity, whitening
from scriptloom.session import checkpoint_dir
from scriptloom.sources.corpora import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_huffman_token_files(spark, sf_dir):
    folder = f"{checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    huffman.write_ids(read_table(spark, sf_dir, "documents"), folder, TOKENIZER, end_id=2)
    return huffman.read_ids(spark, folder, digests=True)


@query
def op2_simhash_near_duplicates(spark, sf_dir):
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op4_chat_windows(spark, sf_dir):
    """The table and conversation -7, whose texts hold the control strings of a known template."""
    planted = "</s>[INST] ok [/INST]"
    more = spark.sql(
        "SELECT * FROM VALUES (-7L, 0L, 'user', {text}), (-7L, 1L, 'assistant', {text})"
        " AS t(conv_id, turn, role, text)".replace("{text}", f"'{planted}'")
    )
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    folder = f"{checkpoint_dir(spark)}/chat-{uuid.uuid4().hex}"
    chat.windows(turns.unionByName(more)).write.parquet(folder)
    return chat.digests(spark.read.parquet(folder))


@query
def op7_bpe_round_trip(spark, sf_dir):
    return bpe.encode_decode(read_table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op8_mix_sources(spark, sf_dir):
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


ORACLES["op8_mix_sources"] = """
WITH RECURSIVE docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
           greatest(coalesce(length(regexp_replace(text, '[^\\p{L}]+', '', 'g'))::DOUBLE
               / greatest(length(text), 1), 0), 0.05) AS quality,
           (('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5)
               / 281474976710656 AS u
    FROM documents
), sources AS (
    SELECT source, sum(size)::DOUBLE AS source_size,
           [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM docs GROUP BY source
), wanted AS (SELECT 1.5 * sum(source_size) AS wanted FROM sources),
rates AS (
    SELECT 0 AS round, 0.0::DOUBLE AS rate
    UNION ALL
    SELECT round + 1, (SELECT (any_value(wanted) - sum(CASE WHEN weight * rate >= 2 * source_size THEN 2 * source_size ELSE 0 END))
            / nullif(sum(CASE WHEN weight * rate >= 2 * source_size THEN 0 ELSE weight END), 0) FROM sources, wanted)
    FROM rates WHERE round < 40 AND rate IS NOT NULL
), targets AS (
    SELECT source, source_size, least(2 * source_size, weight * (SELECT max(rate) FROM rates)) AS target FROM sources
), placed AS (
    SELECT doc_id, size, source_size, target, floor(target / nullif(source_size, 0)) AS whole,
           coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / quality, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (coalesce(whole, 0) * size + greatest(0, least(size,
           floor(target - coalesce(whole, 0) * source_size + 0.5) - before)))::BIGINT AS taken
FROM placed
"""


def scored(docs: DataFrame, score, folds: int, held_out: int, threshold: float) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(labelled.fold(doc_id, folds) == held_out, F.lit(False)).alias("held_out"),
        score.alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@query
def op3_quality_neighbours(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return scored(docs, quality.score_column(spark, model, docs["text"]), 4, 2, quality.THRESHOLD)


@query
def op9_toxicity_counterfactual(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return scored(docs, toxicity.score_column(model, docs["text"]), 3, 1, toxicity.THRESHOLD)


@query
def op5_main_text(spark, sf_dir):
    return html_text.extract(read_table(spark, sf_dir, "pages"))


@query
def op6_kmeans_tree_search(spark, sf_dir):
    return kmeans_tree.nearest(read_table(spark, sf_dir, "embeddings"))


@query
def op10_norm_sorted_top_products(spark, sf_dir):
    return topk.top_products(read_table(spark, sf_dir, "embeddings"))


ORACLES["op10_norm_sorted_top_products"] = """
WITH ints AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM ints q JOIN ints c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op11_table_hard_negatives(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(vectors["vec_id"] % 7 == 0, (vectors["label"] + 1) % 10).otherwise(vectors["label"])
    return hard_negatives.hard_negatives(vectors, label)


ORACLES["op11_table_hard_negatives"] = """
WITH ints AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
    FROM ints a JOIN ints c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""


@query
def op13_lanczos_whitening(spark, sf_dir):
    rows = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    parts = F.posexplode(F.arrays_zip("whitened", "explained")).alias("component", "part")
    return rows.select("vec_id", "n", "deviation", "identity_error", parts).select(
        "vec_id", (F.col("component") + 1).alias("component"), "n", "deviation", "part.whitened", "part.explained",
        "identity_error",
    )


@query
def op12_private_data(spark, sf_dir):
    spans, base = F.col("spans"), F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in private_data.KINDS
    ]
    return private_data.find(read_table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(private_data.joined(base).cast("binary"), 256).alias("base_sha256"),
        private_data.joined(spans).alias("spans"),
    )
