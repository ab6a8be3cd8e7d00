"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target size. A source is taken in complete epochs as often as its target holds
its size; the rest of the target is a weighted sample without replacement: each document draws the
exponential key -ln(u) / quality, documents are sorted by key within their source, and sizes are
summed until the rest is used up. The document at the border is taken in part.

No source is sorted in one task. A key is turned into a cell (its place among ``CELLS`` or more
equal parts of a source's unit interval); sizes are summed per source and cell, the sums of the
cells before are added up over that small table, and only a cell's own documents are sorted
together. u is taken from a hash of doc_id and a seed, so reruns agree.

Targets: weights go round the sources in code point order, null last; the mix has ``share`` times
the size of all documents; no target is above ``epochs`` times its source's size, and what is cut
off is dealt to the other sources by weight until none is above. The cut is found by rounds of
sums over the sources; the driver sees two numbers a round.

Defined results: a null or blank text has size 0 and takes 0; a source of size 0 has target 0; a
null doc_id draws a key like any other; rows that repeat a doc_id are ordered by size and share
equal cuts; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptloom.session import stage_table

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
EPOCHS = 2.0
CELL_ROWS = 2000  # rows a cell of the largest source has, about
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """A plain quality weight: the share of letters in a text, 0.05 at least."""
    letters = F.length(F.regexp_replace(text, "[^\\p{L}]+", ""))
    share = letters / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(0.05))


def unit_draw(doc_id: Column, seed: int) -> Column:
    """A number between 0 and 1 (both left out) from the digest of seed and doc_id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS) -> DataFrame:
    """(source_key, source_size) with ``target``. Sources are ranked by range partitions."""
    ordered = stage_table(
        sizes.repartitionByRange("source_key")
        .sortWithinPartitions("source_key")
        .withColumn("part", F.spark_partition_id())
    )
    before, total = {}, 0
    for row in sorted(ordered.groupBy("part").count().collect()):  # one row per partition
        before[row["part"]] = total
        total += row["count"]
    offsets = ordered.sparkSession.createDataFrame(list(before.items()) or [(0, 0)], "part int, before long")
    place = F.row_number().over(Window.partitionBy("part").orderBy("source_key")) + F.col("before") - 1
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (place % len(weights) + 1).cast("int"))
    ranked = stage_table(
        ordered.join(F.broadcast(offsets), "part").select(
            "source_key", "source_size", weight.alias("weight"), (F.col("source_size") * epochs).alias("cap")
        )
    )
    wanted = share * float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    rate = 0.0
    while True:
        full = F.col("weight") * rate >= F.col("cap")
        held, rest = ranked.agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if not rest:
            break
        higher = (wanted - held) / rest
        if higher <= rate:
            break
        rate = higher
    return ranked.select(
        "source_key", "source_size", F.least("cap", F.col("weight") * rate).alias("target")
    )


def mix_sources(
    docs: DataFrame, quality: Column | None = None, id_column: str = "doc_id", text_column: str = "text",
    source_column: str = "source", weights=WEIGHTS, share: float = SHARE, epochs: float = EPOCHS,
    seed: int = 7, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: doc_id, size, source_size, target (the source's), taken; and the carried columns.

    ``quality`` is a column of weights above 0 (default: the share of letters).
    """
    text = docs[text_column]
    doc_id = docs[id_column].cast("long")
    weight = letter_share(text) if quality is None else quality
    rows = stage_table(
        docs.select(
            doc_id.alias("doc_id"),
            # a letter before the name keeps null apart from every name and behind it
            F.coalesce(F.concat(F.lit("s"), docs[source_column]), F.lit("t")).alias("source_key"),
            word_count(text).alias("size"),
            (-F.log(unit_draw(doc_id, seed)) / weight).alias("draw"),
            *(docs[c].alias(c) for c in carry),
        )
    )
    sources = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = stage_table(sources)
    largest = sources.agg(F.max("n")).first()[0] or 1
    cells = max(1, -(-largest // CELL_ROWS))
    targets = source_targets(sources.select("source_key", "source_size"), weights, share, epochs)
    # 1 - exp(-draw) grows with the draw and lies between 0 and 1
    celled = rows.withColumn(
        "cell", F.floor((1 - F.exp(-F.col("draw"))) * cells).cast("int")
    )
    before = Window.partitionBy("source_key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        celled.groupBy("source_key", "cell")
        .agg(F.sum("size").alias("cell_size"))
        .withColumn("cell_before", F.coalesce(F.sum("cell_size").over(before), F.lit(0)))
        .join(targets, "source_key")
        .select("source_key", "cell", "cell_before", "source_size", "target")
    )
    inside = (
        Window.partitionBy("source_key", "cell")
        .orderBy("draw", F.col("doc_id").asc_nulls_last(), "size", *carry)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    epochs_taken = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target") - epochs_taken * F.col("source_size") + 0.5)
    prefix = F.col("cell_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - prefix))
    return celled.join(offsets, ["source_key", "cell"]).select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
        (epochs_taken * F.col("size") + part).cast("long").alias("taken"), *carry,
    )
