"""Mixing sources to target weights.

Every document gets a hash-random key. Within its source the documents stand in the order of that
key; distributed prefix sums of the word counts tell how many words stand before each one, and the
source is cut at its exact budget. A budget beyond the source's size repeats the source in epochs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.llm.common import hash60, stored, word_count

ROWS_PER_BUCKET = 4096


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """Targets per source: ``source, n, source_size`` in, ``target`` (double) added.

    Sources in code point order, null last, take the weights in turn and share the total of all
    sizes. A target stops at ``cap`` times its source's size; what is above goes to the others by
    weight, again until none is above. With the sources in the order of cap by weight, those that
    stop form a prefix, so running sums give the result in one pass. The table holds one row per
    source; the windows over all sources see nothing else.
    """
    everything, by_name = W.partitionBy(F.lit(0)), W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumns(
        {
            "weight": F.element_at(
                F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
            ).cast("long"),
            "limit": F.col("source_size") * cap,
            "everything": F.sum("source_size").over(everything),
        }
    )
    up = W.partitionBy(F.lit(0)).orderBy(F.col("limit").cast("double") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = up.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(F.lit(0))
    left = F.col("everything") - F.coalesce(F.sum("limit").over(before), F.lit(0))
    weight_left = F.sum("weight").over(onward) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = ranked.withColumns({"left": left, "weight_left": weight_left, "place": F.row_number().over(up)}).withColumn(
        "free", F.col("limit").cast("double") * F.col("weight_left") >= F.col("left").cast("double") * F.col("weight")
    )
    first = F.min(F.when(F.col("free"), F.struct("place", "left", "weight_left"))).over(everything)
    share = F.col("first.left").cast("double") * F.col("weight") / F.col("first.weight_left")
    stops = F.col("first").isNull() | (F.col("place") < F.col("first.place"))
    return level.withColumn("first", first).select(
        "source", "n", "source_size", F.when(stops, F.col("limit").cast("double")).otherwise(share).alias("target")
    )


def mix(
    docs: DataFrame,
    seed: int = 0,
    weights: Sequence[int] = (5, 2, 1),
    cap: int = 3,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """The share of every document: ``doc_id, source, size, source_size, target, taken, copies``.

    ``docs`` needs ``doc_id, source, text``; further columns are not read. ``taken`` counts words,
    repeats included, and adds up to each source's target rounded to whole words: the document at
    the cut is taken in part. ``copies`` is the same decision for whole documents: epochs, plus one
    where at least half of the document lies before the cut. ``carry`` names further columns to keep.

    The bits of the key that name a bucket follow from the source's row count, so a source that
    holds most rows is spread over as many buckets as it needs, and bucket totals are summed in two
    levels. Rows with the same ``doc_id`` count each by itself. A null source is a source; null or
    empty texts have size 0 and take nothing; an empty table gives an empty result.
    """
    carry = carry or {}
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = stored(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            key.alias("key"),
            *(c.alias(name) for name, c in carry.items()),
        ),
        "mix-sizes",
    )
    sources = source_targets(
        sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")), weights, cap
    ).withColumns(
        {
            "bits": F.least(F.lit(40), F.ceil(F.log2(F.greatest(F.col("n") / rows_per_bucket, F.lit(1.0))))).cast("int"),
            "budget": F.floor(F.col("target") + 0.5).cast("long"),
        }
    ).drop("n")
    placed = (
        sized.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("hash", hash60(F.col("key")))
        .withColumn("fine", F.expr("shiftright(hash, 60 - bits)"))
        .withColumn("coarse", F.expr("shiftright(hash, 60 - bits div 2)"))
        .drop("hash", "bits")
    )
    up_to = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    totals = placed.groupBy("source", "coarse", "fine").agg(F.sum("size").alias("words"))
    coarse = totals.groupBy("source", "coarse").agg(F.sum("words").alias("words")).select(
        F.col("source").alias("_s"),
        F.col("coarse").alias("_c"),
        F.coalesce(F.sum("words").over(up_to(W.partitionBy("source").orderBy("coarse"))), F.lit(0)).alias("_outer"),
    )
    fine = totals.select(
        "source", "coarse", "fine",
        F.coalesce(F.sum("words").over(up_to(W.partitionBy("source", "coarse").orderBy("fine"))), F.lit(0)).alias("_inner"),
    )
    offsets = fine.join(coarse, F.col("source").eqNullSafe(F.col("_s")) & (F.col("coarse") == F.col("_c"))).select(
        F.col("source").alias("_s"), F.col("fine").alias("_f"), (F.col("_outer") + F.col("_inner")).alias("_offset")
    )
    inside = up_to(W.partitionBy("source", "fine").orderBy("key", "doc_id", "size"))
    rest, size, before = F.col("budget") % F.col("source_size"), F.col("size"), F.col("before")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long")
    return (
        placed.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("fine") == F.col("_f")))
        .withColumn("before", F.col("within") + F.col("_offset"))
        .withColumns({"epochs": epochs, "rest": F.coalesce(F.when(F.col("source_size") > 0, rest), F.lit(0))})
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("epochs") * size + F.least(size, F.greatest(F.lit(0), F.col("rest") - before))).alias("taken"),
            (F.col("epochs") + ((F.col("rest") > 0) & (2 * before + size <= 2 * F.col("rest"))).cast("long")).alias("copies"),
            *carry,
        )
    )


def mixed_documents(docs: DataFrame, seed: int = 0, weights: Sequence[int] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes the whole document.

    Rows of one ``doc_id``, source and text that repeat share their decision.
    """
    mark = F.xxhash64("text")
    shares = mix(docs, seed, weights, cap, carry={"mark": mark}).where("copies > 0")
    copies = shares.groupBy(F.struct("doc_id", "source", "mark").alias("_key")).agg(F.max("copies").cast("int").alias("_copies"))
    whole = docs.select(
        F.struct("doc_id", "source", mark.alias("mark")).alias("_key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    )
    taken = whole.join(copies, "_key").withColumn("_epoch", F.explode(F.sequence(F.lit(1), "_copies")))
    return taken.select("_row.*")
