"""Mix sources to target weights.

Every document gets a hash-random key. Within its source the keys are cut into ranges
of about the square root of the rows; sums per range, summed up over the ranges, and
sums inside each range give a distributed prefix sum of sizes, and the source is cut
where that meets its budget.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirrorwell.llm.common import Scratch, WORD, row_print, text_of

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, weight, source_size, source_rows, target)`` from rows ``(source, size)``.

    Sources by code point, null last, get ``weights`` in turn. They share the sum of all
    sizes; no target exceeds ``max_epochs`` times its source, and what is beyond that is
    shared again by weight until none is above. That end is found in one pass: ordered
    by how much weight each can bear, the capped sources come first.

    The one-task windows here see one row per source.
    """
    per = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                        ((rank - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", turn).withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    per = (
        per.withColumn("place", F.row_number().over(order))
        .withColumn("left_size", F.sum("source_size").over(everything)
                    - F.coalesce(F.sum("cap").over(before), zero))
        .withColumn("left_weight", F.sum("weight").over(everything)
                    - F.coalesce(F.sum("weight").over(before), zero))
    )
    fits = (F.col("left_size").cast("double") * F.col("weight")) / F.col("left_weight") <= F.col("cap")
    # the first source below its cap sets the share of all that follow it
    per = per.withColumn("level", F.min(
        F.when(fits, F.struct("place", "left_size", "left_weight"))).over(everything))
    share = (F.col("level.left_size").cast("double") * F.col("weight")) / F.col("level.left_weight")
    below = F.coalesce(F.col("place") >= F.col("level.place"), F.lit(False))
    return per.select(
        "source", "weight", "source_size", "source_rows",
        F.when(below, share).otherwise(F.col("cap").cast("double")).alias("target"))


def random_key(seed: int = 0) -> Column:
    """The same for the same document in every run."""
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("row_print"))


def mix_sources(docs: DataFrame, size: Column | None = None, weights: Sequence[int] = WEIGHTS,
                max_epochs: int = MAX_EPOCHS, whole: bool = False, seed: int = 0) -> DataFrame:
    """How much of each document the mix takes: ``(doc_id, row_print, source, size,
    source_size, target, taken)``, a row per row of ``docs``.

    ``size`` is what is weighed, the number of words unless given. Each source is taken
    in full passes and, in random order, up to its budget (its target rounded down).
    The document at the cut is taken in part; with ``whole`` it is taken or left whole,
    whichever is nearer. A source of size 0 is not taken. Rows that are equal in doc_id
    and text follow each other in the order; a null text has size 0. Reruns agree.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    text = text_of()
    size = F.regexp_count(text, F.lit(WORD)) if size is None else size
    base = scratch.keep(
        docs.select("doc_id", row_print(text).alias("row_print"),
                    F.col("source").cast("string").alias("source"),
                    F.coalesce(size, F.lit(0)).cast("long").alias("size"))
        .withColumn("key", random_key(seed)), "sizes")
    targets = scratch.keep(source_targets(base, weights, max_epochs), "targets")
    targets = targets.withColumnRenamed("source", "_source")
    # a range holds about sqrt(rows) documents and there are about as many ranges
    ranges = F.greatest(F.lit(1), F.ceil(F.sqrt("source_rows"))).cast("long")
    unit = F.shiftrightunsigned("key", 32).cast("double") / float(1 << 32)
    keyed = base.join(targets, base["source"].eqNullSafe(targets["_source"])).select(
        "doc_id", "row_print", "source", "size", "key", "source_size", "target",
        F.floor(unit * ranges).cast("long").alias("range"))
    keyed = scratch.keep(keyed, "keyed")
    sums = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = scratch.keep(
        sums.select(F.col("source").alias("_source"), F.col("range").alias("_range"),
                    F.coalesce(F.sum("range_size").over(ahead), F.lit(0)).alias("range_start")),
        "starts")
    inside = (Window.partitionBy("source", "range")
              .orderBy("key", "doc_id", "row_print")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = keyed.repartitionByRange("source", "range").withColumn("inner_start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(starts, placed["source"].eqNullSafe(starts["_source"])
                         & (placed["range"] == starts["_range"]))
    start = F.col("range_start") + F.col("inner_start")
    budget = F.floor(F.col("target")).cast("long")
    passes = F.when(F.col("source_size") > 0,
                    F.expr("cast(floor(target) as bigint) div source_size")).otherwise(F.lit(0))
    rest = budget - passes * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(F.lit(0), rest - start))
    if whole:
        part = F.when(2 * part > F.col("size"), F.col("size")).otherwise(F.lit(0))
    return placed.select(
        "doc_id", "row_print", "source", "size", "source_size", "target",
        (passes * F.col("size") + part).cast("long").alias("taken"))
