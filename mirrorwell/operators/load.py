"""Write one table into a new version folder.

Every strategy is one Spark job over one scan of the source. A scan that already
has enough splits is written from where it is read: nothing is shuffled only to
spread it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorwell.config import STRATEGIES
from mirrorwell.operators.strategy import CHUNK_MB
from mirrorwell.session import facts_frame

CHUNK = "_chunk"
# Rows that quantiles are taken from, about.
SAMPLE_ROWS = 100_000
_RANGES = T.StructType(
    [
        T.StructField("chunk", T.IntegerType()),
        T.StructField("lower", T.LongType()),
        T.StructField("upper", T.LongType()),
    ]
)


@dataclass(frozen=True)
class LoadContext:
    """``size_mb`` and ``splits`` describe the scan; ``None`` where unknown. ``partition_by``
    are the target's partition columns, and ``laid_out`` tells that the source has the same."""

    df: DataFrame
    path: str
    size_mb: float | None = None
    splits: int | None = None
    max_parallel: int = 4
    chunks: int = 4
    chunk_key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    laid_out: bool = False


def _write(ctx: LoadContext, df: DataFrame) -> None:
    """Write a version in its layout. Rows move only where the source is laid out otherwise:
    those of a partition come together, a partition too large for one task by several."""
    if ctx.partition_by and not ctx.laid_out:
        df = df.hint("rebalance", *ctx.partition_by)
    df.write.mode("overwrite").partitionBy(*ctx.partition_by).parquet(ctx.path)


def direct_copy(ctx: LoadContext) -> None:
    """A small table: as many files as its size asks for."""
    df = ctx.df
    if ctx.size_mb is not None:
        df = df.coalesce(max(1, math.ceil(ctx.size_mb / CHUNK_MB)))
    _write(ctx, df)


def parallel_dml(ctx: LoadContext) -> None:
    """At least ``max_parallel`` writers. Rows move only if the scan is known to have
    fewer splits; a scan of unknown size is written from where it is read."""
    df = ctx.df
    if ctx.splits is not None and ctx.splits < ctx.max_parallel:
        df = df.repartition(ctx.max_parallel)
    _write(ctx, df)


def chunked_staging(ctx: LoadContext) -> None:
    """Chunks staged side by side; publishing them together is the merge. A table with
    partitions has them for chunks."""
    if ctx.partition_by:
        _write(ctx, ctx.df)
        return
    df = with_chunks(ctx.df, ctx.chunks, ctx.chunk_key, ctx.splits)
    df.write.mode("overwrite").partitionBy(CHUNK).parquet(ctx.path)


def partition_exchange(ctx: LoadContext) -> None:
    """The partitions the source has rows of, to be published in place of those the target
    has; its others stay."""
    if not ctx.partition_by:
        raise ValueError("partition_exchange needs a partitioned table")
    _write(ctx, ctx.df)


Strategy = Callable[[LoadContext], None]
STRATEGY_FUNCTIONS: dict[str, Strategy] = dict(
    zip(STRATEGIES, (direct_copy, parallel_dml, chunked_staging, partition_exchange))
)


def register_strategy(name: str, function: Strategy) -> None:
    """Add a strategy of your own; name it per table when running a plan."""
    STRATEGY_FUNCTIONS[name] = function


def chunk_of(columns: Sequence[Column | str], chunks: int) -> Column:
    """Chunk number 0 to ``chunks - 1`` from a hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(chunks)).cast("int")


def row_address() -> list[Column]:
    """Where a row stands: its file, and its place in the file."""
    return [F.col("_metadata.file_path"), F.col("_metadata.row_index")]


def split_address() -> list[Column]:
    return [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]


def with_chunks(
    df: DataFrame, chunks: int, key: Sequence[str] = (), splits: int | None = None
) -> DataFrame:
    """``df`` with its chunk number, laid out for writing by chunk.

    By the row's address the chunks are even whatever the values are, so a value
    held by a third of the rows does no harm. A scan of many splits is chunked
    split by split, without a shuffle, and so is one whose ``splits`` are unknown. With
    ``key`` equal keys share a chunk; a chunk that grows too large is written by several
    tasks. Rows without a file stay in their partitions where ``splits`` are unknown.
    """
    if key:
        return df.withColumn(CHUNK, chunk_of(list(key), chunks)).hint("rebalance", CHUNK)
    try:
        if splits is None or splits >= 4 * chunks:
            return df.withColumn(CHUNK, chunk_of(split_address(), chunks))
        return df.withColumn(CHUNK, chunk_of(row_address(), chunks)).hint("rebalance", CHUNK)
    except AnalysisException:  # no file behind the rows: chunk by scan partition
        spread = df if splits is None or splits >= 4 * chunks else df.repartition(chunks)
        return spread.withColumn(CHUNK, F.pmod(F.spark_partition_id(), F.lit(chunks)))


def chunk_counts(df: DataFrame, chunk: Column) -> DataFrame:
    """Rows of every chunk; counted where they are read, so one hot chunk is no
    more work than any other."""
    return df.groupBy(chunk.alias("chunk")).agg(F.count(F.lit(1)).alias("rows"))


def key_ranges(df: DataFrame, key: str, chunks: int) -> list[tuple[int, int]]:
    """Equal-width ranges ``[lower, upper)`` of a whole-number key, the bounds a
    partitioned JDBC read takes. Empty if there is no key value."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    if low is None:
        return []
    width = -(-(high - low + 1) // chunks)
    last = (1 << 63) - 1
    return [(min(last, low + i * width), min(last, low + (i + 1) * width)) for i in range(chunks)]


def range_chunk_counts(df: DataFrame, key: str, chunks: int) -> DataFrame:
    """``(chunk, lower, upper, rows)`` of every key range, empty ones included.

    A row's range follows from the first lower bound and the width: no range join.
    """
    ranges = key_ranges(df, key, chunks)
    spark = df.sparkSession
    bounds = facts_frame(
        spark, [(i, low, high) for i, (low, high) in enumerate(ranges)], _RANGES
    )
    if not ranges:
        return bounds.withColumn("rows", F.lit(0).cast("bigint"))
    low, width = ranges[0][0], ranges[0][1] - ranges[0][0]
    # in decimal: the distance of two far keys is beyond a long, a quotient beyond a double
    chunk = F.expr(
        f"cast((cast(`{key}` as decimal(38,0)) - cast('{low}' as decimal(38,0)))"
        f" div cast('{width}' as decimal(38,0)) as int)"
    )
    counts = chunk_counts(df.where(F.col(key).isNotNull()), chunk)
    return bounds.join(counts, "chunk", "left").select(
        "chunk", "lower", "upper", F.coalesce("rows", F.lit(0)).alias("rows")
    )


def equi_depth_bounds(df: DataFrame, key: Sequence[str], chunks: int, sample: int = SAMPLE_ROWS) -> list:
    """Keys at which chunks of about equal numbers of rows begin, but for the first.

    ``key`` is any columns that can be ordered, compared as a tuple with NULL lowest. The
    cut points are quantiles of the keys, counted in Spark; of a table of more rows than
    ``sample`` about so many rows, chosen by the hash of their address, stand for all (the
    chunks take every row either way). A key value with a chunk's share of rows or more
    begins and ends a chunk of its own (with the few values behind it that a sample may
    have missed), so there may be up to ``2 * chunks``; no other chunk is above twice the
    mean, within the sample's error.
    """
    rows = df.count()
    taken = df
    if rows > sample:
        every = -(-rows // sample)
        try:
            taken = df.where(F.pmod(F.xxhash64(*row_address()), F.lit(every)) == 0)
            taken.schema
        except AnalysisException:  # no file behind the rows
            taken = df.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(every)) == 0)
    counted = taken.groupBy(_key_tuple(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    # one row per sampled key value at most
    order = Window.orderBy("k")
    placed = counted.withColumn("before", F.sum("n").over(order) - F.col("n")).withColumn(
        "total", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    part = F.floor(F.col("before") * chunks / F.col("total"))
    placed = placed.withColumn("part", part).withColumn("last", F.lag("part").over(order))
    heavy = F.col("n") * chunks >= F.col("total")
    found = placed.where(F.col("last").isNotNull() & (heavy | (F.col("part") > F.col("last"))))
    return [r.k for r in found.orderBy("k").select("k").collect()]


def _key_tuple(key: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(key)])


def depth_chunk(df: DataFrame, key: Sequence[str], bounds: Sequence) -> Column:
    """The number of a row's chunk among ``bounds``, found by halving."""
    types = [df.schema[c].dataType for c in key]
    tuples = [
        F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(bound, types))])
        for bound in bounds
    ]

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(_key_tuple(key) >= tuples[middle - 1], within(middle, high)).otherwise(
            within(low, middle - 1))

    return within(0, len(tuples))


def copy_by_range(df: DataFrame, path: str, key: str, chunks: int) -> None:
    """Range chunks on a key: each output file holds one stretch of the key, which
    later reads can skip by its statistics. The cut points follow the data; rows of
    one common key value are spread by their address."""
    try:
        ranged = df.repartitionByRange(chunks, F.col(key), F.xxhash64(*row_address()))
    except AnalysisException:  # no file behind the rows
        ranged = df.repartitionByRange(chunks, F.col(key))
    ranged.write.mode("overwrite").parquet(path)


def exchange_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace the partitions ``df`` has rows for; leave all others alone.

    Rows of one partition come together for writing; a partition too large for one
    task is written by several.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def merge_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """All chunks one after the other, repeated rows kept."""
    merged = chunks[0]
    for chunk in chunks[1:]:
        merged = merged.unionByName(chunk)
    return merged
