"""Prove that a copy is right: row counts, content hashes, samples, exact diff.

Comparisons take ``{table: DataFrame}`` for each side and return one small
DataFrame. All tables are measured in one job, each by partial sums where its rows
are read, so neither many tables nor repeated rows cost a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorwell.functions.hashing import HASHES, canonical_columns, exact_sum, row_hash
from mirrorwell.operators.orphans import key_columns
from mirrorwell.session import materialize, work_dir

Frames = Mapping[str, DataFrame]

# Buckets that tell where two tables differ. Every task sends one sum per bucket, so
# more of them would cost more than the finer search saves.
DIFF_BUCKETS = 1024
# Bits of the broadcast filter that finds the rows that differ: so many for each of them,
# and at most so many in all (64 MB), in words of 64 that are joined by the group.
ROW_BITS = 8
FILTER_BITS = 1 << 29
GROUP_WORDS = 16


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(frames: Frames) -> DataFrame:
    """``(table_name, rows)``. Reads no column, only row counts."""
    return _stack(
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
            for t, df in frames.items()
        ]
    )


def fingerprint(df: DataFrame, where: Column | None = None, hash_name: str = "xxhash64") -> DataFrame:
    """``(rows, content)`` of one table; ``content`` ignores row order but counts
    every repeated row."""
    hashed = df if where is None else df.where(where)
    return hashed.select(HASHES[hash_name](df).alias("h")).agg(
        F.count(F.lit(1)).alias("rows"), exact_sum(F.col("h")).alias("content")
    )


def fingerprints(
    frames: Frames, samples: Mapping[str, Column] | None = None, hash_name: str = "xxhash64"
) -> DataFrame:
    samples = samples or {}
    return _stack(
        [
            fingerprint(df, samples.get(t), hash_name).select(
                F.lit(t).alias("table_name"), "rows", "content"
            )
            for t, df in frames.items()
        ]
    )


def compare_rows(source: Frames, target: Frames) -> DataFrame:
    """``(table_name, rows_source, rows_target, match)``; a table only one side has
    does not match."""
    left = row_counts(source).withColumnRenamed("rows", "rows_source")
    right = row_counts(target).withColumnRenamed("rows", "rows_target")
    return left.join(right, "table_name", "full_outer").select(
        "table_name", "rows_source", "rows_target", _same("rows_source", "rows_target").alias("match")
    )


def compare_content(
    source: Frames,
    target: Frames,
    samples: Mapping[str, Column] | None = None,
    hash_name: str = "xxhash64",
) -> DataFrame:
    """As ``compare_rows`` with ``content_source`` and ``content_target``."""
    sides = []
    for side, frames in (("source", source), ("target", target)):
        measured = fingerprints(frames, samples, hash_name)
        sides.append(
            measured.withColumnsRenamed({"rows": f"rows_{side}", "content": f"content_{side}"})
        )
    match = _same("rows_source", "rows_target") & _same("content_source", "content_target")
    return sides[0].join(sides[1], "table_name", "full_outer").withColumn("match", match)


def _same(left: str, right: str) -> Column:
    return F.coalesce(F.col(left) == F.col(right), F.lit(False))


def sample_filter(
    df: DataFrame, every: int, key: Sequence[str] = (), hash_name: str = "xxhash64"
) -> Column:
    """About one row in ``every``, the same rows on both sides: chosen by the hash
    of the key, or of the whole row, not by position."""
    chosen = HASHES[hash_name](df, list(key) or None)
    return F.pmod(chosen, F.lit(every)) == 0


def diff(source: DataFrame, target: DataFrame, buckets: int = DIFF_BUCKETS) -> DataFrame:
    """The rows that differ: the columns, ``side`` (which table has more of the
    row) and ``copies`` (how many more).

    Ever fewer rows are looked at ever more closely. Both tables are reduced to one hash
    sum per bucket of row hashes, so equal tables shuffle nothing but ``buckets`` sums.
    Within buckets that differ two hashes of each row and a signed count move, 24 bytes,
    so changes all over the tables do not move the rows beside them. Whole rows move only
    where the counts do not cancel out, and with them one row in eight or less that shares
    a bit of a broadcast filter with those; more if over ``FILTER_BITS / ROW_BITS`` rows
    differ. Equal rows are counted before they move; a row repeated a billion times travels
    once per task. Two different rows are taken for one if both their 64-bit hashes agree.
    """
    columns = source.columns
    target = target.select(*[f"`{c}`" for c in columns])
    both = _tagged(source, 1).unionByName(_tagged(target, -1))
    bucket = F.pmod("_hash", F.lit(buckets)).cast("int")
    off = (
        both.groupBy(bucket.alias("_bucket"))
        .agg(F.sum("_sign").alias("rows"), exact_sum(F.col("_hash").cast("decimal(28,0)") * F.col("_sign")).alias("content"))
        .where((F.col("rows") != 0) | (F.col("content") != 0))
        .select("_bucket")
    )
    # at most `buckets` integers
    suspects = both.withColumn("_bucket", bucket).join(F.broadcast(off), "_bucket", "left_semi")
    hashes = (
        suspects.groupBy("_hash", "_other")
        .agg(F.sum("_sign").alias("_more"))
        .where("_more != 0")
        .select("_hash")
    )
    # written, so that their number decides the size of the filter
    hashes = materialize(hashes, work_dir(source.sparkSession, "differing"))
    # rows that only share a bit cancel out as they are counted
    return (
        _likely_in(suspects, hashes)
        .groupBy(*[f"`{c}`" for c in columns])
        .agg(F.sum("_sign").alias("more"))
        .where("more != 0")
        .select(
            *[f"`{c}`" for c in columns],
            F.when(F.col("more") > 0, "source").otherwise("target").alias("side"),
            F.abs("more").alias("copies"),
        )
    )


def _likely_in(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """Rows whose ``_hash`` may be among ``hashes``: all that are, and some that share a bit
    with one. Rows do not move to be found."""
    bits = min(FILTER_BITS, max(1 << 16, 1 << (ROW_BITS * hashes.count()).bit_length()))
    at = F.pmod("_hash", F.lit(bits)).alias("_other")
    # the columns' own names again, as a table may have any other: place of the bit, its group
    group = F.expr(f"_other div {64 * GROUP_WORDS}")
    word = F.expr(f"cast(_other div 64 % {GROUP_WORDS} as int)")
    inside = F.expr("cast(_other % 64 as int)")
    set_bit = F.expr("shiftleft(1L, cast(_other % 64 as int))")
    words = F.array(
        *[F.bit_or(F.when(word == i, set_bit).otherwise(F.lit(0).cast("bigint"))) for i in range(GROUP_WORDS)]
    )
    # dealt by group first: a hash is smaller than the group it falls in
    marks = (
        hashes.select(at).withColumn("_bucket", group).repartition("_bucket")
        .groupBy("_bucket").agg(words.alias("_hash"))
    )
    placed = rows.withColumn("_other", at).withColumn("_bucket", group).drop("_hash")
    found = placed.join(F.broadcast(marks), "_bucket")
    return found.where(F.getbit(F.get("_hash", word), inside) == 1).drop("_hash", "_other", "_bucket")


def _tagged(df: DataFrame, sign: int) -> DataFrame:
    return df.select(
        *canonical_columns(df), row_hash(df).alias("_hash"), row_hash(df, seed=1).alias("_other"),
        F.lit(sign).cast("bigint").alias("_sign"),
    )


def outcome(results: DataFrame) -> DataFrame:
    """One row about a run's per-table results: ``tables, failed_tables,
    any_failed, all_match`` (tables without a count do not speak against it)."""
    failed = F.col("status") == "failed"
    names = F.array_sort(F.collect_list(F.when(failed, F.col("table_name"))))
    return results.agg(
        F.count(F.lit(1)).alias("tables"),
        names.alias("failed_tables"),
        F.coalesce(F.bool_or(failed), F.lit(False)).alias("any_failed"),
        F.coalesce(F.bool_and("match"), F.lit(True)).alias("all_match"),
    )
