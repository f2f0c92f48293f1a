"""How to load each table, chosen from its size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorwell.config import AUTO, STRATEGIES

# The limits between the strategies.
DIRECT_COPY_MAX_MB = 250
DIRECT_COPY_MAX_ROWS = 1_000_000
PARALLEL_DML_MAX_MB = 2048
PARALLEL_DML_MAX_ROWS = 50_000_000
CHUNK_MB = 256

REFUSED = "refused"


def strategy_column(
    supports_chunks: bool | Column = True, override: str = AUTO
) -> Column:
    """Strategy name over a profile: ``rows, size_mb, wide, refused``.

    A table that cannot be written is ``refused`` whatever the override says.
    """
    if override != AUTO and override not in STRATEGIES:
        raise ValueError(f"unknown strategy {override!r}")
    chunks = supports_chunks if isinstance(supports_chunks, Column) else F.lit(supports_chunks)
    direct, parallel, chunked, _ = STRATEGIES
    below = lambda mb, rows: (F.col("size_mb") < mb) & (F.col("rows") < rows)
    chosen = (
        F.when(F.col("wide"), parallel)
        .when(below(DIRECT_COPY_MAX_MB, DIRECT_COPY_MAX_ROWS), direct)
        .when(below(PARALLEL_DML_MAX_MB, PARALLEL_DML_MAX_ROWS) | ~chunks, parallel)
        .otherwise(chunked)
    )
    return F.when(F.col("refused"), REFUSED).otherwise(
        chosen if override == AUTO else F.lit(override)
    )


def chunk_count_column(max_chunks: int) -> Column:
    """One chunk for every 256 MB, within 1 and ``max_chunks``."""
    wanted = F.ceil(F.col("size_mb") / CHUNK_MB).cast("int")
    return F.least(F.lit(max_chunks), F.greatest(F.lit(1), wanted))


def with_strategy(
    profiles: DataFrame,
    supports_chunks: bool | Column = True,
    override: str = AUTO,
    max_chunks: int = 4,
) -> DataFrame:
    return profiles.withColumn(
        "strategy", strategy_column(supports_chunks, override)
    ).withColumn("chunks", chunk_count_column(max_chunks))
