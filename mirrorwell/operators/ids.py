"""Id columns, the sequences that fill them, and where each must go on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorwell.functions.names import SEQUENCE_ASSIGNMENT
from mirrorwell.session import facts_frame

MARKS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("sequence_name", T.StringType()),
        T.StructField("next_value", T.LongType()),
    ]
)


def trigger_sequences(triggers: DataFrame) -> DataFrame:
    """``(owner, table_name, column_name, sequence_name)`` from trigger text.

    ``triggers`` has ``owner, table_name, body``. Each body is searched whole where
    it is read; only the names found travel to be made distinct.
    """
    group = lambda i: F.regexp_extract_all("body", F.lit(SEQUENCE_ASSIGNMENT), F.lit(i))
    return (
        triggers.where(F.col("body").isNotNull())
        .select(
            "owner",
            "table_name",
            F.explode(F.arrays_zip(group(1).alias("c"), group(2).alias("s"))).alias("hit"),
        )
        .select(
            "owner",
            "table_name",
            F.upper("hit.c").alias("column_name"),
            F.upper("hit.s").alias("sequence_name"),
        )
        .distinct()
    )


def id_columns(declared: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Declared identity columns and those found in triggers, each once."""
    columns = ["owner", "table_name", "column_name", "sequence_name"]
    both = declared.select(*columns)
    if found is not None:
        both = both.unionByName(found.select(*columns))
    return both.distinct()


def high_water_marks(
    frames: Mapping[str, DataFrame], columns: Sequence[tuple[str, str, str]],
    footers: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """``(table_name, column_name, sequence_name, next_value)`` for each
    ``(table, column, sequence)``: one above the greatest id, 1 for no ids.

    Tables in ``footers`` (``frames`` as ``sources.files.footer_frames`` reads them) are
    answered from the greatest value that each file's footer keeps per row group, so no
    column is read. Where a footer keeps none, as for a column of NULLs alone, the table
    is scanned like the others: once, however many id columns it has.
    """
    told = _answered(footers, [c for c in columns if c[0] in footers]) if footers else []
    if not told:
        return scan_marks(frames, columns)
    spark = next(iter(frames.values())).sparkSession
    known = facts_frame(spark, [r.asDict() for r in told], MARKS)
    answered = {r.table_name for r in told}
    rest = [c for c in columns if c[0] not in answered]
    return known.unionByName(scan_marks(frames, rest)) if rest else known


def _answered(footers: Mapping[str, DataFrame], columns: Sequence[tuple[str, str, str]]) -> list:
    """Marks of the tables whose footers give them: all in one job, or else table by table."""
    if not columns:
        return []
    try:
        return scan_marks(footers, columns).collect()
    except (PySparkException, Py4JJavaError) as error:
        if "No min/max found" not in str(error):
            raise
    tables = list(dict.fromkeys(c[0] for c in columns))
    if len(tables) == 1:
        return []
    return [row for t in tables for row in _answered(footers, [c for c in columns if c[0] == t])]


def scan_marks(
    frames: Mapping[str, DataFrame], columns: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """The same from one aggregate per table."""
    by_table: dict[str, list[tuple[str, str]]] = {}
    for table, column, sequence in columns:
        by_table.setdefault(table, []).append((column, sequence))
    parts = []
    for table, wanted in by_table.items():
        marks = [
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(sequence).alias("sequence_name"),
                (F.coalesce(F.max(f"`{column}`").cast("decimal(38,0)"), F.lit(0)) + 1)
                .cast("bigint").alias("next_value"),
            )
            for column, sequence in wanted
        ]
        parts.append(
            frames[table]
            .agg(F.array(*marks).alias("marks"))
            .select(F.lit(table).alias("table_name"), F.inline("marks"))
        )
    return reduce(DataFrame.unionByName, parts)
