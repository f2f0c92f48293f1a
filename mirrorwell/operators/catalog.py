"""Facts about tables as DataFrames: columns, sizes, presence, constraints."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorwell.operators.project import UNWRITABLE, WIDE
from mirrorwell.session import facts_frame, materialize, work_dir

CONSTRAINTS = T.StructType(
    [
        T.StructField("owner", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("constraint_name", T.StringType()),
        T.StructField("constraint_type", T.StringType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("r_owner", T.StringType()),
        T.StructField("r_constraint_name", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)
COLUMNS = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_id", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
    ]
)
PROFILE = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("files", T.LongType()),
        T.StructField("size_mb", T.DoubleType()),
        T.StructField("splits", T.LongType()),
        T.StructField("partitioned", T.BooleanType()),
        T.StructField("wide", T.BooleanType()),
        T.StructField("refused", T.BooleanType()),
    ]
)


def primary_key(owner: str, table: str, columns: Sequence[str]) -> tuple:
    return (owner, table, f"PK_{table}", "P", list(columns), None, None, "ENABLED")


def foreign_key(
    owner: str, table: str, columns: Sequence[str], parent: str, parent_owner: str | None = None,
    name: str | None = None,
) -> tuple:
    name = name or f"FK_{table}_{parent}"
    return (owner, table, name, "R", list(columns), parent_owner or owner, f"PK_{parent}", "ENABLED")


def column_catalog(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Columns in declaration order, numbered from 1."""
    rows = [
        (table, i, f.name, f.dataType.simpleString())
        for table, df in frames.items()
        for i, f in enumerate(df.schema, 1)
    ]
    return facts_frame(spark, rows, COLUMNS).orderBy("table_name", "column_id")


def column_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, column_id, column_name, data_type, filled)``: the column
    catalog with the number of values that are not NULL, one scan per table."""
    parts = []
    for table, df in frames.items():
        facts = [
            F.struct(
                F.lit(i).alias("column_id"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.count(F.col(f"`{f.name}`")).alias("filled"),
            )
            for i, f in enumerate(df.schema, 1)
        ]
        parts.append(
            df.agg(F.array(*facts).alias("facts")).select(
                F.lit(table).alias("table_name"), F.inline("facts")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def shape_flags(schema: T.StructType) -> tuple[bool, bool]:
    """``(wide, refused)``."""
    types = [f.dataType for f in schema]
    return any(isinstance(t, WIDE) for t in types), any(isinstance(t, UNWRITABLE) for t in types)


def table_profiles(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    sizes: Mapping[str, tuple[int, int, int]] | None = None,
    partitioned: Iterable[str] = (),
    counted: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """``table_name, rows, files, size_mb, splits, partitioned, wide, refused``.

    Sizes come from the pinned file listing, rows from the files' footers; no
    column is read. Unknown sizes count as 0 for the choice. ``counted`` gives frames
    with a ready ``rows`` value for tables that are better counted elsewhere.
    """
    sizes, partitioned = sizes or {}, set(partitioned)
    facts = []
    for table, df in frames.items():
        files, length, splits = sizes.get(table, (0, 0, 0))
        wide, refused = shape_flags(df.schema)
        facts.append((table, files, length / 1048576, splits, table in partitioned, wide, refused))
    counts = {t: df.agg(F.count(F.lit(1)).alias("rows")) for t, df in frames.items()}
    counts |= counted or {}
    named = [
        df.select(F.lit(t).alias("table_name"), F.col("rows").cast("bigint").alias("rows"))
        for t, df in counts.items()
    ]
    known = facts_frame(spark, facts, PROFILE)
    return (
        reduce(DataFrame.unionByName, named)
        .join(known, "table_name")
        .select("table_name", "rows", *PROFILE.names[1:])
    )


def fk_listing(
    constraints: DataFrame, tables: DataFrame | None = None, owner: str | None = None
) -> DataFrame:
    """Foreign keys ``(owner, table_name, constraint_name, status)`` of the given
    tables, in name order. ``tables`` has ``owner, table_name``."""
    keys = constraints.where(F.col("constraint_type") == "R")
    if owner is not None:
        keys = keys.where(F.col("owner") == owner)
    if tables is not None:
        keys = keys.join(tables.select("owner", "table_name"), ["owner", "table_name"], "left_semi")
    return keys.select("owner", "table_name", "constraint_name", "status").orderBy(
        "owner", "table_name", "constraint_name"
    )


def select_tables(
    tables: DataFrame,
    owner: str | None = None,
    pattern: str | None = None,
    names: DataFrame | None = None,
) -> DataFrame:
    """Tables of a schema, of a name pattern, or listed in ``names``."""
    chosen = tables
    if owner is not None:
        chosen = chosen.where(F.col("owner") == owner)
    if pattern is not None:
        chosen = chosen.where(F.col("table_name").like(pattern))
    if names is not None:
        listed = names.select(F.upper(F.trim("table_name")).alias("table_name")).distinct()
        listed = materialize(listed, work_dir(tables.sparkSession, "listed"))
        chosen = chosen.join(listed, "table_name", "left_semi").select(*tables.columns)
    return chosen


def with_presence(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Wanted tables with ``status``: planned if the source has it, else skipped.
    Tables pair by all columns of ``present``."""
    here = materialize(present.distinct(), work_dir(present.sparkSession, "present"))
    here = here.withColumn("_here", F.lit(True))
    status: Column = F.when(F.col("_here"), "planned").otherwise("skipped")
    return wanted.join(here, present.columns, "left").withColumn("status", status).drop("_here")


def common_columns_of(source: DataFrame, target: DataFrame) -> DataFrame:
    """``(table_name, column_name)`` both column catalogs have, in any letter case,
    spelled and numbered as in the target."""
    have = source.select("table_name", F.upper("column_name").alias("_name")).distinct()
    return (
        target.withColumn("_name", F.upper("column_name"))
        .join(have, ["table_name", "_name"], "left_semi")
        .select("table_name", "column_id", "column_name")
    )
