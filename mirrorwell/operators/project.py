"""Fit a source onto a target whose columns have drifted."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class NoCommonColumns(ValueError):
    pass


class UnwritableType(ValueError):
    """A column type the sink cannot store."""


# Types a parquet sink refuses.
UNWRITABLE = (T.CalendarIntervalType,)
# Types that make a table "wide": large values, or values of open length.
WIDE = (T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)


def common_columns(source: T.StructType, target: T.StructType) -> list[str]:
    """Target columns the source has too, in target order and spelling."""
    have = {name.lower() for name in source.names}
    return [name for name in target.names if name.lower() in have]


def project_to_target(
    source: DataFrame,
    target: T.StructType,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """The source in the shape of the target.

    Columns pair by name in any letter case. Columns only the source has are not
    read at all; columns only the target has take their default, or NULL.
    """
    if not common_columns(source.schema, target):
        raise NoCommonColumns(
            f"source {source.schema.names} and target {target.names} share no column"
        )
    spelled = {f.name.lower(): f for f in source.schema}
    defaults = {k.lower(): v for k, v in (defaults or {}).items()}
    columns = []
    for wanted in target:
        have = spelled.get(wanted.name.lower())
        if have is None:
            value = F.lit(defaults.get(wanted.name.lower())).cast(wanted.dataType)
        else:
            value = F.col(f"`{have.name}`")
            if have.dataType != wanted.dataType:
                value = value.cast(wanted.dataType)
        columns.append(value.alias(wanted.name))
    return source.select(*columns)


def check_writable(table: str, schema: T.StructType) -> None:
    bad = [f.name for f in schema if isinstance(f.dataType, UNWRITABLE)]
    if bad:
        raise UnwritableType(f"{table}: columns {bad} cannot be written; drop or convert them")
