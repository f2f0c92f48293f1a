"""What every source offers, and how a table is read at a snapshot."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Protocol, runtime_checkable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_ABSENT = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND")


class SourceError(RuntimeError):
    pass


class SnapshotTooOld(SourceError):
    """A file the snapshot needs is gone or was replaced."""


class Source(Protocol):
    """Tables by upper-case name."""

    pins_files: bool

    def read(self, spark: SparkSession, table: str) -> DataFrame: ...

    def location(self, spark: SparkSession, table: str) -> str: ...

    def describe(self) -> str: ...


@runtime_checkable
class HasExists(Protocol):
    """A source with a cheaper test than reading the schema."""

    def exists(self, spark: SparkSession, table: str) -> bool: ...


def table_exists(source: Source, spark: SparkSession, table: str) -> bool:
    try:
        if isinstance(source, HasExists):
            return source.exists(spark, table)
        source.read(spark, table).schema
    except AnalysisException as error:
        if error.getCondition() in _ABSENT:
            return False
        raise
    return True


def present(source: Source, spark: SparkSession, tables: Iterable[str]) -> list[str]:
    return [t for t in tables if table_exists(source, spark, t)]
