"""Tables of a remote database.

The snapshot goes into the table expression, as each partition of a JDBC read
opens its own connection and would otherwise see its own moment.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from mirrorwell.sources.base import SourceError


_SPLIT_OPTIONS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


@dataclass(frozen=True)
class KeyRange:
    """A numeric key to split the read by; rows outside the bounds are read too."""

    column: str
    lower: int
    upper: int
    partitions: int


@dataclass(frozen=True)
class JdbcSource:
    """``as_of`` is text placed behind the table name, e.g. ``AS OF SCN 12345``."""

    url: str
    schema: str
    options: dict[str, str] = field(default_factory=dict)
    as_of: str = ""
    ranges: dict[str, KeyRange] = field(default_factory=dict)
    pins_files: bool = False

    def read_options(self, table: str) -> dict[str, str]:
        name = f'"{self.schema}"."{table}"'
        relation = f"(SELECT * FROM {name} {self.as_of}) snap" if self.as_of else name
        found = {"url": self.url, "dbtable": relation, **self.options}
        if table in self.ranges:
            split = self.ranges[table]
            found |= {
                "partitionColumn": split.column,
                "lowerBound": str(split.lower),
                "upperBound": str(split.upper),
                "numPartitions": str(split.partitions),
            }
        return found

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.read_options(table)).load()

    def one_row_options(self, table: str, measures: str) -> dict[str, str]:
        """Options to read ``measures`` as one row worked out by the remote side."""
        options = self.read_options(table)
        plain = {k: v for k, v in options.items() if k not in _SPLIT_OPTIONS}
        return plain | {"dbtable": f"(SELECT {measures} FROM {options['dbtable']}) measured"}

    def _one_row(self, spark: SparkSession, table: str, measures: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.one_row_options(table, measures)).load()

    def count_frame(self, spark: SparkSession, table: str) -> DataFrame:
        """``rows``, counted without fetching any."""
        return self._one_row(spark, table, 'COUNT(*) AS "rows"')

    def split_by(self, spark: SparkSession, table: str, column: str, partitions: int) -> JdbcSource:
        """This source, reading ``table`` in ranges between the ends of a key."""
        ends = f'MIN("{column}") AS "low", MAX("{column}") AS "high"'
        return self.with_ends(table, column, partitions, *self._one_row(spark, table, ends).first())

    def with_ends(self, table: str, column: str, partitions: int, low, high) -> JdbcSource:
        if low is None or low == high:
            return self
        split = KeyRange(column, int(low), int(high) + 1, partitions)
        return replace(self, ranges={**self.ranges, table: split})

    def location(self, spark: SparkSession, table: str) -> str:
        raise SourceError("a remote table has no files to pin: give as_of")

    def describe(self) -> str:
        return self.url
