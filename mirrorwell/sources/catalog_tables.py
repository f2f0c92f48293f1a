"""Tables registered in the session catalog."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from mirrorwell.sources.base import SourceError


@dataclass(frozen=True)
class CatalogSource:
    """``<database>.<table>``.

    ``as_of`` holds reader options such as ``versionAsOf`` for table formats that
    keep versions. With it the format pins the snapshot; without it the table's
    files are pinned, which needs a parquet table with a location.
    """

    database: str
    as_of: dict[str, str] = field(default_factory=dict)

    @property
    def pins_files(self) -> bool:
        return not self.as_of

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.options(**self.as_of).table(f"{self.database}.{table}")

    def exists(self, spark: SparkSession, table: str) -> bool:
        return spark.catalog.tableExists(f"{self.database}.{table}")

    def location(self, spark: SparkSession, table: str) -> str:
        facts = {
            r.col_name: r.data_type
            for r in spark.sql(f"DESCRIBE TABLE EXTENDED {self.database}.{table}").collect()
        }
        if facts.get("Provider", "").lower() != "parquet" or not facts.get("Location"):
            raise SourceError(f"{self.database}.{table} is not a parquet table: give as_of")
        return facts["Location"]

    def describe(self) -> str:
        return self.database
