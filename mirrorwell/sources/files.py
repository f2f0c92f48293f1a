"""Tables kept as files under a root folder, and snapshots of their file lists.

Plain files have no commit clock, so a snapshot is the list of files that were
there when the job was planned: path, size and modification time. Reads go to
exactly those files. How consistent the tables are with each other is up to
whoever writes them; a snapshot adds that the job sees one state throughout.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorwell.session import facts_frame, materialize, path_exists
from mirrorwell.sources.base import SnapshotTooOld, Source, SourceError

# A listing has one small row per file, whatever the files' sizes: pack its tasks.
LISTING_TASKS = "512"

TABLES_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("root", T.StringType()),
        T.StructField("schema_json", T.StringType()),
    ]
)


@dataclass(frozen=True)
class FileSource:
    """``<root>/<name><suffix>`` for each table, a file or a folder of files."""

    root: str
    suffix: str = ".parquet"
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    lower_case: bool = True
    pins_files: bool = True

    def location(self, spark: SparkSession, table: str) -> str:
        name = table.lower() if self.lower_case else table
        return f"{self.root.rstrip('/')}/{name}{self.suffix}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        return reader.load(self.location(spark, table))

    def exists(self, spark: SparkSession, table: str) -> bool:
        return path_exists(spark, self.location(spark, table))

    def describe(self) -> str:
        return self.root


def footer_frames(
    spark: SparkSession, places: Mapping[str, tuple[str, T.StructType | None]]
) -> dict[str, DataFrame]:
    """Parquet tables by name, from ``(path, schema or None)``, whose MIN, MAX and COUNT over
    whole columns are pushed into the scan and answered from the files' footers.

    The two settings this takes are made in a session of their own.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    found = {}
    for table, (path, schema) in places.items():
        reader = session.read if schema is None else session.read.schema(schema)
        found[table] = reader.parquet(path)
    return found


@contextmanager
def packed_listing(spark: SparkSession):
    """Run a listing in few tasks: by default every large file would be its own."""
    setting = "spark.sql.files.maxPartitionNum"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, LISTING_TASKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def list_files(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """``(table_name, path, file_uri, length, modified_at, partition)``, one row per file.

    One listing for all tables. The ``binaryFile`` source lists in parallel and
    opens no file when its content is not selected. ``partition`` is the part of the
    path that tells partition values (``a=1/b=2``), empty if there is none.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(roots.values()))
        .select(
            "path",
            F.col("_metadata.file_path").alias("file_uri"),
            "length",
            F.col("modificationTime").alias("modified_at"),
        )
    )
    table = F.coalesce(
        *[_inside(F.col("path"), qualified(spark, root), name) for name, root in roots.items()]
    )
    inside = F.coalesce(*[
        F.when(F.startswith(F.col("path"), F.lit(base)), F.substring("path", F.lit(len(base) + 1), F.lit(1 << 30)))
        for base in (qualified(spark, root) + "/" for root in roots.values())
    ], F.lit(""))
    return listed.select(
        table.alias("table_name"), *listed.columns,
        F.regexp_extract(inside, "^((?:[^/=]+=[^/]*/)*)[^/]*$", 1).alias("partition"),
    ).withColumn("partition", F.rtrim("partition", F.lit("/")))


def _inside(path, root: str, name: str):
    return F.when((path == root) | F.startswith(path, F.lit(root + "/")), F.lit(name))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and host, spelled the way file listings spell it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop).toString()


class Snapshot:
    """The pinned file lists of one job, kept as two small tables."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self.pins = spark.read.parquet(f"{path}/pins")
        tables = spark.read.parquet(f"{path}/tables").collect()
        self.tables = {r.table_name: r for r in tables}

    @classmethod
    def capture(
        cls, source: Source, spark: SparkSession, tables: Iterable[str], path: str
    ) -> Snapshot:
        frames = {t: source.read(spark, t) for t in tables}
        roots = {t: qualified(spark, source.location(spark, t)) for t in frames}
        with packed_listing(spark):
            materialize(list_files(spark, roots).coalesce(8), f"{path}/pins")
        rows = [(t, roots[t], df.schema.json()) for t, df in frames.items()]
        facts_frame(spark, rows, TABLES_SCHEMA).coalesce(1).write.parquet(f"{path}/tables")
        return cls(spark, path)

    @property
    def sizes(self) -> dict[str, tuple[int, int, int]]:
        """Files, bytes and scan splits of every table, from the listing alone."""
        if not hasattr(self, "_sizes"):
            step = self.spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
                self.spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("bB")
            )
            stats = self.pins.groupBy("table_name").agg(
                F.count("path").alias("files"),
                F.sum("length").alias("bytes"),
                F.sum(F.ceil(F.col("length") / step)).alias("splits"),
                F.max("partition").alias("partition"),
            )
            rows = stats.collect()
            self._sizes = {r.table_name: (r.files, r.bytes, r.splits) for r in rows}
            self._partitions = {r.table_name: r.partition for r in rows}
        return self._sizes

    def partition_columns(self, table: str) -> tuple[str, ...]:
        """Columns the table's folders are named by, from the listing alone."""
        if table not in self.sizes or not self._partitions[table]:
            return ()
        names = {f["name"].lower(): f["name"] for f in json.loads(self.tables[table].schema_json)["fields"]}
        told = [unquote(step.split("=")[0]).lower() for step in self._partitions[table].split("/")]
        return tuple(names[n] for n in told if n in names)

    def read(self, table: str, source_format: str = "parquet", **options) -> DataFrame:
        """The table as of the snapshot; files added later are not seen.

        The pinned files are named one by one, however many there are, so no other file
        is opened. The scan's own file index holds the same names on the driver.
        """
        if table not in self.tables:
            raise SourceError(f"{table} is not part of the snapshot {self.path}")
        entry = self.tables[table]
        schema = T.StructType.fromJson(json.loads(entry.schema_json))
        reader = self.spark.read.schema(schema).format(source_format).options(**options)
        files = self.sizes.get(table, (0, 0, 0))[0]
        if files == 0:
            return facts_frame(self.spark, [], schema)
        paths = self._paths(table)
        if paths != [entry.root]:  # a folder: keep its partition columns
            reader = reader.option("basePath", entry.root)
        try:
            return reader.load(paths)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise SnapshotTooOld(f"{table}: a pinned file is gone") from error
            raise

    def _paths(self, table: str) -> list[str]:
        """The names of a table's files; read once for all tables."""
        if not hasattr(self, "_by_table"):
            self._by_table: dict[str, list[str]] = {}
            for r in self.pins.select("table_name", "path").collect():
                self._by_table.setdefault(r.table_name, []).append(r.path)
        return self._by_table[table]

    def changed_files(self, tables: Iterable[str] | None = None) -> DataFrame:
        """Pinned files that are gone or differ from what is there now."""
        wanted = list(tables if tables is not None else self.tables)
        pins = self.pins.where(F.col("table_name").isin(wanted))
        roots = {t: self.tables[t].root for t in wanted}
        gone = [t for t, root in roots.items() if not path_exists(self.spark, root)]
        if gone:
            return pins.where(F.col("table_name").isin(gone))
        now = list_files(self.spark, roots)
        return pins.join(now, ["table_name", "path", "length", "modified_at"], "left_anti")

    def check(self, tables: Iterable[str] | None = None) -> None:
        """Raise unless every pinned file is still what it was."""
        with packed_listing(self.spark):
            changed = self.changed_files(tables).select("table_name", "path")
            bad = changed.limit(5).collect()
            if bad:
                names = ", ".join(f"{r.table_name}: {r.path}" for r in bad)
                raise SnapshotTooOld(
                    f"{changed.count()} pinned files changed since the plan, among them {names}")
