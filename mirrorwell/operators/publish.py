"""Versions of target tables and the manifest that says which one is current.

A load writes ``<root>/tables/<TABLE>/v=<job>/`` and touches nothing else.
Publishing appends one file of rows to ``<root>/manifest``; a file appears whole
or not at all, so all tables named in it switch together. Until then, and for
good if a check fails, readers keep the version they had. One writer per target.

A version is one manifest row. A table whose partitions were exchanged has one row per
partition instead, each naming the version that holds it: untouched partitions are
carried over by reference, and nothing is copied or changed in place.

Logs grow by one small file per append. ``compact`` writes what still matters as a new
generation of the log and switches to it by one marker file; see :class:`Generations`.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorwell.session import (
    child_names, facts_frame, materialize, path_exists, remove_path, touch, work_dir,
)
from mirrorwell.sources.files import qualified

MANIFEST = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("job_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("version_path", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("schema_json", T.StringType()),
        T.StructField("partition_columns", T.ArrayType(T.StringType())),
        T.StructField("partition", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Version:
    """What a load wrote. ``exchange`` replaces only the partitions it has rows of;
    without a path the table is empty."""

    table: str
    path: str | None
    rows: int | None
    schema: T.StructType
    partition_columns: tuple[str, ...] = ()
    exchange: bool = False


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An append-only table; empty if nothing has been written yet."""
    if not path_exists(spark, path):
        return facts_frame(spark, [], schema)
    return spark.read.schema(schema).parquet(path)


def append_log(
    spark: SparkSession,
    path: str,
    rows: Sequence[dict],
    schema: T.StructType,
    stamp: Sequence[str] = (),
) -> None:
    """Add rows as one file, hence all at once; ``stamp`` columns get the time."""
    named = [{name: row.get(name) for name in schema.names} for row in rows]
    stamped = {name: F.current_timestamp() for name in stamp}
    added = facts_frame(spark, named, schema).withColumns(stamped)
    added.coalesce(1).write.mode("append").parquet(path)


class Generations:
    """The logs under ``root`` and their compacted successors.

    Generation 0 are the logs as they were begun, in ``root`` itself; generation n lies in
    ``<root>/generations/<n>`` and counts once ``<n>.ready`` stands beside it. A compaction
    that is lost on the way leaves no marker, so readers keep the generation they had and
    the next attempt overwrites what is there. The generation before the current one stays,
    for readers that planned on it; older ones are removed.
    """

    def __init__(self, spark: SparkSession, root: str, logs: Sequence[str]):
        self.spark = spark
        self.root = root
        self.logs = tuple(logs)

    def number(self) -> int:
        names = child_names(self.spark, f"{self.root}/generations")
        return max((int(n.removesuffix(".ready")) for n in names if n.endswith(".ready")), default=0)

    def folder(self, number: int) -> str:
        return f"{self.root}/generations/{number}" if number else self.root

    def path(self, log: str) -> str:
        return f"{self.folder(self.number())}/{log}"

    def advance(self, write: Callable[[str], None]) -> int:
        """``write`` fills the next generation's folder; then it is the current one."""
        number = self.number() + 1
        remove_path(self.spark, self.folder(number))
        write(self.folder(number))
        touch(self.spark, f"{self.folder(number)}.ready")
        if number >= 2:
            self._remove(number - 2)
        return number

    def _remove(self, number: int) -> None:
        if number == 0:
            for log in self.logs:
                remove_path(self.spark, f"{self.root}/{log}")
            return
        remove_path(self.spark, f"{self.folder(number)}.ready")
        remove_path(self.spark, self.folder(number))


def write_log(log: DataFrame, path: str) -> None:
    """A log in as few files as its size asks for."""
    log.hint("rebalance").write.parquet(path)


class Target:
    """A folder of published tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.generations = Generations(spark, self.root, ["manifest"])

    def version_path(self, table: str, job_id: str) -> str:
        return f"{self.root}/tables/{table}/v={job_id}"

    def manifest(self) -> DataFrame:
        return read_log(self.spark, self.generations.path("manifest"), MANIFEST)

    def compact(self) -> None:
        """Rewrite the manifest: of every table its newest rows, and one row for each older
        version, which is still on disk. Partition rows of older states go."""
        def write(folder: str) -> None:
            rows = self.manifest()
            newest = rows.groupBy("table_name").agg(F.max("seq").alias("_newest"))
            newest = materialize(newest, work_dir(self.spark, "newest"))
            dated = rows.join(newest, "table_name")
            current = dated.where(F.col("seq") == F.col("_newest")).select(*MANIFEST.names)
            older = (
                dated.where(F.col("seq") < F.col("_newest"))
                .groupBy("table_name", "version_path")
                .agg(F.max_by(F.struct(*MANIFEST.names), "seq").alias("_row"))
                .select("_row.*")
            )
            write_log(current.unionByName(older), f"{folder}/manifest")

        self.generations.advance(write)

    def current(self) -> DataFrame:
        """What is published of every table: as the manifest, but one row per table, with the
        number of its ``parts``; a table kept by partitions has no single ``version_path``."""
        same = ("published_at", "job_id", "schema_json", "partition_columns")
        told = self.manifest().groupBy("table_name", "seq").agg(
            *[F.any_value(c).alias(c) for c in same],
            F.sum("rows").alias("rows"), F.count("partition").alias("parts"),
            F.max(F.when(F.col("partition").isNull(), F.col("version_path"))).alias("version_path"),
        )
        newest = F.max_by(F.struct(*told.columns), "seq").alias("newest")
        return told.groupBy("table_name").agg(newest).select("newest.*")

    def parts(self, entry) -> DataFrame:
        """``(partition, version_path, rows)`` of a published table with partitions."""
        if entry.parts:
            of_table = (F.col("table_name") == entry.table_name) & (F.col("seq") == entry.seq)
            return self.manifest().where(of_table).select("partition", "version_path", "rows")
        schema = T.StructType.fromJson(json.loads(entry.schema_json))
        return self.written_parts(entry.version_path, schema, len(entry.partition_columns))

    def written_parts(self, path: str, schema: T.StructType, depth: int) -> DataFrame:
        """``(partition, version_path, rows)`` of a version written by ``depth`` partition
        columns, from its footers."""
        root = qualified(self.spark, path)
        # a file's address is escaped once more than its name
        name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        found = self.spark.read.schema(schema).parquet(path).groupBy(
            F.regexp_extract(name, f"/((?:[^/=]+=[^/]*/){{{depth}}})[^/]*$", 1).alias("partition"))
        return found.agg(F.count(F.lit(1)).alias("rows")).select(
            F.rtrim("partition", F.lit("/")).alias("partition"), F.lit(root).alias("version_path"), "rows")

    def entry(self, table: str):
        rows = self.current().where(F.col("table_name") == table).collect()
        return rows[0] if rows else None

    def entries(self) -> dict:
        return {r.table_name: r for r in self.current().collect()}

    def read(self, table: str, entry=None, written_to: str | None = None) -> DataFrame:
        """A published table; with ``written_to`` only the partitions that version holds."""
        entry = entry or self.entry(table)
        if entry is None:
            raise KeyError(f"{table} has not been published in {self.root}")
        schema = T.StructType.fromJson(json.loads(entry.schema_json))
        if entry.parts:
            parts = self.parts(entry)
            if written_to is not None:
                parts = parts.where(F.col("version_path") == qualified(self.spark, written_to))
            return self._read_parts(parts, schema)
        if entry.version_path is None:
            return facts_frame(self.spark, [], schema)
        return self.read_version(entry.version_path, schema)

    def _read_parts(self, parts: DataFrame, schema: T.StructType) -> DataFrame:
        """The partitions' folders, named one by one, as a scan per version that holds some:
        filters on partition columns still leave out folders."""
        by_version: dict[str, list[str]] = {}
        for r in parts.select("version_path", "partition").collect():
            by_version.setdefault(r.version_path, []).append(f"{r.version_path}/{r.partition}")
        if not by_version:
            return facts_frame(self.spark, [], schema)
        frames = [
            self.spark.read.schema(schema).option("basePath", root).parquet(*sorted(folders))
            .select(*[f"`{n}`" for n in schema.names])
            for root, folders in sorted(by_version.items())
        ]
        return reduce(DataFrame.unionByName, frames)

    def read_version(self, path: str, schema: T.StructType) -> DataFrame:
        """A version's rows, without the chunk number of a staged load."""
        return self.spark.read.schema(schema).parquet(path).select(*[f"`{n}`" for n in schema.names])

    def publish(self, job_id: str, versions: Iterable[Version | tuple]) -> None:
        """Make versions (``Version`` or its first fields) current, all at the same moment.

        An exchange keeps the partitions it has no rows of; where there are none to keep, or
        the table was laid out otherwise, it is a version like any other.
        """
        versions = [v if isinstance(v, Version) else Version(*v) for v in versions]
        if not versions:
            return
        last = self.manifest().agg(F.max("seq")).first()[0] or 0
        entries = self.entries() if any(v.exchange for v in versions) else {}
        rows, parts = [], []
        for v in versions:
            row = {
                "seq": last + 1, "job_id": job_id, "table_name": v.table, "version_path": v.path,
                "rows": v.rows, "schema_json": v.schema.json(),
                "partition_columns": list(v.partition_columns) or None,
            }
            before = entries.get(v.table)
            if v.exchange and before is not None and _same_layout(before, v):
                parts.append(self._exchanged(row, v, before))
            else:
                rows.append(row)
        if not parts:
            append_log(self.spark, self.generations.path("manifest"), rows, MANIFEST, ["published_at"])
            return
        whole = facts_frame(self.spark, [{n: r.get(n) for n in MANIFEST.names} for r in rows], MANIFEST)
        added = reduce(DataFrame.unionByName, parts, whole).withColumn("published_at", F.current_timestamp())
        added.coalesce(1).write.mode("append").parquet(self.generations.path("manifest"))

    def _exchanged(self, row: dict, version: Version, before) -> DataFrame:
        """Manifest rows of a table some of whose partitions were replaced."""
        new = materialize(self.written_parts(version.path, version.schema, len(version.partition_columns)), work_dir(self.spark, "parts"))
        kept = self.parts(before).join(new.select("partition"), "partition", "left_anti")
        constant = {n: row.get(n) for n in MANIFEST.names if n not in new.columns}
        return kept.unionByName(new).select("*", *[
            F.array(*map(F.lit, v)).alias(n) if isinstance(v, list)
            else F.lit(v).cast(MANIFEST[n].dataType).alias(n)
            for n, v in constant.items()
        ]).select(*MANIFEST.names)

    def create_missing(
        self, shapes: Mapping[str, T.StructType], job_id: str,
        layouts: Mapping[str, Sequence[str]] | None = None,
    ) -> list[str]:
        """Publish an empty table for every shape that has no table yet, with the partition
        columns given for it; the names of those created. Nothing but the manifest is written."""
        known, layouts = self.entries(), layouts or {}
        created = [
            Version(table, None, 0, schema, tuple(layouts.get(table, ())))
            for table, schema in shapes.items() if table not in known
        ]
        self.publish(job_id, created)
        return [v.table for v in created]

    def discard(self, table: str, job_id: str) -> bool:
        """Remove a version that was never published. Best effort."""
        path = self.version_path(table, job_id)
        if not self.manifest().where(F.col("version_path") == path).isEmpty():
            return False
        return path_exists(self.spark, path) and remove_path(self.spark, path)


def _same_layout(entry, version: Version) -> bool:
    """Whether partitions of ``version`` can stand beside those that are published."""
    return (
        (entry.parts > 0 or entry.version_path is not None)
        and tuple(entry.partition_columns or ()) == version.partition_columns != ()
        and T.StructType.fromJson(json.loads(entry.schema_json)).names == version.schema.names
    )


def empty_clone(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """No rows, same columns."""
    return df.select(*(columns or df.columns)).limit(0)


