"""Where a job may write: the shared folder named in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_SETTING = "spark.checkpoint.dir"
_OWNER = "mirrorwell.scratch.owner"
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder of this session.

    A folder of our own is made only for a single-machine session that names
    none, as in tests; on a cluster a missing setting is an error, since a
    machine-local folder is not visible to the executors.
    """
    named = spark.conf.get(_SETTING, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="mirrorwell-")
    return _local_dirs[context.applicationId]


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder; nothing is created yet."""
    owner = spark.sparkContext.getLocalProperty(_OWNER)
    base = scratch_folder(spark, owner) if owner else shared_dir(spark)
    return f"{base}/{label}-{uuid.uuid4().hex[:12]}"


def scratch_folder(spark: SparkSession, owner: str) -> str:
    return f"{shared_dir(spark)}/{owner}"


@contextmanager
def scratch_of(spark: SparkSession, owner: str) -> Iterator[None]:
    """Work folders named inside, by this thread or by one that inherits its properties,
    lie in a folder of ``owner`` and are removed with it at the end, whatever happens.
    No DataFrame that is read later may depend on them."""
    context = spark.sparkContext
    before = context.getLocalProperty(_OWNER)
    context.setLocalProperty(_OWNER, owner)
    try:
        yield
    finally:
        context.setLocalProperty(_OWNER, before)
        remove_path(spark, scratch_folder(spark, owner))


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    if not path_exists(spark, path):
        return []
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    return [f.getPath().getName() for f in found]


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, there at once or not at all."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(hadoop)


def remove_path(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def facts_frame(spark: SparkSession, rows: Sequence, schema: T.StructType) -> DataFrame:
    """A few rows of facts about tables as a local relation: no Python workers, and
    the optimizer sees the values."""
    named = [r if isinstance(r, dict) else dict(zip(schema.names, r)) for r in rows]
    table = pa.Table.from_pylist(named, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


# Loop states of up to this many rows, counted first, stay a local relation.
SMALL_STATE = 10_000


class LoopState:
    """Keeps what a loop of joins hands from one round to the next.

    Every state is written, so no round depends on the executors of an earlier one.
    Only if all inputs were counted to be small do the states, which cannot outgrow
    them, stay local relations: a foreign-key catalogue of a few dozen rows is not
    worth a write per round.
    """

    def __init__(self, spark: SparkSession, label: str, small: bool = False):
        """``small`` tells that the inputs are known to be small."""
        self.spark = spark
        self.folder = work_dir(spark, label)
        self.small = small
        self.kept = 0
        self.counted: dict[DataFrame, int] = {}

    def inputs(self, *frames: DataFrame) -> list[DataFrame]:
        if self.small:
            return [self.keep(df) for df in frames]
        written = [self.keep(df) for df in frames]
        self.small = all(df.count() <= SMALL_STATE for df in written)
        return [self.keep(df) for df in written] if self.small else written

    def keep(self, df: DataFrame) -> DataFrame:
        if self.small:
            rows = [r.asDict() for r in df.collect()]
            local = facts_frame(self.spark, rows, df.schema)
            self.counted[local] = len(rows)
            return local
        self.kept += 1
        return materialize(df, f"{self.folder}/{self.kept}")

    def settle(self, df: DataFrame) -> DataFrame:
        """Write a side that was just grouped by the key it is joined on. Joined in
        the same plan it would need no exchange of its own, and a skewed other side
        could then not be split at run time."""
        return df if self.small else self.keep(df)

    def count(self, df: DataFrame) -> int:
        """Rows of a kept state: known, or from the footers of what was written."""
        return self.counted[df] if df in self.counted else df.count()


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    The result no longer depends on the executors that computed it, and the
    planner sees its real size.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
