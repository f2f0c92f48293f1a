"""What the operators share: words, ASCII lower case, row names, written states."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mirrorwell.session import materialize, remove_path, work_dir

#: White space that separates words: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is.

    Where no other character has a lower case this is the built-in ``lower``; elsewhere
    the 26 letters are translated, which takes longer.
    """
    plain = (F.octet_length(text) == F.char_length(text)) | ~text.rlike(
        r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def words_of(text: Column) -> Column:
    """The words of a text in order, as an array."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN))


def row_print(text: Column) -> Column:
    """Tells apart rows that share a doc_id but not the text."""
    return F.xxhash64(text)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Join condition on ``names`` under which null meets null."""
    on = left[names[0]].eqNullSafe(right[names[0]])
    for name in names[1:]:
        on &= left[name].eqNullSafe(right[name])
    return on


def shielded(docs: DataFrame, inner: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns called like an operator's ``inner`` ones renamed, and the names
    to give back at the end. Without such columns ``docs`` is returned as it is."""
    taken = {c.lower() for c in docs.columns} | {i.lower() for i in inner}
    back: dict[str, str] = {}
    for name in docs.columns:
        if name.lower() in {i.lower() for i in inner}:
            number = next(n for n in range(len(taken) + 1) if f"given{n}" not in taken)
            back[f"given{number}"] = name
            taken.add(f"given{number}")
    return docs.withColumnsRenamed({old: new for new, old in back.items()}) if back else docs, back


class Scratch:
    """Tables an operator writes on its way, under the shared folder.

    ``drop`` removes one that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = work_dir(spark, label)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            remove_path(self.spark, f"{self.folder}/{name}")


#: Bytes of rows that Spark hands to Python at once, about, inside :func:`small_batches`.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, what runs hands rows to Python some :data:`BATCH_BYTES` at a time, however
    wide they are. Otherwise a batch is 10,000 rows, which both Spark and the worker hold
    more than once."""
    before = spark.conf.getAll.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, before)


#: Broadcast filters hold at most so many bucket numbers, whatever the input.
FILTER_BUCKETS = 1 << 18


def likely_in(df: DataFrame, keys: DataFrame, name: str, others: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``name`` may be among ``keys``: all that are, and some that
    share a bucket with one; or with ``others`` the rows that are left. What is broadcast
    is at most :data:`FILTER_BUCKETS` integers, so wide rows need not move to be found; an
    exact join has to follow."""
    bucket = F.pmod(F.xxhash64(name), F.lit(FILTER_BUCKETS)).cast("int")
    buckets = keys.select(bucket.alias("_bucket")).distinct()
    how = "left_anti" if others else "left_semi"
    return df.withColumn("_bucket", bucket).join(F.broadcast(buckets), "_bucket", how).drop("_bucket")


def input_bytes(df: DataFrame) -> int:
    """Bytes the planner expects of ``df``: the size of its files where it has any."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else df.count() * 4096
