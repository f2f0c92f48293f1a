"""Names: identifiers, table lists, schema remaps, trigger text, job ids."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: the trigger statement that fills a column from a sequence,
# ":new.<column> := [<schema>.]<sequence>.nextval", in any letter case.
SEQUENCE_ASSIGNMENT = (
    r"(?i):new\.([a-z0-9_$#]+)\s*:?=\s*(?:[a-z0-9_$#]+\.)?([a-z0-9_$#]+)\.nextval"
)


def identifier(name: str) -> str:
    return name.strip().upper()


def table_list(names: Iterable[str]) -> list[str]:
    """Upper-cased names in first-seen order, without blanks and repeats."""
    return list(dict.fromkeys(identifier(n) for n in names if n.strip()))


def split_table_list(text: Column) -> Column:
    """The same for a column of comma-separated text, as an array."""
    names = F.transform(F.split(text, ","), lambda n: F.upper(F.trim(n)))
    return F.array_distinct(F.filter(names, lambda n: n != ""))


def remap_schema(qualified: Column, source: str, target: str) -> Column:
    """``SOURCE.T`` to ``TARGET.T``; other schemas stay as they are."""
    prefix = f"{source}."
    return F.when(
        F.startswith(qualified, F.lit(prefix)),
        F.concat(F.lit(f"{target}."), F.substr(qualified, F.lit(len(prefix) + 1))),
    ).otherwise(qualified)


def job_name(at: Column, mark: Column) -> Column:
    """The name of a job begun ``at`` a UTC time, told from others by the hex ``mark``.

    Fixed format: ``j_``, date, ``_``, time, ``_`` and the mark, so names sort by time.
    """
    return F.concat(F.date_format(at, "'j'_yyyyMMdd_HHmmss_"), mark)


def new_job_id(spark: SparkSession) -> str:
    """A name no other job has: a version folder carries it, so 64 bits are random."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    mark = F.right(F.replace(F.uuid(), F.lit("-"), F.lit("")), F.lit(16))
    return spark.range(1).select(job_name(now, mark)).first()[0]
