"""The record of runs, as append-only event tables.

Files cannot be updated in place, so each change is one more event that sets the
fields it knows and leaves the others NULL. The state of a job or of one of its
tables is the last value set for every field. That is an aggregation, not a sorted
window: a job with a third of all events is still reduced where it is read.

``Ledger.compact`` keeps the events that the present states are told by and forgets
dropped jobs, so a ledger grows with its jobs and not with what happened to them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorwell.operators.publish import Generations, append_log, read_log, write_log
from mirrorwell.session import materialize, work_dir

# The states a job and a table may be in.
JOB_STATUSES = ("PLANNED", "RUNNING", "DONE", "FAILED", "CANCELLED")
TABLE_STATUSES = ("PLANNED", "RUNNING", "DONE", "FAILED", "SKIPPED", "CANCELLED")
TERMINAL_STATUSES = ("DONE", "FAILED", "CANCELLED")
#: States a table does not leave by itself.
TABLE_ENDS = tuple(s for s in TABLE_STATUSES if s not in ("PLANNED", "RUNNING"))
RESULT_STATUSES = {"ok": "DONE", "skipped": "SKIPPED", "failed": "FAILED"}
OTHER_RESULT = "CANCELLED"

_text, _long, _time = T.StringType(), T.LongType(), T.TimestampType()
JOB_EVENTS = T.StructType(
    [
        T.StructField("job_id", _text),
        T.StructField("seq", _long),
        T.StructField("event_at", _time),
        T.StructField("created_at", _time),
        T.StructField("source_endpoint", _text),
        T.StructField("target_endpoint", _text),
        T.StructField("source_schema", _text),
        T.StructField("target_schema", _text),
        T.StructField("snapshot_id", _text),
        T.StructField("config_json", _text),
        T.StructField("status", _text),
        T.StructField("error", _text),
    ]
)
TABLE_EVENTS = T.StructType(
    [
        T.StructField("job_id", _text),
        T.StructField("table_name", _text),
        T.StructField("seq", _long),
        T.StructField("event_at", _time),
        T.StructField("ordinal", _long),
        T.StructField("strategy", _text),
        T.StructField("rows_source", _long),
        T.StructField("rows_target", _long),
        T.StructField("status", _text),
        T.StructField("error", _text),
        T.StructField("sequences_reset", T.ArrayType(_text)),
    ]
)
JOB_FIELDS = tuple(JOB_EVENTS.names[3:10])
TABLE_FIELDS = ("ordinal", "strategy", "rows_source", "rows_target", "status", "error", "sequences_reset")


def last_set(name: str, order: str = "seq") -> Column:
    """The last value of a field that an event has set."""
    return F.max_by(name, F.when(F.col(name).isNotNull(), F.col(order))).alias(name)


def _times(terminal: Column) -> list[Column]:
    return [
        F.min(F.when(F.col("status") == "RUNNING", F.col("event_at"))).alias("started_at"),
        F.max(F.when(terminal, F.col("event_at"))).alias("ended_at"),
    ]


def current_jobs(events: DataFrame, fields: Sequence[str] = JOB_FIELDS) -> DataFrame:
    """One row per job. An error belongs to the status change that reported it, so
    a later status clears it."""
    changed = F.when(F.col("status").isNotNull(), F.col("seq"))
    return events.groupBy("job_id").agg(
        *[last_set(f) for f in fields],
        F.max_by("status", changed).alias("status"),
        F.max_by("error", changed).alias("error"),
        *_times(F.col("status").isin(*TERMINAL_STATUSES)),
    )


def current_tables(events: DataFrame, fields: Sequence[str] = TABLE_FIELDS) -> DataFrame:
    """One row per job and table."""
    over = F.col("status").isin(*TABLE_ENDS)
    return events.groupBy("job_id", "table_name").agg(*[last_set(f) for f in fields], *_times(over))


def deciding_events(events: DataFrame, keys: Sequence[str], fields: Sequence[str], ends: Sequence[str]) -> DataFrame:
    """``(*keys, seq)`` of the events that :func:`current_jobs` and :func:`current_tables`
    tell the state by: the last that sets each field, the last with a status, the first
    start and the last end. At most one per field and three more for each key."""
    seqs = [F.max(F.when(F.col(f).isNotNull(), F.col("seq"))) for f in dict.fromkeys([*fields, "status", "error"])]
    started = F.min_by("seq", F.when(F.col("status") == "RUNNING", F.col("event_at")))
    ended = F.max_by("seq", F.when(F.col("status").isin(*ends), F.col("event_at")))
    # an event that sets nothing still tells that its key is there
    told = events.groupBy(*keys).agg(F.array_distinct(F.array_compact(
        F.array(*seqs, started, ended, F.max("seq")))).alias("_seqs"))
    return told.select(*keys, F.explode("_seqs").alias("seq"))


def compacted(events: DataFrame, keys: Sequence[str], fields: Sequence[str], ends: Sequence[str]) -> DataFrame:
    """The deciding events, whole. Every state told by them is the one told by all. What
    decides is written first: joined in the plan that groups by the key, a key with very
    many events could not be split."""
    decide = materialize(
        deciding_events(events, keys, fields, ends), work_dir(events.sparkSession, "deciding"))
    return events.join(decide, [*keys, "seq"], "left_semi").select(*events.columns)


# The part of a stored configuration that listings show.
CONFIG_FIELDS = (
    "source_schema string, target_schema string, tables array<string>, commit_mode string, "
    "strategy string, verify string"
)


def with_config(jobs: DataFrame) -> DataFrame:
    """Jobs with the fields of their stored configuration."""
    read = F.from_json("config_json", CONFIG_FIELDS)
    kept = [c for c in jobs.columns if c not in ("config_json", "source_schema", "target_schema")]
    return jobs.select(*kept, read.alias("_config")).select(*kept, "_config.*")


def newest_jobs(jobs: DataFrame, limit: int = 100) -> DataFrame:
    return jobs.orderBy(F.desc("created_at"), F.desc("job_id")).limit(limit)


def without_jobs(events: DataFrame, dropped: DataFrame) -> DataFrame:
    """Events of jobs that are kept: deleting a job deletes its tables with it.

    Give ``dropped`` as a written table: derived in the same plan by grouping on the
    job, it would keep a job with very many events from being split.
    """
    gone = dropped.select("job_id")
    return events.join(gone, "job_id", "left_anti").select(*events.columns)


def ledger_status(result: str | Column) -> Column:
    """Ledger state for a result state; whatever is neither ok, skipped nor failed
    was cancelled."""
    column = F.col(result) if isinstance(result, str) else result
    mapped = F.lit(OTHER_RESULT)
    for status, state in RESULT_STATUSES.items():
        mapped = F.when(column == status, state).otherwise(mapped)
    return mapped


class Ledger:
    """Job and table events under one folder. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.generations = Generations(spark, self.root, ["jobs", "tables", "dropped"])

    def job_events(self) -> DataFrame:
        kept = read_log(self.spark, self.generations.path("jobs"), JOB_EVENTS)
        return without_jobs(kept, self._dropped())

    def table_events(self) -> DataFrame:
        kept = read_log(self.spark, self.generations.path("tables"), TABLE_EVENTS)
        return without_jobs(kept, self._dropped())

    def compact(self, nobody_writes: bool = False) -> None:
        """Rewrite the ledger as the events its states are told by. Dropped jobs leave it,
        and so does the list of them. Refused while a job runs, which could write meanwhile;
        ``nobody_writes`` tells that jobs shown as running were lost with their drivers."""
        running = self.jobs().where("status = 'RUNNING'").select("job_id").limit(1).collect()
        if running and not nobody_writes:
            raise ValueError(f"job {running[0].job_id} is running")

        def write(folder: str) -> None:
            jobs = compacted(self.job_events(), ["job_id"], JOB_FIELDS, TERMINAL_STATUSES)
            write_log(jobs, f"{folder}/jobs")
            tables = compacted(self.table_events(), ["job_id", "table_name"], TABLE_FIELDS, TABLE_ENDS)
            write_log(tables, f"{folder}/tables")

        self.generations.advance(write)

    def jobs(self) -> DataFrame:
        return current_jobs(self.job_events())

    def job(self, job_id: str):
        """The job's row, or None. Only this job's events are read."""
        mine = self.job_events().where(F.col("job_id") == job_id)
        rows = current_jobs(mine).collect()
        return rows[0] if rows else None

    def status(self, job_id: str) -> str | None:
        mine = self.job_events().where(F.col("job_id") == job_id)
        return mine.agg(last_set("status")).first().status

    def tables(self, job_id: str) -> DataFrame:
        mine = self.table_events().where(F.col("job_id") == job_id)
        return current_tables(mine).orderBy("ordinal", "table_name")

    def newest(self, limit: int = 100) -> DataFrame:
        return newest_jobs(self.jobs(), limit)

    def record_job(self, job_id: str, **fields) -> None:
        _check(fields.get("status"), JOB_STATUSES)
        created = ["created_at"] if fields.get("status") == "PLANNED" else []
        self._append("jobs", JOB_EVENTS, [{"job_id": job_id, **fields}], created)

    def record_tables(self, job_id: str, rows: Sequence[dict]) -> None:
        for row in rows:
            _check(row.get("status"), TABLE_STATUSES)
        self._append("tables", TABLE_EVENTS, [{"job_id": job_id, **row} for row in rows])

    def drop(self, job_id: str) -> None:
        """Forget a job and its tables; refused while it is running."""
        job = self.job(job_id)
        if job is None:
            raise KeyError(f"unknown job {job_id}")
        if job.status == "RUNNING":
            raise ValueError(f"job {job_id} is running; cancel it first")
        append_log(self.spark, self.generations.path("dropped"), [{"job_id": job_id}], _DROPPED)

    def drop_jobs(self, jobs: DataFrame) -> None:
        """Forget all jobs in ``jobs`` (by ``job_id``) that are not running."""
        running = self.jobs().where("status = 'RUNNING'")
        gone = jobs.select("job_id").distinct().join(running, "job_id", "left_anti")
        gone.write.mode("append").parquet(self.generations.path("dropped"))

    def _dropped(self) -> DataFrame:
        return read_log(self.spark, self.generations.path("dropped"), _DROPPED)

    def _append(
        self, name: str, schema: T.StructType, rows: Sequence[dict], stamp: Sequence[str] = ()
    ) -> None:
        if not rows:
            return
        path = self.generations.path(name)
        seq = read_log(self.spark, path, schema).agg(F.max("seq")).first()[0] or 0
        complete = [
            {"seq": seq + i, **row, "error": row.get("error") or None}
            for i, row in enumerate(rows, 1)
        ]
        append_log(self.spark, path, complete, schema, ["event_at", *stamp])


_DROPPED = T.StructType([T.StructField("job_id", _text)])


def _check(status: str | None, allowed: tuple[str, ...]) -> None:
    if status is not None and status not in allowed:
        raise ValueError(f"status {status!r} is not one of {allowed}")
