"""Plan, run and verify a refresh.

A plan is made once: which tables, in which order, from which snapshot, by which
strategy. ``run_refresh`` and ``verify_job`` use the plan's snapshot, so all of them
see the same source rows. Rows never pass through the driver; what does is one
line of facts per table.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorwell.config import STRATEGIES, RefreshConfig
from mirrorwell.functions.hashing import exact_sum, row_hash
from mirrorwell.functions.names import new_job_id
from mirrorwell.operators import graph, ids, ledger, verify
from mirrorwell.operators.catalog import CONSTRAINTS, PROFILE, table_profiles
from mirrorwell.operators.load import STRATEGY_FUNCTIONS, LoadContext
from mirrorwell.operators.orphans import ForeignKey, check_foreign_keys, orphan_keys
from mirrorwell.operators.project import check_writable, project_to_target
from mirrorwell.operators.publish import Target, Version
from mirrorwell.operators.strategy import REFUSED, with_strategy
from mirrorwell.session import (
    SMALL_STATE, facts_frame, path_exists, remove_path, scratch_folder, scratch_of, work_dir,
)
from mirrorwell.sources.base import Source, SnapshotTooOld, present
from mirrorwell.sources.files import Snapshot, footer_frames

#: Seconds between two looks at the ledger while tables load.
POLL_SECONDS = 10.0

PLAN = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("requested", T.BooleanType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        *PROFILE.fields[1:],
        T.StructField("strategy", T.StringType()),
        T.StructField("chunks", T.IntegerType()),
    ]
)
RESULT = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("strategy", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_source", T.LongType()),
        T.StructField("rows_target", T.LongType()),
        T.StructField("match", T.BooleanType()),
        T.StructField("published", T.BooleanType()),
        T.StructField("sequences_reset", T.ArrayType(T.StringType())),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)
FK_RESULT = T.StructType(
    [
        T.StructField("constraint_name", T.StringType()),
        T.StructField("child_table", T.StringType()),
        T.StructField("parent_table", T.StringType()),
        T.StructField("orphan_rows", T.LongType()),
        T.StructField("orphan_values", T.LongType()),
        T.StructField("valid", T.BooleanType()),
    ]
)
_NODES = T.StructType(
    [T.StructField("owner", T.StringType()), T.StructField("table_name", T.StringType())]
)
_COMPARED = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("rows_source", T.LongType()),
        T.StructField("rows_target", T.LongType()),
        T.StructField("match", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Parent:
    """A table of another schema that keys refer to. It is read, never loaded."""

    table: str
    source: Source
    snapshot: Snapshot | None

    def read(self, spark: SparkSession) -> DataFrame:
        return _read_at(spark, self.source, self.snapshot, self.table)


def _read_at(spark: SparkSession, source: Source, snapshot: Snapshot | None, table: str) -> DataFrame:
    if snapshot is None:
        return source.read(spark, table)
    kind = getattr(source, "format", "parquet")
    return snapshot.read(table, kind, **getattr(source, "options", {}))


@dataclass
class Plan:
    """``rows`` holds one line of facts per table, parents first."""

    spark: SparkSession
    job_id: str
    config: RefreshConfig
    source: Source
    target: Target
    rows: list
    snapshot: Snapshot | None
    constraints: list
    recorded: bool
    entries: dict = field(default_factory=dict)
    parents: dict[str, Parent] = field(default_factory=dict)
    _sources: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def tables(self) -> DataFrame:
        return facts_frame(self.spark, [r.asDict() for r in self.rows], PLAN).orderBy("ordinal")

    @property
    def loadable(self) -> list[str]:
        return [r.table_name for r in self.rows if r.status != "skipped"]

    def read_source(self, table: str) -> DataFrame:
        if table not in self._sources:
            self._sources[table] = _read_at(self.spark, self.source, self.snapshot, table)
        return self._sources[table]

    def shape(self, table: str) -> T.StructType:
        """The schema the target will have: its own, or the source's if there is
        no target yet or it is to be re-created."""
        entry = self.entries.get(table)
        if entry is None or self.config.recreate_tables:
            return self.read_source(table).schema
        return T.StructType.fromJson(json.loads(entry.schema_json))

    def source_layout(self, table: str) -> tuple[str, ...]:
        return self.snapshot.partition_columns(table) if self.snapshot is not None else ()

    def layout(self, table: str) -> tuple[str, ...]:
        """Partition columns the target will have: its own, or the source's if there is no
        target yet or it is to be re-created."""
        entry = self.entries.get(table)
        if entry is None or self.config.recreate_tables:
            return self.source_layout(table)
        return tuple(entry.partition_columns or ())

    def projected(self, table: str) -> DataFrame:
        defaults = self.config.defaults.get(table)
        return project_to_target(self.read_source(table), self.shape(table), defaults)

    def primary_key(self, table: str) -> tuple[str, ...]:
        for c in self.constraints:
            if c.constraint_type == "P" and c.table_name == table and c.owner == self.config.source_schema:
                return tuple(c.columns)
        return ()

    def foreign_keys(self, tables: Sequence[str]) -> list[ForeignKey]:
        """Enabled keys of ``tables``. The parent of a key to another schema is named with
        that schema, or by what the key refers to there if that is not declared."""
        keys = {(c.owner, c.constraint_name): c for c in self.constraints
                if c.constraint_type in ("P", "U")}
        found = []
        for c in self.constraints:
            if c.constraint_type != "R" or c.table_name not in tables or c.status == "DISABLED":
                continue
            parent = keys.get((c.r_owner, c.r_constraint_name))
            if parent is None:
                to, columns = f"{c.r_owner}.{c.r_constraint_name}", ()
            else:
                own = parent.owner == self.config.source_schema
                to = parent.table_name if own else f"{parent.owner}.{parent.table_name}"
                columns = tuple(parent.columns)
            found.append(ForeignKey(c.constraint_name, c.table_name, tuple(c.columns), to, columns))
        return found

    def ledger(self) -> ledger.Ledger:
        return ledger.Ledger(self.spark, f"{self.target.root}/ledger")


@dataclass
class RefreshResult:
    job_id: str
    tables: DataFrame
    foreign_keys: DataFrame
    next_ids: DataFrame | None
    success: bool
    cancelled: bool
    errors: list[str] = field(default_factory=list)


def plan_refresh(
    spark: SparkSession,
    source: Source,
    target_root: str,
    config: RefreshConfig,
    constraints: DataFrame | None = None,
    snapshot_of: str | None = None,
    record: bool = True,
    schemas: Mapping[str, Source] | None = None,
) -> Plan:
    """Decide everything about a refresh without loading a row.

    ``snapshot_of`` takes the snapshot of an earlier job. With ``record=False``
    nothing is written under the target. Everything that can be refused, a column
    type or a missing common column, is refused here, before any table changes.
    ``schemas`` gives the sources of other schemas by name: their tables that keys refer to
    are pinned with the rest and read when the keys are checked.
    """
    job_id = new_job_id(spark)
    target = Target(spark, target_root)
    declared = _declared(spark, constraints, config.source_schema).collect()
    with scratch_of(spark, f"plan-{job_id}"):
        order = _order(spark, declared, config)
    names = [r.table_name for r in order]
    here = present(source, spark, names)

    snapshot = None
    if source.pins_files and config.consistent_read == "scn" and here:
        if snapshot_of is not None:
            snapshot = Snapshot(spark, f"{target.root}/snapshots/{snapshot_of}")
        else:
            path = f"{target.root}/snapshots/{job_id}" if record else work_dir(spark, "snapshot")
            snapshot = Snapshot.capture(source, spark, here, path)

    plan = Plan(
        spark, job_id, config, source, target, [], snapshot, declared, record,
        target.entries(),
    )
    if source.pins_files and config.consistent_read == "scn":
        folder = snapshot.path if snapshot is not None else work_dir(spark, "snapshot")
        plan.parents = _pinned_parents(plan, schemas or {}, f"{folder}/schemas")
    else:
        plan.parents = _live_parents(plan, schemas or {})
    frames = {t: plan.read_source(t) for t in here}
    for table in here:
        check_writable(table, frames[table].schema)
        plan.projected(table)
    facts = {}
    if here:
        counted = {}
        if hasattr(source, "count_frame"):
            counted = {t: source.count_frame(spark, t) for t in here}
        sizes = snapshot.sizes if snapshot else None
        partitioned = [t for t in here if plan.source_layout(t)]
        profiles = table_profiles(spark, frames, sizes, partitioned, counted)
        chosen = with_strategy(
            profiles, config.supports_chunks, config.strategy, config.max_chunks_per_table
        )
        facts = {r.table_name: r.asDict() for r in chosen.collect()}
    for ordinal, row in enumerate(order):
        known = facts.get(row.table_name, {})
        values = {
            **known,
            "table_name": row.table_name,
            "level": row.level,
            "ordinal": ordinal,
            "requested": row.table_name in config.tables,
            "status": "planned" if known else "skipped",
        }
        plan.rows.append(T.Row(**{f: values.get(f) for f in PLAN.names}))
    refused = [r.table_name for r in plan.rows if r.strategy == REFUSED]
    if refused:
        raise ValueError(f"columns of a type that cannot be written: {', '.join(refused)}")
    flat = [r.table_name for r in plan.rows if r.strategy == STRATEGIES[3] and not plan.layout(r.table_name)]
    if flat:
        raise ValueError(f"{STRATEGIES[3]} needs partitioned tables: {', '.join(flat)} is not")
    if record:
        _record_plan(plan)
    return plan


def _declared(spark: SparkSession, constraints: DataFrame | None, owner: str) -> DataFrame:
    if constraints is None:
        return facts_frame(spark, [], CONSTRAINTS)
    upper = ("owner", "table_name", "constraint_name", "r_owner", "r_constraint_name")
    named = constraints.select(
        *[F.upper(c).alias(c) if c in upper else F.col(c) for c in CONSTRAINTS.names]
    )
    own = named.where(F.col("owner") == owner)
    # of other schemas only the keys that are referred to
    meant = own.where((F.col("constraint_type") == "R") & (F.col("r_owner") != owner)).select(
        F.col("r_owner").alias("owner"), F.col("r_constraint_name").alias("constraint_name")).distinct()
    others = named.where((F.col("owner") != owner) & F.col("constraint_type").isin("P", "U"))
    others = others.join(meant, ["owner", "constraint_name"], "left_semi").select(*CONSTRAINTS.names)
    return own.unionByName(others)


def _parent_tables(plan: Plan, schemas: Mapping[str, Source]) -> dict[str, list[str]]:
    """Tables of other schemas that keys refer to and that a source was given for."""
    known = {name.upper(): source for name, source in schemas.items()}
    wanted: dict[str, set[str]] = {}
    for c in plan.constraints:
        if c.owner != plan.config.source_schema and c.owner in known:
            wanted.setdefault(c.owner, set()).add(c.table_name)
    return {o: present(known[o], plan.spark, sorted(t)) for o, t in wanted.items()}


def _live_parents(plan: Plan, schemas: Mapping[str, Source]) -> dict[str, Parent]:
    sources = {name.upper(): source for name, source in schemas.items()}
    return {f"{owner}.{t}": Parent(t, sources[owner], None)
            for owner, tables in _parent_tables(plan, schemas).items() for t in tables}


def _pinned_parents(plan: Plan, schemas: Mapping[str, Source], folder: str) -> dict[str, Parent]:
    """Parents of other schemas, with one snapshot to a schema beside the job's own."""
    sources = {name.upper(): source for name, source in schemas.items()}
    found = {}
    for owner, tables in _parent_tables(plan, schemas).items():
        snapshot = None
        if tables and sources[owner].pins_files:
            path = f"{folder}/{owner}"
            snapshot = (Snapshot(plan.spark, path) if path_exists(plan.spark, path)
                        else Snapshot.capture(sources[owner], plan.spark, tables, path))
        found |= {f"{owner}.{t}": Parent(t, sources[owner], snapshot) for t in tables}
    return found


def _order(spark: SparkSession, declared: list, config: RefreshConfig) -> list:
    small = len(declared) + len(config.tables) <= SMALL_STATE
    seeds = facts_frame(spark, [(config.source_schema, t) for t in config.tables], _NODES)
    edges = graph.fk_edges(facts_frame(spark, [r.asDict() for r in declared], CONSTRAINTS))
    nodes = graph.fk_closure(edges, seeds, small) if config.auto_include_fk_parents else seeds
    return graph.load_order(graph.edges_within(edges, nodes, small), nodes, small).collect()


def _record_plan(plan: Plan) -> None:
    root = plan.target.root
    plan.tables.coalesce(1).write.parquet(f"{root}/plans/{plan.job_id}/tables")
    declared = facts_frame(plan.spark, [r.asDict() for r in plan.constraints], CONSTRAINTS)
    declared.coalesce(1).write.parquet(f"{root}/plans/{plan.job_id}/constraints")
    book = plan.ledger()
    book.record_job(
        plan.job_id,
        source_endpoint=plan.source.describe(),
        target_endpoint=root,
        source_schema=plan.config.source_schema,
        target_schema=plan.config.target_schema,
        snapshot_id=plan.snapshot.path if plan.snapshot else None,
        config_json=plan.config.to_json(),
        status="PLANNED",
    )
    book.record_tables(
        plan.job_id,
        [
            {"table_name": r.table_name, "ordinal": r.ordinal, "strategy": r.strategy, "status": "PLANNED"}
            for r in plan.rows
        ],
    )


def load_plan(
    spark: SparkSession, source: Source, target_root: str, job_id: str,
    schemas: Mapping[str, Source] | None = None,
) -> Plan:
    """A recorded plan, with its snapshots. ``schemas`` as for :func:`plan_refresh`."""
    target = Target(spark, target_root)
    job = ledger.Ledger(spark, f"{target.root}/ledger").job(job_id)
    if job is None:
        raise KeyError(f"unknown job {job_id}")
    folder = f"{target.root}/plans/{job_id}"
    plan = Plan(
        spark,
        job_id,
        RefreshConfig.from_json(job.config_json),
        source,
        target,
        spark.read.parquet(f"{folder}/tables").orderBy("ordinal").collect(),
        Snapshot(spark, job.snapshot_id) if job.snapshot_id else None,
        spark.read.parquet(f"{folder}/constraints").collect(),
        True,
        target.entries(),
    )
    if plan.snapshot is not None:
        plan.parents = _pinned_parents(plan, schemas or {}, f"{plan.snapshot.path}/schemas")
    else:
        plan.parents = _live_parents(plan, schemas or {})
    return plan


def run_refresh(
    plan: Plan,
    dry_run: bool = False,
    resume: bool = False,
    check_cancelled: Callable[[], bool] | None = None,
    strategies: Mapping[str, str] | None = None,
    id_columns: Sequence[tuple[str, str, str]] = (),
) -> RefreshResult:
    """Load, check and publish every planned table, then check its foreign keys.

    Tables of one level do not depend on each other and load at the same time. A
    table is published only if what was written equals the source at the snapshot;
    until then, and whenever a check fails, its old version stays. ``resume`` takes
    up a job that failed or was cancelled and leaves the tables it had published.
    """
    if dry_run:
        rows = [_result(plan, r, status="skipped" if r.status == "skipped" else "ok") for r in plan.rows]
        none = facts_frame(plan.spark, [], FK_RESULT)
        return RefreshResult(
            plan.job_id, facts_frame(plan.spark, rows, RESULT), none, None, True, False
        )
    book = plan.ledger() if plan.recorded else None
    if book is not None:
        _admit(book.job(plan.job_id), resume)
        book.record_job(plan.job_id, status="RUNNING")
        book.record_tables(
            plan.job_id, [{"table_name": t, "status": "RUNNING"} for t in plan.loadable]
        )
    run = _Run(plan, check_cancelled, strategies or {}, resume)
    try:
        with scratch_of(plan.spark, f"job-{plan.job_id}"):
            run.load_all()
            foreign_keys, errors = run.check_keys()
            next_ids = run.next_ids(id_columns)
    except Exception as error:
        if book is not None:
            book.record_job(plan.job_id, status="FAILED", error=str(error))
        raise
    rows = [run.results[r.table_name] for r in plan.rows]
    failed = any(r["status"] == "failed" for r in rows)
    success = not failed and not run.cancelled and not errors
    if book is not None:
        _record_results(book, plan.job_id, rows)
        state, why = ("DONE", None) if success else ("FAILED", f"not loaded: {', '.join(r['table_name'] for r in rows if r['status'] == 'failed')}")
        if run.cancelled:
            state, why = "CANCELLED", "stopped before all tables were loaded"
        elif errors and not failed:
            why = "; ".join(errors)
        book.record_job(plan.job_id, status=state, error=why)
    tables = facts_frame(plan.spark, rows, RESULT)
    return RefreshResult(
        plan.job_id, tables, foreign_keys, next_ids, success, run.cancelled, errors
    )


def _admit(job, resume: bool) -> None:
    if job.status == "RUNNING":
        raise ValueError(f"{job.job_id} is still running")
    if job.status != "PLANNED" and not resume:
        raise ValueError(f"{job.job_id} ended as {job.status}: only resume=True takes it up again")


def _result(plan: Plan, row, **facts) -> dict:
    known = {
        "job_id": plan.job_id,
        "table_name": row.table_name,
        "level": row.level,
        "ordinal": row.ordinal,
        "strategy": row.strategy,
        "rows_source": 0,
        "rows_target": 0,
        "published": False,
        "sequences_reset": [],
        "seconds": 0.0,
        **facts,
    }
    return {f: known.get(f) for f in RESULT.names}


def _record_results(book: ledger.Ledger, job_id: str, rows: list[dict]) -> None:
    book.record_tables(
        job_id,
        [
            {
                "table_name": r["table_name"],
                "strategy": r["strategy"],
                "rows_source": r["rows_source"],
                "rows_target": r["rows_target"],
                "error": r["error"],
                "sequences_reset": r["sequences_reset"] or None,
                "status": ledger.RESULT_STATUSES.get(r["status"], ledger.OTHER_RESULT),
            }
            for r in rows
        ],
    )


class _Run:
    def __init__(self, plan: Plan, check_cancelled, strategies: Mapping[str, str], resume: bool):
        self.plan = plan
        self.spark = plan.spark
        self.strategies = strategies
        self.cancelled = False
        self.check_cancelled = check_cancelled
        self.entries = plan.entries
        self.results: dict[str, dict] = {}
        self.waiting: list[tuple] = []
        self.tag = f"load-{plan.job_id}"
        self.kept = set()
        if resume:
            self.kept = {t for t, e in self.entries.items() if e.job_id == plan.job_id}

    def load_all(self) -> None:
        plan = self.plan
        if plan.snapshot is not None:
            plan.snapshot.check(plan.loadable)
        pinned = {p.snapshot.path: p.snapshot for p in plan.parents.values() if p.snapshot is not None}
        for snapshot in pinned.values():
            snapshot.check()
        for level in sorted({r.level for r in plan.rows}):
            rows = [r for r in plan.rows if r.level == level]
            self._load_level(rows)
        ok = all(r["status"] in ("ok", "skipped") for r in self.results.values())
        if ok:
            self._publish(self.waiting)
        else:
            for version in self.waiting:
                plan.target.discard(version.table, plan.job_id)
                self.results[version.table]["status"] = "rolled back"

    def _load_level(self, rows: list) -> None:
        self._poll_ledger()
        todo = []
        for row in rows:
            table = row.table_name
            if row.status == "skipped":
                self.results[table] = _result(self.plan, row, status="skipped")
            elif table in self.kept:
                count = self.entries[table].rows
                self.results[table] = _result(
                    self.plan, row, status="ok", rows_source=count, rows_target=count,
                    match=True, published=True,
                )
            else:
                todo.append(row)
        if not todo:
            return
        workers = min(len(todo), self.plan.config.max_parallel)
        with ThreadPoolExecutor(workers) as pool, self._watched():
            jobs = [pool.submit(inheritable_thread_target(self.spark)(self._load_one), r) for r in todo]
            loads = [job.result() for job in jobs]
        loads = [load for load in loads if load is not None]
        if not loads:
            return
        checked = self._check(loads)
        good = []
        for load in loads:
            facts = checked[load.row.table_name]
            status, error = "ok", None
            if not facts["match"]:
                status = "failed"
                error = f"{self.plan.config.verify} mismatch: source {facts['rows_source']}, target {facts['rows_target']}"
            self.results[load.row.table_name] = _result(
                self.plan, load.row, status=status, error=error, strategy=load.strategy,
                rows_source=facts["rows_source"], rows_target=facts["rows_target"],
                match=facts["match"], seconds=load.seconds,
            )
            if facts["match"]:
                good.append(Version(
                    load.row.table_name, load.path, facts["rows_target"], load.shape,
                    self.plan.layout(load.row.table_name), load.strategy == STRATEGIES[3]))
            else:
                self.plan.target.discard(load.row.table_name, self.plan.job_id)
        if self.plan.config.commit_mode == "per_table":
            self._publish(good)
        else:
            self.waiting += good

    def _poll_ledger(self) -> None:
        if self.cancelled or not self.plan.recorded:
            return
        self.cancelled = self.plan.ledger().status(self.plan.job_id) == "CANCELLED"

    @contextmanager
    def _watched(self):
        """While tables load, look at the ledger every :data:`POLL_SECONDS`. Once the job is
        cancelled there, the Spark jobs of its loads are cancelled too, and those they start
        after that at the next look."""
        over = threading.Event()

        def look() -> None:
            while not over.wait(POLL_SECONDS):
                self._poll_ledger()
                if self.cancelled:
                    self.spark.sparkContext.cancelJobsWithTag(self.tag)

        watcher = threading.Thread(target=inheritable_thread_target(self.spark)(look), daemon=True)
        if self.plan.recorded:
            watcher.start()
        try:
            yield
        finally:
            over.set()
            if self.plan.recorded:
                watcher.join()

    def _load_one(self, row):
        if not self.cancelled and self.check_cancelled is not None and self.check_cancelled():
            self.cancelled = True
        self._poll_ledger()
        if self.cancelled:
            self.results[row.table_name] = _result(self.plan, row, status="cancelled")
            return None
        plan, table = self.plan, row.table_name
        strategy = self.strategies.get(table, row.strategy)
        started = time.monotonic()
        self.spark.sparkContext.addJobTag(self.tag)
        try:
            frame = plan.projected(table)
            shape = frame.schema
            observation = None
            if plan.config.verify == "hash" or plan.snapshot is None:
                observation = Observation()
                measured = [F.count(F.lit(1)).alias("rows")]
                if plan.config.verify == "hash":
                    measured.append(exact_sum(row_hash(frame)).alias("content"))
                frame = frame.observe(observation, *measured)
            path = plan.target.version_path(table, plan.job_id)
            STRATEGY_FUNCTIONS[strategy](
                LoadContext(
                    frame, path,
                    size_mb=row.size_mb if row.files else None,
                    splits=row.splits or None,
                    max_parallel=plan.config.max_parallel,
                    chunks=row.chunks,
                    partition_by=plan.layout(table),
                    laid_out=plan.layout(table) == plan.source_layout(table),
                )
            )
            seen = observation.get if observation is not None else None
        except SnapshotTooOld:
            raise
        except Exception as error:
            self.results[table] = _result(
                plan, row, status="cancelled" if self.cancelled else "failed", strategy=strategy,
                error=str(error), seconds=time.monotonic() - started,
            )
            if self.cancelled:
                plan.target.discard(table, plan.job_id)
            return None
        finally:
            self.spark.sparkContext.removeJobTag(self.tag)
        return _Load(row, strategy, path, shape, seen, time.monotonic() - started)

    def _check(self, loads: list[_Load]) -> dict[str, dict]:
        """Compare what was written, read back, with the source at the snapshot.

        For a hash the source side was measured while it was copied. A lost
        executor can make such a measure count rows twice, so a mismatch is
        decided by reading the source again.
        """
        plan = self.plan
        mode = plan.config.verify
        written = {l.row.table_name: plan.target.read_version(l.path, l.shape) for l in loads}
        seen = {l.row.table_name: l.seen for l in loads if l.seen is not None}
        checked = {}
        if mode != "sample" and seen:
            frames = {t: written[t] for t in seen}
            target = verify.fingerprints(frames) if mode == "hash" else verify.row_counts(frames)
            for r in target.collect():
                same = r.rows == seen[r.table_name]["rows"]
                if mode == "hash":
                    same = same and r.content == seen[r.table_name]["content"]
                if same:
                    checked[r.table_name] = {"rows_source": r.rows, "rows_target": r.rows, "match": True}
        rest = [t for t in written if t not in checked]
        if rest:
            source = {t: plan.projected(t) for t in rest}
            compared = compare(plan, source, {t: written[t] for t in rest}, mode)
            checked |= {r.table_name: r.asDict() for r in compared.collect()}
        if plan.snapshot is not None:
            plan.snapshot.check(list(written))
        return checked

    def _publish(self, versions: list[Version]) -> None:
        self.plan.target.publish(self.plan.job_id, versions)
        for version in versions:
            self.results[version.table]["published"] = True

    def _published_frames(self, tables: set[str]) -> dict[str, DataFrame]:
        entries = self.plan.target.entries()
        return {t: self.plan.target.read(t, e) for t, e in entries.items() if t in tables}

    def check_keys(self) -> tuple[DataFrame, list[str]]:
        plan = self.plan
        done = [t for t, r in self.results.items() if r["published"]]
        keys = plan.foreign_keys(done)
        frames = self._published_frames({t for k in keys for t in (k.child, k.parent)})
        frames |= {k.parent: plan.parents[k.parent].read(plan.spark) for k in keys if k.parent in plan.parents}
        # a parent that was never published, or of a schema not given, leaves its keys undecided
        open_keys = [k for k in keys if k.parent not in frames]
        undecided = [(k.name, k.child, k.parent, None, None, None) for k in open_keys]
        keys = [k for k in keys if k.parent in frames]
        if not keys:
            return facts_frame(self.spark, undecided, FK_RESULT), []
        rows = check_foreign_keys(keys, frames).collect()
        errors = []
        by_name = {(k.child, k.name): k for k in keys}
        for row in rows:
            if not row.valid:
                key = by_name[row.child_table, row.constraint_name]
                missing = orphan_keys(frames[key.child], key.columns, frames[key.parent], key.parent_columns)
                shown = [tuple(m)[:-1] for m in missing.limit(3).collect()]
                errors.append(f"{key.name}: {row.orphan_rows} orphan rows, e.g. {shown}")
        return facts_frame(self.spark, [tuple(r) for r in rows] + undecided, FK_RESULT), errors

    def _footers(self, tables: Iterable[str]) -> dict[str, DataFrame]:
        """Published tables that are one version of plain files, to be told from their footers."""
        entries = {t: e for t, e in self.plan.target.entries().items() if t in tables}
        return footer_frames(self.spark, {
            t: (e.version_path, T.StructType.fromJson(json.loads(e.schema_json)))
            for t, e in entries.items()
            if e.version_path is not None and not e.partition_columns and not e.parts
        })

    def next_ids(self, columns: Sequence[tuple[str, str, str]]) -> DataFrame | None:
        wanted = [c for c in columns if self.results.get(c[0], {}).get("published")]
        if not wanted:
            return None
        tables = {c[0] for c in wanted}
        marks = ids.high_water_marks(self._published_frames(tables), wanted, self._footers(tables))
        rows = marks.collect()
        for mark in rows:
            self.results[mark.table_name]["sequences_reset"].append(mark.sequence_name)
        return facts_frame(self.spark, rows, marks.schema)


@dataclass(frozen=True)
class _Load:
    row: object
    strategy: str
    path: str
    shape: T.StructType
    seen: dict | None
    seconds: float


def compare(plan: Plan, source: dict, target: dict, mode: str) -> DataFrame:
    """``table_name, rows_source, rows_target, match`` for one check mode."""
    if mode == "rows":
        return verify.compare_rows(source, target)
    if mode == "hash":
        found = verify.compare_content(source, target)
        return found.select("table_name", "rows_source", "rows_target", "match")
    samples = {
        t: verify.sample_filter(df, plan.config.sample_every, plan.primary_key(t))
        for t, df in source.items()
    }
    content = verify.compare_content(source, target, samples).select(
        "table_name", F.col("match").alias("same_sample")
    )
    return (
        verify.compare_rows(source, target)
        .join(content, "table_name")
        .select("table_name", "rows_source", "rows_target", (F.col("match") & F.col("same_sample")).alias("match"))
    )


def verify_job(
    spark: SparkSession, source: Source, target_root: str, job_id: str, mode: str = "rows"
) -> DataFrame:
    """Compare the source at the job's snapshot with the target as it is now.

    ``table_name, rows_source, rows_target, match``; skipped tables are listed with
    NULLs and not compared.
    """
    plan = load_plan(spark, source, target_root, job_id)
    states = {r.table_name: r.status for r in plan.ledger().tables(job_id).collect()}
    skipped = [t for t, s in states.items() if s == "SKIPPED"]
    tables = [t for t in plan.loadable if t not in skipped]
    if plan.snapshot is not None:
        plan.snapshot.check(tables)
    entries = plan.entries
    published = [t for t in tables if t in entries]
    # the published shape, also after a re-creation
    left = {
        t: project_to_target(
            plan.read_source(t), plan.target.read(t, entries[t]).schema, plan.config.defaults.get(t)
        )
        if t in entries
        else plan.read_source(t)
        for t in tables
    }
    # an exchange replaced only some partitions: those are compared
    exchanged = {r.table_name for r in plan.rows if r.strategy == STRATEGIES[3]}
    right = {
        t: plan.target.read(
            t, entries[t], plan.target.version_path(t, job_id) if t in exchanged else None)
        for t in published
    }
    parts = [facts_frame(spark, [(t, None, None, None) for t in skipped], _COMPARED)]
    if published:
        parts.append(compare(plan, {t: left[t] for t in published}, right, mode))
    lost = {t: left[t] for t in tables if t not in entries}
    if lost:
        parts.append(
            verify.row_counts(lost).select(
                "table_name", F.col("rows").alias("rows_source"),
                F.lit(None).cast("bigint").alias("rows_target"), F.lit(False).alias("match"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def copy_tables(
    spark: SparkSession,
    source: Source,
    target_root: str,
    config: RefreshConfig,
    constraints: DataFrame | None = None,
    schemas: Mapping[str, Source] | None = None,
    **run_options,
) -> RefreshResult:
    """Plan and run in one call."""
    plan = plan_refresh(spark, source, target_root, config, constraints, schemas=schemas)
    return run_refresh(plan, **run_options)


def cancel_job(spark: SparkSession, target_root: str, job_id: str) -> None:
    """Ask a planned or running job to stop before its next tables."""
    book = ledger.Ledger(spark, f"{target_root.rstrip('/')}/ledger")
    job = book.job(job_id)
    if job is None:
        raise KeyError(f"unknown job {job_id}")
    if job.status in ledger.TERMINAL_STATUSES:
        raise ValueError(f"job {job_id} has ended: {job.status}")
    book.record_job(job_id, status="CANCELLED")


def cleanup_job(spark: SparkSession, target_root: str, job_id: str) -> None:
    """Forget a job that is not running. Versions it never published go, and its plan, its
    snapshot unless another job reads by it, and what a lost driver left of its scratch."""
    target = Target(spark, target_root)
    book = ledger.Ledger(spark, f"{target.root}/ledger")
    tables = [r.table_name for r in book.tables(job_id).select("table_name").collect()]
    job = book.job(job_id)
    book.drop(job_id)
    for table in tables:
        target.discard(table, job_id)
    remove_path(spark, f"{target.root}/plans/{job_id}")
    pins = job.snapshot_id
    if pins and pins.startswith(f"{target.root}/") and book.jobs().where(F.col("snapshot_id") == pins).isEmpty():
        remove_path(spark, pins)
    remove_path(spark, scratch_folder(spark, f"job-{job_id}"))


def compact_target(spark: SparkSession, target_root: str, nobody_writes: bool = False) -> None:
    """Rewrite ledger and manifest of a target without what no longer matters; refused
    while one of its jobs runs, unless ``nobody_writes`` tells that its driver is gone.
    Tables, plans and snapshots stay as they are."""
    target = Target(spark, target_root)
    with scratch_of(spark, f"compact-{uuid.uuid4().hex}"):
        ledger.Ledger(spark, f"{target.root}/ledger").compact(nobody_writes)
        target.compact()
