import pytest
from pyspark.sql import functions as F

from mirrorwell import (
    FileSource, RefreshConfig, cancel_job, cleanup_job, compact_target, copy_tables, plan_refresh,
    run_refresh, verify_job,
)
from mirrorwell.operators.graph import CycleError
from mirrorwell.operators.ledger import Ledger
from mirrorwell.operators.load import register_strategy
from mirrorwell.operators.project import NoCommonColumns, UnwritableType
from mirrorwell.operators.publish import Target
from mirrorwell.plans import refresh
from mirrorwell.plans.refresh import load_plan
from mirrorwell.session import child_names, path_exists, remove_path, shared_dir
from mirrorwell.sources.base import SnapshotTooOld
from tests.fixtures import constraints_of, people


@pytest.fixture
def shop(spark, folder):
    """15 children of 5 parents, and a table nobody refers to."""
    parent = spark.range(5).selectExpr("id", "concat('p', id) as label")
    child = spark.range(15).selectExpr("id", "id % 5 as p_id")
    for name, df in (("parent", parent), ("child", child), ("people", people(spark, 25))):
        df.coalesce(1).write.parquet(f"{folder}/src/{name}.parquet")
    return FileSource(f"{folder}/src")


@pytest.fixture
def cons(spark):
    return constraints_of(spark, [("CHILD", "PARENT")])


def config(tables, **options):
    return RefreshConfig("S", "T", tables, **options)


def states(result):
    return {r.table_name: r.status for r in result.tables.collect()}


def lose_some(ctx):
    ctx.df.where("id <> 3").write.parquet(ctx.path)


def swap_some(ctx):
    """As many rows, one of them wrong."""
    ctx.df.withColumn("id", F.when(F.col("id") == 3, 99).otherwise(F.col("id"))).write.parquet(ctx.path)


def test_copy_with_parents(spark, folder, shop, cons):
    result = copy_tables(spark, shop, f"{folder}/t", config("child"), cons, id_columns=[("CHILD", "id", "SQ")])
    rows = result.tables.orderBy("ordinal").collect()
    assert [(r.table_name, r.level, r.rows_source, r.rows_target, r.match) for r in rows] == [
        ("PARENT", 0, 5, 5, True), ("CHILD", 1, 15, 15, True),
    ]
    assert result.success and result.foreign_keys.first().valid
    assert result.next_ids.first().next_value == 15 and rows[1].sequences_reset == ["SQ"]
    found = verify_job(spark, shop, f"{folder}/t", result.job_id, "sample").collect()
    assert all(r.match for r in found) and len(found) == 2
    jobs = load_plan(spark, shop, f"{folder}/t", result.job_id).ledger()
    assert jobs.job(result.job_id).status == "DONE"
    assert [r.strategy for r in jobs.tables(result.job_id).collect()] == ["direct_copy"] * 2
    with pytest.raises(ValueError, match="resume"):
        run_refresh(load_plan(spark, shop, f"{folder}/t", result.job_id))
    cleanup_job(spark, f"{folder}/t", result.job_id)
    assert jobs.job(result.job_id) is None
    assert Target(spark, f"{folder}/t").read("CHILD").count() == 15


def test_dry_run_and_unrecorded_plan_write_nothing(spark, folder, shop, cons):
    plan = plan_refresh(spark, shop, f"{folder}/t", config("child, lost"), cons, record=False)
    result = run_refresh(plan, dry_run=True)
    assert states(result) == {"PARENT": "ok", "CHILD": "ok", "LOST": "skipped"}
    assert {(r.rows_target, r.match) for r in result.tables.collect()} == {(0, None)}
    assert not path_exists(spark, f"{folder}/t")


def test_rows_added_after_the_plan_are_left_out(spark, folder, shop):
    plan = plan_refresh(spark, shop, f"{folder}/t", config("people"))
    people(spark, 1).write.mode("append").parquet(f"{folder}/src/people.parquet")
    run_refresh(plan)
    assert Target(spark, f"{folder}/t").read("PEOPLE").count() == 25
    assert verify_job(spark, shop, f"{folder}/t", plan.job_id, "hash").first().match
    live = copy_tables(spark, shop, f"{folder}/u", config("people", consistent_read="none"))
    assert live.tables.first().rows_target == 26
    again = plan_refresh(spark, shop, f"{folder}/t", config("people"), snapshot_of=plan.job_id)
    assert again.rows[0].rows == 25


def test_replaced_source_stops_the_run(spark, folder, shop):
    plan = plan_refresh(spark, shop, f"{folder}/t", config("people"))
    people(spark, 25).write.mode("overwrite").parquet(f"{folder}/src/people.parquet")
    with pytest.raises(SnapshotTooOld):
        run_refresh(plan)
    assert plan.ledger().job(plan.job_id).status == "FAILED"


def test_lost_rows_are_not_published(spark, folder, shop):
    register_strategy("lose", lose_some)
    first = copy_tables(spark, shop, f"{folder}/t", config("people"))
    assert first.success
    second = copy_tables(spark, shop, f"{folder}/t", config("people, parent"), strategies={"PEOPLE": "lose"})
    assert states(second) == {"PEOPLE": "failed", "PARENT": "ok"} and not second.success
    target = Target(spark, f"{folder}/t")
    assert target.entry("PEOPLE").job_id == first.job_id and target.entry("PARENT").job_id == second.job_id
    assert not path_exists(spark, target.version_path("PEOPLE", second.job_id))


def test_deferred_commit_publishes_all_or_nothing(spark, folder, shop):
    register_strategy("lose", lose_some)
    mode = config("people, parent", commit_mode="defer_insert_commits")
    failed = copy_tables(spark, shop, f"{folder}/t", mode, strategies={"PEOPLE": "lose"})
    target = Target(spark, f"{folder}/t")
    assert not failed.success and target.entries() == {}
    assert states(failed) == {"PEOPLE": "failed", "PARENT": "rolled back"}
    book = Ledger(spark, f"{folder}/t/ledger")
    assert {r.table_name: r.status for r in book.tables(failed.job_id).collect()} == {
        "PEOPLE": "FAILED", "PARENT": "CANCELLED"}
    assert not path_exists(spark, target.version_path("PARENT", failed.job_id))
    assert copy_tables(spark, shop, f"{folder}/t", mode).success
    assert set(Target(spark, f"{folder}/t").entries()) == {"PEOPLE", "PARENT"}


def test_hash_check_finds_a_wrong_row(spark, folder, shop):
    register_strategy("swap", swap_some)
    wrong = {"PEOPLE": "swap"}
    assert copy_tables(spark, shop, f"{folder}/t", config("people"), strategies=wrong).success
    assert not copy_tables(spark, shop, f"{folder}/u", config("people", verify="hash"), strategies=wrong).success
    every = config("people", verify="sample", sample_every=1)
    assert not copy_tables(spark, shop, f"{folder}/v", every, strategies=wrong).success
    assert copy_tables(spark, shop, f"{folder}/w", config("people", verify="hash")).success


def test_orphans_fail_the_run(spark, folder, shop, cons):
    spark.range(3).selectExpr("id", "'p' as label").write.mode("overwrite").parquet(f"{folder}/src/parent.parquet")
    result = copy_tables(spark, shop, f"{folder}/t", config("child"), cons)
    assert not result.success and result.foreign_keys.first().orphan_rows == 6
    assert "FK_CHILD_PARENT: 6 orphan rows" in result.errors[0]


def test_cancel_and_resume(spark, folder, shop, cons):
    plan = plan_refresh(spark, shop, f"{folder}/t", config("child", max_parallel=1), cons)
    answers = iter([False, True])
    result = run_refresh(plan, check_cancelled=lambda: next(answers))
    assert states(result) == {"PARENT": "ok", "CHILD": "cancelled"} and result.cancelled
    book = plan.ledger()
    assert book.job(plan.job_id).status == "CANCELLED"
    again = run_refresh(load_plan(spark, shop, f"{folder}/t", plan.job_id), resume=True)
    assert again.success and states(again) == {"PARENT": "ok", "CHILD": "ok"}
    with pytest.raises(ValueError, match="ended"):
        cancel_job(spark, f"{folder}/t", plan.job_id)


def test_cancel_from_outside(spark, folder, shop):
    plan = plan_refresh(spark, shop, f"{folder}/t", config("people"))
    book = plan.ledger()
    register_strategy("cancelling", lambda ctx: (cancel_job(spark, f"{folder}/t", plan.job_id), ctx.df.write.parquet(ctx.path)))
    with pytest.raises(KeyError):
        cancel_job(spark, f"{folder}/t", "j_unknown")
    book.record_job(plan.job_id, status="RUNNING")
    with pytest.raises(ValueError, match="running"):
        run_refresh(plan, resume=True)
    cancel_job(spark, f"{folder}/t", plan.job_id)
    assert book.status(plan.job_id) == "CANCELLED"


def test_cancel_inside_a_table(spark, folder, shop, monkeypatch):
    monkeypatch.setattr(refresh, "POLL_SECONDS", 0.2)
    plan = plan_refresh(spark, shop, f"{folder}/t", config("people"))

    def endless(ctx):
        ctx.df.write.parquet(ctx.path)
        cancel_job(spark, f"{folder}/t", plan.job_id)
        spark.range(1 << 40, numPartitions=2).selectExpr("sum(id % 7)").collect()

    register_strategy("endless", endless)
    result = run_refresh(plan, strategies={"PEOPLE": "endless"})
    assert result.cancelled and states(result) == {"PEOPLE": "cancelled"}
    book = plan.ledger()
    assert book.job(plan.job_id).status == "CANCELLED"
    assert [r.status for r in book.tables(plan.job_id).collect()] == ["CANCELLED"]
    assert not path_exists(spark, plan.target.version_path("PEOPLE", plan.job_id))
    assert spark.range(5).count() == 5  # no other work is cancelled
    again = run_refresh(load_plan(spark, shop, f"{folder}/t", plan.job_id), resume=True)
    assert again.success and states(again) == {"PEOPLE": "ok"}


def test_drift_and_recreation(spark, folder, shop):
    target = Target(spark, f"{folder}/t")
    old = spark.sql("select 'x' as NAME, 1 as mine, 'y' as note").limit(0).schema
    target.create_missing({"PEOPLE": old}, "v0")
    kept = config("people", defaults={"PEOPLE": {"note": "new"}})
    assert copy_tables(spark, shop, f"{folder}/t", kept).success
    row = target.read("PEOPLE").where("name = 'person_3'").first()
    assert row.asDict() == {"NAME": "person_3", "mine": None, "note": "new"}
    made = copy_tables(spark, shop, f"{folder}/t", config("people", recreate_tables=True))
    assert made.success and target.read("PEOPLE").columns == ["id", "name", "age"]


def test_refusals_come_at_plan_time(spark, folder, shop):
    Target(spark, f"{folder}/t").create_missing({"PEOPLE": spark.sql("select 1 as other").schema}, "v0")
    with pytest.raises(NoCommonColumns):
        plan_refresh(spark, shop, f"{folder}/t", config("people"))
    loop = constraints_of(spark, [("CHILD", "PARENT"), ("PARENT", "CHILD")])
    with pytest.raises(CycleError):
        plan_refresh(spark, shop, f"{folder}/t", config("child"), loop)


def test_skipped_table_stays_as_it_was(spark, folder, shop):
    target = Target(spark, f"{folder}/t")
    path = target.version_path("GONE", "v0")
    people(spark, 2).write.parquet(path)
    target.publish("v0", [("GONE", path, 2, people(spark, 1).schema)])
    result = copy_tables(spark, shop, f"{folder}/t", config("gone, people"))
    assert result.success and states(result)["GONE"] == "skipped"
    assert target.read("GONE").count() == 2


def test_key_to_an_absent_parent_is_undecided(spark, folder, shop, cons):
    remove_path(spark, f"{folder}/src/parent.parquet")
    result = copy_tables(spark, shop, f"{folder}/t", config("child"), cons)
    key = result.foreign_keys.first()
    assert result.success and (key.constraint_name, key.valid) == ("FK_CHILD_PARENT", None)


def test_failed_load_does_not_stop_the_others(spark, folder, shop):
    def broken(ctx):
        raise RuntimeError("disk on fire")

    register_strategy("broken", broken)
    result = copy_tables(spark, shop, f"{folder}/t", config("people, parent"), strategies={"PEOPLE": "broken"})
    rows = {r.table_name: (r.status, r.error) for r in result.tables.collect()}
    assert rows == {"PEOPLE": ("failed", "disk on fire"), "PARENT": ("ok", None)}


def test_chunked_run(spark, folder, shop):
    result = copy_tables(spark, shop, f"{folder}/t", config("people", strategy="chunked_staging", verify="hash"))
    row = result.tables.first()
    assert (row.strategy, row.rows_target, row.match) == ("chunked_staging", 25, True)
    assert Target(spark, f"{folder}/t").read("PEOPLE").columns == ["id", "name", "age"]


def test_compacted_target_is_read_and_refreshed_as_before(spark, folder, shop, cons):
    first = copy_tables(spark, shop, f"{folder}/t", config("child, people"), cons)
    second = copy_tables(spark, shop, f"{folder}/t", config("people"))
    target, book = Target(spark, f"{folder}/t"), Ledger(spark, f"{folder}/t/ledger")
    before = target.current().orderBy("table_name").collect()
    jobs = book.newest().collect()
    compact_target(spark, f"{folder}/t")
    assert target.current().orderBy("table_name").collect() == before and book.newest().collect() == jobs
    # versions that were replaced are still known as published
    assert not target.discard("PEOPLE", first.job_id) and target.read("PEOPLE").count() == 25
    third = copy_tables(spark, shop, f"{folder}/t", config("people"))
    assert third.success and target.entry("PEOPLE").job_id == third.job_id
    assert all(r.match for r in verify_job(spark, shop, f"{folder}/t", second.job_id).collect())
    for _ in range(2):
        compact_target(spark, f"{folder}/t")
    assert target.entry("PEOPLE").job_id == third.job_id and len(book.newest().collect()) == 3


def test_no_scratch_is_left_of_a_run(spark, folder, shop, cons, monkeypatch):
    monkeypatch.setattr(refresh, "SMALL_STATE", 0)  # loop states are written
    before = set(child_names(spark, shared_dir(spark)))
    result = copy_tables(spark, shop, f"{folder}/t", config("child"), cons)
    assert result.success
    compact_target(spark, f"{folder}/t")
    assert set(child_names(spark, shared_dir(spark))) - before <= {folder.rsplit("/", 1)[1]}
    cleanup_job(spark, f"{folder}/t", result.job_id)
    assert child_names(spark, f"{folder}/t/plans") == child_names(spark, f"{folder}/t/snapshots") == []
