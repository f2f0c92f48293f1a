import pytest
from pyspark.sql import functions as F

from mirrorwell.operators import ledger
from mirrorwell.operators.ledger import Ledger
from mirrorwell.session import path_exists


@pytest.fixture
def book(spark, folder):
    return Ledger(spark, folder)


def test_empty_ledger(book):
    assert book.jobs().isEmpty() and book.job("j") is None and book.newest().isEmpty()


def test_job_goes_through_its_states(book):
    book.record_job("j1", source_schema="SRC", target_schema="TGT", config_json="{}", status="PLANNED")
    planned = book.job("j1")
    assert (planned.status, planned.started_at, planned.ended_at) == ("PLANNED", None, None)
    assert planned.created_at is not None
    book.record_job("j1", status="RUNNING")
    first_start = book.job("j1").started_at
    book.record_job("j1", status="FAILED", error="x" * 5000)
    failed = book.job("j1")
    assert failed.status == "FAILED" and len(failed.error) == 5000 and failed.ended_at is not None
    book.record_job("j1", status="RUNNING")
    book.record_job("j1", status="DONE")
    done = book.job("j1")
    assert (done.status, done.error, done.started_at) == ("DONE", None, first_start)
    assert (done.source_schema, done.config_json) == ("SRC", "{}")


def test_unknown_states_are_refused(book):
    with pytest.raises(ValueError):
        book.record_job("j", status="LOST")
    with pytest.raises(ValueError):
        book.record_tables("j", [{"table_name": "T", "status": "LOST"}])


def test_patches_leave_other_fields(book):
    book.record_tables("j", [{"table_name": t, "ordinal": i, "status": "PLANNED"} for i, t in enumerate("BA")])
    book.record_tables("j", [{"table_name": "A", "rows_source": 0, "rows_target": 0, "status": "DONE"}])
    book.record_tables("j", [{"table_name": "A", "sequences_reset": ["S1"]}])
    b, a = book.tables("j").collect()
    assert (a.table_name, a.status, a.rows_source, a.sequences_reset) == ("A", "DONE", 0, ["S1"])
    assert (b.table_name, b.status, b.rows_source, b.ended_at) == ("B", "PLANNED", None, None)


def test_drop_takes_tables_along(book):
    for job, status in (("j1", "DONE"), ("j2", "RUNNING")):
        book.record_job(job, status=status)
        book.record_tables(job, [{"table_name": "T", "status": "DONE"}])
    with pytest.raises(ValueError, match="running"):
        book.drop("j2")
    with pytest.raises(KeyError):
        book.drop("j9")
    book.drop("j1")
    assert book.job("j1") is None and book.tables("j1").isEmpty()
    assert book.tables("j2").count() == 1


def test_newest_first(spark):
    jobs = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "job_id string, created_at int")
    assert [r.job_id for r in ledger.newest_jobs(jobs, 2).collect()] == ["c", "b"]


def test_result_states(spark):
    df = spark.createDataFrame([("ok",), ("skipped",), ("failed",), ("cancelled",)], "s string")
    assert [r[0] for r in df.select(ledger.ledger_status(F.col("s"))).collect()] == [
        "DONE", "SKIPPED", "FAILED", "CANCELLED",
    ]


def test_compacted_ledger_tells_the_same(spark, book, folder):
    book.record_job("j1", source_schema="SRC", config_json="{}", status="PLANNED")
    for status, error in (("RUNNING", None), ("FAILED", "x"), ("RUNNING", None), ("DONE", None)):
        book.record_job("j1", status=status, error=error)
    book.record_job("j2", status="PLANNED")
    book.record_job("gone", status="FAILED")
    for job in ("j1", "gone"):
        book.record_tables(job, [{"table_name": t, "ordinal": i, "status": "PLANNED"} for i, t in enumerate("BA")])
        for n in range(3):
            book.record_tables(job, [{"table_name": "A", "rows_source": n, "status": "RUNNING"}])
    book.record_tables("j1", [{"table_name": "A", "rows_target": 2, "status": "DONE"}])
    book.drop("gone")

    def told():
        return sorted(book.jobs().collect()), book.tables("j1").collect()

    before = told()
    book.compact()
    assert told() == before and book.job("gone") is None
    assert book.generations.number() == 1
    log = spark.read.parquet(book.generations.path("tables"))
    # of table A: its ordinal, first start, last rows_source and its end
    assert log.where("job_id = 'j1' and table_name = 'A'").count() == 4
    assert log.where("job_id = 'gone'").isEmpty()
    # what comes later is told with what was kept, also through a second compaction
    book.record_tables("j1", [{"table_name": "B", "rows_source": 7, "status": "DONE"}])
    book.record_job("j2", status="CANCELLED")
    later = told()
    assert later != before
    book.compact()
    assert told() == later
    # the generation before stays for readers that planned on it, the one before that does not
    assert path_exists(spark, f"{folder}/generations/1/jobs") and not path_exists(spark, f"{folder}/jobs")


def test_compaction_lost_on_the_way_changes_nothing(spark, book, folder):
    book.record_job("j", status="DONE")
    spark.range(3).write.parquet(f"{folder}/generations/1/jobs")  # no marker beside it
    assert book.job("j").status == "DONE"
    book.compact()
    assert book.job("j").status == "DONE" and book.generations.number() == 1


def test_compaction_waits_for_running_jobs(book):
    book.compact()  # an empty one
    book.record_job("j", status="RUNNING")
    with pytest.raises(ValueError, match="running"):
        book.compact()
    book.compact(nobody_writes=True)
    assert book.job("j").status == "RUNNING"


def test_many_jobs_are_dropped_at_once(spark, book):
    for job, status in (("a", "DONE"), ("b", "FAILED"), ("c", "RUNNING")):
        book.record_job(job, status=status)
    book.drop_jobs(spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("z",)], "job_id string"))
    assert [r.job_id for r in book.jobs().collect()] == ["c"]
