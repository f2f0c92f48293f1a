import pytest
from pyspark.sql import functions as F

from mirrorwell.sources.base import SnapshotTooOld, SourceError, present, table_exists
from mirrorwell.sources.catalog_tables import CatalogSource
from mirrorwell.sources.files import FileSource, Snapshot
from mirrorwell.sources.jdbc import JdbcSource, KeyRange
from mirrorwell.session import remove_path
from tests.fixtures import DATA, people


@pytest.fixture
def live(spark, folder):
    """A table of 10 rows, pinned."""
    source = FileSource(folder)
    people(spark, 10).coalesce(2).write.parquet(f"{folder}/t.parquet")
    return source, Snapshot.capture(source, spark, ["T"], f"{folder}/pins")


def add_row(spark, folder):
    people(spark, 1).write.mode("append").parquet(f"{folder}/t.parquet")


def test_snapshot_hides_later_rows(spark, folder, live):
    source, snapshot = live
    add_row(spark, folder)
    assert snapshot.read("T").count() == 10
    assert source.read(spark, "T").count() == 11
    snapshot.check()


def test_snapshot_names_its_files_and_no_other(spark, folder, live):
    _, snapshot = live
    add_row(spark, folder)
    pinned = snapshot.read("T")
    assert len(pinned.inputFiles()) == snapshot.sizes["T"][0]
    assert "Join" not in pinned._jdf.queryExecution().executedPlan().toString()


def test_missing_pinned_file_stops_the_read(live):
    _, snapshot = live
    remove_path(snapshot.spark, snapshot._paths("T")[0])
    with pytest.raises(SnapshotTooOld):
        snapshot.read("T")


def test_snapshot_of_partitioned_table(spark, folder):
    people(spark, 10).coalesce(1).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(f"{folder}/t.parquet")
    snapshot = Snapshot.capture(FileSource(folder), spark, ["T"], f"{folder}/pins")
    assert snapshot.read("T").where("p = 1").count() == 5
    assert snapshot.sizes["T"][0] == 2


def test_removed_file_is_noticed(spark, folder, live):
    _, snapshot = live
    remove_path(spark, snapshot._paths("T")[0])
    with pytest.raises(SnapshotTooOld):
        snapshot.check()


def test_replaced_table_is_noticed(spark, folder, live):
    _, snapshot = live
    people(spark, 10).write.mode("overwrite").parquet(f"{folder}/t.parquet")
    with pytest.raises(SnapshotTooOld):
        snapshot.check(["T"])


def test_removed_table_is_noticed(spark, folder, live):
    _, snapshot = live
    remove_path(spark, f"{folder}/t.parquet")
    with pytest.raises(SnapshotTooOld):
        snapshot.check()


def test_pins_tell_tables_with_common_prefix_apart(spark, folder):
    for name, n in (("t", 3), ("t2", 4)):
        people(spark, n).coalesce(1).write.parquet(f"{folder}/{name}")
    snapshot = Snapshot.capture(FileSource(folder, suffix=""), spark, ["T", "T2"], f"{folder}/pins")
    assert [snapshot.read(t).count() for t in ("T", "T2")] == [3, 4]


def test_table_outside_the_snapshot(live):
    with pytest.raises(SourceError):
        live[1].read("OTHER")


def test_presence(spark):
    assert present(FileSource(DATA), spark, ["ORDERS", "RETURNS"]) == ["ORDERS"]


def test_catalog_source(spark):
    spark.sql("create database if not exists shop")
    people(spark, 5).write.mode("overwrite").saveAsTable("shop.people")
    source = CatalogSource("shop")
    assert table_exists(source, spark, "PEOPLE") and not table_exists(source, spark, "NONE")
    assert source.read(spark, "PEOPLE").count() == 5
    assert source.location(spark, "PEOPLE").endswith("people")
    spark.sql("create or replace temporary view v as select 1 as x")
    assert not CatalogSource("shop", {"versionAsOf": "3"}).pins_files


def test_jdbc_reads_at_the_snapshot():
    source = JdbcSource(
        "jdbc:some:db", "SRC", {"fetchsize": "1000"}, as_of="AS OF SCN 42",
        ranges={"T": KeyRange("ID", 1, 100, 4)},
    )
    options = source.read_options("T")
    assert options["dbtable"] == '(SELECT * FROM "SRC"."T" AS OF SCN 42) snap'
    assert (options["partitionColumn"], options["numPartitions"]) == ("ID", "4")
    assert (options["lowerBound"], options["upperBound"]) == ("1", "100")
    assert JdbcSource("u", "S").read_options("X")["dbtable"] == '"S"."X"'
    with pytest.raises(SourceError):
        source.location(None, "T")


def test_jdbc_measures_on_the_remote_side():
    source = JdbcSource("u", "S", as_of="AS OF X").with_ends("T", "ID", 8, 1, 800)
    assert source.ranges["T"] == KeyRange("ID", 1, 801, 8)
    counted = source.one_row_options("T", "COUNT(*)")
    assert counted == {
        "url": "u", "dbtable": '(SELECT COUNT(*) FROM (SELECT * FROM "S"."T" AS OF X) snap) measured'
    }
    assert JdbcSource("u", "S").with_ends("T", "ID", 8, None, None).ranges == {}
