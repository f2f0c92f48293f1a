"""Partitioned tables: pinned, copied in their layout, exchanged by partition. Keys to other schemas."""

import pytest
from pyspark.sql import functions as F

from mirrorwell import FileSource, RefreshConfig, copy_tables, plan_refresh, run_refresh, verify_job
from mirrorwell.operators import load
from mirrorwell.operators.catalog import CONSTRAINTS, foreign_key, primary_key
from mirrorwell.operators.load import register_strategy
from mirrorwell.operators.publish import Target, Version
from mirrorwell.operators.verify import diff
from mirrorwell.plans.refresh import load_plan
from mirrorwell.session import facts_frame, path_exists
from mirrorwell.sources.files import Snapshot

ODD = "a b/c%=:é+"


def config(tables="t", **options):
    return RefreshConfig("SRC", "TGT", tables, **options)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark, parts, value="old", n=40):
    """``n`` rows for each ``(p, q)``."""
    wanted = spark.createDataFrame(parts, "p string, q int")
    ids = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("id")
    return wanted.select(ids, F.lit(value).alias("value"), "p", "q")


PARTS = [("x", 1), ("x", 2), (ODD, 1), (None, 3), ("0012", 7)]


@pytest.fixture
def shop(spark, folder):
    rows(spark, PARTS).write.partitionBy("p", "q").parquet(f"{folder}/src/t.parquet")
    return FileSource(f"{folder}/src")


def test_pinned_read_prunes_and_sees_no_later_file(spark, folder, shop):
    snapshot = Snapshot.capture(shop, spark, ["T"], f"{folder}/pins")
    assert snapshot.partition_columns("T") == ("p", "q")
    rows(spark, [("x", 1), ("new", 1)], "late").write.mode("append").partitionBy("p", "q").parquet(f"{folder}/src/t.parquet")
    read = snapshot.read("T")
    assert read.count() == 200 and read.where("value = 'late'").isEmpty()
    assert "PartitionFilters: [isnotnull(q" in plan_text(read.where("q = 2"))


@pytest.mark.parametrize("strategy", ["auto", "parallel_dml", "chunked_staging"])
def test_copy_keeps_the_layout(spark, folder, shop, strategy):
    result = copy_tables(spark, shop, f"{folder}/t", config(verify="hash", strategy=strategy))
    target = Target(spark, f"{folder}/t")
    entry = target.entry("T")
    assert result.success and entry.partition_columns == ["p", "q"] and not entry.parts
    back = target.read("T")
    assert diff(shop.read(spark, "T"), back).isEmpty()
    assert "PartitionFilters: [isnotnull(q" in plan_text(back.where("q = 2"))
    assert path_exists(spark, f"{entry.version_path}/p=x/q=2")


def test_layout_of_the_target_wins(spark, folder):
    rows(spark, PARTS).write.parquet(f"{folder}/src/t.parquet")
    source, target = FileSource(f"{folder}/src"), Target(spark, f"{folder}/t")
    assert target.create_missing({"T": source.read(spark, "T").schema}, "v0", {"T": ["q"]}) == ["T"]
    assert target.read("T").isEmpty() and target.entry("T").version_path is None
    assert copy_tables(spark, source, f"{folder}/t", config(verify="hash")).success
    entry = target.entry("T")
    assert entry.partition_columns == ["q"] and path_exists(spark, f"{entry.version_path}/q=2")
    assert copy_tables(spark, source, f"{folder}/t", config(recreate_tables=True)).success
    assert target.entry("T").partition_columns is None


def exchanged(spark, folder, parts, value, **options):
    root = f"{folder}/{value}"
    rows(spark, parts, value).write.partitionBy("p", "q").parquet(f"{root}/t.parquet")
    plan = plan_refresh(spark, FileSource(root), f"{folder}/t", config(strategy="partition_exchange", verify="hash"))
    return run_refresh(plan, **options), FileSource(root)


def test_exchange_is_published_by_partition(spark, folder, shop):
    copy_tables(spark, shop, f"{folder}/t", config())
    target = Target(spark, f"{folder}/t")
    base = target.entry("T").version_path
    result, source = exchanged(spark, folder, [("x", 2), (ODD, 1), ("more", 9)], "new")
    assert result.success
    held = {(r.p, r.q): r.value for r in target.read("T").select("p", "q", "value").distinct().collect()}
    assert held == {("x", 1): "old", ("x", 2): "new", (ODD, 1): "new", (None, 3): "old", ("0012", 7): "old", ("more", 9): "new"}
    entry = target.entry("T")
    assert (entry.parts, entry.rows, entry.version_path) == (6, 240, None)
    kept = target.parts(entry).where(F.endswith("version_path", F.lit(base.rsplit("/", 1)[1])))
    assert kept.count() == 3  # carried over by reference, where they were
    assert target.written_parts(base, target.read("T").schema, 2).count() == 5
    assert verify_job(spark, source, f"{folder}/t", result.job_id, "hash").first().match
    assert "PartitionFilters: [isnotnull(q" in plan_text(target.read("T").where("q = 2"))
    again, _ = exchanged(spark, folder, [("x", 1), ("x", 2)], "newer")
    found = target.read("T").groupBy("value").count().collect()
    assert again.success and {r.value: r["count"] for r in found} == {"old": 80, "new": 80, "newer": 80}
    copy_tables(spark, shop, f"{folder}/t", config())
    assert not target.entry("T").parts and diff(shop.read(spark, "T"), target.read("T")).isEmpty()


def test_failed_check_leaves_the_old_partitions(spark, folder, shop):
    copy_tables(spark, shop, f"{folder}/t", config())

    def lose(ctx):
        load.partition_exchange(load.LoadContext(ctx.df.where("id > 3"), ctx.path, partition_by=ctx.partition_by))

    register_strategy("losing_exchange", lose)
    result, _ = exchanged(spark, folder, [("x", 2)], "new", strategies={"T": "losing_exchange"})
    target = Target(spark, f"{folder}/t")
    assert not result.success and not target.entry("T").parts
    assert diff(shop.read(spark, "T"), target.read("T")).isEmpty()


def test_exchange_without_anything_to_keep_is_a_version(spark, folder, shop):
    result, source = exchanged(spark, folder, [("x", 2)], "first")
    target = Target(spark, f"{folder}/t")
    assert result.success and not target.entry("T").parts and target.read("T").count() == 40
    other = rows(spark, [("x", 5)], "flat")
    path = target.version_path("T", "v9")
    other.write.partitionBy("q").parquet(path)
    target.publish("v9", [Version("T", path, 40, other.schema, ("q",), exchange=True)])
    assert target.read("T").select("value").distinct().first().value == "flat" and not target.entry("T").parts


# Keys to another schema


def crossed(spark, folder, kept):
    rows = [
        primary_key("COMMON", "PARENT", ["a", "b"]),
        primary_key("COMMON", "UNUSED", ["a"]),
        foreign_key("SRC", "CHILD", ["x", "y"], "PARENT", "COMMON"),
        foreign_key("SRC", "CHILD", ["x"], "LOST", "COMMON"),
        foreign_key("SRC", "CHILD", ["x"], "PARENT", "OTHER", name="FK_OTHER"),
        primary_key("OTHER", "PARENT", ["a"]),
    ]
    spark.range(20).selectExpr("id as x", "if(id = 4, null, id % 3) as y").write.parquet(f"{folder}/src/child.parquet")
    spark.range(20).selectExpr("id as a", "id % 3 as b").where(kept).write.parquet(f"{folder}/common/parent.parquet")
    return facts_frame(spark, rows, CONSTRAINTS), {"common": FileSource(f"{folder}/common")}


def verdicts(result):
    return {r.constraint_name: (r.parent_table, r.orphan_rows, r.valid) for r in result.foreign_keys.collect()}


def test_keys_to_other_schemas_are_checked(spark, folder):
    constraints, schemas = crossed(spark, folder, "a <> 4")
    source = FileSource(f"{folder}/src")
    plan = plan_refresh(spark, source, f"{folder}/t", config("child"), constraints, schemas=schemas)
    assert set(plan.parents) == {"COMMON.PARENT"} and [r.table_name for r in plan.rows] == ["CHILD"]
    # rows the other schema loses later do not count: its tables are pinned with the job's
    spark.range(0).selectExpr("id as a", "id as b").write.mode("append").parquet(f"{folder}/common/parent.parquet")
    result = run_refresh(load_plan(spark, source, f"{folder}/t", plan.job_id, schemas))
    assert result.success and verdicts(result) == {
        "FK_CHILD_PARENT": ("COMMON.PARENT", 0, True),
        "FK_CHILD_LOST": ("COMMON.PK_LOST", None, None),
        "FK_OTHER": ("OTHER.PARENT", None, None),
    }
    assert set(Target(spark, f"{folder}/t").entries()) == {"CHILD"}


def test_orphans_of_another_schema_fail_the_run(spark, folder):
    constraints, schemas = crossed(spark, folder, "a < 15")
    result = copy_tables(spark, FileSource(f"{folder}/src"), f"{folder}/t", config("child"), constraints, schemas)
    assert not result.success and verdicts(result)["FK_CHILD_PARENT"] == ("COMMON.PARENT", 5, False)
    assert "FK_CHILD_PARENT: 5 orphan rows" in result.errors[0]
    undecided = copy_tables(spark, FileSource(f"{folder}/src"), f"{folder}/u", config("child"), constraints)
    assert undecided.success and verdicts(undecided)["FK_CHILD_PARENT"] == ("COMMON.PARENT", None, None)


# Chunks of equal depth


@pytest.mark.parametrize("sample", [100_000, 3_000])
def test_equi_depth_chunks(spark, folder, sample):
    """A third of the rows on one value; text and NULL in the key; all rows or a sample."""
    df = spark.range(30_000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 100 = 1 then null else concat('k', id % 977) end as k",
        "if(id % 3 = 0, 0, id) as n")
    df.repartition(4).write.parquet(f"{folder}/src")
    df = spark.read.parquet(f"{folder}/src")
    bounds = load.equi_depth_bounds(df, ["k", "n"], 10, sample)
    chunked = df.withColumn("chunk", load.depth_chunk(df, ["k", "n"], bounds))
    counts = chunked.groupBy("chunk").agg(
        F.count("*").alias("rows"), F.count_if(F.coalesce(F.col("k"), F.lit("")) != "hot").alias("others"), F.min(F.struct("k", "n")).alias("low"), F.max(F.struct("k", "n")).alias("high")
    ).orderBy("chunk").collect()
    assert sum(r.rows for r in counts) == 30_000 and 5 <= len(counts) <= 20
    assert all(r.others <= 6_000 for r in counts)
    assert sample < 30_000 or all(r.rows <= 6_000 or r.low == r.high for r in counts)
    assert [r.chunk for r in counts] == list(range(len(counts)))
    order = [((v[0] is not None, v[0] or ""), v[1]) for r in counts for v in (r.low, r.high)]
    assert order == sorted(order)


def test_equi_depth_chunks_of_little(spark):
    few = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    assert load.equi_depth_bounds(few, ["k"], 8) == []
    assert [r.c for r in few.select(load.depth_chunk(few, ["k"], []).alias("c")).collect()] == [0, 0, 0]
    assert load.equi_depth_bounds(few.where("k > 1"), ["k"], 8) == []


# Exact diff


def test_scattered_changes_move_only_what_differs(spark):
    """More changes than buckets: whole rows are met by their hashes, not by bucket."""
    source = spark.range(20_000).selectExpr("id", "concat('row ', id) as t")
    target = source.withColumn("t", F.when(F.col("id") % 4 == 0, F.lit("changed")).otherwise(F.col("t")))
    found = diff(source, target, buckets=16)
    assert found.groupBy("side").count().collect().__len__() == 2 and found.count() == 10_000
    assert diff(source, source.unionByName(source.where("id = 7"))).collect() == [(7, "row 7", "target", 1)]
    text = plan_text(diff(source, target, buckets=16))
    assert "LeftSemi" in text


def test_md5_of_special_numbers(spark):
    from mirrorwell.functions.hashing import portable_row_hash

    values = [0.5, None, float("nan"), float("inf"), float("-inf"), 1e13, -1e13, 1e40, 9.3e12]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    hashes = [r.h for r in df.select(portable_row_hash(df).alias("h")).collect()]
    assert len(set(hashes)) == len(values)
