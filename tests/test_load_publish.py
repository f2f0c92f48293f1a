import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mirrorwell.operators import load
from mirrorwell.operators.project import (
    NoCommonColumns, UnwritableType, check_writable, common_columns, project_to_target,
)
from mirrorwell.operators.publish import Target, empty_clone
from mirrorwell.operators.strategy import with_strategy
from mirrorwell.operators.verify import diff
from tests.fixtures import DATA, people


def test_projection_follows_the_target(spark):
    source = spark.createDataFrame([(1, "n", 5)], "ID int, NAME string, SRC_ONLY int")
    target = T.StructType.fromDDL("name string, id bigint, extra date, grade string")
    found = project_to_target(source, target, {"GRADE": "none"})
    assert found.schema.simpleString() == "struct<name:string,id:bigint,extra:date,grade:string>"
    assert tuple(found.first()) == ("n", 1, None, "none")
    assert common_columns(source.schema, target) == ["name", "id"]


def test_projection_reads_only_what_it_needs(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    found = project_to_target(orders, T.StructType.fromDDL("O_ORDERKEY bigint, x int"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_projection_without_common_column(spark):
    with pytest.raises(NoCommonColumns):
        project_to_target(people(spark, 1), T.StructType.fromDDL("other int"))


def test_unwritable_type(spark):
    df = spark.sql("select 1 as a, make_interval(1, 2) as i")
    with pytest.raises(UnwritableType, match="i"):
        check_writable("T", df.schema)


PROFILES = [
    ("small", 100_000, 10.0, False, False, "direct_copy", 1),
    ("rows_over", 1_000_000, 10.0, False, False, "parallel_dml", 1),
    ("mb_over", 10, 250.0, False, False, "parallel_dml", 1),
    ("medium", 5_000_000, 500.0, False, False, "parallel_dml", 2),
    ("large", 200_000_000, 5_000.0, False, False, "chunked_staging", 4),
    ("wide", 200_000_000, 10_000.0, True, False, "parallel_dml", 4),
    ("refused", 10, 1.0, False, True, "refused", 1),
]


def test_strategy_picker(spark):
    schema = "name string, rows bigint, size_mb double, wide boolean, refused boolean"
    df = spark.createDataFrame([p[:5] for p in PROFILES], schema)
    pick = lambda **o: {r.name: r.strategy for r in with_strategy(df, **o).collect()}
    assert {r.name: (r.strategy, r.chunks) for r in with_strategy(df).collect()} == {
        p[0]: p[5:] for p in PROFILES
    }
    assert pick(supports_chunks=False)["large"] == "parallel_dml"
    forced = pick(override="chunked_staging")
    assert forced["small"] == "chunked_staging" and forced["refused"] == "refused"
    with pytest.raises(ValueError):
        with_strategy(df, override="magic")


@pytest.mark.parametrize("key", [(), ("o_custkey",)])
@pytest.mark.parametrize("splits", [1, 100])
def test_chunked_load_keeps_every_row(spark, folder, key, splits):
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    load.chunked_staging(load.LoadContext(orders, folder, chunks=4, chunk_key=key, splits=splits))
    staged = spark.read.parquet(folder)
    assert staged.agg(F.max(load.CHUNK)).first()[0] <= 3
    back = Target(spark, folder).read_version(folder, orders.schema)
    assert diff(orders, back).isEmpty()
    if key:
        assert staged.groupBy("o_custkey").agg(F.countDistinct(load.CHUNK).alias("n")).where("n > 1").isEmpty()


def test_many_splits_are_chunked_without_a_shuffle(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(load.with_chunks(orders, 4, splits=100))
    assert "Exchange" not in plan(load.with_chunks(orders, 4))  # unknown
    assert "REBALANCE" in plan(load.with_chunks(orders, 4, splits=1))


def test_equal_rows_spread_over_chunks(spark, folder):
    spark.range(20_000).select(F.lit("same").alias("x")).coalesce(1).write.parquet(folder)
    counts = load.with_chunks(spark.read.parquet(folder), 4, splits=1).groupBy(load.CHUNK).count()
    assert all(4_000 < r["count"] < 6_000 for r in counts.collect())


def test_chunks_of_rows_without_files(spark, folder):
    df = people(spark, 1000).repartition(3)
    load.chunked_staging(load.LoadContext(df, folder, chunks=4))
    assert spark.read.parquet(folder).count() == 1000


def test_parallel_load_shuffles_only_when_short_of_splits(spark, folder):
    df = people(spark, 1000).coalesce(1)
    load.parallel_dml(load.LoadContext(df, folder + "/a", splits=1, max_parallel=4))
    load.parallel_dml(load.LoadContext(df, folder + "/b", splits=9, max_parallel=4))
    assert len(spark.read.parquet(folder + "/a").inputFiles()) == 4
    assert len(spark.read.parquet(folder + "/b").inputFiles()) == 1


def test_key_ranges(spark):
    df = spark.range(5, 25).withColumnRenamed("id", "k")
    assert load.key_ranges(df, "k", 4) == [(5, 10), (10, 15), (15, 20), (20, 25)]
    counts = load.range_chunk_counts(df.where("k < 12"), "k", 4).orderBy("chunk").collect()
    assert sum(r.rows for r in counts) == 7
    assert load.range_chunk_counts(df.where("k < 0"), "k", 4).isEmpty()


def test_range_copy_spreads_a_hot_key(spark, folder):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    hot.write.parquet(folder + "/src")
    source = spark.read.parquet(folder + "/src")
    load.copy_by_range(source, folder + "/out", "k", 6)
    back = spark.read.parquet(folder + "/out")
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert back.count() == 30_000 and max(sizes) < 9_000


def test_exchange_replaces_only_given_partitions(spark, folder):
    df = people(spark, 100).withColumn("p", F.col("id") % 3)
    load.exchange_partitions(df, folder, ["p"])
    load.exchange_partitions(df.where("p = 1").withColumn("name", F.lit("new")), folder, ["p"])
    back = spark.read.parquet(folder)
    assert back.count() == 100
    assert back.where("name = 'new'").select("p").distinct().collect()[0].p == 1


def test_publish_switches_tables_together(spark, folder):
    target = Target(spark, folder)
    shape = people(spark, 1).schema
    assert target.create_missing({"A": shape, "B": shape}, "v0") == ["A", "B"]
    assert target.create_missing({"A": shape}, "v1") == []
    for table, n in (("A", 3), ("B", 4)):
        people(spark, n).write.parquet(target.version_path(table, "v1"))
    assert target.read("A").count() == 0
    target.publish("v1", [(t, target.version_path(t, "v1"), None, shape) for t in "AB"])
    entries = target.entries()
    assert [target.read(t, entries[t]).count() for t in "AB"] == [3, 4]
    assert not target.discard("A", "v1")
    people(spark, 9).write.parquet(target.version_path("A", "v2"))
    assert target.discard("A", "v2") and not target.discard("A", "v2")
    with pytest.raises(KeyError):
        target.read("C")


def test_empty_clone(spark):
    clone = empty_clone(people(spark, 5), ["name"])
    assert clone.columns == ["name"] and clone.isEmpty()


def test_merge_keeps_repeats(spark):
    assert load.merge_chunks([people(spark, 3), people(spark, 3)]).count() == 6
