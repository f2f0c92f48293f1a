"""A key with a third of all rows is split at run time, not left to one task."""

import pytest
from pyspark.sql import functions as F

from mirrorwell.operators import graph, ledger
from mirrorwell.operators.load import exchange_partitions
from mirrorwell.session import LoopState, materialize

SMALL_SKEW = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skewed(spark):
    """Settings under which small tables count as large."""
    before = {k: spark.conf.get(k, None) for k in SMALL_SKEW}
    for key, value in SMALL_SKEW.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_parent(spark, folder, skewed):
    parent = F.when(F.col("id") % 3 == 0, "T1").otherwise(F.concat(F.lit("T"), (F.col("id") / 7).cast("int")))
    edges = materialize(
        spark.range(0, 200_000, 1, 8).select(
            F.lit("S").alias("child_owner"), F.concat(F.lit("T"), "id").alias("child_table"),
            F.lit("S").alias("parent_owner"), parent.alias("parent_table"),
        ),
        folder,
    )
    kept = graph._with_parent(edges, edges, LoopState(spark, "skew"))
    assert kept.count() == 200_000
    assert "SortMergeJoin(skew=true)" in plan_of(kept)


def test_job_with_a_third_of_all_events(spark, folder, skewed):
    job = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("j"), "id"))
    events = materialize(spark.range(0, 200_000, 1, 8).select(job.alias("job_id"), "id"), f"{folder}/e")
    dropped = materialize(events.where("id % 5 = 1").select("job_id").distinct(), f"{folder}/d")
    kept = ledger.without_jobs(events, dropped)
    assert "SortMergeJoin(skew=true)" in plan_of(kept)


def test_hot_partition_gets_several_files(spark, folder, skewed):
    part = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5)
    spark.range(0, 200_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"), part.alias("p")).write.parquet(f"{folder}/src")
    exchange_partitions(spark.read.parquet(f"{folder}/src"), f"{folder}/out", ["p"])
    out = spark.read.parquet(f"{folder}/out")
    files = [f for f in out.inputFiles() if "p=-1" in f]
    assert out.count() == 200_000 and len(files) > 4
