"""Wide keys, full id columns and foreign keys to unique keys."""

import pytest
from pyspark.sql import functions as F

from mirrorwell import FileSource, RefreshConfig, copy_tables, plan_refresh
from mirrorwell.operators.catalog import CONSTRAINTS, foreign_key
from mirrorwell.operators.graph import fk_edges
from mirrorwell.operators.ids import high_water_marks
from mirrorwell.operators.load import STRATEGY_FUNCTIONS, LoadContext, range_chunk_counts
from mirrorwell.session import facts_frame
from tests.fixtures import DATA


def test_range_chunks_of_far_keys_add_up(spark):
    for keys in ([0, 2**62 - 1], [-(2**62), 2**62], [5, 5, 5]):
        df = spark.createDataFrame([(k,) for k in keys], "k long")
        rows = range_chunk_counts(df, "k", 8).collect()
        assert sum(r["rows"] for r in rows) == len(keys)


def test_full_int_column_has_a_next_value(spark):
    df = spark.createDataFrame([(2147483647,)], "id int")
    assert high_water_marks({"T": df}, [("T", "id", "S")]).first().next_value == 2147483648


def test_foreign_key_to_a_unique_key_is_an_edge(spark):
    common = {"owner": "S", "status": "ENABLED"}
    rows = [
        {**common, "table_name": "P", "constraint_name": "U1", "constraint_type": "U", "columns": ["a"],
         "r_owner": None, "r_constraint_name": None},
        {**common, "table_name": "C", "constraint_name": "F1", "constraint_type": "R", "columns": ["b"],
         "r_owner": "S", "r_constraint_name": "U1"},
    ]
    edges = fk_edges(facts_frame(spark, rows, CONSTRAINTS))
    assert edges.select(F.col("child_table"), F.col("parent_table")).collect() == [("C", "P")]


def test_rows_of_unknown_splits_stay_where_they_are(spark, folder):
    df = spark.range(640).repartition(16)
    for strategy in ("parallel_dml", "chunked_staging"):
        STRATEGY_FUNCTIONS[strategy](LoadContext(df, f"{folder}/{strategy}", chunks=1))
        written = spark.read.parquet(f"{folder}/{strategy}")
        assert len(written.inputFiles()) == 16 and written.count() == 640


def test_partition_exchange_needs_partitions(spark, folder):
    config = RefreshConfig("SRC", "TGT", "region", strategy="partition_exchange")
    with pytest.raises(ValueError, match="needs partitioned tables: REGION"):
        plan_refresh(spark, FileSource(DATA), folder, config)


def test_key_to_another_schema_is_undecided(spark, folder):
    rows = [
        foreign_key("SRC", "NATION", ["n_regionkey"], "REGION", parent_owner="OTHER"),
        foreign_key("SRC", "NATION", ["n_name"], "REGION", name="OFF")[:-1] + ("DISABLED",),
    ]
    config = RefreshConfig("SRC", "TGT", "nation")
    result = copy_tables(spark, FileSource(DATA), folder, config, facts_frame(spark, rows, CONSTRAINTS))
    found = result.foreign_keys.collect()
    assert [(r.parent_table, r.valid) for r in found] == [("OTHER.PK_REGION", None)]
