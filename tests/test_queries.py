"""A part of the driver's comparison, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from mirrorwell.plans.oracles import ORACLES
from mirrorwell.plans.queries import QUERIES, TABLES
from tests.fixtures import DATA

QUICK = (
    "copy_chunked", "copy_partitioned", "copy_partition_overwrite", "table_profile", "fk_cross_schema", "snapshot_read", "project_drift", "chunk_ranges", "chunk_depths",
    "fk_closure", "fk_cycles", "verify_sample", "verify_diff", "fk_orphans", "trigger_sequences",
    "strategy_choice", "ledger_latest", "ledger_tables", "ledger_drop", "ledger_compacted",
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUICK)
def test_same_answer(spark, duck, name):
    df = contract.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    found = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in found.fetchall()]
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, expected)) or sorted(
        map(str, rows)
    ) == sorted(map(str, expected))


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r.table_name for r in rows] == ["REGION", "NATION", "CUSTOMER", "ORDERS"]
    assert all(r.match and r.status == "ok" and r.orphans == 0 for r in rows)
