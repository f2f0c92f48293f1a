"""Queries that SQL can express, against a second engine on the smallest tables."""

import duckdb
import pytest

from mirrorwell.llm.oracles import ORACLES
from mirrorwell.llm.queries import QUERIES
from tests.fixtures import DATA


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_answer(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        connection.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    df = QUERIES[name](spark, DATA)
    found = connection.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(repr([row[names.index(c)] for c in df.columns]) for row in found.fetchall())
    assert sorted(repr(list(r)) for r in df.collect()) == expected
