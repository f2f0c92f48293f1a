import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mirrorwell.functions.hashing import canonical, row_hash
from mirrorwell.operators import verify
from tests.fixtures import people


def content(df):
    return verify.fingerprint(df).first().content


def distinct_contents(spark, rows, schema):
    return len({content(spark.createDataFrame([r], schema)) for r in rows})


def test_nulls_have_a_place(spark):
    rows = [(None, "a"), ("a", None), ("a", "a"), (None, None), ("", None)]
    assert distinct_contents(spark, rows, "x string, y string") == 5


def test_fields_do_not_run_together(spark):
    assert distinct_contents(spark, [("a", "bc"), ("ab", "c")], "x string, y string") == 2


def test_nested_values_count(spark):
    rows = [([1, None],), ([None, 1],), ([1],), ([],), (None,), ([1, 0],)]
    assert distinct_contents(spark, rows, "x array<int>") == 6
    rows = [((1, None),), ((None, 1),), (None,), ((1, 1),)]
    assert distinct_contents(spark, rows, "x struct<a:int,b:int>") == 4


def test_map_order_does_not_matter(spark):
    one = spark.sql("select map('a', 1, 'b', 2) as m, array(map('k', 1, 'j', 2)) as n")
    two = spark.sql("select map('b', 2, 'a', 1) as m, array(map('j', 2, 'k', 1)) as n")
    other = spark.sql("select map('b', 1, 'a', 2) as m, array(map('j', 2, 'k', 1)) as n")
    assert content(one) == content(two) != content(other)
    assert one.select(canonical(F.col("m"), one.schema["m"].dataType)).first()[0][0]["key"] == "a"


def test_order_is_ignored_and_repeats_are_not(spark):
    df = people(spark, 10)
    assert content(df) == content(df.orderBy(F.desc("id")).repartition(3))
    twice = df.unionByName(df.where("id = 1")).unionByName(df.where("id = 1"))
    assert content(twice) != content(df)


def test_many_equal_rows_do_not_overflow(spark):
    df = spark.range(100_000).select(F.lit("same").alias("x"))
    one = spark.createDataFrame([("same",)], "x string").select(row_hash(spark.range(1).select(F.lit("same").alias("x"))).alias("h")).first().h
    assert int(content(df)) == one * 100_000


def test_empty_tables_match(spark):
    none = people(spark, 0)
    row = verify.compare_content({"T": none}, {"T": none}).first()
    assert (row.rows_source, row.match) == (0, True)


def test_compare_rows(spark):
    source = {"A": people(spark, 100), "B": people(spark, 5), "ONLY": people(spark, 1)}
    target = {"A": people(spark, 99), "B": people(spark, 5)}
    found = {r.table_name: tuple(r)[1:] for r in verify.compare_rows(source, target).collect()}
    assert found == {"A": (100, 99, False), "B": (5, 5, True), "ONLY": (1, None, False)}


def test_content_finds_what_counts_miss(spark):
    df = people(spark, 10)
    other = df.withColumn("name", F.when(F.col("id") == 3, "x").otherwise(F.col("name")))
    assert verify.compare_rows({"T": df}, {"T": other}).first().match
    assert not verify.compare_content({"T": df}, {"T": other}).first().match


def test_sample_takes_the_same_rows_on_both_sides(spark):
    df = people(spark, 2000)
    sample = verify.sample_filter(df, 10, ["id"])
    shuffled = df.repartition(5)
    row = verify.compare_content({"T": df}, {"T": shuffled}, {"T": sample}).first()
    assert row.match and 100 < row.rows_source < 300
    assert {r.id for r in df.where(sample).collect()} == {r.id for r in shuffled.where(sample).collect()}


def test_diff_is_exact(spark):
    schema = "a int, t timestamp, v array<int>"
    at = datetime.datetime(2024, 1, 1)
    source = spark.createDataFrame([(1, at, [1])] * 3 + [(2, None, None), (3, at, [])], schema)
    target = spark.createDataFrame([(1, at, [1])] * 5 + [(3, at, []), (4, None, None)], schema)
    for buckets in (1, 7, 1024):
        found = verify.diff(source, target, buckets).collect()
        assert {(r.a, r.side, r.copies) for r in found} == {
            (1, "target", 2), (2, "source", 1), (4, "target", 1),
        }
    assert verify.diff(source, source.repartition(3)).isEmpty()


def test_diff_against_brute_force(spark):
    rng = random.Random(3)
    draw = lambda: (rng.choice([None, 0, 1, 2]), rng.choice([None, "", "a", "b|", "|b"]), rng.choice([None, -0.0, 1.5]))
    left, right = ([draw() for _ in range(n)] for n in (400, 420))
    schema = "a int, b string, c double"
    found = verify.diff(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)).collect()
    more = Counter(left)
    more.subtract(Counter(right))
    expected = {(*row, "source" if n > 0 else "target", abs(n)) for row, n in more.items() if n}
    assert {tuple(r) for r in found} == expected


def test_diff_of_one_hot_row(spark):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    short = hot.where("k >= 0").unionByName(spark.range(9_000).select(F.lit(-1).cast("bigint").alias("k")))
    assert [tuple(r) for r in verify.diff(hot, short).collect()] == [(-1, "source", 1_000)]


def test_diff_moves_no_whole_rows_to_find_those_that_differ(spark):
    """Not even where the hashes of those that differ are too large for a broadcast join."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        found = verify.diff(spark.range(100).toDF("k"), spark.range(50, 120).toDF("k"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 70
    finally:
        spark.conf.set(limit, before)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("bits", [1, 8, 4096])
def test_diff_with_a_crowded_filter(spark, monkeypatch, bits):
    monkeypatch.setattr(verify, "FILTER_BITS", bits)
    names = ["_bit", "_group", "_words"]
    left = spark.range(300).select(*[(F.col("id") % 90 + i).alias(n) for i, n in enumerate(names)])
    right = left.where("_bit <> 7").unionByName(left.where("_bit = 11"))
    rows = {tuple(r) for r in verify.diff(left, right).collect()}
    assert rows == {(7, 8, 9, "source", 4), (11, 12, 13, "target", 4)}


def test_outcome(spark):
    rows = [("A", "ok", True), ("B", "failed", False), ("C", "skipped", None)]
    df = spark.createDataFrame(rows, "table_name string, status string, match boolean")
    assert tuple(verify.outcome(df).first()) == (3, ["B"], True, False)
    assert tuple(verify.outcome(df.where("table_name = 'C'")).first()) == (1, [], False, True)
    assert tuple(verify.outcome(df.limit(0)).first()) == (0, [], False, True)
