from pyspark.sql import functions as F

from mirrorwell.operators import catalog, ids
from mirrorwell.operators.orphans import ForeignKey, check_foreign_keys, orphan_keys, orphan_rows
from mirrorwell.sources.files import footer_frames
from tests.fixtures import constraints_of, nodes_of


def test_null_parts_are_not_checked(spark):
    child = spark.createDataFrame([(1, 1), (1, None), (None, 9), (2, 1), (2, 1)], "a int, b int")
    parent = spark.createDataFrame([(1, 1), (None, 1)], "x int, y int")
    rows = orphan_keys(child, ["a", "b"], parent, ["x", "y"]).collect()
    assert [tuple(r) for r in rows] == [(2, 1, 2)]
    assert orphan_rows(child, ["a", "b"], parent, ["x", "y"]).collect() == [(2, 1), (2, 1)]


def test_self_reference(spark):
    staff = spark.createDataFrame([(1, None), (2, 1), (3, 7)], "id int, boss int")
    key = ForeignKey("fk", "STAFF", ("boss",), "STAFF", ("id",))
    row = check_foreign_keys([key], {"STAFF": staff}).first()
    assert (row.orphan_rows, row.orphan_values, row.valid) == (1, 1, False)


def test_every_key_is_checked(spark):
    child = spark.range(15).select((F.col("id") % 5).alias("p"), "id")
    frames = {"CHILD": child, "PARENT": spark.range(5), "SHORT": spark.range(3)}
    keys = [
        ForeignKey("bad", "CHILD", ("p",), "SHORT", ("id",)),
        ForeignKey("good", "CHILD", ("p",), "PARENT", ("id",)),
    ]
    found = {r.constraint_name: (r.orphan_rows, r.valid) for r in check_foreign_keys(keys, frames).collect()}
    assert found == {"bad": (6, False), "good": (0, True)}


def test_a_hot_orphan_moves_as_one_row(spark):
    child = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 10).alias("k"))
    # a small parent is broadcast; a large one meets keys that are counted already
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = orphan_keys(child, ["k"], spark.range(10), ["id"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert [tuple(r) for r in found.collect()] == [(-1, 10_000)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("LeftAnti") < plan.index("partial_count") < plan.index("Filter")


def test_trigger_text(spark):
    bodies = [
        ("begin :new.id := T1_SEQ.NEXTVAL; end;",),
        (":NEW.code:=SRC.MY_SEQ.nextval and :new.id = t1_seq.nextval",),
        (":new.x := 5; select t1_seq.nextval from dual",),
        (None,),
    ]
    df = spark.createDataFrame(bodies, "body string").select(
        F.lit("S").alias("owner"), F.lit("T").alias("table_name"), "body"
    )
    found = {(r.column_name, r.sequence_name) for r in ids.trigger_sequences(df).collect()}
    assert found == {("ID", "T1_SEQ"), ("CODE", "MY_SEQ")}


def test_high_water_marks(spark):
    frames = {
        "A": spark.createDataFrame([(3, 10), (7, None)], "id int, other bigint"),
        "NONE": spark.createDataFrame([], "id bigint"),
    }
    wanted = [("A", "id", "S1"), ("A", "other", "S2"), ("NONE", "id", "S3")]
    found = {r.sequence_name: r.next_value for r in ids.high_water_marks(frames, wanted).collect()}
    assert found == {"S1": 8, "S2": 11, "S3": 1}


def test_marks_from_footers_read_no_column(spark, folder):
    rows = [(i, None, i % 7) for i in range(500)]
    spark.createDataFrame(rows, "id bigint, nothing bigint, small int").repartition(3).write.parquet(f"{folder}/a")
    spark.createDataFrame(rows[:9], "id bigint, nothing bigint, small int").write.parquet(f"{folder}/b")
    frames = {t: spark.read.parquet(f"{folder}/{t}") for t in "ab"}
    footers = footer_frames(spark, {"a": (f"{folder}/a", None), "b": (f"{folder}/b", frames["b"].schema)})
    wanted = [("a", "id", "S1"), ("a", "small", "S2"), ("b", "id", "S3")]
    plan = ids.scan_marks(footers, wanted)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(id), MAX(small)]" in plan and "PushedAggregation: [MAX(id)]" in plan
    told = ids.high_water_marks(frames, wanted, footers)
    assert "FileScan" not in told._jdf.queryExecution().executedPlan().toString()
    assert {r.sequence_name: r.next_value for r in told.collect()} == {"S1": 500, "S2": 7, "S3": 9}
    assert spark.conf.get("spark.sql.sources.useV1SourceList")  # the caller's session is as it was
    # no footer has a greatest value of a column of NULLs: that table is scanned, the other is not
    mixed = ids.high_water_marks(frames, [("a", "nothing", "S4"), *wanted], footers)
    assert {r.sequence_name: r.next_value for r in mixed.collect()} == {"S1": 500, "S2": 7, "S3": 9, "S4": 1}
    assert {c: t for c, t in mixed.dtypes} == dict(ids.scan_marks(frames, wanted).dtypes)


def test_fk_listing_of_chosen_tables(spark):
    cons = constraints_of(spark, [("CHILD", "PARENT"), ("OTHER", "PARENT")])
    listed = catalog.fk_listing(cons, nodes_of(spark, ["CHILD", "CHILD"]), "S").collect()
    assert [tuple(r) for r in listed] == [("S", "CHILD", "FK_CHILD_PARENT", "ENABLED")]


def test_column_catalog_and_intersection(spark):
    source = catalog.column_catalog(spark, {"T": spark.createDataFrame([], "ID int, NAME string, SRC_ONLY int")})
    target = catalog.column_catalog(spark, {"T": spark.createDataFrame([], "name string, id int, mine int")})
    assert [r.column_id for r in source.collect()] == [1, 2, 3]
    common = catalog.common_columns_of(source, target).orderBy("column_id").collect()
    assert [r.column_name for r in common] == ["name", "id"]


def test_profile_flags(spark):
    frames = {"A": spark.sql("select 1 as a, array(1) as v"), "B": spark.sql("select make_interval(1) as i")}
    rows = {r.table_name: r for r in catalog.table_profiles(spark, frames, {"A": (2, 16777216, 3)}).collect()}
    assert (rows["A"].size_mb, rows["A"].wide, rows["A"].refused) == (16.0, True, False)
    assert (rows["B"].size_mb, rows["B"].wide, rows["B"].refused) == (0.0, False, True)
