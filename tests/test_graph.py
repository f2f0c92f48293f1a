import pytest

from mirrorwell.operators import graph
from mirrorwell import session
from tests.fixtures import constraints_of, nodes_of


@pytest.fixture(params=["local", "written"])
def sizes(request, monkeypatch):
    """Each case runs with local loop states and with written ones."""
    if request.param == "written":
        monkeypatch.setattr(session, "SMALL_STATE", -1)


def names(df):
    return {r.table_name for r in df.collect()}


def levels(spark, edges, tables):
    found = graph.fk_levels(graph.fk_edges(constraints_of(spark, edges)), nodes_of(spark, tables))
    return {r.table_name: r.level for r in found.collect()}


def test_edges_same_schema_only(spark):
    cons = constraints_of(spark, [("CHILD", "PARENT"), ("CHILD", ("OTHER", "PARENT"))])
    rows = graph.fk_edges(cons).collect()
    assert [tuple(r) for r in rows] == [("S", "CHILD", "S", "PARENT")]
    assert graph.fk_edges(cons, same_schema=False).count() == 2


def test_edges_are_distinct(spark):
    cons = constraints_of(spark, [("A", "B"), ("A", "B")])
    assert graph.fk_edges(cons).count() == 1


def test_closure_chain_and_depth(spark):
    edges = graph.fk_edges(constraints_of(spark, [("C", "B"), ("B", "A"), ("X", "Y")]))
    found = graph.fk_closure(edges, nodes_of(spark, ["C"]))
    assert {(r.table_name, r.depth) for r in found.collect()} == {("C", 0), ("B", 1), ("A", 2)}


def test_closure_ends_on_a_cycle(spark, sizes):
    edges = graph.fk_edges(constraints_of(spark, [("A", "B"), ("B", "A"), ("A", "A")]))
    assert names(graph.fk_closure(edges, nodes_of(spark, ["A"]))) == {"A", "B"}


def test_edges_within(spark):
    edges = graph.fk_edges(constraints_of(spark, [("A", "B"), ("B", "C")]))
    kept = graph.edges_within(edges, nodes_of(spark, ["A", "B"])).collect()
    assert [(r.child_table, r.parent_table) for r in kept] == [("A", "B")]


@pytest.mark.parametrize(
    "edges, tables, expected",
    [
        ([("C", "B"), ("B", "A")], "ABC", {"A": 0, "B": 1, "C": 2}),
        ([("D", "B"), ("D", "C"), ("B", "A"), ("C", "A")], "ABCD", {"A": 0, "B": 1, "C": 1, "D": 2}),
        ([("A", "A")], "AZ", {"A": 0, "Z": 0}),
        ([("C", "A"), ("C", "B"), ("B", "A")], "ABC", {"A": 0, "B": 1, "C": 2}),
    ],
)
def test_levels(spark, edges, tables, expected):
    assert levels(spark, edges, tables) == expected


def test_levels_null_on_cycle(spark, sizes):
    found = levels(spark, [("A", "B"), ("B", "A"), ("D", "A"), ("E", "F")], "ABDEF")
    assert found == {"A": None, "B": None, "D": None, "E": 1, "F": 0}


def test_levels_join_nothing_after_the_rounds(spark, sizes):
    """Levels and tables are grouped together; names may repeat, NULL names meet nothing."""
    edges = [("C", "B"), ("C", "B"), ("B", "A"), (None, "A"), ("X", "Y"), ("Y", "X")]
    frame = spark.createDataFrame([("S", c, "S", p) for c, p in edges], [*graph.CHILD, *graph.PARENT])
    nodes = spark.createDataFrame([("S", t) for t in ["A", "B", "B", "C", "X", "Z", None, None]], list(graph.NODE))
    found = graph.fk_levels(frame, nodes)
    assert sorted((r.table_name or "", r.level) for r in found.collect()) == [
        ("", 0), ("A", 0), ("B", 1), ("C", 2), ("X", None), ("Z", 0)]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_load_and_truncate_order(spark):
    edges = graph.fk_edges(constraints_of(spark, [("C", "B"), ("B", "A"), ("D", "A")]))
    order = graph.load_order(edges, nodes_of(spark, "ABCD"))
    assert [r.table_name for r in order.collect()] == ["A", "B", "D", "C"]
    assert [r.table_name for r in graph.truncate_order(order).collect()] == ["C", "D", "B", "A"]


@pytest.mark.parametrize("edges", [[("A", "B"), ("B", "A")], [("A", "C"), ("C", "B"), ("B", "A")]])
def test_load_order_refuses_cycles(spark, edges):
    with pytest.raises(graph.CycleError, match="S.A, S.B"):
        graph.load_order(graph.fk_edges(constraints_of(spark, edges)), nodes_of(spark, "ABC"))


def test_cycles_tells_members_from_dependants(spark):
    edges = [
        ("A", "B"), ("B", "C"), ("C", "A"),  # a cycle
        ("D", "A"),  # depends on it
        ("E", "E"),  # refers to itself only
        ("P", "Q"), ("Q", "P"), ("X", "P"), ("A", "X"),  # X lies between two cycles
        ("G", "H"),
    ]
    found = graph.fk_cycles(graph.fk_edges(constraints_of(spark, edges))).collect()
    assert {(r.table_name, r.on_cycle) for r in found} == {
        ("A", True), ("B", True), ("C", True), ("P", True), ("Q", True), ("D", False), ("X", False),
    }


def test_cycles_none(spark, sizes):
    assert graph.fk_cycles(graph.fk_edges(constraints_of(spark, [("A", "B")]))).count() == 0


def test_cycles_against_brute_force(spark, sizes):
    import random

    rng = random.Random(7)
    tables = [f"T{i}" for i in range(10)]
    edges = {(rng.choice(tables), rng.choice(tables)) for _ in range(16)}
    reach = {(a, b) for a, b in edges if a != b}
    while True:
        more = {(a, d) for a, b in reach for c, d in reach if b == c} - reach
        if not more:
            break
        reach |= more
    on = {t for t in tables if (t, t) in reach}
    stuck = {t for t in tables if t in on or any((t, o) in reach for o in on)}
    found = graph.fk_cycles(graph.fk_edges(constraints_of(spark, sorted(edges)))).collect()
    assert {(r.table_name, r.on_cycle) for r in found} == {(t, t in on) for t in stuck}
