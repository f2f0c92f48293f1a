"""Foreign-key graph: edges, closure over parents, load order, cycles.

Constraints are declared in a DataFrame, as plain files carry none:
``owner, table_name, constraint_name, constraint_type ('P'|'R'), columns,
r_owner, r_constraint_name, status``.

Every loop takes one step for all tables at once and writes its state, so the
number of rounds is the depth of the graph, not the number of tables. Joins leave
the choice of broadcast to the sizes of the written tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorwell.session import LoopState

NODE = ("owner", "table_name")
CHILD = ("child_owner", "child_table")
PARENT = ("parent_owner", "parent_table")


class CycleError(ValueError):
    """Foreign keys form a cycle, so no load order exists."""


def fk_edges(constraints: DataFrame, same_schema: bool = True) -> DataFrame:
    """Distinct ``(child, parent)`` pairs: each foreign key joined to the key it
    refers to. With ``same_schema`` parents of another schema are left out."""
    child = constraints.where(F.col("constraint_type") == "R").select(
        F.col("owner").alias("child_owner"),
        F.col("table_name").alias("child_table"),
        F.col("r_owner").alias("parent_owner"),
        F.col("r_constraint_name").alias("key_name"),
    )
    if same_schema:
        # before the join: a parent schema shared by all children never shuffles
        child = child.where(F.col("child_owner") == F.col("parent_owner"))
    parent = constraints.where(F.col("constraint_type").isin("P", "U")).select(
        F.col("owner").alias("parent_owner"),
        F.col("constraint_name").alias("key_name"),
        F.col("table_name").alias("parent_table"),
    )
    return child.join(parent, ["parent_owner", "key_name"]).select(*CHILD, *PARENT).distinct()


def edges_within(edges: DataFrame, nodes: DataFrame, small: bool = False) -> DataFrame:
    """Edges with both ends among ``nodes``."""
    nodes = LoopState(edges.sparkSession, "within", small).settle(nodes)
    return edges.join(_as(nodes, CHILD), list(CHILD), "left_semi").join(
        _as(nodes, PARENT), list(PARENT), "left_semi"
    )


def fk_closure(edges: DataFrame, seeds: DataFrame, small: bool = False) -> DataFrame:
    """``seeds`` and all their direct and indirect parents.

    ``depth`` is the fewest foreign keys from a seed, 0 for the seeds themselves.
    """
    state = LoopState(edges.sparkSession, "closure", small)
    first = seeds.select(*NODE).distinct().withColumn("depth", F.lit(0))
    edges, first = state.inputs(_proper(edges), first)
    found = [first]
    while True:
        reached = reduce(DataFrame.unionByName, found)
        step = (
            edges.join(_as(found[-1], CHILD), list(CHILD), "left_semi")
            .select(*[F.col(p).alias(n) for p, n in zip(PARENT, NODE)])
            .distinct()
            .join(reached, list(NODE), "left_anti")
            .withColumn("depth", F.lit(len(found)))
        )
        step = state.keep(step)
        if not state.count(step):
            return reached
        found.append(step)


def fk_levels(edges: DataFrame, nodes: DataFrame, small: bool = False) -> DataFrame:
    """``(owner, table_name, level)``: 0 without parents, else one more than the
    highest parent. ``level`` is NULL for tables on a cycle or depending on one."""
    state = LoopState(edges.sparkSession, "levels", small)
    placed, stuck = _peel(edges, state)

    def seen(named: DataFrame, level: int | None, asked: bool, waits: bool) -> DataFrame:
        return named.select(
            *NODE, F.lit(level).cast("int").alias("level"), F.lit(asked).alias("_asked"), F.lit(waits).alias("_waits")
        )

    # one grouping instead of joins, so nothing is sorted; a NULL name meets no key
    found = [seen(children.dropna(), i + 1, False, False) for i, children in enumerate(placed)]
    if stuck is not None:
        found.append(seen(_end(stuck, CHILD).dropna(), None, False, True))
    return (
        reduce(DataFrame.unionByName, [seen(nodes, 0, True, False), *found])
        .groupBy(*NODE)
        .agg(F.max("level").alias("level"), F.max("_asked").alias("_asked"), F.max("_waits").alias("_waits"))
        .where("_asked")
        .select(*NODE, F.when(~F.col("_waits"), F.col("level")).alias("level"))
    )


def load_order(edges: DataFrame, nodes: DataFrame, small: bool = False) -> DataFrame:
    """Parents first; equal levels by name. Raises ``CycleError`` if there is a
    cycle, naming tables that cannot be placed."""
    levels = fk_levels(edges, nodes, small)
    [levels] = LoopState(edges.sparkSession, "order", small).inputs(levels)
    stuck = levels.where(F.col("level").isNull())
    names = stuck.orderBy(*NODE).limit(20).collect()
    if names:
        listed = ", ".join(f"{r.owner}.{r.table_name}" for r in names)
        more = stuck.count() - len(names)
        beyond = f" and {more} more, see fk_cycles" if more else ""
        raise CycleError(f"foreign keys form a cycle; these wait: {listed}{beyond}")
    return levels.orderBy("level", *NODE)


def truncate_order(levels: DataFrame) -> DataFrame:
    """Children first: the load order backwards."""
    return levels.orderBy(F.desc("level"), *[F.desc(n) for n in NODE])


def fk_cycles(edges: DataFrame) -> DataFrame:
    """Tables that cannot be ordered, ``on_cycle`` telling those on a cycle from
    those that only depend on one. Foreign keys of a table to itself do not count.
    """
    state = LoopState(edges.sparkSession, "cycles")
    _, stuck = _peel(edges, state)
    if stuck is None:
        return _children(edges).limit(0).withColumn("on_cycle", F.lit(True))
    on_cycle = _on_cycle(stuck, state)
    return (
        _children(stuck)
        .join(on_cycle.withColumn("_on", F.lit(True)), list(NODE), "left")
        .select(*NODE, F.coalesce("_on", F.lit(False)).alias("on_cycle"))
    )


def _proper(edges: DataFrame) -> DataFrame:
    """Edges without self-references. An edge given twice is kept twice: no loop minds."""
    loop = (F.col(CHILD[0]) == F.col(PARENT[0])) & (F.col(CHILD[1]) == F.col(PARENT[1]))
    return edges.select(*CHILD, *PARENT).where(~loop)


def _as(nodes: DataFrame, names: tuple[str, str]) -> DataFrame:
    return nodes.select(*[F.col(n).alias(a) for n, a in zip(NODE, names)])


def _end(edges: DataFrame, names: tuple[str, str]) -> DataFrame:
    return edges.select(*[F.col(a).alias(n) for n, a in zip(NODE, names)])


def _children(edges: DataFrame) -> DataFrame:
    return _end(edges, CHILD).distinct()


def _shrink(edges: DataFrame, keep, state: LoopState) -> DataFrame | None:
    """Apply ``keep`` until no edge is left or none is removed; the stable rest if there
    is one."""
    size = state.count(edges)
    while size:
        edges = state.keep(keep(edges))
        left = state.count(edges)
        if left == size:
            return edges
        size = left
    return None


def _peel(edges: DataFrame, state: LoopState) -> tuple[list[DataFrame], DataFrame | None]:
    """Round by round keep the edges whose parent is itself a child.

    Returns the children of each round, as they were settled for it, and the stable rest
    of the edges if there is one. A table that is a child in round r has level r + 1 at least.
    """
    [proper] = state.inputs(_proper(edges))
    rounds: list[DataFrame] = []

    def keep(left: DataFrame) -> DataFrame:
        rounds.append(state.settle(_children(left)))
        return _below(left, rounds[-1])

    stuck = _shrink(proper, keep, state)
    return rounds, stuck


def _below(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose parent is among ``nodes``."""
    return edges.join(_as(nodes, PARENT), list(PARENT), "left_semi")


def _with_parent(edges: DataFrame, others: DataFrame, state: LoopState) -> DataFrame:
    """Edges whose parent is a child in ``others``."""
    return _below(edges, state.settle(_children(others)))


def _trim(edges: DataFrame, state: LoopState) -> DataFrame | None:
    """Drop, again and again, tables without a parent or without a child."""
    return _shrink(
        edges,
        lambda e: _with_parent(e, e, state).join(
            _as(state.settle(_end(e, PARENT).distinct()), CHILD), list(CHILD), "left_semi"
        ),
        state,
    )


def _on_cycle(edges: DataFrame, state: LoopState) -> DataFrame:
    """Tables in a strongly connected component of two tables or more.

    Each turn gives every table the greatest name that reaches it, its colour. The
    tables that can get back to the owner of their colour form its component; they
    are set aside and the rest goes into the next turn.
    """
    found: list[DataFrame] = []
    rest = _trim(edges, state)
    if rest is not None:  # what is left is often small enough to go on locally
        state = LoopState(edges.sparkSession, "core")
        [rest] = state.inputs(rest)
    while rest is not None:
        colours = _colour(rest, state)
        component = _component(rest, colours, state)
        grouped = component.groupBy("colour").agg(F.count(F.lit(1)).alias("tables"))
        several = grouped.where(F.col("tables") > 1).select("colour")
        found.append(component.join(several, "colour", "left_semi").select(*NODE))
        apart = rest.join(_as(component, CHILD), list(CHILD), "left_anti").join(
            _as(component, PARENT), list(PARENT), "left_anti"
        )
        rest = _trim(state.keep(apart), state)
    if not found:
        return _children(edges).limit(0)
    return reduce(DataFrame.unionByName, found)


def _colour(edges: DataFrame, state: LoopState) -> DataFrame:
    name = F.struct(*NODE)
    nodes = _end(edges, CHILD).union(_end(edges, PARENT)).distinct()
    now = state.keep(nodes.select(*NODE, name.alias("colour")))
    while True:
        offered = (
            edges.join(now.withColumnsRenamed(dict(zip(NODE, PARENT))), list(PARENT))
            .groupBy(*[F.col(c).alias(n) for c, n in zip(CHILD, NODE)])
            .agg(F.max("colour").alias("offer"))
        )
        following = state.keep(
            now.join(offered, list(NODE), "left").select(
                *NODE,
                F.greatest("colour", F.coalesce("offer", "colour")).alias("colour"),
                (F.col("offer") > F.col("colour")).alias("changed"),
            )
        )
        done = following.where("changed").isEmpty()
        now = following.drop("changed")
        if done:
            return now


def _component(edges: DataFrame, colours: DataFrame, state: LoopState) -> DataFrame:
    child = colours.withColumnsRenamed({**dict(zip(NODE, CHILD)), "colour": "child_colour"})
    parent = colours.withColumnsRenamed(dict(zip(NODE, PARENT)))
    inner = state.keep(
        edges.join(child, list(CHILD))
        .join(parent, list(PARENT))
        .where(F.col("colour") == F.col("child_colour"))
        .select(*CHILD, *PARENT, "colour")
    )
    roots = colours.where(F.struct(*NODE) == F.col("colour"))
    found = [state.keep(roots)]
    while True:
        reached = reduce(DataFrame.unionByName, found)
        step = (
            inner.join(_as(found[-1], CHILD), list(CHILD), "left_semi")
            .select(*[F.col(p).alias(n) for p, n in zip(PARENT, NODE)], "colour")
            .distinct()
            .join(reached, list(NODE), "left_anti")
        )
        step = state.keep(step)
        if not state.count(step):
            return reached
        found.append(step)
