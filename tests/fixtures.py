"""Small tables and the declared keys of the driver's tables."""

from mirrorwell.operators.catalog import CONSTRAINTS, foreign_key, primary_key
from mirrorwell.session import facts_frame

DATA = "/root/testdata/sf0.001"
OWNER = "SRC"


def star_constraints(spark):
    keys = {
        "REGION": ["r_regionkey"],
        "NATION": ["n_nationkey"],
        "CUSTOMER": ["c_custkey"],
        "ORDERS": ["o_orderkey"],
    }
    rows = [primary_key(OWNER, t, c) for t, c in keys.items()]
    rows += [
        foreign_key(OWNER, "NATION", ["n_regionkey"], "REGION"),
        foreign_key(OWNER, "CUSTOMER", ["c_nationkey"], "NATION"),
        foreign_key(OWNER, "ORDERS", ["o_custkey"], "CUSTOMER"),
    ]
    return facts_frame(spark, rows, CONSTRAINTS)


def constraints_of(spark, edges, owner="S"):
    """Constraints for ``(child, parent)`` pairs; a parent may be ``(owner, name)``."""
    tables, rows = set(), []
    for child, parent in edges:
        where, name = parent if isinstance(parent, tuple) else (owner, parent)
        tables |= {(owner, child), (where, name)}
        rows.append(foreign_key(owner, child, ["p_id"], name, where))
    rows += [primary_key(o, t, ["id"]) for o, t in sorted(tables)]
    return facts_frame(spark, rows, CONSTRAINTS)


def nodes_of(spark, names, owner="S"):
    return spark.createDataFrame([(owner, n) for n in names], "owner string, table_name string")


def people(spark, n):
    return spark.range(n).selectExpr(
        "id + 1 as id", "concat('person_', id) as name", "20 + id % 60 as age"
    )
