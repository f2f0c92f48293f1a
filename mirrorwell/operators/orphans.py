"""Foreign keys that point nowhere."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorwell.session import materialize, work_dir


@dataclass(frozen=True)
class ForeignKey:
    name: str
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def key_columns(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def orphan_keys(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]
) -> DataFrame:
    """Key values without a parent row, ``k0, k1, …``, and their ``rows``.

    A key with any NULL part is not checked, as in SQL. The child is reduced to
    one row per key value before it moves, so a value held by a third of the rows
    weighs as much as any other, and only distinct keys meet the parent's keys.
    """
    names = [f"k{i}" for i in range(len(columns))]
    used = (
        child.select(*[c.alias(n) for c, n in zip(key_columns(columns), names)])
        .dropna("any")
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(*[c.alias(n) for c, n in zip(key_columns(parent_columns), names)])
    return used.join(known, names, "left_anti")


def orphan_rows(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]
) -> DataFrame:
    """The child rows themselves. The missing keys are written first, so that their
    size decides the join and a key held by many rows can be split."""
    names = {f"k{i}": c for i, c in enumerate(columns)}
    bad = orphan_keys(child, columns, parent, parent_columns).drop("rows").withColumnsRenamed(names)
    bad = materialize(bad, work_dir(child.sparkSession, "orphans"))
    return child.join(bad, list(columns), "left_semi").select(*key_columns(child.columns))


def check_foreign_keys(keys: Sequence[ForeignKey], frames: dict[str, DataFrame]) -> DataFrame:
    """``(constraint_name, child_table, parent_table, orphan_rows, orphan_values,
    valid)``, all keys in one job; each is checked whatever the others give."""
    parts = []
    for key in keys:
        missing = orphan_keys(
            frames[key.child], key.columns, frames[key.parent], key.parent_columns
        )
        parts.append(
            missing.agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
                F.count(F.lit(1)).alias("orphan_values"),
            ).select(
                F.lit(key.name).alias("constraint_name"),
                F.lit(key.child).alias("child_table"),
                F.lit(key.parent).alias("parent_table"),
                "orphan_rows",
                "orphan_values",
                (F.col("orphan_values") == 0).alias("valid"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
