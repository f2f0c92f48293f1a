"""Connected components of an edge table, in Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mirrorwell.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (``a``, ``b``): the smallest node
    it can reach.

    Large-star and small-star rounds: each hangs a node's neighbours on the smallest of
    them, until every node hangs on the root of its component. The number of rounds
    grows with the logarithm of the longest path. Every round is a written table.
    """
    def stars(links: DataFrame, small: bool) -> DataFrame:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = (both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) if small
                else both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        least = scratch.keep(least, f"{label}-least-{step}-{small}")
        hung = both.join(least, "u")
        if small:
            hung = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        else:
            hung = hung.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return hung.where("a <> b").distinct()

    step = 0
    links = scratch.keep(edges.select("a", "b").where("a <> b").distinct(), f"{label}-0")
    before = None
    while True:
        step += 1
        links = scratch.keep(stars(links, small=False), f"{label}-large-{step}")
        links = scratch.keep(stars(links, small=True), f"{label}-small-{step}")
        scratch.drop(f"{label}-least-{step}-False", f"{label}-least-{step}-True", f"{label}-large-{step}",
                     f"{label}-{step - 1}" if step == 1 else f"{label}-small-{step - 1}")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
