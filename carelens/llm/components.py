"""Connected components of a graph that only Spark tables hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node it reaches) for every node of ``links`` (a, b).

    Every round hooks each root to its smallest neighbour, follows the pointers to their end
    and puts roots in place of nodes; links inside one root go.  The tables of a round are
    stored, so a lost executor costs no earlier round.  Self links and repeats do no harm.
    """
    found = None
    edges = cut_lineage(links.select("a", "b").where("a <> b").distinct())
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("node", "to")
        parent = both.groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("root"))
        parent = _to_the_end(cut_lineage(parent))
        found = parent if found is None else cut_lineage(_follow(found, parent))
        a = parent.select(F.col("node").alias("a"), F.col("root").alias("x"))
        b = parent.select(F.col("node").alias("b"), F.col("root").alias("y"))
        edges = cut_lineage(
            edges.join(a, "a").join(b, "b").where("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        )
    if found is None:
        found = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found


def _follow(found: DataFrame, parent: DataFrame) -> DataFrame:
    """Replace every root by its own root where it has one."""
    further = parent.select(F.col("node").alias("root"), F.col("root").alias("further"))
    return found.join(further, "root", "left").select(
        "node", F.coalesce("further", "root").alias("root"))


def _to_the_end(parent: DataFrame) -> DataFrame:
    """Pointer doubling: as many rounds as the longest chain has binary digits."""
    while True:
        moved = cut_lineage(_follow(parent, parent))
        changed = moved.join(parent.withColumnRenamed("root", "old"), "node").where("root <> old")
        if changed.isEmpty():
            return moved
        parent = moved
