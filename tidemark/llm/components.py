"""Connected components by contraction.

Each round lets every vertex point to its smallest neighbour, shortens the
pointers twice and replaces edges by the edges between what their ends
point to. A component of n vertices takes about log(n) rounds, also when it
is a path; edges within a component disappear, so rounds get smaller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``(v, root)`` of every vertex of ``edges`` (a, b); roots are equal
    exactly for vertices that edges connect."""
    edges = stage(edges.select("a", "b").filter("a != b").distinct(), "graph-edges")
    roots = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("a"), F.min("b")).alias("root"))
        to = stage(to, "graph-pointers")
        for _ in range(2):
            next_ = to.select(F.col("v").alias("root"), F.col("root").alias("__next"))
            to = to.join(next_, "root").select("v", F.col("__next").alias("root"))
        to = stage(to, "graph-roots")
        if roots is None:
            roots = to
        else:
            step = to.select(F.col("v").alias("root"), F.col("root").alias("__next"))
            roots = roots.join(step, "root", "left").select("v", F.coalesce("__next", "root").alias("root"))
            roots = stage(roots, "graph-labels")
        a = to.select(F.col("v").alias("a"), F.col("root").alias("__a"))
        b = to.select(F.col("v").alias("b"), F.col("root").alias("__b"))
        edges = edges.join(a, "a").join(b, "b").select(F.col("__a").alias("a"), F.col("__b").alias("b"))
        edges = stage(edges.filter("a != b").distinct(), "graph-edges")
    if roots is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return roots
