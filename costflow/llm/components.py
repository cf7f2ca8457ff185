"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costflow.llm.common import written

JUMPS = 3


def _relabelled(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Edges between the parents of their ends, without loops and repeats."""
    left = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
    right = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
    return (
        edges.join(left, "a")
        .join(right, "b")
        .where("pa <> pb")
        .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); root is the smallest node in reach.

    Each round hooks every node to its smallest neighbour, shortens these
    pointers, and keeps the edges between what is still apart; at least half of
    the nodes that still have edges go each round. A hub's edges meet in a
    partial aggregate or in a join that adaptive execution splits. Loops and
    repeated edges change nothing; an empty table gives an empty one. Only the
    word whether edges are left reaches the driver.
    """
    edges = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    roots = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = written(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("parent")),
            "parents",
        )
        for _ in range(JUMPS):
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            parents = parents.join(above, "parent").select("node", F.col("above").alias("parent"))
        parents = written(parents, "parents")
        if roots is None:
            roots = parents.select("node", F.col("parent").alias("root"))
        else:
            step = parents.select(F.col("node").alias("root"), "parent")
            roots = written(
                roots.join(step, "root", "left").select("node", F.coalesce("parent", "root").alias("root")), "roots"
            )
        edges = written(_relabelled(edges, parents), "edges")
        if edges.isEmpty():
            return roots
