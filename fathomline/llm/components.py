"""Connected components by contraction: every node hooks onto its smallest neighbour until no edge is left.

A round takes one aggregate and two joins of edges with nodes; a node of very many edges is one row per task in
the aggregate, and the joins may split its rows. The nodes at least halve each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; the root is a node of the same component.

    Edges may be repeated and of either direction; an edge from a node to itself only names the node. Each round
    is written to the shared folder, so a lost executor costs no earlier round.
    """
    edges = materialize(edges.select("a", "b").distinct(), "edges")
    hooks = []
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = materialize(
            both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "hooks")
        hooks.append(hook)
        left = hook.select("a", F.col("m").alias("ma"))
        right = hook.select(F.col("a").alias("b"), F.col("m").alias("mb"))
        edges = materialize(
            edges.filter("a <> b").join(left, "a").join(right, "b").filter("ma <> mb")
            .select(F.col("ma").alias("a"), F.col("mb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            break
    roots = hooks[0].select(F.col("a").alias("node"), F.col("m").alias("root"))
    for hook in hooks[1:]:
        later = hook.select(F.col("a").alias("root"), "m")
        roots = roots.join(later, "root", "left").select("node", F.coalesce("m", "root").alias("root"))
    return roots
