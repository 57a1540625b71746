"""Breadth-first degrees of separation on an edge table ``(src, dst)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.session import materialize_by

# Distance of a node that was not reached, and the number of hops tried.
UNREACHED = 9999
MAX_HOPS = 10


def out_of(edges: DataFrame, frontier: DataFrame) -> DataFrame:
    """The edges that leave the frontier. Edges and frontier are bucketed alike, so neither is shuffled."""
    return edges.join(frontier, edges["src"] == frontier["node"], "left_semi")


def unseen(edges: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Ends of edges that are in none of the levels. Only these ends move, once; levels are bucketed by node."""
    ends = edges.select(F.col("dst").alias("node")).distinct()
    for level in levels:
        ends = ends.join(level.select("node"), "node", "left_anti")
    return ends


def _hops(edges: DataFrame, start, target, max_hops: int):
    """Walk outwards hop by hop; every level of nodes is written once to the shared folder, bucketed by node.

    A hop semi-joins the edges with the last level, so each edge is read once and a hub is one row of a level. The
    edges lie in the buckets of their start, so they never move: a hop shuffles the nodes it touches and nothing else,
    and earlier levels are read in place. Only emptiness and the target's hit count come back to the driver.
    """
    node_type = edges.schema["src"].dataType
    first = edges.sparkSession.range(1).select(F.lit(start).cast(node_type).alias("node"), F.lit(0).alias("distance"))
    levels = [materialize_by(first, "node", "frontier")]
    hit = None
    for hop in range(1, max_hops + 1):
        out = out_of(edges, levels[-1])
        if target is not None:
            parents = out.filter(F.col("dst") == target).agg(F.count_distinct("src")).first()[0]
            if parents:
                hit = (hop, parents)
        new = materialize_by(unseen(out, levels).withColumn("distance", F.lit(hop)), "node", "frontier")
        if new.isEmpty():
            break
        levels.append(new)
        if hit:
            break
    reached = levels[0]
    for level in levels[1:]:
        reached = reached.unionByName(level)
    return reached, hit


def _held(edges: DataFrame, hold: bool) -> DataFrame:
    """The two edge columns, bucketed by their start unless they already come from a table.

    Repeated edges may stay: each hop makes its new nodes distinct, which is far fewer rows.
    """
    thin = edges.select("src", "dst")
    return materialize_by(thin, "src", "edges") if hold else thin


def degrees_of_separation(
    edges: DataFrame, start, target=None, max_hops: int = MAX_HOPS, hold: bool = True
) -> DataFrame:
    """``(node, distance)`` for every node of the graph; a node not reached gets ``UNREACHED``.

    With a target the walk ends at the hop that touches it. ``hold=False`` spares the copy of the
    edges when they are a stored table already, best one bucketed by ``src``.
    """
    once = _held(edges, hold)
    reached, _ = _hops(once, start, target, max_hops)
    nodes = once.select(F.col("src").alias("node")).union(once.select("dst")).distinct()
    return nodes.join(reached, "node", "left").select(
        "node", F.coalesce("distance", F.lit(UNREACHED)).alias("distance")
    )


def hit(edges: DataFrame, start, target, max_hops: int = MAX_HOPS, hold: bool = True) -> DataFrame:
    """``(hop, directions)``: the hop that touches the target and how many frontier nodes lead to
    it; no row if it is out of reach."""
    _, found = _hops(_held(edges, hold), start, target, max_hops)
    return edges.sparkSession.createDataFrame([found] if found else [], "hop int, directions long")
