"""Degrees of separation in the graph of suppliers and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.operators.separation import degrees_of_separation, hit
from fathomline.plans.catalog.registry import query, table
from fathomline.session import spread


def _edges(spark, folder):
    """Both directions of every supplier-part link; nodes are text such as ``s7`` and ``p12``."""
    links = spread(table(spark, folder, "lineitem").select("l_suppkey", "l_partkey")).select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("s"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("p"),
    )
    both = F.array(
        F.struct(F.col("s").alias("src"), F.col("p").alias("dst")), F.struct(F.col("p").alias("src"), F.col("s").alias("dst"))
    )
    return links.select(F.inline(both))


_WALK = """
with recursive e as (
  select distinct 's' || l_suppkey as src, 'p' || l_partkey as dst from lineitem
  union select distinct 'p' || l_partkey, 's' || l_suppkey from lineitem),
w as (
  select 's0' as node, 0 as distance
  union
  select e.dst, w.distance + 1 from w join e on e.src = w.node where w.distance < 10),
d as (select node, min(distance) as distance from w group by node),
n as (select distinct src as node from e)
"""


@query(_WALK + "select node, coalesce(distance, 9999) as distance from n left join d using (node)")
def bfs_degrees(spark, folder):
    return degrees_of_separation(_edges(spark, folder), "s0")


@query(_WALK + """
select d.distance + 1 as hop, count(*) as directions
from d join e on e.src = d.node
where e.dst = 's1' and d.distance + 1 = (select distance from d where node = 's1')
group by d.distance
""")
def bfs_hit(spark, folder):
    return hit(_edges(spark, folder), "s0", "s1")
