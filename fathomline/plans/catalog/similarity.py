"""Similarity of parts bought by the same customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.operators.similarity import items_similar_to, pair_similarity
from fathomline.plans.catalog.registry import query, table
from fathomline.session import spread

_RATINGS = """
with r as (select o_custkey as u, l_partkey as i, avg(l_quantity) as x
           from lineitem join orders on o_orderkey = l_orderkey group by 1, 2)
"""


def ratings(spark, folder):
    """``(user, item, rating)``: mean quantity of a part bought by a customer."""
    lines = spread(table(spark, folder, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item"), "l_quantity"))
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("user"))
    bought = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return bought.groupBy("user", "item").agg(F.avg("l_quantity").alias("rating"))


@query(_RATINGS + """
select a.i as item1, b.i as item2, round(sum(a.x * b.x) / (sqrt(sum(a.x * a.x)) * sqrt(sum(b.x * b.x))), 6) as score,
       count(*) as support
from r a join r b on a.u = b.u and a.i < b.i
group by 1, 2
having sum(a.x * b.x) / (sqrt(sum(a.x * a.x)) * sqrt(sum(b.x * b.x))) > 0.97 and count(*) > 3
""")
def co_similarity(spark, folder):
    # The ratings are read once, so their rows are summed where the means are taken.
    pairs = pair_similarity(ratings(spark, folder), 0.97, 3)
    return pairs.withColumn("score", F.round("score", 6))


@query(_RATINGS + """
, s as (
  select b.i as item, sum(a.x * b.x) / (sqrt(sum(a.x * a.x)) * sqrt(sum(b.x * b.x))) as score, count(*) as support
  from r a join r b on a.u = b.u and a.i <> b.i where a.i = 7 group by 1)
select item, p_name as name, round(score, 6) as score, support from s join part on p_partkey = item
where score > 0.8 and support > 1 order by s.score desc, support desc, item limit 10
""")
def similar_items_report(spark, folder):
    names = table(spark, folder, "part").select(F.col("p_partkey").alias("item"), F.col("p_name").alias("name"))
    best = items_similar_to(ratings(spark, folder), names, 7, 0.8, 1, 10)
    return best.withColumn("score", F.round("score", 6))
