"""Plans that only large inputs take, run with low thresholds; learners on data that has one right answer; small sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.learning.features import assembler
from fathomline.learning.models import (
    recommend, score, train_als, train_forest, train_logistic, train_svm, train_tree, train_tree_regressor,
)
from fathomline.operators.ordering import running_totals, skip_rows, with_neighbours
from fathomline.operators.quantiles import median_by, upper_median
from fathomline.operators.similarity import pair_similarity
from fathomline.plans.catalog.registry import query, table
from fathomline.plans.catalog.similarity import _RATINGS, ratings
from fathomline.plans.flow import run_steps, sql_over
from fathomline.session import fresh_path, materialize
from fathomline.sinks.tables import write_noop
from fathomline.sources.market import read_ticker
from fathomline.sources.tables import relation
from fathomline.streaming.counts import word_count
from fathomline.streaming.sinks import read_batches, start_sink, write_batches
from fathomline.streaming.sources import stream_lines, stream_table


@query(_RATINGS + """
select a.i as item1, b.i as item2, round(sum(a.x * b.x) / (sqrt(sum(a.x * a.x)) * sqrt(sum(b.x * b.x))), 6) as score,
       count(*) as support
from r a join r b on a.u = b.u and a.i < b.i where a.x <> 25 and b.x <> 25
group by 1, 2
having sum(a.x * b.x) / (sqrt(sum(a.x * a.x)) * sqrt(sum(b.x * b.x))) > 0.97 and count(*) > 3
""")
def co_similarity_in_blocks(spark, folder):
    """Every user above five items is cut into blocks or left out; ratings of 25 are missing."""
    rated = ratings(spark, folder).withColumn("rating", F.nullif("rating", F.lit(25.0)))
    return pair_similarity(rated, 0.97, 3, max_items_per_task=5).withColumn("score", F.round("score", 6))


_SPLIT = """
with o as (select o_orderstatus as k, {order} as d, o_orderkey as id, o_totalprice as p from orders)
select k, id, coalesce(lag(id) over w, -1) as prev, coalesce(lead(id) over w, -1) as next, row_number() over w - 1 as position,
       count(*) over (partition by k) as length
from o window w as (partition by k order by d nulls first, id)
"""


def _split(spark, folder, order):
    rows = table(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("k"), order.alias("d"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("p"))
    found = with_neighbours(
        rows, ["k"], ["d", "id"], ["p", "id"], "before", "after", "position", "length", max_rows_per_task=50)
    return found.select("k", "id", F.coalesce("before.id", F.lit(-1)).alias("prev"), F.coalesce("after.id", F.lit(-1)).alias("next"), "position", "length")


@query(_SPLIT.format(order="nullif(o_orderpriority, '1-URGENT')"))
def neighbours_by_text(spark, folder):
    """Few keys, cut along a text column with many nulls and ties."""
    return _split(spark, folder, F.nullif("o_orderpriority", F.lit("1-URGENT")))


@query(_SPLIT.format(order="case o_orderkey % 3 when 0 then null when 1 then -'inf'::double else o_totalprice end"))
def neighbours_by_odd_numbers(spark, folder):
    """Nulls beside minus infinity."""
    rest = F.col("o_orderkey") % 3
    return _split(spark, folder, F.when(rest == 1, F.lit(float("-inf"))).when(rest == 2, F.col("o_totalprice")))


@query("""
with d as (select p_name as name, sum(p_size) as n from part group by 1)
select name, n::bigint as n, (sum(n) over (order by name desc))::bigint as n_so_far from d
""")
def totals_by_text(spark, folder):
    sums = table(spark, folder, "part").groupBy(F.col("p_name").alias("name")).agg(F.sum("p_size").alias("n"))
    return running_totals(sums, "name", ["n"], descending=True, max_rows_per_task=50)


@query("select o_orderkey from orders order by o_orderkey offset 1000")
def rows_after_many(spark, folder):
    return skip_rows(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 1000, max_top=100)


@query("""
with v as (select l_suppkey, l_partkey + 9007199254740992 as v from lineitem),
r as (select *, row_number() over (partition by l_suppkey order by v) - 1 as i, count(*) over (partition by l_suppkey) as n from v)
select l_suppkey, max(v) filter (where i = n // 2) as upper,
       ((max(v) filter (where i = (n - 1) // 2))::hugeint + (max(v) filter (where i = n // 2)))::varchar as twice_median
from r group by 1
""")
def medians_of_large_integers(spark, folder):
    """Integers beyond what a double tells apart, by narrowing."""
    rows = table(spark, folder, "lineitem").select("l_suppkey", (F.col("l_partkey") + 9007199254740992).alias("v"))
    upper = upper_median(rows, "v", ["l_suppkey"], "upper", max_buffered=100)
    middle = median_by(rows, ["l_suppkey"], "v", "m", max_buffered=100)
    return upper.join(middle, "l_suppkey").select(
        "l_suppkey", "upper", (F.col("m") * 2).cast("decimal(30,0)").cast("string").alias("twice_median"))


@query("""
with l as (select (l_quantity > 25)::int::double as label from lineitem)
select learner, label, label as prediction, count(*) as n
from l, (select unnest(['tree', 'forest', 'logistic', 'margin', 'regression']) as learner) group by 1, 2, 3
""")
def separable_predictions(spark, folder):
    """Each learner on rows that one of its features tells apart; all predictions are the labels."""
    label = F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0)
    rows = table(spark, folder, "lineitem").select(label.alias("label"), label.alias("told"), "l_discount")
    rows = materialize(assembler(["told", "l_discount"]).transform(rows).select("label", "features"), "separable")
    models = {
        "tree": train_tree(rows), "forest": train_forest(rows, numTrees=3, featureSubsetStrategy="all"),
        "logistic": train_logistic(rows), "margin": train_svm(rows, maxIter=20), "regression": train_tree_regressor(rows),
    }
    parts = [
        score(model, rows).groupBy("label", F.round("prediction", 6).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("learner", F.lit(name)) for name, model in models.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[4])


@query("""
select count(distinct o_custkey) as users, 10 * count(distinct o_custkey) as items, 0::bigint as unnamed
from lineitem join orders on o_orderkey = l_orderkey
""")
def recommendation_counts(spark, folder):
    """Ten different, named items for every user."""
    rows = materialize(ratings(spark, folder).select(
        F.col("user").cast("int"), F.col("item").cast("int"), F.col("rating").cast("float")), "ratings")
    names = table(spark, folder, "part").select(F.col("p_partkey").cast("int").alias("item"), F.col("p_name").alias("name"))
    made = recommend(train_als(rows), rows.select("user").distinct(), names, 10)
    per_user = made.groupBy("user").agg(
        F.count_distinct("item").alias("items"), F.count_if(F.col("name").isNull()).alias("unnamed"))
    return per_user.agg(
        F.count(F.lit(1)).alias("users"), F.sum("items").alias("items"), F.sum("unnamed").alias("unnamed"))


@query("select event_type, count(*) as n from events where event_type in (select min(event_type) from events) group by 1")
def listed_events(spark, folder):
    """A small table made in the program, joined to the events."""
    events = table(spark, folder, "events")
    first = events.agg(F.min("event_type")).first()[0]
    wanted = relation(spark, [(first,)], "event_type string")
    return events.join(wanted, "event_type").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""
select strftime(o_orderdate, '%Y-%m-%d') as date, count(*) as n, round(sum(o_totalprice), 2) as close from orders group by 1
""")
def ticker_scan(spark, folder):
    path, price = fresh_path(spark, "ticker"), F.col("o_totalprice")
    table(spark, folder, "orders").select(
        F.to_date("o_orderdate").alias("Date"), *[price.alias(c) for c in ("Open", "High", "Low", "Close", "Volume", "Adj Close")],
    ).write.option("header", True).csv(path)
    return read_ticker(spark, path).groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("close"), 2).alias("close"))


@query("""
select word, count(*) as n from (select unnest(string_split(p_name, ' ')) as word from part) where word <> '' group by 1
""")
def streamed_line_words(spark, folder):
    """Lines of text files as a stream of one file a batch; words are counted per batch and added up."""
    path, out = fresh_path(spark, "lines"), fresh_path(spark, "batches")
    table(spark, folder, "part").select("p_name").repartition(3).write.text(path)
    write_batches(stream_lines(spark, path, max_files=1), out, transform=word_count).awaitTermination()
    return read_batches(spark, out).groupBy("word").agg(F.sum("n").alias("n"))


@query("select event_type, count(*) as n from events group by 1")
def restarted_stream(spark, folder):
    """A sink stopped after half of the files and started again at its checkpoint: every row once."""
    source, target, state = (fresh_path(spark, x) for x in ("arriving", "arrived", "checkpoint"))
    events = table(spark, folder, "events").select("event_id", "event_type")
    for half in (0, 1):
        events.filter(F.col("event_id") % 2 == half).repartition(2).write.mode("append").parquet(source)
        start_sink(stream_table(spark, source, events.schema, 1), "parquet", target, checkpoint=state).awaitTermination()
    return spark.read.parquet(target).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("select o_orderstatus, count(*) as n from orders group by 1")
def run_without_output(spark, folder):
    """The whole plan runs into nowhere, then the same frame is counted."""
    orders = table(spark, folder, "orders")
    write_noop(orders)
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("select o_orderstatus as status, count(*) as n from orders where o_totalprice > 1000 group by 1")
def stepped_orders(spark, folder):
    """Steps folded over a frame, the last one in SQL."""
    return run_steps(table(spark, folder, "orders"), [
        lambda df: df.filter("o_totalprice > 1000"), lambda df: df.withColumnRenamed("o_orderstatus", "status"),
        lambda df: sql_over(df, "stepped_rows", "select status, count(*) as n from stepped_rows group by 1"),
    ])
