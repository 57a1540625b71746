"""Moves, returns and statistics of each customer's order totals over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.operators.columns import flatten_stats
from fathomline.operators.counts import align_forecasts
from fathomline.operators.filters import filter_above
from fathomline.operators.moves import next_pair, price_change, signed_move, up_move
from fathomline.operators.ordering import skip_rows, with_neighbours, with_row_index
from fathomline.operators.performance import (
    growth_ratio, period_stats, price_stats, sharpe_ratio, stock_performance,
)
from fathomline.plans.catalog.registry import query, table
from fathomline.plans.reports import combined_results, emerging

KEYS = ["o_custkey"]
ORDER = ["o_orderdate", "o_orderkey"]
PRICE = "o_totalprice"
SERIES = {"keys": KEYS, "order": ORDER, "price": PRICE}


def _orders(spark, folder):
    return table(spark, folder, "orders").select(*KEYS, *ORDER, PRICE)


@query("""
select o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as order_date,
       round(o_totalprice - lag(o_totalprice) over w, 2) as price_diff,
       strftime(lag(o_orderdate) over w, '%Y-%m-%d') as prev_date
from orders
window w as (partition by o_custkey order by o_orderdate, o_orderkey)
qualify lag(o_orderdate) over w is not null
""")
def price_change_by_customer(spark, folder):
    rows = price_change(_orders(spark, folder), **SERIES)
    return rows.select(
        "o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.round("o_totalprice_diff", 2).alias("price_diff"),
        F.date_format("prev_o_orderdate", "yyyy-MM-dd").alias("prev_date"),
    )


@query("""
select o_custkey, o_orderkey,
       case when o_totalprice > lag(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey)
            then 1 else 0 end as up
from orders
""")
def up_moves(spark, folder):
    return up_move(_orders(spark, folder), **SERIES).select("o_custkey", "o_orderkey", "up")


@query("""
select o_custkey, o_orderkey,
       round(o_totalprice - lag(o_totalprice, 1, 0) over (partition by o_custkey order by o_orderdate, o_orderkey), 2)
         as move
from orders
""")
def signed_moves(spark, folder):
    rows = signed_move(_orders(spark, folder), **SERIES)
    return rows.select("o_custkey", "o_orderkey", F.round("move", 2).alias("move"))


@query("""
with p as (
  select o_custkey, o_orderkey, o_totalprice,
         lead(o_totalprice, 1, 0) over (partition by o_custkey order by o_orderdate, o_orderkey) as next_price
  from orders)
select o_custkey, o_orderkey, next_price, next_price > o_totalprice as rising from p
""")
def next_pairs(spark, folder):
    rows = next_pair(_orders(spark, folder), **SERIES)
    return rows.select("o_custkey", "o_orderkey", F.col("next_o_totalprice").alias("next_price"), "rising")


@query("""
select o_custkey,
       arg_min(o_totalprice, (o_orderdate, o_orderkey)) as start_price,
       arg_max(o_totalprice, (o_orderdate, o_orderkey)) as latest_price,
       max(o_totalprice) as max_price,
       round(arg_max(o_totalprice, (o_orderdate, o_orderkey)) / arg_min(o_totalprice, (o_orderdate, o_orderkey)) - 1, 6)
         as performance
from orders group by o_custkey
""")
def period_performance(spark, folder):
    stats = period_stats(_orders(spark, folder), "6m", **SERIES)
    return stats.withColumn("performance", F.round("performance", 6))


@query("""
with s as (
  select o_custkey, o_totalprice,
         row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as pos,
         count(*) over (partition by o_custkey) // 2 as endpoint
  from orders)
select o_custkey,
       max(case when pos = 0 then o_totalprice end) as start_price,
       max(case when pos = endpoint then o_totalprice end) as latest_price,
       max(o_totalprice) as max_price,
       round(max(case when pos = endpoint then o_totalprice end) / max(case when pos = 0 then o_totalprice end) - 1, 6)
         as performance
from s group by o_custkey
""")
def half_period_performance(spark, folder):
    stats = period_stats(_orders(spark, folder), "3-6m", **SERIES)
    return stats.withColumn("performance", F.round("performance", 6))


@query("""
with s as (
  select o_custkey, o_totalprice as p, lag(o_totalprice) over w as prev, lead(o_totalprice) over w as nxt
  from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)),
r as (select o_custkey, case when nxt is not null then p / prev - 1 end as r from s)
select o_custkey, round(sqrt(250) * avg(r) / nullif(stddev_pop(r), 0), 6) as sharpe_ratio
from r group by o_custkey
""")
def sharpe_by_customer(spark, folder):
    stats = sharpe_ratio(_orders(spark, folder), "6m", **SERIES)
    return stats.withColumn("sharpe_ratio", F.round("sharpe_ratio", 6))


@query("""
with s as (
  select o_custkey, o_totalprice as p,
         lag(o_totalprice) over (partition by o_custkey order by o_orderdate, o_orderkey) as prev,
         row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as pos,
         count(*) over (partition by o_custkey) // 2 as endpoint
  from orders),
r as (select o_custkey, case when pos < endpoint then p / prev - 1 end as r from s)
select o_custkey, round(sqrt(250) * avg(r) / nullif(stddev_pop(r), 0), 6) as sharpe_ratio
from r group by o_custkey
""")
def half_period_sharpe(spark, folder):
    stats = sharpe_ratio(_orders(spark, folder), "3-6m", **SERIES)
    return stats.withColumn("sharpe_ratio", F.round("sharpe_ratio", 6))


@query("""
with a as (select o_custkey, avg(o_totalprice) as m from orders group by o_custkey)
select o.o_custkey, max(o_totalprice) as max_price, min(o_totalprice) as min_price,
       count(*) filter (where o_totalprice < m) as days_below_avg,
       count(*) filter (where not o_totalprice < m) as days_not_below_avg
from orders o join a on o.o_custkey = a.o_custkey
group by o.o_custkey
""")
def price_spread(spark, folder):
    return price_stats(_orders(spark, folder), KEYS, PRICE)


@query("""
select o_custkey,
       round(arg_max(o_totalprice, (o_orderdate, o_orderkey)) / arg_min(o_totalprice, (o_orderdate, o_orderkey)), 6)
         as growth
from orders group by o_custkey
""")
def growth_by_customer(spark, folder):
    return growth_ratio(_orders(spark, folder), **SERIES).withColumn("growth", F.round("growth", 6))


@query("""
with p as (
  select o_custkey,
         arg_max(o_totalprice, (o_orderdate, o_orderkey)) / arg_min(o_totalprice, (o_orderdate, o_orderkey)) - 1
           as performance
  from orders group by o_custkey)
select c_mktsegment, count(*) as n from p join customer on c_custkey = o_custkey
where performance > 1.0 group by c_mktsegment
""")
def strong_performers_by_segment(spark, folder):
    """Companies above a return threshold, counted by industry."""
    returns = filter_above(period_stats(_orders(spark, folder), "6m", **SERIES), "performance", 1.0)
    companies = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return returns.join(companies, "o_custkey").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("""
with s as (
  select o_custkey, o_totalprice as p, lag(o_totalprice) over w as prev, lead(o_totalprice) over w as nxt
  from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)),
r as (select o_custkey, case when nxt is not null then p / prev - 1 end as r from s),
h as (select o_custkey, round(sqrt(250) * avg(r) / nullif(stddev_pop(r), 0), 6) as sharpe from r group by o_custkey),
p as (select o_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) as first_price,
             arg_max(o_totalprice, (o_orderdate, o_orderkey)) as last_price, max(o_totalprice) as top,
             min(o_totalprice) as low
      from orders group by o_custkey),
d as (select o_custkey, count(*) filter (where o_totalprice < mean) as below, count(*) filter (where o_totalprice >= mean) as not_below
      from (select *, avg(o_totalprice) over (partition by o_custkey) as mean from orders) group by o_custkey)
select c_custkey, c_name, first_price as "start_price_3m", last_price as "latest_price_3m", top as "max_price_3m",
       low as "min_price_3m", round(last_price / first_price - 1, 6) as "performance_3m", sharpe as "sharpe_ratio_3m",
       below as "days_below_avg_3m", not_below as "days_not_below_avg_3m"
from customer join p on p.o_custkey = c_custkey join h on h.o_custkey = c_custkey join d on d.o_custkey = c_custkey
""")
def company_performance(spark, folder):
    """Return, Sharpe ratio and price statistics joined to the company table."""
    quotes = _orders(spark, folder).withColumnRenamed("o_custkey", "c_custkey")
    companies = table(spark, folder, "customer").select("c_custkey", "c_name")
    stats = stock_performance(quotes, companies, "3m", "c_custkey", ORDER, PRICE)
    return stats.select(
        "c_custkey", "c_name", "start_price_3m", "latest_price_3m", "max_price_3m", "min_price_3m",
        F.round("performance_3m", 6).alias("performance_3m"), F.round("sharpe_ratio_3m", 6).alias("sharpe_ratio_3m"),
        "days_below_avg_3m", "days_not_below_avg_3m",
    )


@query("""
with p as (
  select o_custkey, o_orderdate >= timestamp '1998-01-01' as recent,
         round(arg_max(o_totalprice, (o_orderdate, o_orderkey)) / arg_min(o_totalprice, (o_orderdate, o_orderkey)) - 1, 6)
           as performance
  from orders group by 1, 2)
select a.o_custkey as "Symbol", a.performance as performance3m, b.performance as performance1m,
       round(b.performance - a.performance, 6) as diffs
from p a join p b on a.o_custkey = b.o_custkey
where not a.recent and b.recent and b.performance > a.performance
order by b.performance - a.performance desc, a.o_custkey limit 30
""")
def emerging_performers(spark, folder):
    """Two periods' results joined per company, ranked by how much the recent one is better."""
    recent = F.col("o_orderdate") >= F.lit("1998-01-01")

    def result(rows, name):
        stats = period_stats(rows, "3m", **SERIES)
        return stats.select(
            F.col("o_custkey").alias("Symbol"), F.lit("x").alias("industry"), F.round("performance", 6).alias(name)
        )

    orders = _orders(spark, folder)
    joined = combined_results(
        result(orders.filter(~recent), "performance3m"), result(orders.filter(recent), "performance1m")
    )
    best = emerging(joined.drop("industry"), "performance1m", "performance3m")
    return best.withColumn("diffs", F.round("diffs", 6))


@query("""
select o_custkey, min(o_totalprice) as "min_1m", max(o_totalprice) as "max_1m", count(*) as "days_1m"
from orders group by o_custkey
""")
def flattened_stats(spark, folder):
    """A struct of statistics flattened into period-suffixed columns."""
    stats = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.struct(
            F.min(PRICE).alias("min"), F.max(PRICE).alias("max"), F.count(F.lit(1)).alias("days")
        ).alias("stats")
    )
    return flatten_stats(stats, "stats", "_1m")


@query("""
with s as (
  select o_custkey, o_totalprice,
         row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as pos
  from orders),
m as (select min(n) as shortest from (select count(*) as n from orders group by o_custkey))
select o_custkey, 'T' || pos as label, o_totalprice from s, m where pos < shortest
""")
def aligned_forecasts(spark, folder):
    """Every customer's series cut to the length of the shortest one."""
    rows = with_neighbours(_orders(spark, folder), KEYS, ORDER, [PRICE], position="pos")
    kept = align_forecasts(rows, "o_custkey", "pos")
    return kept.select("o_custkey", F.concat(F.lit("T"), F.col("pos").cast("string")).alias("label"), PRICE)


@query("""
select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) - 1 as row_index from orders
""")
def row_index(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return with_row_index(rows, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_index")


@query("""
select o_orderkey, o_custkey from orders
qualify row_number() over (order by o_orderdate, o_orderkey) > 100
""")
def skipped_rows(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return skip_rows(rows, ["o_orderdate", "o_orderkey"], 100).select("o_orderkey", "o_custkey")
