"""Equi-joins, lookups and period comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.operators.counts import sum_by
from fathomline.operators.joins import (
    compare_periods, enrich_company, enrich_security, join_on_date, series_by_date, join_using, lookup_with_default,
)
from fathomline.plans.catalog.registry import query, table
from fathomline.plans.reports import top_holdings


@query("""
select o_custkey as custkey, c_name, o_orderkey, o_totalprice from orders join customer on c_custkey = o_custkey
""")
def joined_using_key(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return join_using(orders, customers, "custkey")


@query("""
select n_name, round(sum(c_acctbal), 2) as total from customer join nation on c_nationkey = n_nationkey
group by n_name
""")
def sum_by_nation(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("n_nationkey"), "c_acctbal")
    named = join_using(customers, table(spark, folder, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    return sum_by(named, "n_name", "c_acctbal").withColumn("total", F.round("total", 2))


@query("""
select p_brand, coalesce(short, 'no_mapping_found') as short, count(*) as n
from lineitem join part on p_partkey = l_partkey
left join (select distinct p_brand as brand, 'code-' || p_brand as short from part where p_brand < 'Brand#2') m
  on brand = p_brand
group by p_brand, short
""")
def lookup_default(spark, folder):
    part = table(spark, folder, "part")
    codes = part.filter(F.col("p_brand") < "Brand#2").select("p_brand").distinct()
    codes = codes.withColumn("short", F.concat(F.lit("code-"), "p_brand"))
    lines = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    rows = lines.join(part.select("p_partkey", "p_brand"), "p_partkey")
    return lookup_with_default(rows, codes, "p_brand", "short").groupBy("p_brand", "short").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""
with t as (select l_partkey, count(*) as n from lineitem group by l_partkey),
d as (select case when length(p_partkey::varchar) < 8 then lpad(p_partkey::varchar, 8, '0') else p_partkey::varchar end
        as k, p_name, p_brand from part where p_size > 25)
select l_partkey::varchar as cusip, n, coalesce(p_name, '') as name, coalesce(p_brand, '') as ticker
from t left join d
  on k = case when length(l_partkey::varchar) < 8 then lpad(l_partkey::varchar, 8, '0') else l_partkey::varchar end
""")
def enriched_securities(spark, folder):
    counts = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("cusip")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return enrich_security(counts, _securities(spark, folder, F.col("p_size") > 25))


def _securities(spark, folder, kept):
    return table(spark, folder, "part").filter(kept).select(
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("cusip"),
        F.col("p_name").alias("name"), F.col("p_brand").alias("ticker"),
    )


@query("""
with t as (select l_partkey, sum(l_linenumber)::bigint as total from lineitem group by l_partkey
           order by total desc, l_partkey::varchar limit 30)
select l_partkey::varchar as cusip, total, p_name as name, p_brand as ticker
from t join part on p_partkey = l_partkey
""")
def top_holdings_report(spark, folder):
    counts = table(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("cusip"), F.col("l_linenumber").alias("numfilings")
    )
    return top_holdings(counts, _securities(spark, folder, F.lit(True)))


@query("""
with s as (select o_custkey, round(avg(o_totalprice), 8) as beta from orders group by o_custkey)
select c_custkey as symbol, c_name, beta from customer join s on o_custkey = c_custkey
""")
def enriched_companies(spark, folder):
    companies = table(spark, folder, "customer").select(F.col("c_custkey").alias("symbol"), "c_name")
    stats = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("symbol")).agg(
        F.round(F.avg("o_totalprice"), 8).alias("beta")
    )
    return enrich_company(companies, stats)


@query("""
with d as (select strftime(o_orderdate, '%Y-%m-%d') as date, o_orderpriority as p, round(sum(o_totalprice), 2) as t
           from orders group by 1, 2)
select a.date, a.t as urgent, b.t as high, c.t as medium, e.t as unspecified, f.t as low
from d a join d b on a.date = b.date join d c on a.date = c.date join d e on a.date = e.date join d f on a.date = f.date
where a.p = '1-URGENT' and b.p = '2-HIGH' and c.p = '3-MEDIUM' and e.p = '4-NOT SPECIFIED' and f.p = '5-LOW'
""")
def series_joined_on_date(spark, folder):
    """The daily totals of all five priorities, side by side."""
    orders = table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "o_orderpriority", "o_totalprice")
    names = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}
    return series_by_date(orders, "o_orderpriority", F.col("o_totalprice"), names, measure=lambda x: F.round(F.sum(x), 2))


@query("""
with a as (select date, sum(o_totalprice) as t from (select strftime(o_orderdate, '%Y-%m-%d') as date, * from orders)
           where o_orderpriority = '1-URGENT' group by date),
b as (select date, sum(o_totalprice) as t from (select strftime(o_orderdate, '%Y-%m-%d') as date, * from orders)
      where o_orderpriority = '5-LOW' group by date)
select a.date, round(a.t, 2) as urgent, round(b.t, 2) as low from a join b using (date)
""")
def frames_joined_on_date(spark, folder):
    """Two frames that share nothing but the date."""
    orders = table(spark, folder, "orders").withColumn("date", F.date_format("o_orderdate", "yyyy-MM-dd"))

    def daily(priority, name):
        rows = orders.filter(F.col("o_orderpriority") == priority)
        return rows.groupBy("date").agg(F.round(F.sum("o_totalprice"), 2).alias(name))

    return join_on_date([daily("1-URGENT", "urgent"), daily("5-LOW", "low")])


@query("""
with a as (select o_custkey, count(*) as n from orders
           where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1997-01-01' group by o_custkey),
b as (select o_custkey, count(*) as n from orders
      where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1998-01-01' group by o_custkey)
select a.o_custkey, a.n as earlier, b.n as later, b.n - a.n as diff from a join b on a.o_custkey = b.o_custkey
""")
def period_over_period(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate")

    def year(y):
        day = F.col("o_orderdate")
        return orders.filter((day >= F.lit(f"{y}-01-01")) & (day < F.lit(f"{y + 1}-01-01")))

    return compare_periods(year(1996), year(1997), "o_custkey", F.count(F.lit(1)))
