"""Counts, sums, modes, medians, imputations and encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.functions.encoding import encode_sorted
from fathomline.learning.cleaning import clean_passengers, impute_mean, impute_median, impute_mode, impute_zero
from fathomline.operators.columns import cast_columns, drop_columns, rename_all
from fathomline.operators.counts import (
    append_rows, count_by, count_rows, count_tokens, distinct_values, mean_by, mean_of, most_common, pivot_codes,
    sum_by, top_filers, top_k,
)
from fathomline.operators.filters import (
    count_containing, filter_above, filter_lines, null_counts, random_split, sample_by_keys, sample_fraction,
)
from fathomline.operators.quantiles import median_by, median_of, upper_median
from fathomline.plans.catalog.registry import query, table
from fathomline.plans.flow import compose, sql_over
from fathomline.session import spread


@query("""
select user_id, count(*) as filings from events where event_type = 'purchase'
group by user_id order by filings desc, user_id limit 20
""")
def top_filers_report(spark, folder):
    return top_filers(table(spark, folder, "events"), "purchase", 20, "user_id", "event_type")


@query("select event_type, count(*) as n from events group by event_type")
def count_by_type(spark, folder):
    return count_by(table(spark, folder, "events"), "event_type")


@query("select count(*) as n from lineitem")
def global_count(spark, folder):
    return count_rows(table(spark, folder, "lineitem"))


@query("""
select l_partkey, sum(l_quantity) as total from lineitem group by l_partkey
""")
def sum_by_part(spark, folder):
    return sum_by(table(spark, folder, "lineitem"), "l_partkey", "l_quantity")


@query("""
select token, count(*) as n from (select unnest(string_split(text, ' ')) as token from documents)
where token <> '' group by token
""")
def token_count(spark, folder):
    return count_tokens(spread(table(spark, folder, "documents").select("text")), "text", " ")


@query("""
select token, count(*) as n from (select unnest(string_split(text, ' ')) as token from documents)
where token <> '' group by token order by n desc, token limit 30
""")
def top_tokens(spark, folder):
    tokens = count_tokens(spread(table(spark, folder, "documents").select("text")), "text", " ")
    return top_k(tokens, "n", 30, ["token"])


@query("""
select user_id,
       count(*) filter (where event_type = 'click') as click,
       count(*) filter (where event_type = 'error') as error,
       count(*) filter (where event_type = 'purchase') as purchase,
       count(*) filter (where event_type = 'signup') as signup,
       count(*) filter (where event_type = 'view') as view
from events group by user_id
""")
def pivoted_codes(spark, folder):
    kinds = ["click", "error", "purchase", "signup", "view"]
    return pivot_codes(table(spark, folder, "events"), "user_id", "event_type", kinds)


@query("select distinct source from documents")
def distinct_sources(spark, folder):
    return distinct_values(table(spark, folder, "documents"), "source")


@query("select round(avg(l_extendedprice), 4) as mean from lineitem")
def mean_price(spark, folder):
    return mean_of(table(spark, folder, "lineitem"), "l_extendedprice").select(F.round("mean", 4).alias("mean"))


@query("select l_returnflag, round(avg(l_extendedprice), 4) as mean from lineitem group by l_returnflag")
def mean_by_flag(spark, folder):
    rows = mean_by(table(spark, folder, "lineitem"), "l_returnflag", "l_extendedprice")
    return rows.withColumn("mean", F.round("mean", 4))


@query("select median(l_extendedprice) as median from lineitem")
def median_price(spark, folder):
    return median_of(table(spark, folder, "lineitem"), "l_extendedprice")


@query("select l_suppkey, median(l_extendedprice) as median from lineitem group by l_suppkey")
def median_by_supplier(spark, folder):
    return median_by(table(spark, folder, "lineitem"), ["l_suppkey"], "l_extendedprice")


@query("""
with s as (select c_acctbal, row_number() over (order by c_acctbal) - 1 as pos, count(*) over () as n from customer)
select c_acctbal as upper_median from s where pos = n // 2
""")
def upper_median_balance(spark, folder):
    return upper_median(table(spark, folder, "customer"), "c_acctbal")


@query("""
(select 'c_mktsegment' as "column", c_mktsegment as value, count(*) as n from customer
 group by c_mktsegment order by n desc, value limit 1)
union all
(select 'c_nationkey', cast(c_nationkey as varchar), count(*) as n from customer
 group by c_nationkey order by n desc, c_nationkey limit 1)
""")
def most_common_values(spark, folder):
    return most_common(table(spark, folder, "customer"), ["c_mktsegment", "c_nationkey"])


@query("select count(*) filter (where contains(text, 'the')) as n from documents")
def containing_count(spark, folder):
    return count_containing(table(spark, folder, "documents"), "text", "the")


@query("""
select 'c_acctbal' as "column", count(*) filter (where c_acctbal < 0) as nulls from customer
union all
select 'c_mktsegment', count(*) filter (where c_mktsegment = 'BUILDING') from customer
union all
select 'c_nationkey', count(*) filter (where c_nationkey is null) from customer
""")
def null_count_by_column(spark, folder):
    rows = table(spark, folder, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
        "c_nationkey",
    )
    return null_counts(rows)


@query("select c_custkey, c_acctbal from customer where c_acctbal > 1.0")
def above_threshold(spark, folder):
    return filter_above(table(spark, folder, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query("""
select doc_id, n_chars from documents where lang = 'en' and contains(text, 'the')
""")
def predicate_filter(spark, folder):
    rows = filter_lines(table(spark, folder, "documents"), (F.col("lang") == "en") & F.col("text").contains("the"))
    return rows.select("doc_id", "n_chars")


@query("""
select o_orderkey as key, o_totalprice as price, case when o_orderstatus = 'F' then 1.0 end as flag from orders
""")
def reshaped_orders(spark, folder):
    """Positional rename, cast of dirty text, drop with an absent name."""
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("string"),
        F.when(F.col("o_orderstatus") == "F", "1").otherwise("?"), "o_custkey",
    )
    step = compose(
        lambda df: rename_all(df, ["key", "price", "flag", "customer"]),
        lambda df: cast_columns(df, {"price": "double", "flag": "double"}),
        lambda df: drop_columns(df, ["customer", "not_there"]),
    )
    return step(rows)


@query("""
select o_orderkey, o_totalprice from orders union all select -1, 0.0
""")
def appended_filler(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    filler = spark.range(1).select(F.lit(-1).cast("long").alias("o_orderkey"), F.lit(0.0).alias("o_totalprice"))
    return append_rows(rows, filler)


@query("select n_name, n_regionkey from nation order by n_name limit 10")
def first_rows(spark, folder):
    return table(spark, folder, "nation").select("n_name", "n_regionkey").orderBy("n_name").limit(10)


@query("""
select o_orderpriority, count(*) as n, round(max(o_totalprice), 2) as top from orders
where o_orderstatus = 'F' group by o_orderpriority
""")
def sql_view(spark, folder):
    return sql_over(
        table(spark, folder, "orders"), "orders_view",
        "select o_orderpriority, count(*) as n, round(max(o_totalprice), 2) as top from orders_view "
        "where o_orderstatus = 'F' group by o_orderpriority",
    )


@query()
def sampled_events(spark, folder):
    return sample_fraction(table(spark, folder, "events").select("event_id", "event_type"), 0.1, 42)


@query("""
select event_id, event_type from events
where ('0x' || substr(md5('42:' || event_id), 1, 12))::ubigint < round(0.1 * 281474976710656)::ubigint
""")
def events_sampled_by_id(spark, folder):
    return sample_by_keys(table(spark, folder, "events").select("event_id", "event_type"), ["event_id"], 0.1, 42)


@query("select count(*) as n from lineitem")
def split_covers_all(spark, folder):
    """Rows of both random parts together."""
    a, b = random_split(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber"), [0.7, 0.3], 42)
    return count_rows(a.unionByName(b))


# --- imputation; the tables hold no nulls, so both engines turn some values into null first ---


def _gappy(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 1000, F.col("c_acctbal")).alias("balance"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.nullif("c_nationkey", F.lit(3)).alias("nation"),
    )


_GAPPY = """
with g as (
  select c_custkey, case when c_acctbal >= 1000 then c_acctbal end as balance,
         nullif(c_mktsegment, 'BUILDING') as segment, nullif(c_nationkey, 3) as nation
  from customer)
"""


@query(_GAPPY + """
select c_custkey,
       coalesce(segment, (select segment from g where segment is not null group by segment
                          order by count(*) desc, segment limit 1)) as segment,
       coalesce(nation, (select nation from g where nation is not null group by nation
                         order by count(*) desc, nation limit 1)) as nation
from g
""")
def imputed_mode(spark, folder):
    return impute_mode(_gappy(spark, folder), ["segment", "nation"]).select("c_custkey", "segment", "nation")


@query(_GAPPY + """
select c_custkey, round(coalesce(balance, (select avg(balance) from g)), 4) as balance from g
""")
def imputed_mean(spark, folder):
    rows = impute_mean(_gappy(spark, folder), "balance")
    return rows.select("c_custkey", F.round("balance", 4).alias("balance"))


@query(_GAPPY + """
select c_custkey, coalesce(balance, (select median(balance) from g)) as balance from g
""")
def imputed_median(spark, folder):
    return impute_median(_gappy(spark, folder), "balance").select("c_custkey", "balance")


@query(_GAPPY + """
, m as (select nation, median(balance) as m from g group by nation)
select c_custkey, coalesce(balance, m) as balance from g left join m on g.nation is not distinct from m.nation
""")
def imputed_median_by_nation(spark, folder):
    return impute_median(_gappy(spark, folder), "balance", "nation").select("c_custkey", "balance")


@query(_GAPPY + """
select c_custkey, coalesce(balance, 0) as balance, segment, coalesce(nation, 0) as nation from g
""")
def imputed_zero(spark, folder):
    return impute_zero(_gappy(spark, folder))


@query(_GAPPY + """
, e as (select balance, segment, case segment when 'AUTOMOBILE' then 'C' when 'FURNITURE' then 'Q'
               else case when segment is not null then 'S' end end as port from g)
select count(*) as n,
       round(sum(coalesce(balance, (select avg(balance) from g))), 2) as age_sum,
       count(*) filter (where segment = 'MACHINERY') as sex_sum,
       sum(case coalesce(port, (select port from e where port is not null group by port
                                order by count(*) desc, port limit 1))
             when 'C' then 0 when 'Q' then 1 else 2 end)::bigint as port_sum
from e
""")
def cleaned_passengers(spark, folder):
    """The passenger cleaning steps on a table of the same shape."""
    segment = F.col("segment")
    port = F.when(segment == "AUTOMOBILE", "C").when(segment == "FURNITURE", "Q").when(segment.isNotNull(), "S")
    rows = _gappy(spark, folder).select(
        F.col("c_custkey").alias("PassengerId"), F.col("balance").alias("Age"),
        F.when(segment == "MACHINERY", "male").otherwise("female").alias("Sex"),
        port.alias("Embarked"), F.lit("1").alias("Survived"),
    )
    return clean_passengers(rows).agg(
        F.count("Survived").alias("n"), F.round(F.sum("Age"), 2).alias("age_sum"),
        F.sum("SexInt").alias("sex_sum"), F.sum("EmbarkedInt").alias("port_sum"),
    )


@query("""
with d as (select p_type, row_number() over (order by p_type) - 1 as type_code
           from (select distinct p_type from part))
select p_partkey, type_code from part join d using (p_type)
""")
def sorted_encoding(spark, folder):
    return encode_sorted(table(spark, folder, "part"), "p_type", "type_code").select("p_partkey", "type_code")
