"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.functions.encoding import (
    bucket_three, bucket_two, difference, encode_binary, encode_ordinal, last_positive, ratio, relative_change,
    un_one_hot,
)
from fathomline.functions.filings import archive_url, filing_folder_path, financial_report_path, pad_security_id
from fathomline.functions.text import (
    as_of_date, as_of_text, parse_access_log, price_or_zero, request_url, split_fields, upper,
)
from fathomline.operators.counts import count_by, count_codes
from fathomline.plans.catalog.registry import query, table

_PATH = "'edgar/data/' || o_custkey || '/' || lpad(o_orderkey::varchar, 10, '0') || '-16-2.txt'"


@query(f"""
select o_orderkey,
       'edgar/data/' || o_custkey || '/' || lpad(o_orderkey::varchar, 10, '0') || '162/'
         || lpad(o_orderkey::varchar, 10, '0') || '-16-2.txt' as folder_path,
       replace(replace({_PATH}, '-', ''), '.txt', '') || '/Financial_Report.xlsx' as report_path,
       'https://www.sec.gov/Archives/' || {_PATH} as url
from orders
""")
def filing_paths(spark, folder):
    path = F.concat(
        F.lit("edgar/data/"), F.col("o_custkey").cast("string"), F.lit("/"),
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit("-16-2.txt"),
    )
    rows = table(spark, folder, "orders").select("o_orderkey", path.alias("path"))
    return rows.select(
        "o_orderkey", filing_folder_path(F.col("path")).alias("folder_path"),
        financial_report_path(F.col("path")).alias("report_path"), archive_url(F.col("path")).alias("url"),
    )


@query("""
select page_id, case when starts_with(url, 'http') then url else 'https://www.sec.gov/Archives/' || url end as url
from pages
""")
def page_addresses(spark, folder):
    return table(spark, folder, "pages").select("page_id", archive_url(F.col("url")).alias("url"))


@query("""
with k as (select o_orderkey, (o_orderkey * 90001)::varchar as id from orders)
select o_orderkey, case when length(id) < 8 then lpad(id, 8, '0') else id end as id from k
""")
def security_padding(spark, folder):
    key = (F.col("o_orderkey") * 90001).cast("string")
    return table(spark, folder, "orders").select("o_orderkey", pad_security_id(key).alias("id"))


@query("""
select event_id, case when event_type = 'error' then '[error]' else '/u/' || user_id end as url,
       '10.0.' || (user_id // 256) || '.' || (user_id % 256) as ip,
       case when event_type = 'error' then '500' else '200' end as status, event_type as agent
from events
""")
def access_log_fields(spark, folder):
    """Log lines built from the events, parsed back; error events carry a malformed request."""
    user = F.col("user_id")
    request = F.when(F.col("event_type") == "error", "-").otherwise(
        F.concat(F.lit("GET /u/"), user.cast("string"), F.lit(" HTTP/1.1"))
    )
    line = F.format_string(
        '10.0.%d.%d - - [%s] "%s" %s %d "-" "%s"',
        F.floor(user / 256), user % 256, F.col("ts").cast("string"), request,
        F.when(F.col("event_type") == "error", "500").otherwise("200"), F.length("props"), F.col("event_type"),
    )
    parsed = parse_access_log(table(spark, folder, "events").select("event_id", line.alias("line")), "line")
    return parsed.select("event_id", request_url(F.col("request")).alias("url"), "ip", "status", "agent")


@query("""
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as as_of, strftime(o_orderdate, '%m/%d/%Y') as as_of_text,
       case when o_orderstatus = 'P' then 0.0 else o_totalprice end as price, upper(o_orderpriority) as priority
from orders
""")
def dates_and_prices(spark, folder):
    price = F.when(F.col("o_orderstatus") == "P", "N/A").otherwise(F.col("o_totalprice").cast("string"))
    day = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey", as_of_date(day).cast("string").alias("as_of"), as_of_text(day).alias("as_of_text"),
        price_or_zero(price).alias("price"), upper(F.col("o_orderpriority")).alias("priority"),
    )


@query("""
select o_orderkey, split_part(o_orderpriority, '-', 1) as level, split_part(o_orderpriority, '-', 2) as name from orders
""")
def split_priority(spark, folder):
    level, name = split_fields(F.col("o_orderpriority"), "-", 0, 1)
    return table(spark, folder, "orders").select("o_orderkey", level.alias("level"), name.alias("name"))


@query("""
select code, count(*) as n from (select unnest(string_split(l_returnflag || l_linestatus, '')) as code from lineitem)
where code <> '' group by code
""")
def character_codes(spark, folder):
    codes = table(spark, folder, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("codes"))
    return count_codes(codes, "codes", issuer=None)


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
       case when l_tax = 0 then null else round(l_discount / l_tax, 6) end as ratio,
       round(l_extendedprice / l_quantity - 1, 8) as change, round(l_discount - l_tax, 6) as diff
from lineitem
""")
def ratios(spark, folder):
    c = F.col
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(ratio(c("l_discount"), c("l_tax")), 6).alias("ratio"),
        F.round(relative_change(c("l_extendedprice"), c("l_quantity")), 8).alias("change"),
        F.round(difference(c("l_discount"), c("l_tax")), 6).alias("diff"),
    )


@query("""
select p_partkey,
       case when p_brand = 'Brand#1' then 1 else 0 end as is_first,
       case p_type when 'ECONOMY' then 0 when 'PROMO' then 1 else 2 end as type_code,
       case when p_size <= 40 then 1 else 2 end as bucket2,
       case when p_size <= 15 then 1 when p_size < 35 then 2 else 3 end as bucket3
from part
""")
def encoded_parts(spark, folder):
    size = F.col("p_size")
    return table(spark, folder, "part").select(
        "p_partkey", encode_binary(F.col("p_brand"), "Brand#1").alias("is_first"),
        encode_ordinal(F.col("p_type"), ["ECONOMY", "PROMO"]).alias("type_code"),
        bucket_two(size).alias("bucket2"), bucket_three(size, 15, 35).alias("bucket3"),
    )


@query("""
select case when l_tax > 0.04 then 3 when l_discount > 0.05 then 2 when l_quantity > 25 then 1 else 0 end
         as last_set, count(*) as n
from lineitem group by 1
""")
def last_positive_indicator(spark, folder):
    marks = [F.col("l_quantity") - 25, F.col("l_discount") - 0.05, F.col("l_tax") - 0.04]
    rows = table(spark, folder, "lineitem").select(last_positive(marks).alias("last_set"))
    return count_by(rows, "last_set")


@query("""
select event_id, case event_type when 'click' then 0 when 'view' then 1 when 'error' then 2 else -1 end as kind
from events
""")
def restored_category(spark, folder):
    """Indicator columns turned back into one category number."""
    kinds = ["click", "view", "error"]
    rows = table(spark, folder, "events").select(
        "event_id", *[F.when(F.col("event_type") == k, 1.0).otherwise(0.0).alias(f"is_{k}") for k in kinds]
    )
    return un_one_hot(rows, [f"is_{k}" for k in kinds], "kind")
