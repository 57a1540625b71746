"""Sources and sinks: a table is written in some format below the shared folder and read back."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from fathomline.operators.counts import count_by, top_k
from fathomline.operators.filters import null_counts
from fathomline.operators.ordering import with_row_index
from fathomline.plans.catalog.registry import query, table
from fathomline.plans.flow import Flow
from fathomline.plans.resumable import ResumableFlow, Step
from fathomline.session import fresh_path, materialize, spread
from fathomline.sinks.batches import append_batch, load_batches, stage_batch
from fathomline.sinks.single import Folder
from fathomline.sinks.tables import (
    load_table, store_table, write_csv, write_documents, write_parquet, write_ranked_csv, write_sorted_text,
)
from fathomline.sources.archives import read_zip_members
from fathomline.sources.filings import explode_zip, read_documents, read_filing_index
from fathomline.sources.market import explode_forecast, explode_quotes
from fathomline.sources.relations import read_adjacency, read_item_names, read_ratings
from fathomline.sources.tables import read_csv, read_json, read_lines, read_parquet, read_positional


@query("""
select c_mktsegment, count(*) as n, round(sum(c_acctbal), 2) as total from customer group by c_mktsegment
""")
def csv_round_trip(spark, folder):
    path = fresh_path(spark, "csv")
    write_csv(table(spark, folder, "customer"), path)
    rows = read_csv(spark, path, schema="c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    return rows.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total")
    )


@query("""
select 'key' as "column", count(*) filter (where c_custkey is null) as nulls from customer
union all select 'balance', count(*) filter (where c_acctbal < 0) from customer
union all select 'nation', count(*) filter (where c_mktsegment = 'BUILDING') from customer
""")
def positional_scan(spark, folder):
    """Headerless file with ``?`` for a missing value."""
    path = fresh_path(spark, "positional")
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    table(spark, folder, "customer").select(
        "c_custkey",
        F.when(balance < 0, "?").otherwise(balance.cast("string")).alias("balance"),
        F.when(F.col("c_mktsegment") == "BUILDING", "?").otherwise(nation.cast("string")).alias("nation"),
    ).write.csv(path)
    rows = read_positional(spark, path, ["key", "balance", "nation"], {"key": "long", "balance": "double", "nation": "int"})
    return null_counts(rows)


@query("select count(*) as n, sum(c_custkey)::bigint as keys from customer")
def line_scan(spark, folder):
    """Lines of several files named by one comma-separated list with a common prefix."""
    base = fresh_path(spark, "lines")
    line = F.concat_ws("|", "c_custkey", "c_name").alias("value")
    customers = table(spark, folder, "customer")
    customers.filter("c_acctbal >= 0").select(line).write.text(f"{base}/in")
    customers.filter("c_acctbal < 0").select(line).write.text(f"{base}/out")
    rows = read_lines(spark, "in,out", f"{base}/")
    key = F.get(F.split("value", r"\|"), F.lit(0)).cast("long")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum(key).alias("keys"))


@query("""
select o_custkey::varchar as cik, count(*) as filings from orders where o_orderstatus = 'F'
group by 1 order by filings desc, cik limit 20
""")
def filing_index_scan(spark, folder):
    """An index file with preamble and header lines, filtered on one form type and ranked."""

    def extract(session, source):
        path = fresh_path(session, "index")
        orders = table(session, source, "orders")
        line = F.concat_ws(
            "|", "o_custkey", F.concat(F.lit("Customer "), "o_custkey"), "o_orderstatus",
            F.date_format("o_orderdate", "yyyyMMdd"),
            F.concat(F.lit("edgar/data/"), F.col("o_orderkey").cast("string"), F.lit(".txt")),
        )
        head = orders.select(F.explode(F.array(
            F.lit("Description: index of filings"), F.lit("CIK|Company Name|Form Type|Date Filed|File Name"),
            F.lit("-" * 40),
        )).alias("value")).distinct()
        orders.select(line.alias("value")).unionByName(head).write.text(path)
        return read_filing_index(session, path, "F")

    def rank(index):
        return top_k(count_by(index, "cik", "filings"), "filings", 20, ["cik"])

    return Flow(extract, rank, lambda df: df).run(spark, folder)


@query("select event_type, count(*) as n, round(sum(value), 2) as total from events group by event_type")
def json_scan(spark, folder):
    path = fresh_path(spark, "json")
    table(spark, folder, "events").select("event_type", "value", "user_id").write.json(path)
    rows = read_json(spark, path, "event_type string, value double, user_id long")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("select (props::json ->> 'k')::integer as k, count(*) as n from events group by 1")
def json_properties(spark, folder):
    value = F.from_json("props", "k int")["k"]
    return count_by(table(spark, folder, "events").select(value.alias("k")), "k")


@query("""
select count(*) as n, round(sum(o_totalprice), 2) as close_total, count(distinct o_orderdate::date) as days from orders
""")
def quote_arrays(spark, folder):
    """Quote-history JSON built per order, then expanded."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    payload = F.to_json(F.array(F.struct(
        day.alias("date"), F.col("o_totalprice").alias("open"), F.col("o_totalprice").alias("close"),
        F.lit(1.0).alias("volume"), F.lit(0.5).alias("changePercent"),
    )))
    rows = explode_quotes(table(spark, folder, "orders").select("o_orderkey", payload.alias("json")), "json")
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("close"), 2).alias("close_total"),
        F.count_distinct("date").alias("days"),
    )


@query("""
select label, count(*) as n, sum(v)::bigint as total from (
  select 'T0' as label, o_custkey as v from orders union all
  select 'T1', o_custkey + 1 from orders union all
  select 'T2', o_custkey + 2 from orders) group by label
""")
def forecast_maps(spark, folder):
    """Map-of-maps JSON built per order; keys 1, 2 and 10 must come out in number order."""
    key = F.col("o_custkey")
    payload = F.to_json(F.create_map(
        F.lit("Fiscal"), F.create_map(F.lit("0"), F.lit("Dec")),
        F.lit("Consensus"), F.create_map(
            F.lit("10"), (key + 2).cast("string"), F.lit("1"), key.cast("string"), F.lit("2"), (key + 1).cast("string"),
        ),
    ))
    rows = explode_forecast(table(spark, folder, "orders").select("o_orderkey", payload.alias("json")), "json")
    return rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("long")).alias("total")
    )


@query("select count(*) as n, sum(length(html))::bigint as chars from pages")
def whole_document_scan(spark, folder):
    """Every page landed as a file of its own, then read back one row per file."""
    path = fresh_path(spark, "pages")
    # Tasks publish their own files; otherwise the driver renames them one by one at the end.
    writer = spread(table(spark, folder, "pages").select("html")).write.option("maxRecordsPerFile", 1)
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    # The text writer ends each file with a line break that is not part of the page.
    body = F.regexp_replace("content", r"\n\z", "")
    rows = read_documents(spark, path).select(F.length(body).alias("size"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").cast("long").alias("chars"))


@query("""
select doc_id || '.txt' as name, length(text) as size from documents
union all select doc_id || '.lang', length(lang) from documents
""")
def archive_members(spark, folder):
    """Each document zipped with its language, then expanded member by member."""

    def zipped(doc_id, text, lang):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
            archive.writestr(f"{doc_id}.txt", text)
            archive.writestr(f"{doc_id}.lang", lang)
        return buffer.getvalue()

    def pack(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 200):  # some rows at a time, whatever the batch holds
                rows = batch.slice(start, 200)
                blobs = [zipped(*(value.as_py() for value in row)) for row in zip(*rows.columns, strict=True)]
                yield pa.record_batch([pa.array(blobs, pa.binary())], ["content"])

    documents = spread(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    archives = documents.mapInArrow(pack, "content binary")
    return explode_zip(archives).select("name", F.length("text").cast("long").alias("size"))


@query("""
select doc_id || '.txt' as name, length(text) as size from documents
union all select doc_id || '.lang', length(lang) from documents
""")
def archive_member_ranges(spark, folder):
    """All documents in one archive per partition, each archive landed as a file and read by ranges of members."""
    base = fresh_path(spark, "archives")
    place = Folder(spark, base)
    address = place.path(base).makeQualified(place.system.getUri(), place.system.getWorkingDirectory()).toUri().toString()

    def pack(batches):
        system, path = fs.FileSystem.from_uri(address)
        system.create_dir(path)
        with system.open_output_stream(f"{path}/{uuid.uuid4().hex}.zip") as file:
            with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
                for batch in batches:
                    for doc_id, text, lang in zip(batch["doc_id"], batch["text"], batch["lang"], strict=True):
                        archive.writestr(f"{doc_id}.txt", text)
                        archive.writestr(f"{doc_id}.lang", lang)
        yield pd.DataFrame({"path": [path]})

    documents = spread(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    materialize(documents.mapInPandas(pack, "path string"), "packed")
    members = read_zip_members(spark, f"{base}/*.zip", range_bytes=1 << 20)
    return members.select("name", F.length("text").cast("long").alias("size"))


@query("""
select l_suppkey as src, count(*) as degree, count(distinct d) as neighbours from (
  select l_suppkey, l_partkey as d from lineitem union all select l_suppkey, l_orderkey from lineitem)
group by l_suppkey
""")
def adjacency_scan(spark, folder):
    path = fresh_path(spark, "adjacency")
    line = F.concat_ws(" ", "l_suppkey", "l_partkey", "l_orderkey")
    table(spark, folder, "lineitem").select(line.alias("value")).write.text(path)
    edges = read_adjacency(spark, path)
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"), F.count_distinct("dst").alias("neighbours"))


@query("""
select l_partkey as item, p_name as name, count(*) as n, round(avg(l_quantity), 6) as rating
from lineitem join part on p_partkey = l_partkey group by l_partkey, p_name
""")
def ratings_scan(spark, folder):
    """Ratings with a two-character separator and item names with another one."""
    base = fresh_path(spark, "ratings")
    table(spark, folder, "lineitem").select(
        F.concat_ws("::", "l_orderkey", "l_partkey", "l_quantity").alias("value")
    ).write.text(f"{base}/ratings")
    table(spark, folder, "part").select(
        F.concat_ws("|", "p_partkey", "p_name", "p_brand").alias("value")
    ).write.text(f"{base}/names")
    ratings, names = read_ratings(spark, f"{base}/ratings", "::"), read_item_names(spark, f"{base}/names", "|")
    means = ratings.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("rating"), 6).alias("rating"))
    return means.join(names, "item").select("item", "name", "n", "rating")


@query("""
select l_suppkey, count(*) as n from lineitem group by l_suppkey
""")
def ranked_csv_sink(spark, folder):
    path = fresh_path(spark, "ranked")
    write_ranked_csv(count_by(table(spark, folder, "lineitem"), "l_suppkey"), path, "n", ["l_suppkey"])
    return read_csv(spark, path, schema="l_suppkey long, n long")


@query("""
select row_number() over (order by o_totalprice desc, o_orderkey) - 1 as line, o_orderkey, o_totalprice, o_orderpriority
from orders
""")
def single_file_sink(spark, folder):
    """All orders in one file, the dearest first; read back with the number of every line."""
    path = fresh_path(spark, "single") + ".csv"
    columns = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    write_ranked_csv(table(spark, folder, "orders").select(*columns), path, "o_totalprice", ["o_orderkey"], single_file=True)
    lines = read_csv(spark, path, schema="o_orderkey long, o_totalprice double, o_orderpriority string")
    return with_row_index(lines.withColumn("at", F.monotonically_increasing_id()), ["at"], "line").drop("at")


@query("select event_type as filing_type, count(*) as count from events group by 1")
def parquet_sink(spark, folder):
    path = fresh_path(spark, "parquet")
    counts = count_by(table(spark, folder, "events").withColumnRenamed("event_type", "filing_type"), "filing_type", "count")
    write_parquet(counts, path)
    return read_parquet(spark, path)


@query("select count(*) * 2 as n, round(sum(o_totalprice) * 2, 1) as total from orders")
def appended_table(spark, folder):
    """A table stored once, appended once and read back."""
    path = fresh_path(spark, "store")
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    store_table(rows, path)
    store_table(rows, path, append=True)
    return load_table(spark, path).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 1).alias("total")
    )


@query("""
select o_orderstatus as status, count(*) as n, round(sum(o_totalprice), 1) as total from orders group by o_orderstatus
""")
def repeated_appends(spark, folder):
    """Batches by order status: each is staged by a run that dies, then appended, then appended once more."""
    path = fresh_path(spark, "batches")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for status in ("F", "O", "P"):
        batch = orders.filter(F.col("o_orderstatus") == status)
        stage_batch(batch, path)
        append_batch(batch, path, status)
        append_batch(batch, path, status)
    return load_batches(spark, path).groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 1).alias("total")
    )


@query("""
select c_mktsegment as segment, count(*) as orders, round(sum(o_totalprice), 1) as total
from orders join customer on c_custkey = o_custkey where o_orderstatus <> 'P' group by c_mktsegment
""")
def resumed_flow(spark, folder):
    """A flow of three steps whose last one fails at first; the second run goes on from the stored steps."""
    state = {"ready": False}

    def totals(df):
        if not state["ready"]:
            raise RuntimeError("the last step is not ready")
        return df.groupBy(F.col("c_mktsegment").alias("segment")).agg(
            F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 1).alias("total")
        )

    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    flow = ResumableFlow(
        lambda session: table(session, folder, "orders"),
        [f"{folder}/orders.parquet", f"{folder}/customer.parquet"],
        [
            Step("shipped", lambda df: df.filter("o_orderstatus <> 'P'").select("o_custkey", "o_totalprice")),
            Step("segments", lambda df: df.join(customers, "o_custkey")),
            Step("totals", totals),
        ],
        fresh_path(spark, "flow"),
    )
    try:
        flow.run(spark)
    except RuntimeError:
        state["ready"] = True
    result = flow.run(spark)
    if [(o.name, o.reused) for o in flow.outcomes] != [("segments", True), ("totals", False)]:
        raise AssertionError(f"steps were not read back: {flow.outcomes}")
    return result


@query("select n_name || chr(9) || n_nationkey || chr(9) || n_regionkey as value from nation")
def sorted_text_sink(spark, folder):
    path = fresh_path(spark, "sorted")
    write_sorted_text(table(spark, folder, "nation").select("n_name", "n_nationkey", "n_regionkey"), ["n_name"], path)
    return spark.read.text(path)


@query("select doc_id || '.txt' as name, length(text) as size from documents")
def document_sink(spark, folder):
    path = fresh_path(spark, "documents")
    rows = table(spark, folder, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), "text")
    write_documents(rows, path, "name", "text")
    return spark.read.parquet(path).select("name", F.length("content").cast("long").alias("size"))
