"""Ranked lexical search: the best documents for every query item, by a score of term weights and frequencies.

Only terms that some item asks for can score, so a document is its vector of frequencies of those terms. Documents of
one vector and one length value ``m`` have one score whatever the item: such a bag is hashed, documents of equal
hash are told apart by their vectors, and every class is scored once. A class that is not among the best ``top`` of an
item, by score and smallest id, has ``top`` documents ahead of all of its own, and of a class only its ``top`` smallest
ids matter. So members are numbered within their class by ascending id and only the first ``top`` of winning classes
are expanded, whatever the size of a group of copies.

Items are dealt into blocks of bounded vocabulary; a block's terms go to every task, and all documents are read once
per block. Scores are sums of whole numbers. A task keeps the best classes of each item while classes stream through.

Defined results: a null or blank text has no terms; it is counted nowhere and never returned. Null items have no terms
and return nothing. Repeated rows are documents of their own; of equal scores the smaller id comes first, null ids
last, and equal ids in any order (their rows are equal but for the rank). Items of one id are items of their own. Empty
tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.registry import query, table
from fathomline.llm.texts import small
from fathomline.session import materialize

TOP = 50
BLOCK_ITEMS = 2_000
BLOCK_BYTES = 16_000_000  # of the distinct terms of each item, summed over a block
CLASS_CHUNK = 1_024  # classes scored at once in a task
MAX_WINNERS = 1_000_000  # rows of three numbers that may be broadcast
_LAST = np.iinfo(np.int64).max  # stands for a null id in orders

# Letters, digits and everything beyond ASCII make terms; only A to Z change case.
_LETTERS = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """All terms of a UTF-8 text, in order."""
    return (text or b"").translate(_LETTERS).split()


def item_blocks(items: DataFrame, item: str, text: str):
    """Bounded lists of ``(item, terms)``; every item is in one of them."""
    words = F.array_distinct(F.filter(F.split(F.translate(
        F.coalesce(F.col(f"`{text}`"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != ""))
    rows = items.select(F.monotonically_increasing_id().alias("number"), F.col(f"`{item}`").alias("item"), words.alias("terms"))
    rows = materialize(rows.filter(F.size("terms") > 0), "items")
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda s, w: s + F.octet_length(w) + 8)
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    blocks = max(-(-count // BLOCK_ITEMS), -(-total // BLOCK_BYTES))
    for b in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == b).orderBy("number").collect()
        yield [(r.number, r.item, [w.encode() for w in r.terms]) for r in part]


def vectors(docs: DataFrame, vocabulary, key: str, text: str) -> DataFrame:
    """``id``, ``n`` (all terms) and ``bag``: places in the vocabulary and frequencies, as two runs of 32-bit numbers.

    ``vocabulary`` is a broadcast dictionary of terms.
    """
    def make(batches):
        known = vocabulary.value
        for batch in batches:
            counts, bags = [], []
            for text in batch.column("text"):
                found = terms(text.as_py())
                counts.append(len(found))
                pairs = sorted((known[t], c) for t, c in Counter(found).items() if t in known)
                bags.append(np.array(pairs, "<i4").T.tobytes())
            yield pa.record_batch([batch.column("id"), pa.array(counts, "int64"), pa.array(bags, "binary")], ["id", "n", "bag"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    return rows.mapInArrow(make, "id long, n long, bag binary")


def _frequencies(classes: DataFrame, width: int) -> np.ndarray:
    """Documents that hold each term, from the sizes of the classes that hold it."""
    def count(batches):
        total = np.zeros(width, "int64")
        for batch in batches:
            for bag, size in zip(batch.column("bag"), batch.column("size")):
                total[np.frombuffer(bag.as_py(), "<i4").reshape(2, -1)[0]] += size.as_py()
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held, "int64"), pa.array(total[held])], ["term", "df"])

    out = np.zeros(width, "int64")
    parts = classes.select("bag", "size").mapInArrow(count, "term long, df long")
    for r in parts.groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most one row per term of the block
        out[r.term] = r.df
    return out


class _Best:
    """The best classes of every item so far: by score, then by smallest id."""

    def __init__(self, items: int, top: int):
        self.top, self.frames, self.rows, self.limit = top, [], 0, max(200_000, 4 * items * top)
        self.floor = np.zeros(items, "int64")  # the score that is needed to be among the best

    def add(self, item, score, hash_, twin, first):
        self.frames.append(pd.DataFrame({"item": item, "score": score, "hash": hash_, "twin": twin, "first": first}))
        self.rows += len(item)
        if self.rows > self.limit:
            self.cut()

    def cut(self):
        rows = pd.concat(self.frames, ignore_index=True)
        rows = rows.sort_values(["item", "score", "first"], ascending=[True, False, True], kind="stable")
        rank = rows.groupby("item").cumcount()
        rows = rows[rank < self.top]
        last = rows[rank[rows.index] == self.top - 1]
        self.floor[last["item"]] = last["score"]
        self.frames, self.rows = [rows], len(rows)
        return rows


def _scored(classes: DataFrame, wanted, weights: np.ndarray, items: int, top: int) -> DataFrame:
    """Per task, the best classes of every item of the block. ``wanted`` is broadcast: by term, the items that hold it."""
    def score(batches):
        holders, best = wanted.value, _Best(items, top)
        for batch in batches:
            for at in range(0, batch.num_rows, CLASS_CHUNK):
                part = batch.slice(at, CLASS_CHUNK)
                pairs = [np.frombuffer(b.as_py(), "<i4").reshape(2, -1) for b in part.column("bag")]
                place = np.repeat(np.arange(len(pairs)), [p.shape[1] for p in pairs])
                term, tf = np.concatenate(pairs, axis=1).astype("int64")
                m = part.column("m").to_numpy()[place]
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
                order = np.argsort(term, kind="stable")
                term, place, value = term[order], place[order], value[order]
                borders = np.flatnonzero(np.diff(term, prepend=-1, append=-1))
                total = np.zeros((items, len(pairs)), "int64")
                for a, b in zip(borders[:-1], borders[1:]):
                    total[np.ix_(holders[term[a]], place[a:b])] += value[a:b]
                item, held = np.nonzero((total > 0) & (total >= best.floor[:, None]))
                first = part.column("first").fill_null(_LAST).to_numpy()
                best.add(item, total[item, held], part.column("hash").to_numpy()[held], part.column("twin").to_numpy()[held], first[held])
        if best.frames:
            yield pa.RecordBatch.from_pandas(best.cut(), preserve_index=False)

    columns = "item long, score long, hash long, twin long, first long"
    return classes.select("bag", "m", "hash", "twin", "first").mapInArrow(score, columns)


def _classes(bags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per class (``hash``, ``m``, ``bag``, ``size``, ``first``), and the classes that share a hash, with a number ``twin``."""
    found = bags.groupBy("hash", "m", "bag").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("first"))
    found = materialize(found, "bag-classes")
    shared = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash")
    shared = materialize(found.join(shared, "hash").withColumn(
        "twin", F.row_number().over(Window.partitionBy("hash").orderBy("m", "bag")).cast("long") - 1
    ).select("hash", "m", "bag", "twin"), "twins")
    return found, shared


def _with_twin(rows: DataFrame, shared: DataFrame, any_shared: bool) -> DataFrame:
    """Classes of one hash are told apart by their vectors; there are hardly any, so mostly nothing is joined."""
    if not any_shared:
        return rows.withColumn("twin", F.lit(0).cast("long"))
    return rows.join(shared, ["hash", "m", "bag"], "left").withColumn("twin", F.coalesce("twin", F.lit(0)))


def _search_block(docs: DataFrame, items: list, key: str, text: str, top: int, hash_bits: int) -> DataFrame | None:
    context = docs.sparkSession.sparkContext
    places = {t: i for i, t in enumerate(sorted({t for _, _, found in items for t in found}))}
    bags = materialize(vectors(docs, context.broadcast(places), key, text), "bags")
    n_docs, n_terms = bags.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    bags = bags.filter(F.octet_length("bag") > 0).withColumn(
        "m", (50 + F.expr(f"(cast(50 as decimal(38, 0)) * n * {n_docs}) div {max(n_terms, 1)}")).cast("long"))
    bags = bags.withColumn("hash", F.xxhash64("m", "bag").bitwiseAND(F.lit((1 << hash_bits) - 1)))
    classes, shared = _classes(bags)
    any_shared = not shared.isEmpty()
    classes = _with_twin(classes, shared, any_shared)
    df = _frequencies(classes, len(places))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], "int64")
    holders = [[] for _ in places]
    for i, (_, _, found) in enumerate(items):
        for t in found:
            holders[places[t]].append(i)
    wanted = context.broadcast([np.array(h) for h in holders])
    scored = _scored(classes, wanted, weights, len(items), top)
    best = Window.partitionBy("item").orderBy(F.desc("score"), "first", "hash", "twin")
    winners = materialize(scored.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= top)
                          .select("item", "score", "hash", "twin"), "winning-classes")
    chosen = small(materialize(winners.select("hash", "twin").distinct(), "chosen"), MAX_WINNERS)
    turn = Window.partitionBy("hash", "twin").orderBy(F.col("id").asc_nulls_last())
    members = _with_twin(bags, shared, any_shared).select("id", "hash", "twin").join(chosen, ["hash", "twin"], "left_semi")
    members = members.withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= top).drop("turn")
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    rows = winners.join(members, ["hash", "twin"]).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    names = docs.sparkSession.createDataFrame([(i, item) for i, (_, item, _) in enumerate(items)], "item long, item_id long")
    return rows.join(F.broadcast(names), "item").select(  # at most BLOCK_ITEMS rows
        "item_id", "rank", F.col("id").alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", top: int = TOP, hash_bits: int = 63) -> DataFrame:
    """The ``top`` best documents of every item: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    ``hash_bits`` is the width of the bags' hashes; classes are told apart whatever it is.
    """
    found = None
    for block in item_blocks(items, item, item_text):
        rows = _search_block(docs, block, key, text, top, hash_bits)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found


@query(r"""
with d as (
  select doc_id, row_number() over () as row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents where text is not null
), t as (
  select doc_id, row, len(terms)::bigint as n, unnest(terms) as term from d where len(terms) > 0
), s as (
  select (select count(*) from d where len(terms) > 0) as docs, (select count(*) from t) as total
), f as (
  select doc_id, row, term, any_value(n) as n, count(*) as tf from t group by doc_id, row, term
), w as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from f, s group by term, docs
), i as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), c as (
  select item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::bigint as score
  from i join f using (term) join w using (term), s group by item_id, doc_id, row
), r as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score
  from c where score > 0
)
select * from r where rank <= 50
""")
def op13_lexical_search(spark, folder):
    """The 50 best documents for every item of the benchmark."""
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
