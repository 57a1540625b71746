import math
import re
from collections import Counter

import duckdb

from fathomline.llm import lexical
from fathomline.llm.catalog import ORACLE_SQL, QUERIES
from tests.llm import helpers

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, top):
    """Ranked ``(item, rank, doc, score)`` by scoring every document for every item."""
    counted = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item, text in items:
        scored = []
        for d, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        found += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(found, key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_terms():
    for text in ("A-b_C é,É x1y ", "", None, "İſK a\u0085b", "\x00a\x7fb{c}"):
        assert [t.decode() for t in lexical.terms(None if text is None else text.encode())] == terms(text)


def test_same_as_sql(spark, rows):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as select * from '{helpers.FOLDER}/{name}.parquet'")
    want = con.sql(f"select item_id, rank, doc_id, score from ({ORACLE_SQL['op13_lexical_search']})").fetchall()
    assert rows(QUERIES["op13_lexical_search"](spark, helpers.FOLDER), "item_id", "rank", "doc_id", "score") == sorted(want, key=repr)


def case(spark):
    docs = [(i, f"{'alpha ' * (i % 5)}{'beta ' * (i % 3)}{'gamma ' * (i % 2)}filler w{i % 7}") for i in range(400)]
    docs += [(1_000 - i, "alpha beta beta same copy") for i in range(300)] + [(None, "alpha beta beta same copy"), (7, None), (8, " -- ")]
    items = [(1, "Alpha BETA"), (2, "gamma alpha alpha w3"), (3, "nothing here matches"), (4, None), (5, "same"), (5, "copy filler")]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_against_all_pairs(spark):
    docs, items, d, i = case(spark)
    for top in (1, 7, 50, 1_000):
        assert got(lexical.search(d, i, top=top)) == plain(docs, items, top)


def test_colliding_hashes_and_blocks(spark, monkeypatch):
    docs, items, d, i = case(spark)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 2)
    monkeypatch.setattr(lexical, "CLASS_CHUNK", 3)
    for bits in (0, 3):
        assert got(lexical.search(d, i, top=20, hash_bits=bits)) == plain(docs, items, 20)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in helpers.odd_rows()]
    items = [(1, "the house word1 and5 é"), (2, rows[8][1])]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert got(lexical.search(helpers.odd(spark), frame)) == plain(rows, items, 50)
    assert lexical.search(helpers.empty(spark), frame).count() == 0
    assert lexical.search(helpers.odd(spark), frame.limit(0)).count() == 0
