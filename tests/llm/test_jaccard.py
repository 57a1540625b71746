import pytest
from pyspark.sql import functions as F

from fathomline.llm import jaccard
from fathomline.llm.catalog import QUERIES
from fathomline.llm.components import components
from tests.llm import helpers


def test_bands_reach_the_recall():
    bands, rows = jaccard.choose_bands()
    assert bands * rows <= jaccard.MAX_HASHES
    assert 1 - (1 - 0.8 ** rows) ** bands >= jaccard.RECALL


def test_query(spark):
    docs = helpers.documents("/root/testdata/sf0.01")
    links, heads = helpers.groups([d[1] for d in docs])
    got = {r.doc_id: r for r in QUERIES["op3_jaccard_join"](spark, "/root/testdata/sf0.01").collect()}
    assert [got[d[0]].n_links for d in docs] == links
    assert [got[d[0]].class_id for d in docs] == [docs[h][0] for h in heads]


def near_copies(n):
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(n):
        w = list(base)
        for k in range(i % 4):
            w[(i * 7 + k * 50) % 200] = f"other{i}"
        rows.append((i, " ".join(w)))
    return rows + [(1_000 + i, rows[3][1]) for i in range(50)]


@pytest.mark.parametrize("block", [7, 2_000])
def test_groups_larger_than_a_block(spark, block):
    rows = near_copies(60)
    links, heads = helpers.groups([t for _, t in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in jaccard.near_duplicates(docs, block_docs=block).collect()}
    assert [got[d].n_links for d, _ in rows] == links
    assert [got[d].class_id for d, _ in rows] == [rows[h][0] for h in heads]
    kept = jaccard.keep_one_of_each(docs.withColumn("_k1", F.lit("x")))
    assert {r.doc_id for r in kept.collect()} == {rows[h][0] for h in heads}
    assert {r["_k1"] for r in kept.collect()} == {"x"}


def test_odd_rows(spark):
    odd = helpers.odd(spark)
    rows = jaccard.near_duplicates(odd).collect()
    assert len(rows) == len(helpers.odd_rows())
    links, heads = helpers.groups([r[1] for r in helpers.odd_rows()])
    assert sorted(r.n_links for r in rows) == sorted(links)
    kept = jaccard.keep_one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(heads))
    assert jaccard.keep_one_of_each(helpers.empty(spark)).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (9, 8), (8, 7), (7, 6), (6, 5), (5, 4), (20, 20)] + [(30, 30 + i) for i in range(40)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in (1, 2, 3)}) == len({got[i] for i in range(4, 10)}) == 1
    assert len(set(got.values())) == 4 and got[20] == 20
