import hashlib

from pyspark.sql import functions as F

from fathomline.llm import pii
from fathomline.llm.catalog import QUERIES
from tests.llm import helpers


def listed(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_query(spark):
    texts = {d: t for d, t, *_ in helpers.documents()}
    for r in QUERIES["op6_pii"](spark, helpers.FOLDER).collect():
        base = helpers.personal(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        assert set(listed(base).split(",")) <= set(r.spans.split(","))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == i for x in base) for i in range(4)]


TEXTS = [
    "mail me: bob (at) example (dot) com or a@b.c_d@e.fr x", "call (843) 555-4223 now", "card 4111.1111.1111.1111 " + "1 " * 60_000,
    "+1 (843) 555-4223 and 4111 1111 1111 1111, 10.0.0.256, 1.2.3.4.5 é 9.9.9.9", "a@b.co " * 3_000, "7" * 20_000,
    "@@a@b@c.de.f@g.hi", "+++12345678901 +1234567890123456", "1.2.3.4.5.6.7.8", "x@y", "4111-1111-1111-1111-1", "0001.02.3.255",
    "a" * 50_000 + "@b.c", "", None,
]


def test_strict_spans(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = pii.find(docs, {}).select("doc_id", pii.listing(F.col("base_spans")).alias("spans")).collect()
    assert {r.doc_id: r.spans for r in found} == {i: listed(helpers.personal(t)) for i, t in enumerate(TEXTS)}


def test_looser_spans_and_mask(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS[:4])], "doc_id long, text string")
    weights = pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    more = {r.doc_id: r.spans for r in pii.find(docs, weights).select("doc_id", pii.listing(F.col("spans")).alias("spans")).collect()}
    assert more[0] == "email:9:35,email:39:44,email:44:51"
    assert more[1] == "phone:5:19"
    masked = {r.doc_id: r.text for r in pii.mask(docs, weights).collect()}
    assert masked[0] == "mail me: <email> or <email><email> x"
    assert masked[1] == "call <phone> now"
    assert masked[3] == "<phone> and <card>, 10.0.0.256, <ip>.5 é <ip>"


def test_plan_has_no_python(spark):
    plan = QUERIES["op6_pii"](spark, helpers.FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark):
    odd = helpers.odd(spark)
    rows = pii.mask(odd).collect()
    assert len(rows) == len(helpers.odd_rows())
    assert sum("<phone> <ip>" in (r.text or "") for r in rows) == 1
    assert {r.ranges for r in rows} == {8}
    assert pii.mask(helpers.empty(spark)).count() == 0
