import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fathomline.llm import fingerprints
from fathomline.llm.catalog import QUERIES
from tests.llm import helpers


def similarity(a, b):
    a, b = helpers.shingles(a), helpers.shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query(spark):
    docs = helpers.documents("/root/testdata/sf0.01")
    texts = [d[1] or "" for d in docs]
    after = texts[1:] + texts[:1]
    edited = [t[:len(t) - len(t) // 4] + n[:len(t) // 4] for t, n in zip(texts, after)]
    got = {r.doc_id: r for r in QUERIES["op9_fingerprints"](spark, "/root/testdata/sf0.01").collect()}
    rows = [got[d[0]] for d in docs]
    assert [r.n_chars for r in rows] == [len(t) for t in texts]
    assert [r.edited_sha256 for r in rows] == [hashlib.sha256(e.encode()).hexdigest() for e in edited]
    for name, other in (("near_edited", edited), ("near_next", after)):
        error = [r[name] - similarity(t, o) for r, t, o in zip(rows, texts, other)]
        assert np.sqrt(np.mean(np.square(error))) < 0.05
    by_text = {}
    for t, r in zip(texts, rows):
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint


def test_small_sets_and_bits():
    pairs = [("a b c d e f", "a b c d e f"), ("a b c d e", "f g h i j"), ("", ""), ("", "a"), (None, "  ")]
    for bits in (1, 2, 4, 8):
        left = fingerprints.fingerprint_texts([a for a, _ in pairs], bits=bits)
        right = fingerprints.fingerprint_texts([b for _, b in pairs], bits=bits)
        like = fingerprints.likeness(left, right, bits)
        assert like[0] == 1 and like[1] < 0.2 and like[2:].tolist() == [1, 0, 1]
        assert {len(x) for x in left if x} == {fingerprints.BINS * bits // 8}


def test_odd_rows(spark):
    odd = helpers.odd(spark)
    rows = fingerprints.compare_with_next(odd).collect()
    assert len(rows) == len(helpers.odd_rows())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.compare_with_next(helpers.empty(spark)).count() == 0
    assert fingerprints.compare_with_next(odd.filter("doc_id = 9")).first().near_next == 1
    printed = fingerprints.with_fingerprints(odd.withColumn("fingerprint", F.lit(1)))
    assert printed.count() == len(helpers.odd_rows()) and printed.schema["fingerprint"].dataType.simpleString() == "binary"


def test_one_id_or_none_is_spread_over_ranges(spark):
    texts = [f"text {i % 40:03d} of {i} " * (1 + i % 7) for i in range(300)]
    for key in (7, None):
        rows = spark.createDataFrame([(key, t) for t in texts], "doc_id long, text string").repartition(5)
        got = Counter((r.n_chars, r.edited_sha256) for r in fingerprints.compare_with_next(rows).collect())
        turn = sorted(texts)
        want = Counter()
        for a, b in zip(turn, turn[1:] + turn[:1]):
            cut = len(a) // 4
            want[len(a), hashlib.sha256((a[:len(a) - cut] + b[:cut]).encode()).hexdigest()] += 1
        assert got == want
