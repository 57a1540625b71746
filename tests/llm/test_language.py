import zlib

import numpy as np

from fathomline.llm import language
from fathomline.llm.catalog import QUERIES
from tests.llm import helpers

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    lang = {d: v for d, _, v, _ in helpers.documents(FOLDER)}
    found = QUERIES["op2_language_id"](spark, FOLDER).collect()
    assert len(found) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    kept = [r for r in found if r.held_out and lang[r.doc_id]]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in kept]) > 0.98


def test_other_columns_do_not_matter(spark):
    docs = spark.read.parquet(f"{helpers.FOLDER}/documents.parquet")
    model = language.train(docs)
    plain = language.predict(docs.select("doc_id", "text"), model)
    swapped = language.predict(docs.selectExpr("doc_id", "text", "'xx' as lang", "0 as source"), model)
    assert sorted(plain.select("doc_id", "lang_pred", "score").collect()) == sorted(
        swapped.select("doc_id", "lang_pred", "score").collect())


def test_families():
    assert language.family_of("de") == language.family_of("en") != language.family_of("fr")
    assert language.family_of("tlh") == "tlh"


def test_odd_rows(spark):
    odd = helpers.odd(spark)
    rows = language.predict(odd, language.train(odd)).collect()
    assert len(rows) == len(helpers.odd_rows())
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered)
        assert lettered or r.score == 0
    none = language.train(helpers.empty(spark))
    assert {r.lang_pred for r in language.predict(odd, none).collect()} == {"und"}
    assert language.predict(helpers.empty(spark), none).count() == 0
    one = language.train(spark.createDataFrame([(1, "abc def", "en")], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in language.predict(odd, one).collect()} == {"en", "und"}
