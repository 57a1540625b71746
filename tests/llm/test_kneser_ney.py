import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.llm import kneser_ney
from fathomline.llm.catalog import QUERIES
from tests.llm import helpers


def test_scores_are_those_of_the_definition(spark):
    docs = helpers.documents()
    trusted = [t for d, t, *_ in docs if d % 3 == 0][:25]
    other = [t for d, t, *_ in docs if d % 3 == 1][:10] + ["漢字 かな", "a", "", None]
    plain = helpers.KneserNey([helpers.symbols(t) for t in trusted])
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in trusted], "text string"))
    rows = spark.createDataFrame(list(enumerate(other)), "doc_id long, text string")
    got = {r.doc_id: r for r in kneser_ney.score(rows, model).collect()}
    for i, t in enumerate(other):
        assert got[i].n_scored == len(t or "")
        if t:
            assert got[i].log_perplexity == pytest.approx(plain.log_perplexity(helpers.symbols(t)), rel=2e-3)
        else:
            assert got[i].log_perplexity is None


def test_probabilities_add_up(spark):
    model = kneser_ney.train(spark.createDataFrame([("abcab abd",), ("bca",)], "text string")).collect()
    logp = {r.gram: r.logp for r in model}
    weight = {r.gram: r.weight for r in model}
    unigrams = [g for g in logp if 1 < g < 1 << 12]
    assert np.isnan(logp[1])  # the start symbol is a context only
    total = sum(np.exp(logp[g]) for g in unigrams) + (4096 - len(unigrams)) * np.exp(weight[0]) / 4096
    assert total == pytest.approx(1, abs=1e-6)


def test_verdict_on_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r.kept for r in QUERIES["op4_quality_classifier"](spark, folder).collect()}
    labels = duckdb.sql(f"select doc_id, quality, toxic from '{folder}/labels.parquet'").fetchall()
    assert len(got) == len(helpers.documents(folder))
    assert np.mean([got[d] for d, q, t in labels if q == 1 and t == 0]) > 0.99
    assert np.mean([got[d] for d, q, _ in labels if q == 0]) < 0.4


def test_unseen_trusted_documents_are_kept_in_every_language(spark):
    folder = "/root/testdata/sf0.01"
    labels = duckdb.sql(f"select doc_id, quality, toxic from '{folder}/labels.parquet'").fetchall()
    held = {d for d, q, t in labels if q == 1 and t == 0 and zlib.crc32(str(d).encode()) % 5 == 0}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    rest = spark.createDataFrame([r for r in labels if r[0] not in held], "doc_id long, quality int, toxic int")
    got = kneser_ney.classify(docs, rest, keep_text=False).collect()
    for lang in ("en", "fr", "de", "es"):
        kept = [r.kept for r in got if r.doc_id in held and r.lang == lang]
        assert len(kept) >= 5 and np.mean(kept) >= 0.8, lang
    bad = {d for d, q, _ in labels if q == 0}
    assert np.mean([r.kept for r in got if r.doc_id in bad]) < 0.2


def test_models_without_a_fold_are_those_of_the_other_texts(spark):
    texts = [(t, d % 3) for d, t, *_ in helpers.documents()[:30] if t]
    model = kneser_ney.train(spark.createDataFrame(texts, "text string, fold long"), folds=3)
    for fold in range(3):
        got = {r.gram: r for r in kneser_ney.without_fold(model, fold).collect()}
        alone = kneser_ney.train(spark.createDataFrame([(t,) for t, f in texts if f != fold], "text string")).collect()
        assert set(got) == {r.gram for r in alone}
        for r in alone[::50]:
            assert got[r.gram].logp == pytest.approx(r.logp, abs=1e-5, nan_ok=True)
            assert got[r.gram].weight == pytest.approx(r.weight, abs=1e-5)


def test_all_folds_in_one_run(spark, monkeypatch):
    texts = [(d, t, d % kneser_ney.FOLDS) for d, t, *_ in helpers.documents()[:60]] + [(-1, None, 0), (-2, "", 3)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, fold long")
    model = kneser_ney.train(frame.select("text", "fold"), folds=kneser_ney.FOLDS)
    monkeypatch.setattr(kneser_ney, "BLOCK_CHARS", 20_000)
    got = {r.doc_id: r.log_perplexity for r in kneser_ney.score(frame, model, fold="fold").collect()}
    assert len(got) == len(texts)
    for f in range(kneser_ney.FOLDS):
        alone = kneser_ney.score(frame.filter(F.col("fold") == f), kneser_ney.without_fold(model, f)).collect()
        assert {r.doc_id: r.log_perplexity for r in alone} == {d: got[d] for d, _, x in texts if x == f}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("blocks_")]


def test_odd_rows(spark):
    odd = helpers.odd(spark)
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0), (None, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    rows = kneser_ney.classify(odd, labels).collect()
    assert len(rows) == len(helpers.odd_rows())
    assert all((r.perplexity is None) == (not r.text) and (r.text or not r.kept) for r in rows)
    assert kneser_ney.classify(helpers.empty(spark), labels).count() == 0
    untrained = kneser_ney.classify(odd, labels.limit(0)).collect()
    assert all(r.kept == bool(r.text) for r in untrained)
