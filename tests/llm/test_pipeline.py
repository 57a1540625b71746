from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fathomline.llm import bpe, kneser_ney, mixing
from fathomline.session import materialize
from tests.llm import helpers

FOLDER = helpers.FOLDER


def stage(n):
    return corpus_pipeline.STAGES[n][1]


def strangers(spark, trusted):
    """Score of every trusted document by the definition's model of all trusted documents of other folds."""
    frame = spark.createDataFrame([(d, t) for d, t, *_ in trusted], "d long, t string")
    fold = dict(frame.select("d", F.pmod(F.xxhash64("t"), F.lit(kneser_ney.FOLDS))).collect())
    models = {f: helpers.KneserNey([helpers.symbols(t) for d, t, *_ in trusted if fold[d] != f]) for f in set(fold.values())}
    return {d: models[fold[d]].log_perplexity(helpers.symbols(t)) for d, t, *_ in trusted if t}


def plain_limits(scores):
    """By language, and over all under None: the upper end and the distance, from ``{id: (language, score)}``."""
    def quantile(values, q):
        return sorted(values)[max(0, int(np.ceil(q * len(values))) - 1)]

    low, high = kneser_ney.QUANTILES
    own = {}
    for lang, x in scores.values():
        own.setdefault(lang, []).append(x)
    pooled = quantile([x - quantile(own[lang], low) for lang, x in scores.values()], high)
    every = [x for _, x in scores.values()]
    found = {None: (quantile(every, high), quantile(every, high) - quantile(every, low))}
    for lang, values in own.items():
        middle, n = quantile(values, low), len(values)
        distance = (n * (quantile(values, high) - middle) + kneser_ney.MIN_TRUSTED * pooled) / (n + kneser_ney.MIN_TRUSTED)
        found[lang] = (middle + distance, distance)
    return found


def test_all_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = duckdb.sql(f"select doc_id from '{FOLDER}/labels.parquet' where quality = 1 and toxic = 0").fetchall()
    plain = helpers.documents()

    # 1: limits from trusted documents, each scored by a model of the other folds
    trusted = {d for (d,) in labels}
    score = strangers(spark, [x for x in plain if x[0] in trusted])
    limits = plain_limits({d: (lang, score[d]) for d, t, lang, _ in plain if d in trusted and t})
    model = helpers.KneserNey([helpers.symbols(t) for d, t, *_ in plain if d in trusted])
    over = {}
    for d, t, lang, _ in plain:
        upper, distance = limits.get(lang, limits[None])
        room = kneser_ney.MARGIN * (1 + np.sqrt(kneser_ney.LENGTH / max(len(t or ""), 1)))
        over[d] = model.log_perplexity(helpers.symbols(t)) - upper - room * distance if t else np.inf
    first = materialize(stage(0)(spark, docs, FOLDER), "test-1")
    got = {r.doc_id for r in first.select("doc_id").collect()}
    sure = {d for d, x in over.items() if abs(x) > 0.01}
    assert {d for d in sure if over[d] < 0} == got & sure
    assert len(sure) > 0.9 * len(plain)

    # 2: one of each class
    second = materialize(stage(1)(spark, first, FOLDER), "test-2")
    left = [x for x in plain if x[0] in got]
    heads = {left[h][0] for h in helpers.groups([x[1] for x in left])[1]}
    assert sorted(r.doc_id for r in second.collect()) == sorted(heads)

    # 3: strict spans are gone
    third = materialize(stage(2)(spark, second, FOLDER), "test-3")
    before = {r.doc_id: r for r in second.collect()}
    for r in third.collect():
        assert r.text == helpers.masked(before[r.doc_id].text) and r.n_chars == len(r.text)

    # 4: copies by rate and draw
    fourth = materialize(stage(3)(spark, third, FOLDER), "test-4")
    copies = {r.doc_id: r.copies for r in mixing.with_copies(third).collect()}
    assert Counter(r.doc_id for r in fourth.collect()) == Counter({d: n for d, n in copies.items() if n})

    # 5: ids and text of the library
    tokenizer = Tokenizer.from_file(bpe.word_vocabulary())
    tokenizer.no_truncation()
    fifth = stage(4)(spark, fourth, FOLDER)
    for r in fifth.collect():
        assert r.token_ids == tokenizer.encode(r.text, add_special_tokens=False).ids
        assert r.decoded == tokenizer.decode(r.token_ids, skip_special_tokens=False)
    for n in range(4):
        assert (first, second, third, fourth)[n].columns == docs.columns
    assert fifth.count() == fourth.count()


def test_odd_rows(spark):
    docs = helpers.odd(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for n in range(5):
        docs = materialize(stage(n)(spark, docs, FOLDER), "odd")
    assert docs.count() > 0
    none = helpers.empty(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, f in corpus_pipeline.STAGES:
        none = materialize(f(spark, none, FOLDER), "none")
    assert none.count() == 0
