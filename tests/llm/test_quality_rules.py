from collections import Counter

import duckdb

from fathomline.llm.catalog import ORACLE_SQL, QUERIES
from fathomline.llm.quality_rules import Rule, judge
from tests.llm import helpers


def measured(text):
    words = helpers.words(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + o for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for o in range(3)}
    lines = [x for x in (text or "").split("\n") if helpers.words(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered), failed)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_same_as_sql(spark, rows):
    names = ["doc_id", *COLUMNS, "kept"]
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{helpers.FOLDER}/documents.parquet'")
    want = con.sql(f"select {', '.join(names)} from ({ORACLE_SQL['op1_quality_rules']})").fetchall()
    assert rows(QUERIES["op1_quality_rules"](spark, helpers.FOLDER), *names) == sorted(want, key=repr)


def test_odd_rows(spark):
    found = judge(helpers.odd(spark)).collect()
    assert len(found) == len(helpers.odd_rows())
    for r in found:
        assert tuple(r[c] for c in COLUMNS) == measured(r.text)
        assert not (r.base_failed and r.kept)
        assert r.copies == 6
    assert judge(helpers.empty(spark)).count() == 0


def test_repeats_and_thresholds(spark):
    texts = ["a b c a b c a b c d", "a a a a", "x\nx\n y\nx\n\n", "one two", "## ** a", "a b c d e f"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in judge(docs, [Rule("n_words", 3, None), Rule("symbol_ratio", None, 1.0)], min_words=0, max_repeat_percent=100).collect():
        n = measured(r.text)
        assert tuple(r[c] for c in COLUMNS[:5]) == n[:5]
        assert r.kept == (n[0] >= 3 and n[2] / n[0] <= 1)
        assert r.broken_rules == [m for m, bad in (("n_words", n[0] < 3), ("symbol_ratio", n[2] / n[0] > 1)) if bad]


def test_stop_words_in_any_case(spark):
    docs = spark.createDataFrame([(0, "FÜR alle drei Bäume"), (1, "für alle drei Bäume"), (2, "furs")], "doc_id long, text string")
    found = {r.doc_id: r.stop_word_ratio for r in judge(docs).collect()}
    assert found[0] == found[1] > 0 and found[2] == 0
