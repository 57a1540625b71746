import duckdb
import pytest

from fathomline.llm import mixing
from fathomline.llm.catalog import QUERIES
from tests.llm import helpers


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 5, 7], [1_000_000, 1, 1, 1, 1], [5], [0, 3, 9], [2, 2, 2, 900]])
def test_targets(spark, sizes):
    docs = spark.createDataFrame([(f"s{i:02}", s) for i, s in enumerate(sizes)], "source string, size long")
    got = sorted(mixing.source_targets(docs).collect())
    assert [r.target for r in got] == pytest.approx(helpers.targets(sizes))
    assert sum(r.target for r in got) == pytest.approx(sum(sizes))


def test_query(spark):
    folder = "/root/testdata/sf0.1"
    docs = duckdb.sql(f"select doc_id, text, source from '{folder}/documents.parquet'").fetchall()
    size = {d: len(helpers.words(t)) for d, t, _ in docs}
    source = {d: s for d, _, s in docs}
    sums = {}
    for d, s in source.items():
        sums[s] = sums.get(s, 0) + size[d]
    names = sorted(sums)
    want = dict(zip(names, helpers.targets([sums[n] for n in names])))
    first = QUERIES["op10_mix_sources"](spark, folder).collect()
    taken = dict.fromkeys(names, 0)
    for r in first:
        s = source[r.doc_id]
        assert (r.size, r.source_size, r.target) == (size[r.doc_id], sums[s], pytest.approx(want[s]))
        assert r.taken in {k * r.size for k in range(4)}
        taken[s] += r.taken
    assert all(abs(taken[n] / want[n] - 1) < 0.25 for n in names)
    assert sum(taken.values()) == pytest.approx(sum(sums.values()), rel=0.05)
    assert sorted(first) == sorted(QUERIES["op10_mix_sources"](spark, folder).repartition(5).collect())


def test_odd_rows(spark):
    odd = helpers.odd(spark)
    rows = mixing.with_copies(odd).collect()
    assert len(rows) == len(helpers.odd_rows())
    null = [r for r in rows if r.source is None]
    assert {r.source_size for r in null} == {0} and {r.target for r in null} == {0}
    assert all(0 <= r.copies <= 3 for r in rows)
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and {r.copies for r in mixed.collect()} <= {6}
    assert mixing.mix(helpers.empty(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = QUERIES["op10_mix_sources"](spark, helpers.FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
