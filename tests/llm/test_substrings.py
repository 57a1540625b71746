import random

import numpy as np
import pytest

from fathomline.llm import substrings, suffixes
from fathomline.llm import texts as texts_of
from fathomline.llm.catalog import QUERIES
from tests.llm import helpers


def test_suffix_order_and_factors():
    pick = np.random.default_rng(1)
    data = pick.integers(1, 3, 300).astype(np.uint8)
    raw, depth = data.tobytes(), 40
    levels, ranks = suffixes.suffix_ranks(data, depth)
    starts = np.arange(300 - depth + 1)
    order = starts[np.lexsort((starts, ranks[starts]))]
    assert order.tolist() == sorted(starts.tolist(), key=lambda i: (raw[i:i + depth], i))

    def common(i, j):
        n = 0
        while n < depth and raw[i + n:i + n + 1] == raw[j + n:j + n + 1]:
            n += 1
        return n

    lengths = np.array([0] + [common(a, b) for a, b in zip(order, order[1:])])
    assert suffixes.common_lengths(levels, order[:-1], order[1:], depth).tolist() == [n // 8 * 8 for n in lengths[1:]]
    previous, following = suffixes.longest_factors(order, lengths)
    for r, i in enumerate(order):
        assert previous[r] == max([common(i, j) for j in starts if j < i], default=0)
        assert following[r] == max([common(i, j) for j in starts if j > i], default=0)


def texts():
    pick = random.Random(3)

    def noise(n):
        return "".join(pick.choice("abcdefghij é") for _ in range(n))

    passage, tail = noise(700), noise(450)
    out = [noise(pick.randint(0, 900)) for _ in range(20)]
    out += [noise(150) + passage + noise(100) for _ in range(25)]
    out += [tail + tail + noise(30), tail[:399], tail[:401], "z" * 1_000, "ab" * 700, passage, passage, None, "", passage[:300]]
    return out


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("most", [1, 4_000])
def test_same_as_comparing_all_strings(spark, keep_first, most):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.without_repeats(docs, keep_first, max_contexts=most).selectExpr(
        "doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept_bytes, 256) as digest").collect()
    want = helpers.repeated_bytes([t for _, t in rows], keep_first=keep_first)
    assert [tuple(r)[1:] for r in sorted(found)] == want


def test_query(spark):
    docs = helpers.documents()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op7_repeated_substrings"](spark, helpers.FOLDER).collect()}
    assert [got[d[0]] for d in docs] == helpers.repeated_bytes([d[1] for d in docs])


def test_no_table_with_arrays_is_broadcast(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(substrings, "small", lambda df, *a: seen.append(df) or texts_of.small(df, *a))
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    out = substrings.without_repeats(docs, keep_first=False)
    assert not [f for df in seen for f in df.schema.fields if f.dataType.typeName() == "array"]
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_anchors_cover_every_string_once():
    data = np.random.default_rng(2).integers(0, 4, 5_000).astype(np.uint8)
    hashes, place, first, last = substrings.anchors(data)
    assert np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)]).tolist() == list(range(4_601))
    assert (place >= last).all() and (place <= first + substrings.LENGTH - substrings.GRAM).all()


def test_odd_rows(spark):
    odd = helpers.odd(spark)
    rows = substrings.without_repeats(odd, keep_first=False).collect()
    assert len(rows) == len(helpers.odd_rows())
    assert {r.ranges for r in rows} == {8}
    want = helpers.repeated_bytes([r[1] for r in helpers.odd_rows() if r[0] not in (5, 7)])
    assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in rows if r.doc_id not in (5, 7)) == sorted(w[:3] for w in want)
    assert substrings.without_repeats(helpers.empty(spark)).count() == 0
