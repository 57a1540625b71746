import math
import random
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fathomline.operators import similarity
from fathomline.operators.separation import UNREACHED, degrees_of_separation, hit, out_of, unseen
from fathomline.operators.similarity import items_similar_to, pair_similarity, similar_items
from fathomline.session import materialize_by


def brute_pairs(rows, min_score, min_support):
    by_user = {}
    for u, i, x in rows:
        by_user.setdefault(u, {})[i] = x
    sums = {}
    for items in by_user.values():
        for a, b in combinations(sorted(items), 2):
            s = sums.setdefault((a, b), [0.0, 0.0, 0.0, 0])
            s[0] += items[a] * items[b]
            s[1] += items[a] ** 2
            s[2] += items[b] ** 2
            s[3] += 1
    out = {}
    for pair, (xy, xx, yy, n) in sums.items():
        score = xy / (math.sqrt(xx) * math.sqrt(yy)) if xx and yy else 0.0
        if n > min_support and (min_score is None or score > min_score):
            out[pair] = (score, n)
    return out


@pytest.fixture(scope="module")
def ratings_rows():
    rng = random.Random(5)
    rows = [("u%02d" % u, i, float(rng.randrange(0, 6))) for u in range(40) for i in rng.sample(range(60), rng.randrange(2, 9))]
    for hot in ("hot1", "hot2", "hot3", "hot4"):
        rows += [(hot, i, float(rng.randrange(1, 6))) for i in rng.sample(range(60), 50)]
    return rows


@pytest.mark.parametrize("max_items", [2_000, 10])
@pytest.mark.parametrize("min_support", [0, 1, 2, 5])
def test_pair_similarity_is_exact(spark, ratings_rows, max_items, min_support):
    df = spark.createDataFrame(ratings_rows, "user string, item int, rating double")
    got = pair_similarity(df, 0.5, min_support, max_items_per_task=max_items).collect()
    expected = brute_pairs(ratings_rows, 0.5, min_support)
    assert {(r.item1, r.item2) for r in got} == set(expected) and len(got) == len(expected)
    for r in got:
        score, n = expected[(r.item1, r.item2)]
        assert r.support == n and r.score == pytest.approx(score)
        assert 0 <= r.score <= 1 + 1e-9


@pytest.mark.parametrize("max_items", [2_000, 10])
def test_repeated_ratings_of_one_user_are_support(spark, max_items):
    rows = [("hot", i, 2.0) for i in range(30)] + [("hot", i, float(x)) for i in (0, 1) for x in range(7)]
    rows += [(f"a{u}", 0, 1.0) for u in range(60)] + [(f"b{u}", 1, 1.0) for u in range(60)]
    rows += [("twice", i, 3.0) for i in (50, 51) for _ in range(8)]  # each item has fewer ratings than the threshold
    df = spark.createDataFrame(rows, "user string, item int, rating double")
    got = [tuple(r) for r in pair_similarity(df, None, 50, max_items_per_task=max_items).collect()]
    x = [2.0, *map(float, range(7))]
    score = sum(x) ** 2 / (8 * sum(v * v for v in x))
    assert sorted(got) == [(0, 1, pytest.approx(score), 64), (50, 51, pytest.approx(1), 64)]


@pytest.mark.parametrize("max_items", [2_000, 4])
@pytest.mark.parametrize("per_task", [100_000, 3])
def test_sums_are_taken_of_passing_pairs_only(spark, monkeypatch, max_items, per_task):
    rng = random.Random(11)
    rows = [(u, f"i{i}", float(rng.randrange(1, 6))) for u in range(150) for i in rng.sample(range(150), 6)]
    rows += [(u, f"i{i}", float(rng.randrange(1, 6))) for u in range(400, 408) for i in (1, 2, 3, 4, 5)]
    rows += [(500, f"i{i}", 2.0) for i in range(30)] + [(600, f"i{i}", 3.0) for i in (7, 8) for _ in range(3)]
    given = rows + [(None, f"i{i}", 1.0) for i in range(9)] + [(1, None, 1.0), (2, "i2", None)]
    monkeypatch.setattr(similarity, "RATINGS_PER_TASK", per_task)
    monkeypatch.setattr(similarity, "_pair_sums", None)  # no row of sums for every co-rated pair
    df = spark.createDataFrame(given, "user int, item string, rating double")
    got = similarity.co_rated_sums(df, 4, max_items).collect()
    expected = {}
    for u in {u for u, _, _ in rows}:
        own = [(i, x) for v, i, x in rows if v == u]
        for (i, x), (j, y) in ((a, b) for a in own for b in own if a[0] < b[0]):
            sums = expected.setdefault((i, j), [0.0, 0.0, 0.0, 0])
            for k, v in enumerate((x * y, x * x, y * y, 1)):
                sums[k] += v
    assert {(r.item1, r.item2): [r.xy, r.xx, r.yy, r.support] for r in got} == {
        pair: sums for pair, sums in expected.items() if sums[3] > 4}
    assert len({(r.item1, r.item2) for r in got}) == len(got) >= 11


@pytest.mark.parametrize("slices_per_run", [1, 3, 16])
@pytest.mark.parametrize("share", [0, 1])
def test_blocks_of_a_user_meet_once_and_in_few_lists(spark, monkeypatch, slices_per_run, share):
    rng = random.Random(3)
    ratings = {(u, i): [float(rng.randrange(1, 6))] for u in range(25) for i in rng.sample(range(200), 40)}
    for u, i in [(u, 5 + u % 3) for u in range(25)] + [(1, 80), (2, 81)]:  # repeated ratings, so no user is left out
        ratings.setdefault((u, i), []).extend([2.0, 4.0, 5.0])
    ratings |= {(100 + i, 1000 + i): [1.0] for i in range(200)}  # items that no threshold lets pass
    expected = {}
    for (u, i), x in ratings.items():
        for j in range(i + 1, 200):
            if (y := ratings.get((u, j))) is not None:
                sums = expected.setdefault((i, j), [0.0, 0.0, 0.0, 0])
                for k, v in enumerate((sum(x) * sum(y), sum(a * a for a in x) * len(y), sum(b * b for b in y) * len(x), len(x) * len(y))):
                    sums[k] += v
    sent, real = [], similarity._with_partners
    monkeypatch.setattr(similarity, "_with_partners", lambda *given: sent.append(real(*given)) or sent[-1])
    monkeypatch.setattr(similarity, "SLICES_PER_RUN", slices_per_run, raising=False)
    monkeypatch.setattr(similarity, "LEFT_OUT_SHARE", share, raising=False)
    monkeypatch.setattr(similarity, "RATINGS_PER_TASK", 10)
    frame = spark.createDataFrame([(u, i, x) for (u, i), xs in ratings.items() for x in xs], "user int, item int, rating double")
    got = similarity.co_rated_sums(frame, 5, max_items_per_task=5).collect()
    assert {(r.item1, r.item2): [r.xy, r.xx, r.yy, r.support] for r in got} == {
        pair: sums for pair, sums in expected.items() if sums[3] > 5}
    assert len(got) >= 50 and len({(r.item1, r.item2) for r in got}) == len(got)
    lists = sent[0].collect()
    formed, every = sum(r.n * (sum(r.ns) if r.ns else len(r.codes)) for r in lists), sum(s[3] for s in expected.values())
    assert formed == every if share else 0.99 * every < formed < every
    if slices_per_run == 16:  # 40 items, 8 or 9 slices: one list an item, not one a block
        assert len(lists) <= 25 * 45


def test_zero_vector_scores_zero(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 3.0)], "user int, item int, rating double")
    assert [tuple(r) for r in pair_similarity(df, min_support=0).collect()] == [(1, 2, 0.0, 1)]


def test_similar_items_both_ways(spark, ratings_rows):
    df = spark.createDataFrame(ratings_rows, "user string, item int, rating double")
    names = spark.createDataFrame([(i, f"item {i}") for i in range(60)], "item int, name string")
    direct = items_similar_to(df, names, 3, 0.5, 1, 5)
    stored = similar_items(pair_similarity(df, None, 1), names, 3, 0.5, 1, 5)
    key = lambda r: (r.item, r.name, round(r.score, 9), r.support)
    assert sorted(map(key, direct.collect())) == sorted(map(key, stored.collect()))
    expected = sorted(
        ((s, n, a + b - 3) for (a, b), (s, n) in brute_pairs(ratings_rows, 0.5, 1).items() if 3 in (a, b)),
        key=lambda t: (-t[0], -t[1], t[2]),
    )[:5]
    assert sorted(i for _, _, i in expected) == sorted(r.item for r in direct.collect())


def bfs(edges, start):
    adjacent = {}
    for a, b in edges:
        adjacent.setdefault(a, set()).add(b)
    seen, frontier, hop = {start: 0}, {start}, 0
    while frontier:
        hop += 1
        frontier = {b for a in frontier for b in adjacent.get(a, ())} - seen.keys()
        seen.update({n: hop for n in frontier})
    return seen


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=25))
def test_bfs_matches_brute_force(spark, edges):
    df = spark.createDataFrame(edges, "src int, dst int")
    got = {r.node: r.distance for r in degrees_of_separation(df, 0).collect()}
    expected = bfs(edges, 0)
    nodes = {n for e in edges for n in e}
    assert got == {n: expected.get(n, UNREACHED) for n in nodes}
    for a, b in edges:
        if got[a] != UNREACHED:
            assert got[b] <= got[a] + 1


def test_hit_counts_directions(spark):
    df = spark.createDataFrame([(0, 1), (0, 2), (1, 3), (2, 3), (2, 3), (4, 3), (3, 9)], "src int, dst int")
    assert [tuple(r) for r in hit(df, 0, 3).collect()] == [(2, 2)]
    assert hit(df, 9, 0, hold=False).count() == 0
    stopped = {r.node: r.distance for r in degrees_of_separation(df, 0, target=3).collect()}
    assert stopped[3] == 2 and stopped[9] == UNREACHED
    limited = {r.node: r.distance for r in degrees_of_separation(df, 0, max_hops=1).collect()}
    assert limited[3] == UNREACHED


def test_a_hop_moves_neither_edges_nor_levels(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.createDataFrame([(i % 50, (i * 7) % 60) for i in range(500)], "src long, dst long")
        held = materialize_by(edges, "src", "edges")
        levels = [materialize_by(spark.createDataFrame(ids, "node long"), "node", "frontier") for ids in ([(0,)], [(7,), (5,)])]
        out = out_of(held, levels[-1])
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        new = unseen(out, levels)
        assert new._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        assert {r.node for r in new.collect()} == {(i * 7) % 60 for i in range(500) if i % 50 in (5, 7)} - {0, 5, 7}
        assert not [t for t in spark.catalog.listTables() if t.name.startswith(("edges_", "frontier_"))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
