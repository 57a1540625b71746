import numpy as np
import pytest

from fathomline.learning import models
from fathomline.learning.models import recommend, train_als
from fathomline.learning.retrieval import recommend_all, top_products

PAIR = "{} long, factors array<double>"


def frames(spark, users, items):
    return spark.createDataFrame(users, PAIR.format("user")), spark.createDataFrame(items, PAIR.format("item"))


def product(u, v):
    total = 0.0
    for a, b in zip(u, v, strict=True):
        total += a * b
    return total


def plain(users, items, k):
    """Every pair scored."""
    found = []
    for user, u in users:
        best = sorted(((-product(u, v), item) for item, v in items))[:k]
        found += [(user, item, -score, rank) for rank, (score, item) in enumerate(best, 1)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("slice_bytes", [1 << 20, 40 * 5 * 100])
def test_equals_full_product(spark, rows, slice_bytes):
    draw = np.random.default_rng(5)
    users = [(i, draw.normal(size=4).tolist()) for i in range(70)]
    items = [(i, (draw.normal(size=4) * draw.exponential()).tolist()) for i in range(2500)]
    best = top_products(*frames(spark, users, items), 7, slice_bytes)
    assert rows(best, "user", "item", "score", "rank") == plain(users, items, 7)
    scored = {r.user: r.scored for r in best.collect()}
    assert max(scored.values()) < len(items) and sum(scored.values()) < 70 * 2500 // 2


def test_ties_and_signs(spark, rows):
    items = [(i, [float(i % 3), float(i % 2)]) for i in range(1300, 0, -1)]
    users = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [-1.0, -1.0]), (3, [-1.0, -1.0]), (4, [0.5, 2.0])]
    for size in (1 << 20, 3200):
        assert rows(top_products(*frames(spark, users, items), 5, size), "user", "item", "score", "rank") == plain(users, items, 5)


def test_few_products_where_factors_are_few(spark, rows):
    draw = np.random.default_rng(8)
    users = [(i, draw.integers(-12, 13, 3).astype(float).tolist()) for i in range(90)]
    items = [(i, v.tolist()) for i, v in enumerate(np.repeat(draw.integers(-30, 31, (1_000, 3)).astype(float), 6, axis=0))]
    best = top_products(*frames(spark, users, items), 3)
    assert rows(best, "user", "item", "score", "rank") == plain(users, items, 3)
    assert best.agg({"scored": "avg"}).first()[0] < 1_700  # of 6,000


def test_missing_factors_are_left_out(spark, rows):
    items = [(i, [float(i % 9), float(i % 7)]) for i in range(1_500)]
    users = [(1, [1.0, 2.0]), (2, [-1.0, 0.5]), (3, [0.0, 1.0])]
    holes = [(5_000 + i, [None, float(i)]) for i in range(40)] + [(6_000, [float("nan"), 1.0])]
    best = top_products(*frames(spark, [*users, (4, [None, 1.0])], [*items, *holes]), 4)
    assert rows(best, "user", "item", "score", "rank") == plain(users, items, 4)


def test_recommendations_are_the_full_product(spark):
    draw = np.random.default_rng(2)
    ratings = [(int(u), int(i), float(draw.integers(1, 6))) for u in range(30) for i in draw.choice(80, 12, replace=False)]
    frame = spark.createDataFrame(ratings, "user int, item int, rating float")
    model, asked = train_als(frame, rank=3), spark.createDataFrame([(1,), (1,), (4,), (999,)], "user int")
    got = recommend(model, asked, None, 5)
    assert got.dtypes == [("user", "int"), ("item", "int"), ("score", "float")]
    assert "RecommendationsAggregator" not in got._jdf.queryExecution().toString() and "CartesianProduct" not in got._jdf.queryExecution().toString()
    built_in = model.recommendForUserSubset(asked, 5).selectExpr("user", "inline(recommendations)").collect()
    want = {(r.user, r.item): r.rating for r in built_in}
    found = {(r.user, r.item): r.score for r in got.collect()}
    assert found.keys() == want.keys() and len(want) == 10
    assert all(found[key] == pytest.approx(want[key], rel=1e-5, abs=1e-5) for key in want)


def test_edges(spark, rows):
    users, items = [(1, [1.0]), (None, [1.0]), (2, None)], [(7, [2.0]), (None, [9.0]), (8, None), (9, [-1.0])]
    asked, stock = frames(spark, users, items)
    assert rows(top_products(asked, stock, 10)) == [(1, 7, 2.0, 1, 2), (1, 9, -1.0, 2, 2)]
    assert top_products(asked, stock.limit(0), 10).count() == 0
    assert top_products(asked.limit(0), stock, 10).count() == 0
    with pytest.raises(ValueError):
        top_products(asked, stock, 0)
    with pytest.raises(Exception, match="differ in number"):
        top_products(*frames(spark, [(1, [1.0, 2.0])], [(7, [2.0])]), 1).collect()


def test_factor_model(spark):
    rated = [(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(15) if (u + i) % 3]
    model = train_als(spark.createDataFrame(rated, "user int, item int, rating float"), rank=3, iterations=2)
    wanted = {r.id: [tuple(x) for x in r.recs] for r in
              model.recommendForAllUsers(4).selectExpr("user as id", "recommendations as recs").collect()}
    found = {}
    for row in recommend_all(model, k=4).orderBy("user", "rank").collect():
        found.setdefault(row.user, []).append((row.item, row.score))
    assert found.keys() == wanted.keys()
    for user, best in wanted.items():
        assert [i for i, _ in found[user]] == [i for i, _ in best]
        assert np.allclose([s for _, s in found[user]], [s for _, s in best], atol=1e-4)
    some = spark.createDataFrame([(3,), (3,), (99,)], "user int")
    assert {r.user for r in recommend_all(model, some, 4).collect()} == {3}


def test_blocks_of_factors_follow_the_number_of_ratings(spark, monkeypatch):
    draw = np.random.default_rng(4)
    u, v = draw.uniform(1, 2, (40, 2)), draw.uniform(1, 2, (30, 2))
    rated = [(a, b, float(u[a] @ v[b])) for a in range(40) for b in range(30) if (a + b) % 4]
    frame = spark.createDataFrame(rated, "user int, item int, rating float")
    assert train_als(frame, 2, 1).userFactors.rdd.getNumPartitions() == 10
    monkeypatch.setattr(models, "RATINGS_PER_BLOCK", 70, raising=False)
    model = train_als(frame, 2, 20, reg=0.0001)
    # With ten blocks whatever their size, a task holds a tenth of all ratings.
    assert model.userFactors.rdd.getNumPartitions() == model.itemFactors.rdd.getNumPartitions() == 13  # 900 / 70
    assert model.userFactors.count() == 40 and model.itemFactors.count() == 30
    wrong = model.transform(frame).selectExpr("max(abs(prediction - rating))").first()[0]
    assert wrong < 0.05
