import math
import random

import pytest
from pyspark.sql import functions as F

from fathomline.operators.moves import next_pair, price_change, signed_move, up_move
from fathomline.operators.ordering import (
    cut_series, running_totals, skip_rows, with_neighbours, with_row_index,
)
from fathomline.operators.performance import growth_ratio, history_of, period_stats, price_stats, sharpe_ratio, stock_performance
from fathomline.operators.quantiles import median_by, median_of, upper_median

GOLDEN = [1, 2, 3, 2, 4, 3, 1, 5]


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame([("A", i, float(p)) for i, p in enumerate(GOLDEN)], "symbol string, date int, close double")


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most of the rows; another key is null."""
    rng = random.Random(7)
    rows = [("hot", rng.randrange(900), i, rng.uniform(1, 9)) for i in range(1500)]
    rows += [(k, rng.randrange(900), i, rng.uniform(1, 9)) for k in ("a", "b", None) for i in range(40)]
    return spark.createDataFrame(rows, "symbol string, day int, id int, close double").repartition(5)


def brute(skewed):
    series = {}
    for r in skewed.collect():
        series.setdefault(r.symbol, []).append((r.day, r.id, r.close))
    return {k: sorted(v) for k, v in series.items()}


def test_golden_moves(golden):
    up = [r.up for r in up_move(golden).orderBy("date").collect()]
    assert up == [0, 1, 1, 0, 1, 0, 0, 1]
    assert [r.move for r in signed_move(golden).orderBy("date").collect()] == [1, 1, 1, -1, 2, -1, -2, 4]
    pairs = [(r.close, r.next_close, r.rising) for r in next_pair(golden, filler=False).orderBy("date").collect()]
    assert pairs == [(1, 2, True), (2, 3, True), (3, 2, False), (2, 4, True), (4, 3, False), (3, 1, False), (1, 5, True)]
    last = next_pair(golden).orderBy("date").collect()[-1]
    assert (last.next_close, last.rising) == (0, False)
    change = price_change(golden).orderBy("date").collect()
    assert [r.close_diff for r in change] == [1, 1, -1, 2, -1, -2, 4]
    assert [r.prev_date for r in change] == list(range(7))


@pytest.mark.parametrize("limit", [10_000, 300, 50])
def test_neighbours_do_not_depend_on_splitting(skewed, limit):
    got = with_neighbours(
        skewed, ["symbol"], ["day", "id"], ["close", "id"], "prev", "next", "pos", "n", "mean", max_rows_per_task=limit
    ).collect()
    expected = brute(skewed)
    assert len(got) == sum(map(len, expected.values()))
    for r in got:
        series = expected[r.symbol]
        assert series[r.pos][1] == r.id
        assert r.n == len(series) and r.mean == pytest.approx(sum(p for _, _, p in series) / len(series))
        before = series[r.pos - 1] if r.pos else None
        after = series[r.pos + 1] if r.pos + 1 < len(series) else None
        assert (r.prev and r.prev.id) == (before and before[1])
        assert (r.next and r.next.id) == (after and after[1])


@pytest.mark.parametrize("limit", [10_000, 100])
def test_common_order_values_are_split_too(spark, limit):
    rng = random.Random(9)
    rows = [("hot", 5 if rng.random() < 0.6 else rng.choice([1, 2, 3, 7, 7, 9]), i, rng.uniform(1, 9)) for i in range(2000)]
    rows += [("hot", None, -i, 1.0) for i in range(1, 900)]
    df = spark.createDataFrame(rows, "symbol string, day int, id int, close double").repartition(5)
    got = with_neighbours(df, ["symbol"], ["day", "id"], ["close", "id"], "prev", None, "pos", max_rows_per_task=limit)
    series = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    for r in got.collect():
        assert series[r.pos][2] == r.id
        assert (r.prev and r.prev.id) == (series[r.pos - 1][2] if r.pos else None)
    cut, pieces = cut_series(df, ["symbol"], ["day", "id"], df.count(), 100)
    sizes = [r["count"] for r in cut.groupBy("__chunk").count().collect()]
    assert max(sizes) <= 300 and len(sizes) <= pieces


def test_a_low_limit_makes_chunks_not_tasks(spark, rows):
    df = spark.range(6_000).selectExpr("'hot' as symbol", "id * 7919 % 6000 as id")
    cut, pieces = cut_series(df, ["symbol"], ["id"], 6_000, 5)
    assert len(cut.inputFiles()) <= 8  # the session's partitions
    sizes = [r["count"] for r in cut.groupBy("__chunk").count().collect()]
    assert max(sizes) <= 5 and 1_200 <= len(sizes) <= pieces
    got = with_neighbours(df, ["symbol"], ["id"], ["id"], "prev", "next", "pos", max_rows_per_task=5)
    assert rows(got.filter("pos <> id or ifnull(prev.id, -1) <> id - 1 or ifnull(next.id, 6000) <> id + 1")) == []


def test_equal_rows_keep_one_order_over_a_cut(spark):
    df = spark.range(400).selectExpr("'hot' as symbol", "0 as day", "id")
    got = with_neighbours(df, ["symbol"], ["day"], ["id"], "prev", "next", max_rows_per_task=7).collect()
    following = {r.id: r.next.id for r in got if r.next}
    assert {r.prev.id: r.id for r in got if r.prev} == following and len(following) == 399


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "double", "string", "ntz_far", "odd_double"])
def test_splitting_works_for_every_order_type(skewed, kind):
    typed = {
        "date": F.expr("date_add(date'2020-01-01', day)"),
        "timestamp": F.expr("timestamp'2020-01-01 00:00:00' + make_interval(0, 0, 0, day)"),
        "timestamp_ntz": F.expr("cast(timestamp'2020-03-01 00:00:00' + make_interval(0, 0, 0, 0, day) as timestamp_ntz)"),
        "double": F.expr("day / 7.0D"),
        "string": F.expr("concat('k', day)"),
        "ntz_far": F.expr("cast(timestamp'2039-03-01 00:00:00' + make_interval(0, 0, 0, day) as timestamp_ntz)"),
        "odd_double": F.expr("case day % 4 when 0 then null when 1 then -double('infinity') when 2 then double('nan') else -1e300 end"),
    }[kind]
    df = skewed.withColumn("day", typed)
    plain = with_neighbours(df, ["symbol"], ["day", "id"], ["id"], "prev", None, "pos")
    split = with_neighbours(df, ["symbol"], ["day", "id"], ["id"], "prev", None, "pos", max_rows_per_task=100)
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


@pytest.mark.parametrize("limit", [10_000, 200])
@pytest.mark.parametrize("period", ["6m", "3-6m"])
def test_period_stats_and_sharpe(skewed, period, limit):
    options = {"keys": ["symbol"], "order": ["day", "id"], "max_rows_per_task": limit}
    stats = {r.symbol: r for r in period_stats(skewed, period, **options).collect()}
    sharpe = {r.symbol: r.sharpe_ratio for r in sharpe_ratio(skewed, period, **options).collect()}
    for symbol, series in brute(skewed).items():
        prices = [p for _, _, p in series]
        end = len(prices) // 2 if period == "3-6m" else len(prices) - 1
        assert stats[symbol].start_price == prices[0]
        assert stats[symbol].latest_price == prices[end]
        assert stats[symbol].max_price == max(prices)
        assert stats[symbol].performance == pytest.approx(prices[end] / prices[0] - 1)
        used = prices[:end]
        r = [b / a - 1 for a, b in zip(used, used[1:])]
        mean = sum(r) / len(r)
        sigma = math.sqrt(sum((x - mean) ** 2 for x in r) / len(r))
        assert sharpe[symbol] == pytest.approx(math.sqrt(250) * mean / sigma)


@pytest.mark.parametrize("period", ["6m", "3-6m"])
def test_stock_performance_equals_its_parts(spark, skewed, period):
    quotes = skewed.filter("symbol is not null")
    companies = spark.createDataFrame([("hot", "Hot Inc"), ("a", "A Inc"), ("z", "No quotes")], "symbol string, name string")
    options = {"order": ["day", "id"], "max_rows_per_task": 150}
    got = {r.symbol: r for r in stock_performance(quotes, companies, period, **options).collect()}
    assert set(got) == {"hot", "a"}
    returns = {r.symbol: r for r in period_stats(quotes, period, **options).collect()}
    ratio = {r.symbol: r.sharpe_ratio for r in sharpe_ratio(quotes, period, **options).collect()}
    spread = {r.symbol: r for r in price_stats(quotes).collect()}
    for symbol, r in got.items():
        assert r[f"performance_{period}"] == pytest.approx(returns[symbol].performance)
        assert r[f"sharpe_ratio_{period}"] == pytest.approx(ratio[symbol])
        assert r[f"days_below_avg_{period}"] == spread[symbol].days_below_avg
        assert r[f"max_price_{period}"] == spread[symbol].max_price


def test_degenerate_series(spark):
    df = spark.createDataFrame(
        [("one", 1, 5.0), ("flat", 1, 2.0), ("flat", 2, 2.0), ("flat", 3, 2.0), ("zero", 1, 0.0), ("zero", 2, 3.0)],
        "symbol string, date int, close double",
    )
    assert {r.sharpe_ratio for r in sharpe_ratio(df).collect()} == {None}
    growth = {r.symbol: r.growth for r in growth_ratio(df).collect()}
    assert growth == {"one": 1.0, "flat": 1.0, "zero": None}
    assert history_of("3-6m") == "6m" and history_of("1m") == "1m"


@pytest.mark.parametrize("limit", [100, 3])
def test_price_stats(golden, limit):
    r = price_stats(golden, max_rows_per_task=limit).first()
    assert (r.max_price, r.min_price, r.days_below_avg, r.days_not_below_avg) == (5, 1, 4, 4)


@pytest.mark.parametrize("limit", [10_000, 60])
def test_running_totals(spark, limit):
    rng = random.Random(3)
    rows = [(float(v), rng.randrange(5)) for v in rng.sample(range(5000), 500)]
    df = spark.createDataFrame(rows, "x double, n int")
    for descending in (False, True):
        got = {r.x: r.n_so_far for r in running_totals(df, "x", ["n"], descending, max_rows_per_task=limit).collect()}
        total, expected = 0, {}
        for x, n in sorted(rows, reverse=descending):
            total += n
            expected[x] = total
        assert got == expected


def test_row_index_and_skip(spark):
    df = spark.createDataFrame([(f"k{i:04d}", i) for i in range(700)], "k string, v int").repartition(6)
    assert {r.v: r.row_index for r in with_row_index(df, ["k"]).collect()} == {i: i for i in range(700)}
    assert sorted(r.v for r in skip_rows(df, ["k"], 3).collect()) == list(range(3, 700))
    assert sorted(r.v for r in skip_rows(df, ["k"], 3, max_top=2).collect()) == list(range(3, 700))
    assert skip_rows(df, ["k"], 0).count() == 700


@pytest.mark.parametrize("limit", [100_000, 40])
def test_medians(spark, limit):
    rng = random.Random(11)
    rows = [("hot", rng.gauss(0, 100)) for _ in range(2001)] + [("dup", float(rng.randrange(3))) for _ in range(400)]
    rows += [("small", float(v)) for v in (4, 1, 3, 2)] + [("small", None), (None, 7.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r.g: r.m for r in median_by(df, ["g"], "v", "m", limit).collect()}
    up = {r.g: r.m for r in upper_median(df, "v", ["g"], "m", limit).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    for g, vs in groups.items():
        vs.sort()
        n = len(vs)
        assert up[g] == vs[n // 2]
        assert got[g] == pytest.approx((vs[(n - 1) // 2] + vs[n // 2]) / 2)
    everything = sorted(v for _, v in rows if v is not None)
    n = len(everything)
    assert median_of(df, "v", max_buffered=limit).first()[0] == pytest.approx(
        (everything[(n - 1) // 2] + everything[n // 2]) / 2
    )
