"""Item-to-item cosine similarity over co-rating users.

``ratings`` holds ``(user, item, rating)``. Rows without a rating are left out; several ratings of an item by one user
count each on its own.

Ratings of an item by one user are first reduced to their sum, sum of squares and number. A user with ``a`` ratings of
one item and ``b`` of another gives that pair ``a * b`` support.

Where few pairs can pass, supports are counted first and sums are taken for passing pairs alone: every item of a user is
sent on with one list of short codes of the user's later items, so a co-rated pair costs four bytes instead of a row of
sums. Codes may meet, which only adds pairs that the exact sums drop again. Where most pairs pass, sums of all co-rated
pairs are reduced map-side instead.

Users with very many items would dominate the pairing step. As long as the users left out of pairing give no pair more
than a part of the support threshold together, no pair that passes is missed: every one of them shows up through the
remaining users. The largest users of whom that is certain (the squares of their largest numbers of ratings of an item
add up to that part at most) are therefore left out, and their ratings are added to the surviving pairs alone. Other large
users are cut into blocks of items, and each block is paired with runs of blocks by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.session import materialize

MAX_ITEMS_PER_TASK = 2_000
MIN_SUPPORT = 50
PAIRS_PER_TASK = 2_000_000  # pairs counted by one task; some hundred bytes each
RATINGS_PER_TASK = 100_000  # an item with more ratings is counted by several tasks
SLICES_PER_RUN = 16  # slices of a large user that a slice is paired with at once
LEFT_OUT_SHARE = 0.1  # rows of rare items stay where they are fewer: moving all rows would cost more than their pairs

_SUMS = ["xy", "xx", "yy", "support"]


def _summed(ratings: DataFrame) -> DataFrame:
    """``user``, ``item``, ``s``, ``q``, ``n`` (sum, sum of squares, number)."""
    rating = F.col("rating").cast("double")
    return ratings.select("user", "item", rating.alias("rating")).filter("rating is not null").groupBy("user", "item").agg(
        F.sum("rating").alias("s"), F.sum(F.col("rating") * F.col("rating")).alias("q"), F.count(F.lit(1)).alias("n"))


def _frequent(ratings: DataFrame, min_support: int) -> tuple[DataFrame, DataFrame]:
    """Summed rows, and the number of users ``rated`` of every item that can pass ``min_support``.

    Rows of other items are left out where they are many enough to pay for moving all rows by item.
    """
    rows = materialize(_summed(ratings).filter("user is not null and item is not null"), "summed-ratings")
    # Each rating of an item meets at most as many of another one as the user has of any item.
    repeated = materialize(rows.filter("n > 1").groupBy("user").agg(F.max("n").alias("most")), "repeated")
    met = rows.withColumn("most", F.lit(1)) if repeated.isEmpty() else rows.join(repeated, "user", "left")
    most = F.sum(F.col("n") * F.coalesce("most", F.lit(1)))
    items = materialize(met.groupBy("item").agg(most.alias("most"), F.count(F.lit(1)).alias("rated")), "items")
    enough = items.filter(F.col("most") > min_support).select("item", "rated")
    given, kept = (x.agg(F.sum("rated")).first()[0] or 0 for x in (items, enough))
    if given - kept > LEFT_OUT_SHARE * given:
        rows = materialize(rows.join(enough, "item", "left_semi"), "frequent-ratings")
    return rows, enough


def _left_out(degrees: DataFrame, max_items: int, spared: int) -> DataFrame:
    """``user``: the largest users, as many as give no pair more than ``spared`` together."""
    first = Window.orderBy(F.desc("items"), "user").rowsBetween(Window.unboundedPreceding, 0)
    large = degrees.filter((F.col("items") > max_items) & (F.col("most") <= spared))
    hot = large.orderBy(F.desc("items"), "user").limit(spared)
    return hot.withColumn("most", F.sum("most").over(first)).filter(F.col("most") <= spared).select("user")


def _with_partners(rows: DataFrame, degrees: DataFrame, max_items: int, tasks: int) -> DataFrame:
    """``first``, ``n``, ``codes``, ``ns``, ``salt``: for every item of a user the codes of the user's later items.

    Items are ordered by ``(code, item)``. A large user's slices of that order are paired with runs of ``SLICES_PER_RUN``
    slices, their own and all later ones, so an item is sent on with one list a run, however small the slices are. ``ns``
    are the numbers of ratings of the partners, null if all are 1.
    """
    code = F.hash("item")
    sized = rows.select("user", "item", "n", "salt").repartition(tasks, "user")
    sized = sized.join(degrees.select("user", F.ceil(F.col("items") / max_items).alias("slices")), "user")
    own = F.shiftright((code.cast("long") + F.lit(1 << 31)) * F.col("slices"), 32)
    run = F.floor(own / SLICES_PER_RUN)
    entry = F.struct(code.alias("code"), "item", own.alias("own"), "n", "salt")
    lists = sized.groupBy("user", "slices", run.alias("run")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))

    def field(entries, name, plain=None):
        values = F.transform(entries, lambda e: e[name])
        return values if plain is None else F.when(F.exists(entries, lambda e: ~plain(e[name])), values)

    def numbers(entries):
        return field(entries, "n", lambda n: n == 1)

    def items_of(entries):
        return [field(entries, "item").alias("items"), numbers(entries).alias("own_ns"),
                field(entries, "salt", lambda salt: salt.isNull()).alias("salts")]

    def partners_of(entries):
        return [field(entries, "code").alias("codes"), numbers(entries).alias("ns")]

    entries, slice_, run = F.col("entries"), F.col("to.own"), F.col("run")
    small = lists.filter((F.col("slices") == 1) & (F.size(entries) > 1))
    small = small.select(*items_of(entries), *partners_of(entries), F.lit(True).alias("inner"))

    # Every slice sends its items to its own run and all later ones; a run's codes meet its own and all earlier slices.
    goal = lambda own, run, holds: F.struct(own.alias("own"), run.alias("run"), F.lit(holds).alias("holds"))
    first, last = run * SLICES_PER_RUN, F.floor((F.col("slices") - 1) / SLICES_PER_RUN)
    slices = F.sequence(first, F.least(first + SLICES_PER_RUN, F.col("slices")) - 1)
    own_goals = F.flatten(F.transform(slices, lambda a: F.transform(F.sequence(run, last), lambda r: goal(a, r, True))))
    earlier = F.filter(F.sequence(F.lit(0).cast("long"), first), lambda a: a < first)
    goals = F.concat(own_goals, F.transform(earlier, lambda a: goal(a, run, False)))
    sent = lists.filter("slices > 1").select("user", "run", "entries", F.explode(goals).alias("to"))
    inner = F.col("to.run") == run
    held = F.when(F.col("to.holds"), F.filter(entries, lambda e: e["own"] == slice_))
    given = F.when(~F.col("to.holds"), entries).when(inner, F.filter(entries, lambda e: e["own"] >= slice_))
    sent = sent.select("user", slice_.alias("own"), F.col("to.run").alias("run"), held.alias("held"), given.alias("given"))
    sent = sent.select("user", "own", "run", *items_of(F.col("held")), *partners_of(F.col("given")))
    names = ["items", "own_ns", "salts", "codes", "ns"]
    units = sent.repartition(tasks, "user", "own", "run").groupBy("user", "own", "run").agg(
        *[F.first(c, True).alias(c) for c in names])
    units = units.filter("items is not null and codes is not null")
    units = units.select(*names, (F.floor(F.col("own") / SLICES_PER_RUN) == F.col("run")).alias("inner"))

    at = F.col("at")
    each = small.unionByName(units).select(F.posexplode("items").alias("at", "item"), "own_ns", "salts", "codes", "ns", "inner")
    begin = F.when(F.col("inner"), at + 2).otherwise(1)
    each = each.filter(begin <= F.size("codes"))
    return each.select(
        F.col("item").alias("first"), F.coalesce(F.get("own_ns", at), F.lit(1)).alias("n"), F.get("salts", at).alias("salt"),
        *[F.slice(c, begin, F.size("codes")).alias(c) for c in ("codes", "ns")])


def _passing_pairs(rows, degrees, items, pairs: int, max_items: int, more_than: int) -> DataFrame:
    """``(item1, item2, probe, other)``: pairs whose support in ``rows`` may be above ``more_than``, by codes.

    ``items`` has the number of ratings ``rated`` per item; the probe is the item with fewer of them.
    """
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // PAIRS_PER_TASK))
    salts = F.ceil(F.col("rated") / RATINGS_PER_TASK)
    many = materialize(items.filter(F.col("rated") > RATINGS_PER_TASK).select("item", salts.alias("salts")), "salts")
    salted = rows.withColumn("salts", F.lit(None).cast("long")) if many.isEmpty() else rows.join(many, "item", "left")
    salted = salted.withColumn("salt", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("user"), "salts").cast("int")))
    # Counting by item, salt and code needs no second exchange; only salted items and passing pairs meet again.
    spread = _with_partners(salted, degrees, max_items, tasks).repartition(tasks, "first", "salt")
    single = spread.select("first", "salt", "n", "ns", F.posexplode("codes").alias("at", "code"))
    weight = F.col("n") * F.coalesce(F.get("ns", F.col("at")), F.lit(1))
    counted = single.groupBy("first", "salt", "code").agg(F.sum(weight).alias("support"))
    counted = counted.filter(F.col("salt").isNotNull() | (F.col("support") > more_than))
    passing = counted.groupBy("first", "code").agg(F.sum("support").alias("support")).filter(F.col("support") > more_than)
    coded = materialize(passing.select("first", "code"), "passing-codes")
    seconds = items.select(F.hash("item").alias("code"), F.col("item").alias("second"), F.col("rated").alias("rated2"))
    firsts = items.select(F.col("item").alias("first"), F.col("rated").alias("rated1"))
    found = coded.join(seconds, "code").join(firsts, "first")
    own = F.hash("first")
    found = found.filter((F.col("code") > own) | ((F.col("code") == own) & (F.col("second") > F.col("first"))))
    fewer = F.col("rated1") <= F.col("rated2")
    return found.select(
        F.least("first", "second").alias("item1"), F.greatest("first", "second").alias("item2"),
        F.when(fewer, F.col("first")).otherwise(F.col("second")).alias("probe"),
        F.when(fewer, F.col("second")).otherwise(F.col("first")).alias("other"))


def _sums_of(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Sums of the given pairs over all users, from the ratings of their items only."""
    wanted = pairs.select(F.explode(F.array("item1", "item2")).alias("item")).distinct()
    kept = rows.join(wanted, "item", "left_semi")
    a, b = kept.alias("a"), kept.alias("b")
    met = pairs.alias("p").join(a, F.col("p.probe") == F.col("a.item"))
    met = met.join(b, (F.col("p.other") == F.col("b.item")) & (F.col("a.user") == F.col("b.user")))
    straight = F.col("p.probe") == F.col("p.item1")
    x = lambda c: F.when(straight, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}"))
    y = lambda c: F.when(straight, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))
    return met.groupBy("p.item1", "p.item2").agg(
        F.sum(x("s") * y("s")).alias("xy"), F.sum(x("q") * y("n")).alias("xx"), F.sum(y("q") * x("n")).alias("yy"),
        F.sum(x("n") * y("n")).alias("support"),
    )


def _pair_sums(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    a, b = left.alias("a"), right.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on]
    x, y = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    pairs = a.join(b, [*same, F.col("a.item") < F.col("b.item")])
    return pairs.groupBy(F.col("a.item").alias("item1"), F.col("b.item").alias("item2")).agg(
        F.sum(x("s") * y("s")).alias("xy"), F.sum(x("q") * y("n")).alias("xx"), F.sum(y("q") * x("n")).alias("yy"),
        F.sum(x("n") * y("n")).alias("support"),
    )


def _spread_pair_sums(rows: DataFrame, degrees: DataFrame, max_items: int) -> DataFrame:
    """Pair sums in which a user's items are cut into slices of about ``max_items``, both sides of the pairing alike."""
    sized = rows.join(degrees.withColumn("slices", F.ceil(F.col("items") / max_items).cast("int")), "user")
    own = F.pmod(F.xxhash64("item"), F.col("slices")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    left = sized.withColumn("slice", own).withColumn("other", every)
    right = sized.withColumn("other", own).withColumn("slice", every)
    return _pair_sums(left, right, ["user", "slice", "other"])


def _with_hot_users(sums: DataFrame, rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Add the ratings of the hot users, at most as many as the support threshold, to every pair."""
    vectors = rows.join(hot, "user", "left_semi").groupBy("item").agg(
        F.map_from_entries(F.collect_list(F.struct("user", F.struct("s", "q", "n")))).alias("by_user"))
    first = vectors.select(F.col("item").alias("item1"), F.col("by_user").alias("v1"))
    second = vectors.select(F.col("item").alias("item2"), F.col("by_user").alias("v2"))
    joined = sums.join(first, "item1", "left").join(second, "item2", "left")
    shared = F.coalesce(F.array_intersect(F.map_keys("v1"), F.map_keys("v2")), F.array())

    def added(term, zero=F.lit(0.0)):
        return F.aggregate(shared, zero, lambda total, u: total + term(u))

    x, y = (lambda u: F.col("v1")[u]), (lambda u: F.col("v2")[u])
    return joined.select(
        "item1", "item2",
        (F.col("xy") + added(lambda u: x(u)["s"] * y(u)["s"])).alias("xy"),
        (F.col("xx") + added(lambda u: x(u)["q"] * y(u)["n"])).alias("xx"),
        (F.col("yy") + added(lambda u: y(u)["q"] * x(u)["n"])).alias("yy"),
        (F.col("support") + added(lambda u: x(u)["n"] * y(u)["n"], F.lit(0).cast("long"))).alias("support"),
    )


def co_rated_sums(
    ratings: DataFrame,
    min_support: int = MIN_SUPPORT,
    max_items_per_task: int = MAX_ITEMS_PER_TASK,
) -> DataFrame:
    """``(item1, item2, xy, xx, yy, support)`` with ``item1 < item2`` and support above ``min_support``.

    Sums are taken of pairs that pass the threshold, or, where most pairs pass, of all co-rated pairs, reduced map-side.
    With ``min_support=0`` nothing can be left out, so every co-rated pair is formed.
    """
    rows, items = _frequent(ratings, min_support) if min_support > 0 else (_summed(ratings), None)
    degrees = rows.groupBy("user").agg(F.count(F.lit(1)).alias("items"), F.max(F.col("n") * F.col("n")).alias("most"))
    if min_support > 0:
        degrees = materialize(degrees, "degrees")
        spared = min_support // 2
        hot = materialize(_left_out(degrees, max_items_per_task, spared), "left-out") if spared else None
        light = rows if hot is None else rows.join(hot, "user", "left_anti")
        held = degrees if hot is None else degrees.join(hot, "user", "left_anti")
        given = 0 if hot is None or hot.isEmpty() else spared
        formed = held.agg(F.sum(F.col("items") * (F.col("items") - 1) / 2)).first()[0] or 0
        known = items.count()
        # Markov: of all pairs, at most this average over the threshold can pass.
        if 2 * formed < (min_support - spared) * known * (known - 1) / 2:
            pairs = _passing_pairs(light, held, items, int(formed), max_items_per_task, min_support - given)
            sums = _sums_of(materialize(pairs, "passing-pairs"), rows)
            return sums.filter(F.col("support") > min_support).select("item1", "item2", *_SUMS)
    large = degrees.filter(F.col("items") > max_items_per_task)
    if large.isEmpty():
        sums = _pair_sums(rows, rows, ["user"])
    elif min_support <= 0:
        sums = _spread_pair_sums(rows, degrees.drop("most"), max_items_per_task)
    else:
        # What they give a pair together stays within the threshold.
        hot = _left_out(degrees, max_items_per_task, min_support)
        light = rows.join(hot, "user", "left_anti")
        sums = _spread_pair_sums(light, degrees.drop("most"), max_items_per_task)
        sums = _with_hot_users(sums, rows, hot)
    return sums.filter(F.col("support") > min_support).select("item1", "item2", *_SUMS)


def cosine(xy, xx, yy):
    """Cosine of two rating vectors from their sums; 0 where a vector has no length."""
    return F.coalesce(F.try_divide(xy, F.sqrt(xx) * F.sqrt(yy)), F.lit(0.0))


def pair_similarity(
    ratings: DataFrame,
    min_score: float | None = None,
    min_support: int = MIN_SUPPORT,
    max_items_per_task: int = MAX_ITEMS_PER_TASK,
) -> DataFrame:
    """``(item1, item2, score, support)``; both thresholds are strict."""
    sums = co_rated_sums(ratings, min_support, max_items_per_task)
    scored = sums.select("item1", "item2", cosine(F.col("xy"), F.col("xx"), F.col("yy")).alias("score"), "support")
    return scored if min_score is None else scored.filter(F.col("score") > min_score)


def similar_items(
    sims: DataFrame, names: DataFrame, item, min_score: float = 0.97, min_support: int = 50, k: int = 10
) -> DataFrame:
    """``(item, name, score, support)``: the best ``k`` partners of one item among scored pairs."""
    partner = F.when(F.col("item1") == item, F.col("item2")).otherwise(F.col("item1"))
    rows = sims.filter((F.col("item1") == item) | (F.col("item2") == item))
    rows = rows.select(partner.alias("item"), "score", "support")
    return _best(rows, names, min_score, min_support, k)


def items_similar_to(
    ratings: DataFrame, names: DataFrame, item, min_score: float = 0.97, min_support: int = 50, k: int = 10
) -> DataFrame:
    """As ``similar_items``, straight from the ratings: only users of that item are joined, so no
    pair of other items is ever formed."""
    rows = ratings.select("user", "item", F.col("rating").cast("double").alias("rating"))
    own = rows.filter(F.col("item") == item).select("user", F.col("rating").alias("own"))
    x, y = F.col("own"), F.col("rating")
    sums = rows.filter(F.col("item") != item).join(own, "user").groupBy("item").agg(
        F.sum(x * y).alias("xy"), F.sum(x * x).alias("xx"), F.sum(y * y).alias("yy"),
        F.count(F.lit(1)).alias("support"),
    )
    scored = sums.select("item", cosine(F.col("xy"), F.col("xx"), F.col("yy")).alias("score"), "support")
    return _best(scored, names, min_score, min_support, k)


def _best(rows, names, min_score, min_support, k):
    good = rows.filter((F.col("score") > min_score) & (F.col("support") > min_support))
    best = good.orderBy(F.desc("score"), F.desc("support"), "item").limit(k)
    return best.join(names.select("item", "name"), "item", "left").select("item", "name", "score", "support")
