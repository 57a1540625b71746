"""Personal data by weak supervision, with built-in functions only.

Candidates are the spans of strict patterns (always kept) and of looser ones. Labelers vote on every candidate: strict
pattern, checks of its digits or parts, gazetteers of prefixes and endings, words before it, and what touches it. The
counts of vote patterns, a few hundred rows per kind, are all that expectation-maximisation needs to estimate how
reliable each labeler is; it runs as a fold inside one expression per kind. Its probabilities are the soft labels of
a naive Bayes classifier over features of a span, whose table of a hundred-odd weights decides about the looser spans.

Texts are scanned twice and never shuffled. Positions come from the pieces between matches, summed up in blocks, so
a text of very many matches stays affordable; patterns that repeat a group are possessive, so a long run of digits
neither backtracks nor deepens the stack.

Defined results: a null text is empty and has no spans. Repeated rows give repeated results. Columns of the input
stay, names made here replace clashing ones. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.registry import query, table
from fathomline.llm.texts import packed
from fathomline.session import materialize

KINDS = ("email", "ip", "card", "phone")
BEFORE = 24  # characters looked at ahead of a span
ROUNDS = 25
ACCEPT = 0.8
_BLOCK = 64

_MAIL = "A-Za-z0-9._%+-"
STRICT = {
    "email": rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(] ?(?i:at) ?[\])] ?[A-Za-z0-9-]{1,63}+"
             r"(?: ?[\[(] ?(?i:dot) ?[\])] ?[A-Za-z0-9-]{1,63}+|\.[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9._/])[0-9]{4}([._/])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9._/])",
    "phone": r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z.-])",
}
_NEEDS = {"email": ("@", "at"), "phone": ("+", "-| |\\.")}

# Endings of host names, card and telephone prefixes, and words that come before personal data or before
# other numbers.
ENDINGS = "com org net edu gov io info biz de fr es uk it eu us ca ch at nl be pl ru br in jp cn au mx"
CARD_PREFIX = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|64[4-9]|35)"
CALL_PREFIX = r"^(1[2-9]|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CUES = {
    "email": "e-?mail|mail|contact|write|correo|courriel|adresse",
    "ip": r"\bip|host|server|address|adresse|dirección",
    "card": "card|visa|master|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|telefon|téléphone|teléfono|ruf",
}
OTHER_CUES = r"version|isbn|order|token|build|release|serial|\bid\b|\bno\b|§"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(sizes: Column) -> Column:
    """Running sums of an array, by sums of blocks."""
    def place(items):
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _BLOCK).cast("int")),
            lambda b: F.aggregate(F.slice(items, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), lambda s, x: s + x))
        return bound(blocks, lambda sums: F.transform(items, lambda _, i: (
            F.aggregate(F.slice(sums, F.lit(1), F.floor(i / _BLOCK).cast("int")), F.lit(0), lambda s, x: s + x)
            + F.aggregate(F.slice(items, (i - i % _BLOCK + 1).cast("int"), i % _BLOCK + 1), F.lit(0), lambda s, x: s + x))))

    return bound(sizes, place)


_EMPTY = "array<struct<kind:int,start:int,end:int,body:string,before:string,after:string,strict:boolean>>"


def _spans(body: Column, kind: str, strict: bool) -> Column:
    """All matches of a kind's pattern with their places and neighbours."""
    pattern = (STRICT if strict else LOOSE)[kind]
    needs = _NEEDS.get(kind, (None, None))[0 if strict else 1]
    found = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))

    def placed(matches):
        def whole(pieces):
            ends = _running(F.zip_with(
                matches, F.slice(pieces, F.lit(1), F.size(matches)), lambda m, p: F.length(m) + F.length(p)))
            return bound(ends, lambda to: F.transform(matches, lambda m, i: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"), (F.get(to, i) - F.length(m)).alias("start"), F.get(to, i).alias("end"),
                m.alias("body"), F.right(F.get(pieces, i), F.lit(BEFORE)).alias("before"),
                F.left(F.get(pieces, i + 1), F.lit(1)).alias("after"), F.lit(strict).alias("strict"))))

        return F.when(F.size(matches) > 0, bound(F.split(body, pattern, -1), whole)).otherwise(F.array().cast(_EMPTY))

    all_of = bound(found, placed)
    if needs is None:
        return all_of
    test = F.contains(body, F.lit(needs)) if needs in ("@", "+") else body.rlike(
        r"[\[(] ?(?i:at) ?[\])]" if kind == "email" else "[0-9]{4}")
    return F.when(test, all_of).otherwise(F.array().cast(_EMPTY))


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    total = F.aggregate(
        F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0),
        lambda s, i: s + bound(
            F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (1 + i % 2),
            lambda d: F.when(d > 9, d - 9).otherwise(d)))
    return total % 10 == 0


def _valid(kind: str, body: Column) -> Column:
    """Whether a match of a kind passes the check of its digits or parts."""
    if kind == "email":
        return body.rlike(r"\.[A-Za-z]{2,}$|(?i)dot ?[\])] ?[a-z]{2,}$")
    if kind == "ip":
        return body.contains(":") | ~F.exists(
            F.split(body, r"\."), lambda p: ~p.rlike("^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"))
    low, high = (14, 19) if kind == "card" else (10, 15)
    return bound(_digits(body), lambda d: F.when(
        F.length(d).between(low, high), _luhn(d) if kind == "card" else F.lit(True)).otherwise(F.lit(False)))


def _checked(kind: str):
    return lambda x: _valid(kind, x["body"])


def base_spans(body: Column) -> dict[str, Column]:
    """By kind, the matches of the strict patterns that pass their checks."""
    return {
        kind: _spans(body, kind, True) if kind == "email" else F.filter(
            _spans(body, kind, True), _checked(kind))
        for kind in KINDS
    }


def with_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_base`` (strict spans by start and kind) and ``_more`` (looser spans that overlap none of them)."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs
    for kind, spans in base_spans(body).items():
        rows = rows.withColumn(f"_{kind}", spans)
    base = F.concat(*[F.col(f"_{kind}") for kind in KINDS])
    by_place = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"])
    rows = rows.withColumn("_base", F.array_sort(base, by_place))
    loose = F.concat(*[_spans(body, kind, False) for kind in KINDS])
    free = bound(loose, lambda found: F.when(F.size(found) == 0, found).otherwise(F.filter(
        found, lambda x: ~F.exists(F.col("_base"), lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))))
    return rows.withColumn("_more", free)


def votes(span: Column) -> Column:
    """One vote per labeler: 1 for, -1 against, 0 for none."""
    def by_kind(choose):
        return reduce(lambda rest, k: F.when(span["kind"] == KINDS.index(k), choose(k)).otherwise(rest), KINDS, F.lit(0))

    def sign(test):
        return F.when(test, 1).otherwise(-1)

    body, before = span["body"], F.lower(span["before"])
    listed = {
        "email": lambda: F.array_contains(F.array(*[F.lit(e) for e in ENDINGS.split()]), F.lower(F.regexp_extract(body, "([A-Za-z]+)$", 1))),
        "ip": lambda: body.contains(":") | F.coalesce(F.regexp_extract(body, "^0*([0-9]{0,3})", 1).try_cast("int"), F.lit(0)).between(1, 223),
        "card": lambda: _digits(body).rlike(CARD_PREFIX),
        "phone": lambda: F.when(body.startswith("+"), _digits(body).rlike(CALL_PREFIX)).otherwise(_digits(body).rlike("^[2-9]")),
    }
    return F.array(
        sign(span["strict"]),
        by_kind(lambda k: sign(_valid(k, body))),
        by_kind(lambda k: sign(listed[k]())),
        F.when(before.rlike(OTHER_CUES), -1).otherwise(by_kind(lambda k: F.when(before.rlike(CUES[k]), 1).otherwise(0))),
        sign(~span["before"].rlike(r"[\p{L}0-9]$") & ~span["after"].rlike(r"[\p{L}0-9]")),
    )


def features(span: Column) -> Column:
    """Names of the features of a span; each is one of a few values."""
    kind, body = span["kind"].cast("string"), span["body"]

    def named(name, value):
        return F.concat_ws("|", kind, F.lit(name), value)

    def shape(c):
        return F.when(c == "", "none").when(c.rlike(r"[\p{L}]"), "letter").when(c.rlike("[0-9]"), "digit").when(
            c.rlike(r"\s"), "space").otherwise("mark")

    return F.array(
        named("digits", F.least(F.length(_digits(body)), F.lit(20)).cast("string")),
        named("length", F.least(F.floor(F.length(body) / 4), F.lit(12)).cast("string")),
        named("before", shape(F.right(span["before"], F.lit(1)))), named("after", shape(span["after"])),
        named("valid", F.get(span["votes"], F.lit(1)).cast("string")), named("listed", F.get(span["votes"], F.lit(2)).cast("string")),
        named("cue", F.get(span["votes"], F.lit(3)).cast("string")),
    )


def _estimated(patterns: Column) -> Column:
    """Reliabilities and prior of one kind from ``array<struct<v, n>>``, by expectation-maximisation."""
    def posterior(v, state):
        odds = F.aggregate(F.zip_with(v, state["acc"], lambda x, a: x * F.log(a / (1 - a))), F.lit(0.0), lambda s, x: s + x)
        return 1 / (1 + F.exp(-(F.log(state["prior"] / (1 - state["prior"])) + odds)))

    def total(items, value):
        return F.aggregate(items, F.lit(0.0), lambda s, x: s + value(x))

    def clip(x, low, high):
        return F.least(F.greatest(x, F.lit(low)), F.lit(high))

    def step(state, _):
        judged = F.transform(patterns, lambda p: F.struct(
            p["v"].alias("v"), p["n"].cast("double").alias("n"), posterior(p["v"], state).alias("q")))
        return bound(judged, lambda items: F.struct(
            clip(total(items, lambda x: x["n"] * x["q"]) / total(items, lambda x: x["n"]), 0.05, 0.95).alias("prior"),
            F.transform(F.sequence(F.lit(0), F.lit(4)), lambda l: clip(
                (8 + total(items, lambda x: F.when(F.get(x["v"], l) == 1, x["n"] * x["q"]).when(
                    F.get(x["v"], l) == -1, x["n"] * (1 - x["q"])).otherwise(0.0)))
                / (10 + total(items, lambda x: F.when(F.get(x["v"], l) != 0, x["n"]).otherwise(0.0))), 0.5, 0.99,
            )).alias("acc")))

    start = F.struct(F.lit(0.5).alias("prior"), F.array(*[F.lit(0.8)] * 5).alias("acc"))
    state = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return bound(state, lambda s: F.transform(patterns, lambda p: F.struct(
        p["v"].alias("v"), posterior(p["v"], s).alias("q"))))


def train(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """Weights of the span classifier: log odds per feature, and per kind under its number.

    All candidates of all texts are counted by votes and features; the counts are bounded by the number of their
    combinations, the result by the number of features.
    """
    rows = with_candidates(docs.select(F.col(f"`{text}`").alias("text")))
    spans = rows.select(F.explode(F.concat("_base", "_more")).alias("x"))
    spans = spans.select("x", votes(F.col("x")).alias("votes")).select(F.struct("x.*", "votes").alias("x"))
    cells = materialize(
        spans.select(F.col("x.kind").alias("kind"), F.col("x.votes").alias("v"), features(F.col("x")).alias("f"))
        .groupBy("kind", "v", "f").agg(F.count(F.lit(1)).alias("n")), "span-counts")
    patterns = cells.groupBy("kind", "v").agg(F.sum("n").alias("n"))
    by_kind = patterns.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("patterns"))
    soft = by_kind.select("kind", F.explode(_estimated(F.col("patterns"))).alias("p")).select("kind", "p.v", "p.q")
    labelled = cells.join(soft, ["kind", "v"]).select(
        "kind", "f", (F.col("n") * F.col("q")).alias("yes"), (F.col("n") * (1 - F.col("q"))).alias("no"))
    sums = labelled.select(F.explode(F.concat("f", F.array(F.col("kind").cast("string")))).alias("name"), "kind", "yes", "no")
    totals = labelled.groupBy("kind").agg(F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"))
    weighed = sums.groupBy("kind", "name").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).join(totals, "kind")
    odds = F.when(F.col("name") == F.col("kind").cast("string"), F.log((F.col("yes") + 1) / (F.col("no") + 1))).otherwise(
        F.log((F.col("yes") + 1) / (F.col("all_yes") + 20)) - F.log((F.col("no") + 1) / (F.col("all_no") + 20)))
    return {r[0]: float(r[1]) for r in weighed.select("name", odds).collect()}


def find(docs: DataFrame, weights: dict[str, float] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of ``kind`` (its number), ``start``, ``end`` and ``body``.

    Without ``weights`` they are trained on ``docs`` first.
    """
    weights = train(docs, text) if weights is None else weights
    rows = with_candidates(packed(docs, ("base_spans", "spans"), text=text))
    table_of = F.create_map(*[F.lit(x) for pair in sorted(weights.items()) for x in pair]) if weights else F.create_map().cast("map<string,double>")

    def accepted(x):
        def decide(span):
            names = F.concat(features(span), F.array(span["kind"].cast("string")))
            odds = F.aggregate(names, F.lit(0.0), lambda s, name: s + F.coalesce(F.try_element_at(table_of, name), F.lit(0.0)))
            return 1 / (1 + F.exp(-odds)) >= ACCEPT

        return bound(F.struct(x["kind"].alias("kind"), x["body"].alias("body"), x["before"].alias("before"),
                              x["after"].alias("after"), votes(x).alias("votes")), decide)

    def plain(spans):
        return F.transform(spans, lambda x: F.struct(x["kind"], x["start"], x["end"], x["body"]))

    by_place = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"])
    added = F.when(F.size("_more") > 0, F.filter("_more", accepted)).otherwise(F.col("_more"))
    rows = rows.withColumn("_added", added)
    every = F.when(F.size("_added") > 0, F.array_sort(F.concat("_base", "_added"), by_place)).otherwise(F.col("_base"))
    return rows.select("_row.*", plain(F.col("_base")).alias("base_spans"), plain(every).alias("spans"))


def listing(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def mask(docs: DataFrame, weights: dict[str, float] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets; overlapping spans by the first's."""
    found = find(packed(docs, text=text), weights, "text").withColumnRenamed("text", "body")
    body = F.col("body")
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])

    # Furthest end so far, and the pieces of the result.
    def step(state, x):
        return F.when(x["start"] < state["at"], F.struct(F.greatest(state["at"], x["end"]).alias("at"), state["out"].alias("out"))).otherwise(
            F.struct(x["end"].alias("at"), F.concat(state["out"], F.array(
                F.substring(body, state["at"] + 1, x["start"] - state["at"]), F.get(names, x["kind"]))).alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    state = F.aggregate("spans", start, step)
    masked = bound(state, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(body, s["at"] + 1, F.length(body))))
    whole = found.select("_row", F.when(F.size("spans") > 0, masked).otherwise(body).alias("masked"))
    return whole.select(*[F.col("masked").alias(c) if c == text else F.col(f"_row.`{c}`") for c in docs.columns])


@query()
def op6_pii(spark, folder):
    """Strict spans counted and digested, and all spans, of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find(docs)

    def n(kind):
        return F.size(F.filter("base_spans", lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[n(k) for k in KINDS], F.sha2(listing(F.col("base_spans")), 256).alias("base_sha256"),
        listing(F.col("spans")).alias("spans"))
