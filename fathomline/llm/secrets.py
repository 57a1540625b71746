"""Secrets in texts: fixed patterns, and tokens that a battery of randomness tests tells from words; built-in functions only.

Tokens are runs of at least ``SHORTEST`` characters of the base 64 alphabets. The narrowest encoding that holds all of
a token (hexadecimal, base 32, base 36, base 64) gives each of its characters a number, and four tests say how well
these numbers go with independent uniform draws: chi-squared over the alphabet, runs above and below its middle, runs
of digits, of letters of one case and of signs, and serial correlation of neighbours. Fisher's method and the smallest
one join their p-values; a token that fails either is patterned, not random.

Being uniform is no discovery in itself: a short word may be, too. Every token is therefore also held against words.
The characters of all distinct long tokens of all texts, fixed patterns left out, give the share of each symbol, and
from it the mean and deviation of the surprisal of a word of the token's own length; the p-value is that of a word
being as surprising. It shrinks with length, and is controlled for false discoveries by the Benjamini-Hochberg rule
among distinct tokens, by encoding and doubling length, so that masses of short words set no bar for long tokens.
A discovery that also passes the battery is a secret.

Texts are scanned twice and never shuffled; only tokens and counts move. Everything collected is bounded: sums per
encoding, one limit per encoding and doubling length.

Defined results: a null text is empty and has no spans. Repeated rows give repeated results. A text without any long token, or an
empty table, adds nothing to the shares, which start from one of each symbol; an encoding and length not met in
training has the plain limit of one test. Columns of the input stay, names made here
replace clashing ones. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.pii import _running, bound
from fathomline.llm.registry import query, table
from fathomline.llm.texts import packed
from fathomline.session import materialize

# The patterns that are always reported, and the least length of what they find.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"[0-9a-f]{24,}+",
}
LEAST_VALUE = 6
KINDS = (*PATTERNS, "random")

SHORTEST = 16
WORD = 12  # least length of a token that counts for the shares
RATE = 0.05  # of false discoveries
FAIL = 0.01  # battery p-value below which a token is patterned
TOKEN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{SHORTEST},}}+={{0,2}}"
LONG = TOKEN.replace(str(SHORTEST), str(WORD))

# Encodings from narrow to wide: symbols in the order of their numbers, and the form of a whole token.
ENCODINGS = {
    "hex": ("0123456789abcdef", r"^(?:[0-9a-f]+|[0-9A-F]+)$"),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", r"^[A-Z2-7]+=*$"),
    "base36": ("0123456789abcdefghijklmnopqrstuvwxyz", r"^(?:[0-9a-z]+|[0-9A-Z]+)$"),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", r"^[A-Za-z0-9+/_-]+=*$"),
}
_SPAN = "array<struct<kind:int,start:int,end:int,body:string>>"
_BIN = 8  # p-values are told apart to an eighth of their logarithm when ranked
_MOST = 700


def _spans(body: Column, pattern: str, kind: int) -> Column:
    """All matches of a pattern with their places."""
    def placed(matches):
        def whole(pieces):
            ends = _running(F.zip_with(matches, F.slice(pieces, F.lit(1), F.size(matches)), lambda m, p: F.length(m) + F.length(p)))
            return bound(ends, lambda to: F.transform(matches, lambda m, i: F.struct(
                F.lit(kind).alias("kind"), (F.get(to, i) - F.length(m)).alias("start"), F.get(to, i).alias("end"), m.alias("body"))))

        return F.when(F.size(matches) > 0, bound(F.split(body, pattern, -1), whole)).otherwise(F.array().cast(_SPAN))

    return bound(F.regexp_extract_all(body, F.lit(pattern), F.lit(0)), placed)


def base_spans(body: Column) -> dict[str, Column]:
    """By kind, the matches of the fixed patterns that are long enough."""
    none = F.array().cast(_SPAN)
    assign = F.filter(_spans(body, PATTERNS["assign"], 0),
                      lambda x: F.length(F.regexp_extract(x["body"], PATTERNS["assign"], 2)) >= LEAST_VALUE)
    return {
        "assign": F.when(body.contains("=") | body.contains(":"), assign).otherwise(none),
        "access": F.when(body.contains("AKIA"), _spans(body, PATTERNS["access"], 1)).otherwise(none),
        "hex": _spans(body, PATTERNS["hex"], 2),
    }


def _by_place(a: Column, b: Column) -> Column:
    return F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"])


def with_candidates(docs: DataFrame, text: str = "text", pattern: str = TOKEN) -> DataFrame:
    """``docs`` with ``_base`` (spans of the fixed patterns by start and kind) and ``_tokens`` (others that overlap none)."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs
    for kind, spans in base_spans(body).items():
        rows = rows.withColumn(f"_{kind}", spans)
    rows = rows.withColumn("_base", F.concat(*[F.col(f"_{kind}") for kind in PATTERNS]))
    rows = rows.withColumn("_base", F.when(F.size("_base") > 1, F.array_sort("_base", _by_place)).otherwise(F.col("_base")))
    tokens = F.filter(_spans(body, pattern, KINDS.index("random")), lambda x: ~x["body"].rlike("^[0-9]+$"))
    apart = bound(tokens, lambda found: F.when((F.size(found) == 0) | (F.size("_base") == 0), found).otherwise(
        F.filter(found, lambda x: ~F.exists("_base", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))))
    return rows.withColumn("_tokens", apart).drop(*[f"_{kind}" for kind in PATTERNS])


# -- the battery


def upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, right to some per cent far into the tail."""
    def tail(x):
        return (1 - F.exp(-1.4 * x)) * F.exp(-x * x / 2) / (1.135 * math.sqrt(2 * math.pi) * x)

    size = F.least(F.greatest(F.abs(z), F.lit(1e-6)), F.lit(37.0))
    return F.when(z < 0, 1 - tail(size)).otherwise(tail(size))


def encoding(token: Column) -> Column:
    """Number of the narrowest encoding that holds the whole token; null if none does."""
    return reduce(lambda rest, e: F.when(token.rlike(e[1][1]), F.lit(e[0])).otherwise(rest),
                  reversed(list(enumerate(ENCODINGS.values()))), F.lit(None).cast("int"))


def _numbers(token: Column, code: Column) -> Column:
    """The number of every character of a token in its alphabet; padding has none."""
    def per(alphabet):
        plain = F.regexp_replace(token, "=+$", "")
        if len(alphabet) == 64:
            return F.translate(plain, "-_", "+/")
        return F.lower(plain) if "a" in alphabet else plain

    chosen = F.get(F.array(*[F.lit(a) for a, _ in ENCODINGS.values()]), code)
    plain = reduce(lambda rest, e: F.when(code == e[0], per(e[1][0])).otherwise(rest), enumerate(ENCODINGS.values()), F.lit(""))
    return F.transform(F.split(plain, ""), lambda c: F.instr(chosen, c) - 1)


def _class(x: Column, code: Column) -> Column:
    """Class of a number in its alphabet: digits, letters of one case, signs."""
    # Where each alphabet's classes end.
    ends = F.get(F.array(*[F.array(*[F.lit(e) for e in es]) for es in ((10, 16, 16), (26, 32, 32), (10, 36, 36), (26, 52, 62))]), code)
    return (x >= F.get(ends, F.lit(0))).cast("int") + (x >= F.get(ends, F.lit(1))).cast("int") + (x >= F.get(ends, F.lit(2))).cast("int")


_CHANGES = [1 - sum((p / n) ** 2 for p in parts) for n, parts in (
    (16, (10, 6)), (32, (26, 6)), (36, (10, 26)), (64, (26, 26, 10, 2)))]  # chance that neighbours differ in class


def statistics(token: Column) -> Column:
    """``code``, ``n``, ``numbers`` (of the characters) and ``fit`` (p-value of the battery) of a token."""
    def per_code(code):
        def of_code(values):
            return F.get(F.array(*[F.lit(float(v)) for v in values]), code)

        def measured(v):
            n, k = F.size(v).cast("double"), of_code([len(a) for a, _ in ENCODINGS.values()])
            # Squared counts: in order, every symbol adds twice its number of equal predecessors and one.
            start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))
            squares = F.aggregate(F.array_sort(v), start, lambda s, x: F.struct(
                x.alias("last"), F.when(x == s["last"], s["run"] + 1).otherwise(F.lit(1.0)).alias("run"),
                (s["sum"] + F.when(x == s["last"], 2 * s["run"] + 1).otherwise(F.lit(1.0))).alias("sum")))["sum"]
            middle = (k - 1) / 2
            walk = F.struct(F.lit(-1).alias("last"), *[F.lit(0.0).alias(c) for c in ("runs", "turns", "serial")])

            def step(s, x):
                def more(name, value):
                    return (s[name] + F.when(s["last"] >= 0, value).otherwise(F.lit(0.0))).alias(name)

                return F.struct(
                    x.alias("last"), more("runs", ((s["last"] < middle) != (x < middle)).cast("double")),
                    more("turns", (_class(s["last"], code) != _class(x, code)).cast("double")),
                    more("serial", (s["last"] - middle) * (x - middle)))

            def joined(sums):
                pairs, w = F.greatest(n - 1, F.lit(1.0)), sums["w"]
                turn = of_code(_CHANGES)
                chi = (k * sums["squares"] / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * pairs / n)
                runs = F.abs(w["runs"] - pairs / 2) / F.sqrt(pairs / 4)
                turns = F.abs(w["turns"] - pairs * turn) / F.sqrt(pairs * turn * (1 - turn))
                serial = F.abs(w["serial"]) / ((k * k - 1) / 12 * F.sqrt(pairs))
                ps = [upper_tail(chi), *[2 * upper_tail(z) for z in (runs, turns, serial)]]
                half = reduce(lambda a, b: a + b, [-F.log(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-300))) for p in ps])
                # Fisher's sum of four, chi-squared of eight degrees of freedom.
                fit = F.exp(-half) * (1 + half + half * half / 2 + half * half * half / 6)
                return F.struct(code.alias("code"), F.size(v).alias("n"), v.alias("numbers"),
                                F.least(fit, len(ps) * F.least(*ps)).alias("fit"))

            return bound(F.struct(squares.alias("squares"), F.aggregate(v, walk, step).alias("w")), joined)

        return bound(_numbers(token, code), measured)

    return bound(encoding(token), per_code)


def words_like(s: Column, shares: list[list[float]]) -> Column:
    """P-value of a word being as surprising as a token with statistics ``s``. ``shares``: of the symbols of each encoding."""
    def of_code(value, kind=float):
        return F.get(F.array(*[F.lit(kind(value(q))) for q in shares]), s["code"])

    logs = F.get(F.array(*[F.array(*[F.lit(-math.log(x)) for x in q]) for q in shares]), s["code"])
    mean = of_code(lambda q: -sum(x * math.log(x) for x in q))
    square = of_code(lambda q: sum(x * math.log(x) ** 2 for x in q))
    total = bound(logs, lambda table: F.aggregate(s["numbers"], F.lit(0.0), lambda t, x: t + F.get(table, x)))
    return upper_tail((total - s["n"] * mean) / F.sqrt(F.greatest(s["n"] * (square - mean * mean), F.lit(1e-9))))


def _shares(symbols: DataFrame) -> list[list[float]]:
    """By encoding, the share of each of its symbols among ``symbol``, ``n``."""
    counts = {r.symbol: r.n for r in symbols.collect()}  # characters of the tokens' alphabets: 67 rows at most
    for sign, same in ("-+", "_/"):
        counts[same] = counts.get(same, 0) + counts.get(sign, 0)
    found = []
    for alphabet, _ in ENCODINGS.values():
        one_case = len(alphabet) < 64
        held = [1 + sum(counts.get(c, 0) for c in ({a.lower(), a.upper()} if one_case else {a})) for a in alphabet]
        found.append([h / sum(held) for h in held])
    return found


def _length_class(n: Column) -> Column:
    return F.floor(F.log2(n.cast("double"))).cast("int")


def train(docs: DataFrame, text: str = "text", rate: float = RATE) -> dict:
    """What all texts say: the ``shares`` of symbols in words, and per encoding and doubling length the largest p-value
    that keeps the expected share of false discoveries among distinct tokens below ``rate`` (``limits``)."""
    found = with_candidates(docs.select(F.col(f"`{text}`").alias("text")), pattern=LONG)
    found = materialize(found.select(F.explode("_tokens.body").alias("body")).distinct(), "secret-tokens")
    shares = _shares(found.select(F.explode(F.split("body", "")).alias("symbol")).groupBy("symbol").agg(F.count(F.lit(1)).alias("n")))
    tokens = found.filter(F.col("body").rlike(TOKEN)).select(statistics(F.col("body")).alias("s")).filter("s.code is not null")
    step = F.least(F.floor(-F.log(F.greatest(words_like(F.col("s"), shares), F.lit(1e-300))) * _BIN), F.lit(_BIN * _MOST))
    bins = tokens.groupBy(F.col("s.code").alias("code"), _length_class(F.col("s.n")).alias("size"), step.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    one = Window.partitionBy("code", "size")  # rows of a window: bins, 5,600 at most
    ranked = bins.withColumns({"rank": F.sum("n").over(one.orderBy(F.desc("bin"))), "all": F.sum("n").over(one)})
    passed = F.exp(-F.col("bin") / float(_BIN)) <= rate * F.col("rank") / F.col("all")
    limits = ranked.groupBy("code", "size").agg(F.min(F.when(passed, F.col("bin"))).alias("bin")).collect()
    return {"shares": shares, "limits": {
        (r.code, r["size"]): 0.0 if r.bin is None else math.exp(-r.bin / _BIN) for r in limits}}


def find(docs: DataFrame, model: dict | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of ``kind`` (its number), ``start``, ``end`` and ``body``.

    Without a ``model`` one is trained on ``docs`` first.
    """
    model = train(docs, text) if model is None else model
    rows = with_candidates(packed(docs, ("base_spans", "spans"), text=text))
    limit = F.create_map(*[x for (code, size), p in sorted(model["limits"].items()) for x in (F.lit(f"{code}:{size}"), F.lit(p))]) \
        if model["limits"] else F.create_map().cast("map<string,double>")

    def is_secret(x):
        return bound(statistics(x["body"]), lambda s: F.coalesce(
            (s["fit"] >= FAIL) & (words_like(s, model["shares"]) <= F.coalesce(F.try_element_at(
                limit, F.concat_ws(":", s["code"].cast("string"), _length_class(s["n"]).cast("string"))), F.lit(RATE))),
            F.lit(False)))

    added = F.when(F.size("_tokens") > 0, F.filter("_tokens", is_secret)).otherwise(F.col("_tokens"))
    rows = rows.withColumn("_added", added)
    every = F.when(F.size("_added") > 0, F.array_sort(F.concat("_base", "_added"), _by_place)).otherwise(F.col("_base"))
    return rows.select("_row.*", F.col("_base").alias("base_spans"), every.alias("spans"))


def listing(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


@query()
def op11_secret_scans(spark, folder):
    """Fixed patterns counted and digested, and all spans, of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find(docs)

    def n(kind):
        return F.size(F.filter("base_spans", lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[n(k) for k in PATTERNS], F.sha2(listing(F.col("base_spans")), 256).alias("base_sha256"),
        listing(F.col("spans")).alias("spans"))
