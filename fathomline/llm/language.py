"""Language identification in two steps: the family of languages, then one-versus-one machines within it.

Features are frequencies of letters, letter pairs and triples of the lower-cased whole text, hashed to ``WIDTH`` places
and square-rooted. The family is the one whose one-versus-rest linear support vector machine gives the largest margin;
inside the family every pair of languages has a machine of its own and the language with most wins is taken (ties: larger
sum of margins, then the first name).

Machines are fitted on a bounded sample: at most ``MAX_PER_LANGUAGE`` labelled documents per language, those with the
smallest hashes of their ids, whatever the size of the table. One task fits one machine. A machine is ``WIDTH`` numbers;
there are as many as families and pairs of languages within families, so what goes to the tasks is bounded by the
number of languages. Prediction is one pass without a shuffle over every row.

Defined results: ``und`` with score 0 for a null text or one without a letter, and for all if nothing can be learned.
Rows without a language are predicted, not learned from. Repeated rows give repeated results. All columns stay, columns
named ``lang_pred``, ``score`` or ``family_pred`` are replaced.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.llm.registry import query, table
from fathomline.llm.shingles import mixed
from fathomline.llm.texts import slices, small
from fathomline.session import materialize, spread

WIDTH = 4096
MAX_PER_LANGUAGE = 1_500
MAX_PER_SIDE = 3_000  # documents on each side of one machine
UNKNOWN = "und"
BROADCAST_LANGUAGES = 10_000

# Languages that are told apart from each other only in a second step.
FAMILIES = {
    "germanic": "de en nl sv da no nb nn is af lb fy",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "turkic": "tr az kk uz ky tk",
    "indic": "hi bn ur mr gu pa ne",
    "uralic": "fi et hu",
}


def family_of(lang: str) -> str:
    """The family of a language code; an unlisted one is a family of its own."""
    return next((f for f, codes in FAMILIES.items() if lang in codes.split()), lang)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """One row of ``WIDTH`` features per text, and the number of its letters."""
    codes = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    gap = np.zeros(1, dtype=np.uint32)
    flat = np.concatenate([x for c in codes for x in (gap, c)] + [gap]).astype(np.int64)
    letter = _letters()[flat]
    flat = np.where(letter, flat, 0)
    at = np.flatnonzero(letter)
    row = np.repeat(np.arange(len(texts)), [len(c) + 1 for c in codes])[at]
    before, here, after = flat[at - 1], flat[at], flat[at + 1]
    out = np.zeros(len(texts) * WIDTH, dtype=np.float32)
    for kind, key in enumerate((here, here << 21 | before, (here << 21 | before) << 21 | after)):
        place = (mixed(key.view(np.uint64) * np.uint64(3) + np.uint64(kind)) % np.uint64(WIDTH)).astype(np.int64)
        out += np.bincount(row * WIDTH + place, minlength=len(out)).astype(np.float32)
    counts = np.bincount(row, minlength=len(texts))
    out = out.reshape(len(texts), WIDTH)
    out /= np.maximum(3 * counts, 1)[:, None]
    return np.sqrt(out, out=out), counts


def fit(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30, seed: int = 7) -> np.ndarray:
    """A linear support vector machine with squared hinge loss, by dual coordinate descent; the last weight is the bias.

    Both sides weigh the same whatever their sizes.
    """
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)]).astype(np.float64)
    weight = np.zeros(x.shape[1])
    alpha = np.zeros(len(x))
    share = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1)))
    slack = 1 / (2 * cost * share)
    length = (x * x).sum(axis=1) + slack
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for i in random.permutation(len(x)):
            gradient = y[i] * (weight @ x[i]) - 1 + slack[i] * alpha[i]
            new = max(alpha[i] - gradient / length[i], 0.0)
            if new != alpha[i]:
                weight += (new - alpha[i]) * y[i] * x[i]
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return weight


def _sample(docs: DataFrame, doc_id: str, text: str, lang: str, most: int) -> DataFrame:
    """``lang``, ``place`` and ``features`` of at most ``most`` documents per language, by the hash of the id and text."""
    rows = docs.filter(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").rlike(r"\p{L}")).select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"),
        F.pmod(F.xxhash64(F.col(f"`{doc_id}`"), F.length(f"`{text}`")), F.lit(1 << 30)).alias("turn"))
    sizes = docs.groupBy(F.col(f"`{lang}`").alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    # A fraction that leaves enough of each language, then exactly the smallest of what is left.
    cut = (F.lit(4.0 * most) / F.col("n") * float(1 << 30)).cast("long")
    sizes = materialize(sizes.filter("lang is not null").withColumn("cut", cut), "languages")
    few = rows.join(small(sizes, BROADCAST_LANGUAGES), "lang").filter(F.col("turn") <= F.col("cut"))
    order = Window.partitionBy("lang").orderBy("turn", F.xxhash64("text"))
    few = few.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)

    def measure(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in slices(texts):
                x = features(texts[a:b])[0].astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns[:2], pa.array([row.tobytes() for row in x], pa.binary())],
                    names=["lang", "place", "features"])

    return few.select("lang", "place", "text").mapInArrow(measure, "lang string, place int, features binary")


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          most: int = MAX_PER_LANGUAGE) -> dict:
    """Machines learned from rows with a language: ``families`` (name to weights), ``pairs`` and ``languages``."""
    sample = materialize(_sample(docs, doc_id, text, lang, most), "language-sample")
    languages = sorted(r[0] for r in sample.select("lang").distinct().collect())
    members: dict[str, list[str]] = {}
    for code in languages:
        members.setdefault(family_of(code), []).append(code)
    problems = [(f"family {name}", name, None) for name in members if len(members) > 1] + [
        (f"pair {a} {b}", a, b) for codes in members.values() for a, b in combinations(codes, 2)]
    machines: dict[str, np.ndarray] = {}
    if problems:
        sides = {code: [] for code in languages}
        for name, a, b in problems:
            for code in languages:
                if b is None:
                    own = family_of(code) == a
                    others = sum(family_of(c) != a for c in languages) if not own else len(members[a])
                    sides[code].append((name, 1 if own else -1, max(1, MAX_PER_SIDE // others)))
                elif code in (a, b):
                    sides[code].append((name, 1 if code == a else -1, MAX_PER_SIDE))
        rows = [(code, *side) for code, found in sides.items() for side in found]
        wanted = docs.sparkSession.createDataFrame(rows, "lang string, problem string, side int, quota int")
        use = sample.join(F.broadcast(wanted), "lang").filter("place <= quota").select("problem", "side", "features")

        def solve(frame: pd.DataFrame) -> pd.DataFrame:
            x = np.frombuffer(b"".join(frame["features"]), dtype=np.float16).reshape(len(frame), WIDTH)
            weight = fit(x.astype(np.float32), frame["side"].to_numpy())
            return pd.DataFrame({"problem": frame["problem"].iloc[:1], "weight": [weight.astype(np.float32).tobytes()]})

        solved = use.groupBy("problem").applyInPandas(solve, "problem string, weight binary")
        machines = {r[0]: np.frombuffer(r[1], dtype=np.float32) for r in solved.collect()}
    return {"languages": languages, "members": members, "machines": machines}


def _decide(x: np.ndarray, model: dict) -> tuple[list[str], list[str], np.ndarray]:
    """Family, language and score of each row of features."""
    def margin(name):
        weight = model["machines"][name]
        return x @ weight[:-1] + weight[-1]

    def chance(m):
        return 1 / (1 + np.exp(-4 * np.clip(m, -50, 50)))

    names = list(model["members"])
    score = np.ones(len(x))
    if len(names) > 1:
        margins = np.stack([margin(f"family {n}") for n in names], axis=1)
        family = margins.argmax(axis=1)
        score *= chance(margins[np.arange(len(x)), family])
    else:
        family = np.zeros(len(x), dtype=np.int64)
    chosen = np.empty(len(x), dtype=object)
    for f, name in enumerate(names):
        own = np.flatnonzero(family == f)
        codes = model["members"][name]
        wins, sums = np.zeros((len(own), len(codes))), np.zeros((len(own), len(codes)))
        least = np.ones((len(own), len(codes)))
        for i, j in combinations(range(len(codes)), 2):
            m = margin(f"pair {codes[i]} {codes[j]}")[own]
            wins[:, i] += m >= 0
            wins[:, j] += m < 0
            sums[:, i] += m
            sums[:, j] -= m
            least[:, i] = np.minimum(least[:, i], chance(m))
            least[:, j] = np.minimum(least[:, j], chance(-m))
        best = np.array([max(range(len(codes)), key=lambda k: (wins[r, k], sums[r, k])) for r in range(len(own))], dtype=np.int64)
        chosen[own] = np.array(codes, dtype=object)[best] if len(own) else []
        score[own] *= least[np.arange(len(own)), best] if len(own) else 1
    return [names[f] for f in family], chosen.tolist(), score


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``family_pred``."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "family_pred")]
    rows = spread(docs.select(*[F.col(f"`{c}`") for c in kept]))
    place = kept.index(text)

    def work(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            for begin, end in slices(texts):
                for a in range(begin, end, 1_000):  # bounds the matrix, however short the texts are
                    b = min(a + 1_000, end)
                    x, letters = features(texts[a:b])
                    if model["languages"]:
                        family, lang, score = _decide(x, model)
                    else:
                        family, lang, score = [UNKNOWN] * (b - a), [UNKNOWN] * (b - a), np.zeros(b - a)
                    none = letters == 0
                    yield pa.RecordBatch.from_arrays(
                        [*batch.slice(a, b - a).columns,
                         pa.array([UNKNOWN if z else v for z, v in zip(none, lang, strict=True)]),
                         pa.array(np.where(none, 0.0, score)),
                         pa.array([UNKNOWN if z else v for z, v in zip(none, family, strict=True)])],
                        names=[*kept, "lang_pred", "score", "family_pred"])

    return rows.mapInArrow(work, T.StructType([
        *rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("family_pred", T.StringType())]))


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: one in five by the checksum of its id."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))) % 5 == 0


@query()
def op2_language_id(spark, folder):
    """Predicted language of every document, learned from the documents that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(~held_out()))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "family_pred")
