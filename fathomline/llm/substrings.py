"""Removal of long repeated byte strings by suffix order and longest previous factors.

Two equal strings of ``length`` bytes have the same smallest hash of ``GRAM`` bytes at the same place in them. That
place is the anchor of the string. So only strings with equal anchors are compared, and an anchor occurs every
hundred-odd bytes.

1. Documents of equal bytes are one text. Each text gives its anchors; anchors seen twice or more stay.
2. Around each of those, the strings that it anchors lie in one short context. Equal contexts are merged.
3. Contexts of one anchor hash meet in one task. The suffixes of a block of contexts are sorted to ``length`` bytes
   by prefix doubling; common lengths with the nearest suffixes of smaller and larger positions in suffix order are
   the longest previous and next factors. A string is repeated if one of them reaches ``length``.
4. An anchor with more than ``MAX_CONTEXTS`` different contexts is not held together: its strings are spread by 128-bit
   hashes and counted with their first place, which decides the same question.
5. Repeated strings are laid over their documents.

With ``keep_first`` the earliest copy of everything stays (by id, then place), as a previous factor tells. Without it
every copy goes.

Defined results: a null text is empty; texts shorter than ``length`` keep all bytes. Rows with the same id and text
count as two documents. Null ids come last. Columns may have any names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.jaccard import keyed
from fathomline.llm.registry import query, table
from fathomline.llm.shingles import mixed
from fathomline.llm.suffixes import common_lengths, longest_factors, suffix_ranks
from fathomline.llm.texts import packed, slices, small
from fathomline.session import materialize, spread

LENGTH = 400
GRAM = 128
CHUNK = 1_000_000  # bytes searched for anchors at once
BLOCK = 700_000  # bytes sorted at once
MAX_CONTEXTS = 4_000
BROADCAST_ROWS = 100_000  # of anchors, eight bytes each

_BYTES = [mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(seed)) for seed in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)]
_BASE = 0x5851F42D4C957F2D
_powers: dict[int, np.ndarray] = {}


def _power(base: int, count: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < count:
        steps = np.full(max(count, CHUNK + LENGTH + 1), base % 2**64, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps)
    return known[:count]


def rolling_hashes(data: np.ndarray, length: int, kind: int = 0) -> np.ndarray:
    """A 64-bit hash of every string of ``length`` bytes: prefix sums of a polynomial, shifted to a common power."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTES[kind][data] * _power(_BASE, len(data)))])
    return mixed((sums[length:] - sums[:-length]) * _power(pow(_BASE, -1, 2**64), n))


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchors of all strings of ``length`` bytes: hash, place, and first and last start of the strings it anchors."""
    found = [(np.zeros(0, dtype=np.uint64), *[np.zeros(0, dtype=np.int64)] * 3)]
    width = length - gram + 1
    for begin in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[begin:begin + CHUNK + length - 1]
        hashes = rolling_hashes(part, gram)
        n = len(hashes)
        keyed_ = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        full = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
        full[:n] = keyed_
        rows = full.reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        strings = n - width + 1
        place = (np.minimum(behind[:strings], ahead[width - 1:width - 1 + strings]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:] - 1, [strings - 1]])
        found.append((hashes[place[first]], place[first] + begin, first + begin, last + begin))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def _anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id``, ``k1``, ``k2``, ``digest``, ``size`` and ``anchors`` of rows with the first four and ``text``."""

    def work(batches):
        for batch in batches:
            body = batch.column(4)
            for a, b in slices([t or "" for t in body.to_pylist()]):
                data = [_bytes(t.as_py()) for t in body[a:b]]
                hashes = [anchors(d, length, gram)[0].view(np.int64) for d in data]
                ends = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns[:4], pa.array([len(d) for d in data], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(hashes), pa.int64()))],
                    names=["doc_id", "k1", "k2", "digest", "size", "anchors"])

    return spread(texts).mapInArrow(
        work, "doc_id long, k1 long, k2 long, digest binary, size long, anchors array<long>")


_CONTEXT = "key long, cid binary, doc_id long, k1 long, k2 long, start long, strings int, span binary"


def _contexts(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Contexts of the anchors listed in ``repeated`` of rows ``doc_id``, ``k1``, ``k2``, ``repeated``, ``text``."""

    def work(batches):
        for batch in batches:
            ids, one, two, repeated = (batch.column(k) for k in range(4))
            out = []
            size = 0

            def made(out):
                return pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in out], kind) for k, kind in enumerate((
                        pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                    names=[c.split()[0] for c in _CONTEXT.split(", ")])

            for r in range(batch.num_rows):
                data = _bytes(batch.column(4)[r].as_py())
                hashes, place, first, last = anchors(data, length, gram)
                raw = data.tobytes()
                wanted = np.asarray(repeated[r].values.to_numpy())
                for k in np.flatnonzero(np.isin(hashes.view(np.int64), wanted)):
                    a, b = int(first[k]), int(last[k])
                    span = raw[a:b + length]
                    key = int(hashes[k].view(np.int64))
                    cid = hashlib.blake2b(
                        span, digest_size=16, key=hashes[k].tobytes() + int(place[k] - a).to_bytes(8, "little")).digest()
                    out.append((key, cid, ids[r].as_py(), one[r].as_py(), two[r].as_py(), a, b - a + 1, span))
                    size += len(span)
                    if size > 4_000_000:
                        yield made(out)
                        out, size = [], 0
            if out:
                yield made(out)

    return rows.mapInArrow(work, _CONTEXT)


def _ranges(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last places of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2].tolist(), (edges[1::2] - 1).tolist()


def _repeated_in(spans: list[bytes], length: int, keep_first: bool) -> list[tuple[list[int], list[int]]]:
    """For contexts in order of their first places: runs of starts of strings that occur elsewhere too."""
    data = np.frombuffer(b"".join(spans), dtype=np.uint8)
    sizes = np.array([len(s) for s in spans])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    levels, deepest = suffix_ranks(data, length)
    inside = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(begins[:-1], begins[1:], strict=True)])
    order = inside[np.lexsort((inside, deepest[inside]))]
    lengths = np.zeros(len(order), dtype=np.int64)
    same = deepest[order[1:]] == deepest[order[:-1]]
    lengths[1:] = np.where(same, length, np.minimum(common_lengths(levels, order[:-1], order[1:], length), length - 1))
    previous, following = longest_factors(order, lengths)
    best = previous if keep_first else np.maximum(previous, following)
    flags = np.zeros(len(data), dtype=bool)
    flags[order[best >= length]] = True
    return [_ranges(flags[a:b - length + 1]) for a, b in zip(begins[:-1], begins[1:], strict=True)]


def _sorted_repeats(batches, length: int, keep_first: bool):
    """Rows ``key``, ``cid``, order columns and ``span``, sorted by key, to ``cid``, ``lows``, ``highs``."""
    held: list[tuple] = []
    size, key = 0, None

    def done():
        rows = sorted(held, key=lambda x: x[1:6])
        found = _repeated_in([x[6] for x in rows], length, keep_first)
        kept = [(x[0], *f) for x, f in zip(rows, found, strict=True) if f[0]]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in kept], pa.binary()), pa.array([x[1] for x in kept], pa.list_(pa.int32())),
             pa.array([x[2] for x in kept], pa.list_(pa.int32()))], names=["cid", "lows", "highs"])

    for batch in batches:
        frame = batch.to_pydict()
        for k, cid, no_id, doc_id, k1, k2, start, span in zip(*[frame[c] for c in (
                "key", "cid", "no_id", "doc_id", "k1", "k2", "start", "span")], strict=True):
            if k != key and size > BLOCK:
                yield done()
                held, size = [], 0
            key = k
            held.append((cid, no_id, doc_id or 0, k1, k2, start, span))
            size += len(span)
    if held:
        yield done()


def _spread_repeats(contexts: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """The same for anchors of very many contexts: strings meet by their hashes, one row per task and string."""

    def work(batches):
        for batch in batches:
            for cid, span in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = np.frombuffer(span, dtype=np.uint8)
                one, two = (rolling_hashes(data, length, kind).view(np.int64) for kind in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cid] * len(one), pa.binary()), pa.array(range(len(one)), pa.int32()), pa.array(one),
                     pa.array(two)], names=["cid", "at", "h1", "h2"])

    strings = contexts.select("cid", "span").mapInArrow(work, "cid binary, at int, h1 long, h2 long").join(
        contexts.select("cid", "no_id", "doc_id", "k1", "k2", "start"), "cid")
    strings = strings.withColumn("order", F.struct(
        "no_id", "doc_id", "k1", "k2", (F.col("start") + F.col("at")).alias("place")))
    strings = materialize(strings.select("cid", "at", "h1", "h2", "order"), "strings")
    met = strings.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("order").alias("least")).filter("n > 1")
    again = strings.join(met, ["h1", "h2"])
    if keep_first:
        again = again.filter(F.col("order") > F.col("least"))
    return again.groupBy("cid").agg(F.sort_array(F.collect_list("at")).alias("lows")).select(
        "cid", "lows", F.col("lows").alias("highs"))


def removed_ranges(docs: DataFrame, keep_first: bool = True, length: int = LENGTH, gram: int = GRAM,
                   max_contexts: int = MAX_CONTEXTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored ``k1``, ``k2`` (see ``jaccard.keyed``), ``whole`` and ``ranges`` of every key whose text loses bytes.

    ``ranges`` are pairs of the first start and the last start of repeated strings; ``whole`` means all bytes go.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = keyed(docs, doc_id, text).withColumn("digest", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    found = materialize(
        _anchor_rows(source.select("doc_id", "k1", "k2", "digest", "text"), length, gram), "anchors")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")
    long_ones = found.filter(F.col("size") >= length)
    texts = materialize(long_ones.groupBy("digest").agg(
        F.min(order).alias("rep"), F.count(F.lit(1)).alias("copies")), "texts")
    reps = long_ones.join(texts.select("rep.k1", "rep.k2").distinct(), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    keys = reps.select("k1", "k2", F.explode("anchors").alias("key"))
    twice = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    wanted = materialize(
        keys.join(twice, "key").groupBy("k1", "k2").agg(F.collect_set("key").alias("repeated")), "wanted")

    # Anchors of a text are as many as it is long, so at every size they meet the texts by a shuffle.
    rows = source.select("doc_id", "k1", "k2", "text").join(wanted.hint("merge"), ["k1", "k2"]).select(
        "doc_id", "k1", "k2", "repeated", "text")
    members = materialize(_contexts(rows, length, gram), "contexts")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2", "start")
    contexts = materialize(members.groupBy("key", "cid").agg(
        F.min(place).alias("least"), F.countDistinct(place).alias("members"), F.first("span").alias("span"),
    ).select("key", "cid", "least.*", "members", "span"), "distinct-contexts")
    sizes = materialize(contexts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > max_contexts).select("key"), "large-anchors")
    columns = ["key", "cid", "no_id", "doc_id", "k1", "k2", "start", "span"]
    usual = contexts.join(small(sizes, BROADCAST_ROWS), "key", "left_anti").select(*columns)
    usual = usual.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(
        lambda batches: _sorted_repeats(batches, length, keep_first), "cid binary, lows array<int>, highs array<int>")
    repeats = usual
    if not sizes.isEmpty():
        large = contexts.join(small(sizes, BROADCAST_ROWS), "key", "left_semi").select(*columns)
        repeats = usual.unionByName(_spread_repeats(large, length, keep_first))
    repeats = materialize(repeats, "repeats")

    # Members of merged contexts are copies of each other from end to end.
    laid = members.select("cid", "doc_id", "k1", "k2", "start", "strings").join(
        contexts.select("cid", "members", F.struct("no_id", "doc_id", "k1", "k2", "start").alias("least")), "cid").join(
        repeats, "cid", "left")
    copied = F.col("members") > 1
    if keep_first:
        copied = copied & (place != F.col("least"))
    pairs = F.when(copied, F.array(F.struct(F.col("start").alias("lo"), (F.col("start") + F.col("strings") - 1).alias("hi")))).otherwise(
        F.zip_with("lows", "highs", lambda a, b: F.struct((F.col("start") + a).alias("lo"), (F.col("start") + b).alias("hi"))))
    by_rep = laid.select("k1", "k2", pairs.alias("pairs")).filter("pairs is not null").groupBy("k1", "k2").agg(
        F.sort_array(F.flatten(F.collect_list("pairs"))).alias("ranges"))
    # All rows of equal bytes: further copies go as a whole, with keep_first all but the first.
    fate = long_ones.select("doc_id", "k1", "k2", "digest").join(texts, "digest").join(by_rep, ["k1", "k2"], "left")
    is_first = (F.col("k1") == F.col("rep.k1")) & (F.col("k2") == F.col("rep.k2"))
    whole = F.col("copies") > 1
    if keep_first:
        whole = whole & ~is_first
    fate = fate.withColumn("whole", whole).filter("whole or ranges is not null")
    return materialize(fate.select("k1", "k2", "whole", "ranges").dropDuplicates(["k1", "k2"]), "fates")


def without_repeats(docs: DataFrame, keep_first: bool = True, length: int = LENGTH, gram: int = GRAM,
                    max_contexts: int = MAX_CONTEXTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_bytes`` (what is left, which may cut characters).

    Repeats between rows of the same id and text are settled between their keys: with ``keep_first`` both stay.
    """
    made = ("n_bytes", "n_removed", "n_spans", "kept_bytes")
    fates = removed_ranges(docs, keep_first, length, gram, max_contexts, doc_id, text)
    rows = packed(docs, made, doc_id=doc_id, text=text)
    pair = [F.col("doc_id").cast("long"), F.col("text")]
    fated = fates.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "whole", "ranges")
    rows = rows.withColumns({"_k1": F.xxhash64(F.lit(1), *pair), "_k2": F.xxhash64(F.lit(2), *pair)}).drop("doc_id")
    if text not in made:  # the row holds it too, and is moved once
        rows = rows.drop("text")
    # As with anchors, ranges follow the length of a text.
    rows = rows.join(fated.hint("merge"), ["_k1", "_k2"], "left")
    whole_text = F.col("text") if text in made else F.col("_row")[text]
    body = F.encode(F.coalesce(whole_text, F.lit("")), "UTF-8")
    size = F.octet_length(body).cast("long")
    # Starts become bytes; ranges are in order and apart, so a run ends where the next one does not touch it.
    ranges = F.col("ranges")
    ends = F.filter(F.transform(ranges, lambda x, i: F.when(
        F.coalesce(F.get(ranges, i + 1)["lo"] > x["hi"] + length, F.lit(True)), x["hi"] + length)), lambda x: x.isNotNull())
    starts = F.filter(F.transform(ranges, lambda x, i: F.when(
        F.coalesce(x["lo"] > F.get(ranges, i - 1)["hi"] + length, F.lit(True)), x["lo"])), lambda x: x.isNotNull())
    everything = F.array(F.struct(F.lit(0).cast("long").alias("lo"), size.alias("hi")))
    rows = rows.withColumn("_spans", F.when(F.col("whole"), everything).when(
        ranges.isNotNull(), F.zip_with(starts, ends, lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))),
    ).otherwise(F.array().cast("array<struct<lo:bigint,hi:bigint>>")))
    spans = F.col("_spans")
    removed = F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["hi"] - x["lo"])
    # Bytes as characters of one byte each, so that the pieces are joined in one go.
    pieces = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: F.decode(F.substring(
        body, (F.coalesce(F.get(spans, i - 1)["hi"], F.lit(0)) + 1).cast("int"),
        (F.coalesce(F.get(spans, i)["lo"], size) - F.coalesce(F.get(spans, i - 1)["hi"], F.lit(0))).cast("int")), "ISO-8859-1"))
    kept = F.when(F.size(spans) == 0, body).otherwise(F.encode(F.array_join(pieces, ""), "ISO-8859-1"))
    return rows.select("_row.*", size.alias("n_bytes"), removed.alias("n_removed"), F.size(spans).cast("long").alias("n_spans"),
                       kept.alias("kept_bytes"))


@query()
def op7_repeated_substrings(spark, folder):
    """Bytes that every document loses to strings of 400 bytes found elsewhere, and the digest of the rest."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return without_repeats(docs, keep_first=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))
