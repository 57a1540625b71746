"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is one of characters, ``ORDER`` at a time, so its tables stay far smaller than the text and no text of
any language is out of vocabulary. A character is folded to one of 4,095 symbols; five symbols fill one long.

Training. Tasks count the n-grams of trusted texts and the partial counts are summed by n-gram. Lower orders use
continuation counts (in how many different contexts to the left an n-gram was seen), order by order. Discounts
come from the counts of counts of each order. Joining each n-gram with its context's totals and with its shorter
n-gram gives every seen n-gram its final probability and the weight it leaves to shorter contexts.

Scoring, as sharded count joins. Documents are packed into compressed blocks, stored bucketed by block. A block
asks for its distinct n-grams of all orders, one message per shard of the model; a shard, held by one task at a time,
answers every message in order; the answers of a block are brought to it, which moves none of the stored blocks.
So what moves follows the distinct n-grams of each block and grows with the input, a task holds one shard of
bounded size and one message, or one block, and a document's source or copies make no difference.

Verdict. A document is rejected when its log perplexity lies above its language's limit. Trusted documents are dealt
to ``FOLDS`` folds by a hash of their text, so that copies share one, and each is scored by a model that was not shown
its fold, as unseen documents are. The counts of all those models are kept side by side, so training takes one pass.
Of these scores each language has its median and the distance from there to the upper quantile. That distance is averaged
with the one over all languages (each around its own median), which counts for ``MIN_TRUSTED`` documents. The limit is
the median plus the distance, plus ``MARGIN`` times the distance. The mean over few characters varies more, so that is
added once more times ``sqrt(LENGTH / characters)``. A language without any trusted text uses the limit over all of them.

Defined results: a null or empty text has no perplexity and is rejected. A null language is a language of its own.
Repeated rows are scored one by one; an empty table gives an empty result. Without any trusted text nothing is
rejected but empty texts. All columns stay; names made here replace clashing ones.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.llm.registry import query, table
from fathomline.llm.shingles import mixed
from fathomline.llm.texts import SLICE_CHARS, small
from fathomline.session import fresh_path, materialize, spread

ORDER = 5
_WIDTH = 12
_START = 1  # stands before the first character
BLOCK_CHARS = 12_000_000
SLICE = 1_000_000  # characters whose n-grams are spelled out at once
HELD_GRAMS = 1_500_000  # n-grams that a counting task holds before it sums them up
SHARD_ENTRIES = 500_000
MESSAGES_PER_PART = 512
BROADCAST_IDS = 4_000_000  # 32 MB
BROADCAST_LANGUAGES = 10_000
QUANTILES = (0.5, 0.99)
MARGIN = 0.5
LENGTH = 200  # characters
FOLDS = 5  # of trusted documents
MIN_TRUSTED = 50  # with fewer, the distance over all languages outweighs the own one


def symbols(texts: list[str | None], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each after ``order - 1`` start symbols, and the number of characters of each text."""
    codes = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    pad = np.full(order - 1, _START, dtype=np.int64)
    folded = []
    for c in codes:
        c = c.astype(np.int64)
        folded += [pad, np.where(c < 3_000, c + 2, 3_002 + c % 1_000)]
    return np.concatenate(folded) if folded else np.zeros(0, dtype=np.int64), np.array([len(c) for c in codes], dtype=np.int64)


def grams(texts: list[str | None], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character, text after text, and the number of characters of each text."""
    flat, counts = symbols(texts, order)
    if not counts.sum():
        return np.zeros(0, dtype=np.int64), counts
    keys = flat[:len(flat) - order + 1].copy()
    for k in range(1, order):
        keys = keys << _WIDTH | flat[k:len(flat) - order + 1 + k]
    # Windows that begin in one text and end in the next are left out.
    starts = np.cumsum(counts + order - 1) - (counts + order - 1)
    inside = np.zeros(len(keys) + order, dtype=np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + counts, -1)
    return keys[np.cumsum(inside)[:len(keys)] > 0], counts


def count_grams(texts: DataFrame, order: int = ORDER, folds: int = 0) -> DataFrame:
    """``(gram, n)`` over a frame of texts; partial counts of a task are summed before they move.

    With ``folds`` the frame's second column is the fold of a text, from 0 on; ``n_1`` and so on count the texts of all
    folds but one.
    """
    parts = max(1, folds)

    def work(batches):
        keys, counts, held = [], [], 0

        def summed():
            codes, found = pd.factorize(np.concatenate(keys))
            whole = np.concatenate(counts)
            return found, np.stack([np.bincount(codes, weights=whole[:, f], minlength=len(found)) for f in range(parts)], axis=1).astype(np.int32)

        def batch_of(found, sums):
            return pa.RecordBatch.from_arrays(
                [pa.array(found), *[pa.array(sums[:, f].astype(np.int64)) for f in range(parts)]],
                names=["gram", *[f"f{f}" for f in range(parts)]])

        for batch in batches:
            fold = batch.column(1).to_numpy() if folds else np.zeros(batch.num_rows, dtype=np.int64)
            for a, b in _cut(pc.utf8_length(batch.column(0)).fill_null(0).to_numpy(), SLICE):
                ends, sizes = grams(batch.column(0)[a:b].to_pylist(), order)
                codes, found = pd.factorize(ends)
                here = np.bincount(codes * parts + np.repeat(fold[a:b], sizes), minlength=len(found) * parts)
                keys.append(found)
                counts.append(here.reshape(-1, parts).astype(np.int32))
                held += len(found)
                if held > HELD_GRAMS:
                    found, sums = summed()
                    if len(found) > HELD_GRAMS // 2:
                        yield batch_of(found, sums)
                        keys, counts, held = [], [], 0
                    else:
                        keys, counts, held = [found], [sums], len(found)
        if held:
            yield batch_of(*summed())

    own = [f"f{f}" for f in range(parts)]
    rows = spread(texts).mapInArrow(work, ", ".join(["gram long", *[f"{c} long" for c in own]]))
    rows = rows.groupBy("gram").agg(*[F.sum(c).alias(c) for c in own])
    total = sum((F.col(c) for c in own[1:]), F.col(own[0]))
    return rows.select("gram", total.alias("n"), *[(total - F.col(c)).alias(f"n_{f + 1}") for f, c in enumerate(own[:folds])])


def _discounts(counts: DataFrame, columns: list[str]) -> list[tuple[float, float, float]]:
    """What is taken from counts of one, two, and three or more, by the counts of counts (four numbers a column)."""
    n = counts.agg(*[F.sum((F.col(c) == k).cast("long")) for c in columns for k in (1, 2, 3, 4)]).first()
    out = []
    for i in range(len(columns)):
        n1, n2, n3, n4 = (float(x or 0) for x in n[4 * i:4 * i + 4])
        if not n1 or not n2:
            out.append((0.5, 0.75, 0.9))  # too little text for an estimate
            continue
        y = n1 / (n1 + 2 * n2)
        found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
        out.append(tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(found)))
    return out


def train(trusted: DataFrame, order: int = ORDER, folds: int = 0) -> DataFrame:
    """The stored model ``(gram, logp, weight)`` of a frame of texts.

    ``logp`` is the natural logarithm of the interpolated probability of the n-gram's last symbol after the others (nan
    if it was seen as a context only),
    ``weight`` that of the share which the n-gram, as a context, leaves to shorter contexts (0 if never one).
    With ``folds`` the frame's second column is the fold of a text; ``logp_1``, ``weight_1`` and so on are those of
    the models that were not shown the first fold and so on (see ``without_fold``).
    """
    ends = ["", *[f"_{f + 1}" for f in range(folds)]]

    def each(make):
        return [make(e) for e in ends]

    counts = {order: materialize(count_grams(trusted, order, folds), "grams")}
    for k in range(order - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND((1 << _WIDTH * k) - 1)
        counts[k] = materialize(counts[k + 1].groupBy(shorter.alias("gram")).agg(
            *each(lambda e: F.sum((F.col(f"n{e}") > 0).cast("long")).alias(f"n{e}"))), "continuations")
    below, model = None, None
    for k in range(1, order + 1):
        discounts = dict(zip(ends, _discounts(counts[k], each(lambda e: f"n{e}")), strict=True))

        def taken(e, discounts=discounts):
            n, (d1, d2, d3) = F.col(f"n{e}"), discounts[e]
            return F.when(n == 0, 0.0).when(n == 1, d1).when(n == 2, d2).otherwise(d3)

        context = F.shiftright("gram", _WIDTH).alias("context")
        totals = counts[k].groupBy(context).agg(*each(lambda e: F.sum(f"n{e}").alias(f"total{e}")),
                                                *each(lambda e: F.sum(taken(e)).alias(f"taken{e}")))
        totals = totals.select("context", *each(lambda e: F.col(f"total{e}")), *each(
            lambda e: F.try_divide(f"taken{e}", F.col(f"total{e}")).alias(f"left{e}")))
        weights = totals.select(F.col("context").alias("gram"), *each(lambda e: F.log(f"left{e}").alias(f"weight{e}")))
        if k > 1:  # what was an end may be a context now
            # Contexts of start symbols alone are never an end.
            weighed = below.join(weights, "gram", "full").select(
                "gram", *each(lambda e: F.coalesce(F.log(f"p{e}"), F.lit(float("nan"))).cast("float").alias(f"logp{e}")),
                *each(lambda e: F.coalesce(f"weight{e}", F.lit(0.0)).cast("float").alias(f"weight{e}")))
            model = model.union(weighed)
        own = counts[k].withColumn("context", F.shiftright("gram", _WIDTH)).join(totals, "context")
        # Null where the n-gram was not seen.
        own = own.withColumns({f"own{e}": F.when(F.col(f"n{e}") > 0, F.greatest(
            F.col(f"n{e}") - taken(e), F.lit(0.0)) / F.col(f"total{e}")) for e in ends})
        if k == 1:
            current = own.select("gram", *each(lambda e: (F.col(f"own{e}") + F.col(f"left{e}") / 4096.0).alias(f"p{e}")))
        else:
            shorter = F.col("gram").bitwiseAND((1 << _WIDTH * (k - 1)) - 1)
            current = own.withColumn("shorter", shorter).join(below.select(
                F.col("gram").alias("shorter"), *each(lambda e: F.col(f"p{e}").alias(f"q{e}"))), "shorter")
            current = current.select("gram", *each(
                lambda e: (F.col(f"own{e}") + F.col(f"left{e}") * F.col(f"q{e}")).alias(f"p{e}")))
        below = materialize(current, "probabilities")
        if k == 1:  # the weight of the empty context, under the key 0
            model = weights.select(
                F.lit(0).cast("long").alias("gram"), *each(lambda e: F.lit(0.0).cast("float").alias(f"logp{e}")),
                *each(lambda e: F.coalesce(f"weight{e}", F.lit(0.0)).cast("float").alias(f"weight{e}")))
    top = below.select("gram", *each(lambda e: F.coalesce(F.log(f"p{e}"), F.lit(float("nan"))).cast("float").alias(f"logp{e}")),
                       *each(lambda e: F.lit(0.0).cast("float").alias(f"weight{e}")))
    return materialize(model.union(top), "model")


def without_fold(model: DataFrame, fold: int) -> DataFrame:
    """The model ``(gram, logp, weight)`` that was not shown texts of a fold, counted from 0 on."""
    rows = model.select("gram", F.col(f"logp_{fold + 1}").alias("logp"), F.col(f"weight_{fold + 1}").alias("weight"))
    return rows.filter("gram = 0 or not isnan(logp) or weight <> 0")


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(keys.view(np.uint64)) % np.uint64(shards)).astype(np.int32)


def _read_block(payload: bytes) -> pa.Table:
    with pa.ipc.open_stream(payload) as stream:
        return stream.read_all()


def _closure(levels: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of all orders that scoring n-grams of the highest order can ask for, and of that order.

    No symbol is 0, so n-grams of more symbols are larger numbers, and the orders one after another are sorted.
    """
    top = np.sort(pd.unique(np.concatenate([np.zeros(0, dtype=np.int64), *levels])))
    level, every = top, [top]
    for k in range(order - 1, 0, -1):
        context = level >> _WIDTH  # sorted, as the level is
        context = context[np.diff(context, prepend=-1) != 0]
        level = np.sort(pd.unique(np.concatenate([level & ((1 << _WIDTH * k) - 1), context])))  # as an end and as a context
        every.append(level)
    return np.concatenate(every[::-1]), top


def _log_probabilities(level: np.ndarray, keys: np.ndarray, logp: np.ndarray, weight: np.ndarray, base: float,
                       order: int) -> np.ndarray:
    """Of n-grams of the highest order: backs off from unseen ones to shorter ones. ``logp`` is nan where unseen."""
    out = np.full(len(level), np.nan)
    passed = np.zeros(len(level))
    for k in range(order, 0, -1):
        gram = level & ((1 << _WIDTH * k) - 1)
        here = np.isnan(out)
        at = np.searchsorted(keys, gram[here])
        seen = logp[at]
        out[here] = passed[here] + seen
        if k > 1:
            context = np.searchsorted(keys, gram >> _WIDTH)
            passed += np.where(np.isnan(out), np.nan_to_num(weight[context]), 0.0)
    here = np.isnan(out)
    out[here] = passed[here] + base - np.log(4096.0)
    return out


def _cut(lengths: np.ndarray, most: int = SLICE_CHARS):
    """Ranges of positions whose lengths add up to ``most`` at most, one position at least."""
    start = total = 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if len(lengths) > start:
        yield start, len(lengths)


def score(docs: DataFrame, model: DataFrame, order: int = ORDER, text: str = "text", keep_text: bool = True,
          fold: str | None = None) -> DataFrame:
    """``docs`` with ``n_scored`` (characters) and ``log_perplexity`` (per character, null without characters).

    The text is left out of the result where it is not needed any more. With ``fold``, a column of whole numbers, every
    document is scored by the model that was not shown its fold (see ``train``), all of them in one run: a block holds
    documents of one fold, and its messages name it.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("n_scored", "log_perplexity")]
    rows = spread(docs.select(*[F.col(f"`{c}`") for c in kept]))
    place, given = kept.index(text), [c for c in kept if keep_text or c != text]
    sort = kept.index(fold) if fold else None
    ends = [f"_{f + 1}" for f in range(FOLDS)] if fold else [""]
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def pack(batches):
        held, chars = [[] for _ in ends], [0] * len(ends)
        number, task = 0, TaskContext.get().partitionId()

        def block(f):
            nonlocal number
            parts, held[f], chars[f], number = held[f], [], 0, number + 1
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
                for part in parts:
                    out.write_batch(part)
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | number], pa.int64()), pa.array([f], pa.int32()),
                 pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "fold", "payload"])

        for batch in batches:
            folds = np.asarray(batch.column(sort)) if fold else np.zeros(batch.num_rows, dtype=np.int64)
            for f in np.unique(folds):
                own = batch.filter(pa.array(folds == f)) if fold else batch
                lengths = pc.utf8_length(own.column(place)).fill_null(0).to_numpy()
                for a, b in _cut(lengths):
                    held[f].append(own.slice(a, b - a))
                    chars[f] += int(lengths[a:b].sum())
                    if chars[f] >= BLOCK_CHARS:
                        yield block(f)
        for f in range(len(ends)):
            if held[f]:
                yield block(f)

    name = f"blocks_{uuid.uuid4().hex}"
    rows.mapInArrow(pack, "block long, fold int, payload binary").write.bucketBy(buckets, "block").format("parquet").option(
        "path", fresh_path(spark, "blocks")).saveAsTable(name)
    blocks = spark.table(name)
    n_blocks = blocks.count()
    spark.sql(f"drop table {name}")  # the name only; the bucketed files lie at their own path
    entries = model.count()
    base_row = model.filter("gram = 0").select(*[f"weight{e}" for e in ends]).first()
    base = list(base_row) if base_row else [0.0] * len(ends)
    shards = max(1, -(-entries // SHARD_ENTRIES), min(buckets, 64))
    salts = max(1, -(-n_blocks // MESSAGES_PER_PART))

    def ask(batches):
        for batch in batches:
            for block, f, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                pa.default_memory_pool().release_unused()  # what the block before left
                texts = _read_block(payload.as_buffer()).column(place)
                bounds = _cut(pc.utf8_length(texts).fill_null(0).to_numpy(), SLICE)
                keys, _ = _closure([pd.unique(grams(texts[a:b].to_pylist(), order)[0]) for a, b in bounds], order)
                shard = _shard_of(keys, shards)
                turn = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
                keys, ends = keys[turn], np.cumsum(np.bincount(shard, minlength=shards))
                for s in range(shards):
                    part = keys[(ends[s - 1] if s else 0):ends[s]]
                    if len(part):
                        gaps = np.diff(part, prepend=0)
                        message = pa.compress(gaps.tobytes(), codec="zstd", asbytes=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([s], pa.int32()), pa.array([block % salts], pa.int32()), pa.array([1 + f], pa.int32()),
                             pa.array([block], pa.int64()), pa.array([len(part)], pa.int64()),
                             pa.array([message], pa.binary())],
                            names=["shard", "salt", "role", "block", "n", "message"])

    wire = "shard int, salt int, role int, block long, n long, message binary"

    def offer(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            values = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1).astype(np.float32)
            shard = _shard_of(keys, shards)
            for s in np.unique(shard):
                own = shard == s
                message = keys[own].tobytes() + values[own].tobytes()
                for salt in range(salts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s], pa.int32()), pa.array([salt], pa.int32()), pa.array([0], pa.int32()),
                         pa.array([0], pa.int64()), pa.array([int(own.sum())], pa.int64()), pa.array([message], pa.binary())],
                        names=["shard", "salt", "role", "block", "n", "message"])

    def answer(batches):
        unit, keys, values, pending = None, None, None, []

        def settle():
            k = np.concatenate([p[0] for p in pending]) if pending else np.zeros(0, dtype=np.int64)
            v = np.concatenate([p[1] for p in pending]) if pending else np.zeros((0, 2 * len(ends)), dtype=np.float32)
            turn = np.argsort(k)
            return k[turn], v[turn]

        for batch in batches:
            for s, salt, role, block, n, message in zip(
                    *[batch.column(i).to_pylist() for i in range(5)], batch.column(5), strict=True):
                if (s, salt) != unit:
                    unit, keys, pending = (s, salt), None, []
                body = message.as_buffer()
                if role == 0:
                    raw = body.to_pybytes()
                    pending.append((np.frombuffer(raw[:8 * n], dtype=np.int64),
                                    np.frombuffer(raw[8 * n:], dtype=np.float32).reshape(n, -1)))
                    continue
                if keys is None:
                    keys, values = settle()
                    pending = []
                wanted = np.cumsum(np.frombuffer(pa.decompress(body, 8 * n, codec="zstd"), dtype=np.int64))
                out = np.full((n, 2), np.nan, dtype=np.float32)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                    hit = keys[at] == wanted
                    out[hit] = values[at[hit], 2 * (role - 1):2 * role]
                reply = pa.compress(out.astype(np.float16).T.tobytes(), codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([s], pa.int32()), pa.array([n], pa.int64()),
                     pa.array([reply], pa.binary())], names=["block", "shard", "n", "reply"])

    asked = blocks.mapInArrow(ask, wire)
    pairs = [f"{c}{e}" for e in ends for c in ("logp", "weight")]
    offered = model.filter("gram <> 0").select("gram", *pairs).mapInArrow(offer, wire)
    met = offered.union(asked).repartition(buckets, "shard", "salt").sortWithinPartitions("shard", "salt", "role")
    replies = met.mapInArrow(answer, "block long, shard int, n long, reply binary").groupBy("block").agg(
        F.collect_list(F.struct("shard", "n", "reply")).alias("replies"))
    joined = blocks.join(replies.hint("shuffle_hash"), "block", "left").select("fold", "payload", "replies")
    schema = T.StructType([
        *[f for f in rows.schema.fields if f.name in given], T.StructField("n_scored", T.LongType()), T.StructField("log_perplexity", T.DoubleType())])

    def judge(batches):
        for batch in batches:
            for f, payload, replies in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                pa.default_memory_pool().release_unused()
                stored = _read_block(payload.as_buffer())
                texts, coded = stored.column(place), []
                for a, b in _cut(pc.utf8_length(texts).fill_null(0).to_numpy(), SLICE):
                    found, counts = grams(texts[a:b].to_pylist(), order)
                    codes, level = pd.factorize(found)
                    coded.append((a, b, counts, codes.astype(np.int32), level))
                keys, top = _closure([c[4] for c in coded], order)
                shard = _shard_of(keys, shards)
                logp, weight = np.full(len(keys), np.nan, dtype=np.float32), np.full(len(keys), np.nan, dtype=np.float32)
                for reply in (replies if replies.is_valid else []):
                    n = reply["n"].as_py()
                    out = np.frombuffer(pa.decompress(reply["reply"].as_buffer(), 4 * n, codec="zstd"), dtype=np.float16)
                    own = np.flatnonzero(shard == reply["shard"].as_py())
                    logp[own], weight[own] = out[:n], out[n:]
                value = _log_probabilities(top, keys, logp, weight, base[f], order)
                for a, b, counts, codes, level in coded:
                    own = value[np.searchsorted(top, level)]
                    total = np.bincount(np.repeat(np.arange(b - a), counts), weights=own[codes], minlength=b - a)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        mean = -total / counts
                    for part in stored.slice(a, b - a).select(given).combine_chunks().to_batches():
                        yield pa.RecordBatch.from_arrays(
                            [*part.columns, pa.array(counts), pa.array(mean, mask=counts == 0)],
                            names=[*given, "n_scored", "log_perplexity"])

    return joined.mapInArrow(judge, schema)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled of good quality and not toxic."""
    return labels.filter("quality = 1 and toxic = 0").select("doc_id").distinct()


def classify(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantiles: tuple[float, float] = QUANTILES,
             margin: float = MARGIN, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_scored``, ``log_perplexity``, ``perplexity``, ``perplexity_limit`` and ``kept``.

    ``labels`` names the trusted documents by ``doc_id``, ``quality`` and ``toxic``. Their ids are broadcast up to
    ``BROADCAST_IDS``, beyond that joined by a shuffle.
    """
    made = ["_trusted", "n_scored", "log_perplexity", "perplexity", "perplexity_limit", "kept"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made])
    ids = materialize(trusted_ids(labels).select(F.col("doc_id").alias("_id")), "trusted")
    marked = docs.join(small(ids, BROADCAST_IDS), F.col(f"`{doc_id}`") == F.col("_id"), "left").withColumn(
        "_trusted", F.col("_id").isNotNull()).drop("_id")
    language = F.col(f"`{lang}`")
    good = marked.filter("_trusted").select(F.col(f"`{text}`").alias("text"), language.alias("_lang"), F.pmod(
        F.xxhash64(F.col(f"`{text}`")), F.lit(FOLDS)).cast("long").alias("_fold"))
    model = train(good.select("text", "_fold"), order, FOLDS)
    scored = materialize(score(marked.drop("_trusted"), model.select("gram", "logp", "weight"), order, text, keep_text), "scored")
    # Trusted documents as strangers: each is scored by the model without its fold.
    unseen = score(good, model, order, keep_text=False, fold="_fold")
    unseen = materialize(unseen.filter("log_perplexity is not null").select("_lang", "n_scored", "log_perplexity"), "unseen")
    limits, upper, distance = _limits(unseen, quantiles)
    judged = scored.join(small(limits, BROADCAST_LANGUAGES), language.eqNullSafe(F.col("_lang")), "left")
    room = F.lit(margin) * (1 + F.sqrt(F.lit(float(LENGTH)) / F.greatest("n_scored", F.lit(1))))
    bound = F.coalesce("_upper", F.lit(upper)) + room * F.coalesce("_spread", F.lit(distance))
    judged = judged.withColumns({"perplexity": F.exp("log_perplexity"), "perplexity_limit": F.exp(bound)})
    judged = judged.withColumn("kept", F.coalesce(F.col("log_perplexity") <= bound, F.lit(False)))
    return judged.drop("_upper", "_spread", "_lang")


def _limits(unseen: DataFrame, quantiles: tuple[float, float]) -> tuple[DataFrame, float, float]:
    """Stored ``_lang``, ``_upper`` and ``_spread`` of every language, and both over all of them."""

    def quantile(column, q):
        return F.percentile_approx(column, q, 10_000)

    middle, upper = quantiles
    own = materialize(unseen.groupBy("_lang").agg(
        F.count(F.lit(1)).alias("_n"), quantile("log_perplexity", middle).alias("_middle"),
        quantile("log_perplexity", upper).alias("_upper")), "languages")
    over = F.col("log_perplexity") - F.col("_middle")
    around = unseen.withColumnRenamed("_lang", "_of").join(
        small(own, BROADCAST_LANGUAGES), F.col("_of").eqNullSafe(F.col("_lang")))
    pooled, overall, centre = around.agg(
        quantile(over, upper), quantile("log_perplexity", upper), quantile("log_perplexity", middle)).first()
    if pooled is None:
        return own.select("_lang", "_upper", F.lit(0.0).alias("_spread")), float("inf"), 0.0
    spread_ = (F.col("_n") * (F.col("_upper") - F.col("_middle")) + MIN_TRUSTED * pooled) / (F.col("_n") + MIN_TRUSTED)
    limits = own.select("_lang", (F.col("_middle") + spread_).alias("_upper"), spread_.alias("_spread"))
    return materialize(limits, "limits"), overall, overall - centre


@query()
def op4_quality_classifier(spark, folder):
    """Perplexity, limit and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return classify(docs, table(spark, folder, "labels"), keep_text=False).select(
        "doc_id", "lang", "n_scored", "perplexity", "perplexity_limit", "kept")
