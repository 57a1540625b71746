"""Jaccard join of documents on word shingles: banded MinHash finds pairs, full shingle sets decide.

1. Documents with the same shingle set form one class, known by a 128-bit digest of the set. Only one
   representative of a class goes on, so copies cost nothing further.
2. Bands and rows are chosen so that a pair at the threshold shares a band with the wanted probability, with as
   many rows per band as the number of hashes allows. Band hashes are shuffled; a representative is tied to
   the smallest one of each of its buckets. That is one edge per row, whatever the bucket's size.
3. The tied-together representatives are compared in one task, pair by pair where two share a band, on their full
   sets. A component of many representatives or characters is cut into blocks, and every pair of blocks is a task
   of its own: no group is ever held whole, no pair is emitted. A task returns, per representative, how many it
   is linked to and the smallest one reached by links.
4. Links join representatives to near-duplicate classes.

Time is spent on pairs of one component that share a band, which is the work of an exact answer for a group of
near copies; memory is bounded by two blocks. A pair at the threshold is missed with probability
``1 - recall``, more similar pairs are missed more rarely; pairs of equal sets are never missed.

Defined results: null and wordless texts have the empty set and are one class. Repeated rows and repeated ids count
as documents of their own; ids may be null. All columns of the input may have any name.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.components import components
from fathomline.llm.registry import query, table
from fathomline.llm.shingles import WORDS_PER_SHINGLE, mixed, shingle_sets
from fathomline.llm.texts import packed, slices
from fathomline.session import materialize, spread

THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 192
BLOCK_DOCS = 2_000
BLOCK_CHARS = 8_000_000


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most rows with which ``max_hashes`` still reach the recall at the threshold."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold ** rows)))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per set and band; equal in a band only if all its minima are (or by chance)."""
    out = np.zeros((len(sets), bands), dtype=np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out.view(np.int64)
    flat = np.concatenate([sets[i] for i in full])
    starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])])[:-1]
    seeds = mixed(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for band in range(bands):
        key = np.full(len(full), band + 1, dtype=np.uint64)
        for row in range(rows):
            seed = seeds[band * rows + row]
            least = np.minimum.reduceat((flat ^ seed) * (seed | np.uint64(1)), starts)
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + least)
        out[full, band] = key
    return out.view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, bands: int, rows: int, n: int = WORDS_PER_SHINGLE) -> DataFrame:
    """``digest`` of the shingle set, ``bands`` and ``chars`` of rows with columns ``doc_id``, ``k1``, ``k2``, ``text``."""

    def work(batches):
        for batch in batches:
            texts = batch.column(3).to_pylist()
            for a, b in slices([t or "" for t in texts]):
                sets = shingle_sets(texts[a:b], n)
                keys = band_hashes(sets, bands, rows)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(2), pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, keys.size + 1, bands), pa.int32()), pa.array(keys.ravel())),
                    pa.array([len(t or "") for t in texts[a:b]], pa.int64()),
                    pa.array([len(s) > 0 for s in sets]),
                ], names=["doc_id", "k1", "k2", "digest", "bands", "chars", "filled"])

    return spread(docs).mapInArrow(
        work, "doc_id long, k1 long, k2 long, digest binary, bands array<long>, chars long, filled boolean")


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``k1``, ``k2`` (together a hash of id and text) and ``text``."""
    pair = [F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")]
    return docs.select(
        pair[0].alias("doc_id"), F.xxhash64(F.lit(1), *pair).alias("k1"), F.xxhash64(F.lit(2), *pair).alias("k2"),
        pair[1].alias("text"))


def _link(sets, bands, copies, sides, threshold):
    """Linked documents and texts of each member, and the smallest member of its links' component, all in one unit.

    ``sides`` is None when all members are compared with each other, else only members of side 0 with side 1.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flags = np.zeros(int(ids.max()) + 1 if len(ids) else 0, dtype=np.int32)
    docs, texts = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    parent = np.arange(n)

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    lefts = range(n) if sides is None else np.flatnonzero(sides == 0)
    rights = None if sides is None else np.flatnonzero(sides == 1)
    for i in lefts:
        others = np.arange(i + 1, n) if rights is None else rights
        others = others[(sizes[others] >= threshold * sizes[i] - 1e-9) & (sizes[i] >= threshold * sizes[others] - 1e-9)]
        others = others[(bands[others] == bands[i]).any(axis=1)]
        if not len(others):
            continue
        mine = ids[starts[i]:starts[i + 1]]
        flags[mine] = 1
        # Shared shingles of all candidates in one gather.
        lengths = sizes[others]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(starts[others] - (ends - lengths), lengths)
        shared = np.add.reduceat(flags[ids[at]], ends - lengths)
        flags[mine] = 0
        near = others[shared >= threshold * (sizes[i] + lengths - shared) - 1e-9]
        docs[i] += copies[near].sum()
        texts[i] += len(near)
        docs[near] += copies[i]
        texts[near] += 1
        for j in near:
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return docs, texts, np.array([find(x) for x in range(n)])


def _compare(batches, threshold: float, n: int):
    """Groups of rows with one ``unit``, which follow each other, to one row per member."""
    held: list[tuple] = []
    unit = None

    def done():
        seen: dict[bytes, int] = {}
        members = []
        for digest, side, copies, bands, shingles in held:
            if digest not in seen:
                seen[digest] = len(members)
                members.append((digest, side, copies, bands, shingles))
        members.sort(key=lambda m: m[0])
        sides = np.array([m[1] for m in members])
        docs, texts, roots = _link(
            [m[4] for m in members], np.array([m[3] for m in members]), np.array([m[2] for m in members]),
            None if (sides == -1).all() else sides, threshold)
        return pd.DataFrame({
            "digest": [m[0] for m in members], "docs": docs, "texts": texts, "root": [members[r][0] for r in roots]})

    out, waiting = [], 0
    for batch in batches:
        frame = batch.to_pandas()
        for a, b in slices([t or "" for t in frame["text"]]):
            part = frame.iloc[a:b]
            sets = shingle_sets(part["text"].tolist(), n)
            for u, side, copies, digest, bands, shingles in zip(
                    part["unit"], part["side"], part["copies"], part["digest"], part["bands"], sets, strict=True):
                if u != unit and held:
                    out.append(done())
                    held, waiting = [], waiting + len(out[-1])
                    if waiting > 5_000:
                        yield pa.RecordBatch.from_pandas(pd.concat(out), preserve_index=False)
                        out, waiting = [], 0
                unit = u
                if _digest(shingles) == digest:
                    held.append((digest, side, copies, np.asarray(bands), shingles))
    if held:
        out.append(done())
    if out:
        yield pa.RecordBatch.from_pandas(pd.concat(out), preserve_index=False)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, n: int = WORDS_PER_SHINGLE,
                    max_hashes: int = MAX_HASHES, block_docs: int = BLOCK_DOCS, block_chars: int = BLOCK_CHARS,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``k1``, ``k2`` (see ``keyed``), ``class_id``, ``set_id``, ``n_links``,
    ``n_linked_texts`` and ``first``.

    ``class_id`` is the smallest id of the near-duplicate class, ``set_id`` that of the documents with the same
    shingle set. ``n_links`` counts the other documents that are as similar as ``threshold``, ``n_linked_texts``
    the different shingle sets among them. ``first`` holds for the key that stands for its class.
    """
    spark = docs.sparkSession
    n_bands, n_rows = choose_bands(threshold, recall, max_hashes)
    source = keyed(docs, doc_id, text)
    signed = materialize(signatures(source, n_bands, n_rows, n), "signatures")
    reps = materialize(
        signed.groupBy("digest").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")).alias("rep"),
            F.count(F.lit(1)).alias("copies"), F.min("bands").alias("bands"), F.min("chars").alias("chars"),
            F.min("filled").alias("filled"))
        .select("digest", "rep.doc_id", "rep.k1", "rep.k2", "copies", "bands", "chars", "filled"), "representatives")

    keys = reps.filter("filled").select("digest", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("digest").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    ties = keys.join(buckets.select("key", "least"), "key").select(F.col("digest").alias("a"), F.col("least").alias("b"))
    tied = materialize(components(ties), "tied")

    sized = tied.withColumnRenamed("node", "digest").join(
        reps.select("digest", "doc_id", "k1", "k2", "copies", "bands", "chars"), "digest")
    blocks = sized.groupBy("root").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / block_docs), F.ceil(F.sum("chars") / block_chars)).cast("int").alias("blocks"))
    split = sized.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    units = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.concat_ws(":", F.hex("root"), F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
        F.when(F.col("block") == F.col("other"), -1).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
        "digest", "k1", "k2", "copies", "bands")
    texts = source.select("k1", "k2", "text")
    todo = units.join(texts, ["k1", "k2"]).select("unit", "side", "copies", "digest", "bands", "text")
    todo = todo.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "unit").sortWithinPartitions("unit")
    found = materialize(
        todo.mapInArrow(lambda batches: _compare(batches, threshold, n),
                        "digest binary, docs long, texts long, root binary"), "links")

    roots = components(found.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("digest").agg(F.sum("docs").alias("docs"), F.sum("texts").alias("texts"))
    linked = counted.join(roots.withColumnRenamed("node", "digest"), "digest")
    sets = reps.select("digest", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2").alias("rep"),
                       "copies").join(linked, "digest", "left")
    sets = sets.withColumn("root", F.coalesce("root", "digest"))
    sets = materialize(sets, "sets")
    heads = sets.groupBy("root").agg(F.min("rep").alias("head"))
    classes = sets.join(heads, "root").select(
        "digest", F.col("head.doc_id").alias("class_id"), F.col("head.k1").alias("h1"), F.col("head.k2").alias("h2"),
        F.col("rep.doc_id").alias("set_id"), (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_linked_texts"))
    return signed.select("doc_id", "k1", "k2", "digest").join(classes, "digest").select(
        "doc_id", "k1", "k2", "class_id", "set_id", "n_links", "n_linked_texts",
        ((F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2"))).alias("first"))


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their near-duplicate class, one each.

    The smallest id stands for its class. Of several rows with the same id and text one stays.
    """
    firsts = near_duplicates(docs, doc_id=doc_id, text=text, **options).filter("first").select(
        F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    pair = [F.col("doc_id").cast("long"), F.col("text")]
    rows = packed(docs, doc_id=doc_id, text=text).select(
        "_row", F.xxhash64(F.lit(1), *pair).alias("_k1"), F.xxhash64(F.lit(2), *pair).alias("_k2"))
    return rows.join(firsts, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select("_row.*")


@query()
def op3_jaccard_join(spark, folder):
    """Near-duplicate class and number of links of every document."""
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "class_id", "set_id", "n_links", "n_linked_texts")
