"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits.

The shingles of a text are hashed once. The upper bits of a hash choose one of ``BINS`` bins, the smallest rest of
each bin is kept. An empty bin takes over the value of the bin that its own sequence of random bins meets first among
the filled ones; the sequence depends on the bin only, so equal sets stay equal. Of each value ``BITS`` low-order
bits are stored. Unequal values agree in them with probability ``2 ** -BITS``, which the likeness corrects.

Defined results: a null text counts as empty; a text without words has the empty fingerprint, whose likeness is 1 to
another empty one and 0 to any other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.llm.registry import query, table
from fathomline.llm.shingles import WORDS_PER_SHINGLE, mixed, shingle_hashes
from fathomline.llm.texts import slices
from fathomline.session import materialize, spread

BINS = 512
BITS = 4
RANGE_CHARS = 64  # of a text that take part in cutting ranges
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _densify(bins: np.ndarray) -> None:
    """Fill the empty bins of each row from filled ones; rows without any filled bin are not allowed."""
    count = bins.shape[1]
    filled = bins != _EMPTY
    row, col = np.nonzero(~filled)
    attempt = 0
    while len(row):
        if attempt < 64 * count:
            probe = mixed(col.astype(np.uint64) * _GOLD + np.uint64(attempt + 1))
            donor = (probe % np.uint64(count)).astype(np.int64)
        else:  # a step to the right ends for certain
            donor = (col + attempt - 64 * count + 1) % count
        good = filled[row, donor]
        bins[row[good], col[good]] = bins[row[good], donor[good]]
        row, col = row[~good], col[~good]
        attempt += 1


def fingerprint_texts(texts: list[str | None], n: int = WORDS_PER_SHINGLE, bins: int = BINS,
                      bits: int = BITS) -> list[bytes]:
    """The packed fingerprint of each text. ``bins * bits`` is a multiple of 8, ``bits`` 1, 2, 4 or 8."""
    hashes, starts = shingle_hashes(texts, n)
    counts = np.diff(starts)
    full = np.flatnonzero(counts)
    out = [b""] * len(texts)
    shift = np.uint64(64 - int(np.log2(bins)))
    if bins & (bins - 1) or bits not in (1, 2, 4, 8):
        raise ValueError("bins must be a power of two, bits 1, 2, 4 or 8")
    for at in range(0, len(full), 2_000):  # bounds the table, however short the texts are
        rows = full[at:at + 2_000]
        own = hashes[starts[rows[0]]:starts[rows[-1] + 1]]
        row = np.repeat(np.arange(len(rows)), counts[rows])
        least = np.full((len(rows), bins), _EMPTY, dtype=np.uint64)
        place = row * bins + (own >> shift).astype(np.int64)
        np.minimum.at(least.ravel(), place, mixed(own) >> np.uint64(1))
        _densify(least)
        # Bins that share a taken-over value draw their bits from it each in its own way.
        low = (mixed(least + np.arange(bins, dtype=np.uint64) * _GOLD) & np.uint64((1 << bits) - 1)).astype(np.uint8)
        packed = np.zeros((len(rows), bins * bits // 8), dtype=np.uint8)
        for k in range(8 // bits):
            packed |= low[:, k::8 // bits] << np.uint8(k * bits)
        for i, r in enumerate(rows):
            out[r] = packed[i].tobytes()
    return out


def likeness(left: list[bytes], right: list[bytes], bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity of pairs of fingerprints, corrected for chance agreement of low-order bits."""
    out = np.array([1.0 if not a and not b else 0.0 for a, b in zip(left, right, strict=True)])
    both = [i for i, (a, b) in enumerate(zip(left, right, strict=True)) if a and b]
    if both:
        a = np.frombuffer(b"".join([left[i] for i in both]), dtype=np.uint8).reshape(len(both), -1)
        b = np.frombuffer(b"".join([right[i] for i in both]), dtype=np.uint8).reshape(len(both), -1)
        differ, agree = a ^ b, np.zeros(len(both))
        for k in range(8 // bits):
            agree += ((differ >> np.uint8(k * bits)) & np.uint8((1 << bits) - 1) == 0).mean(axis=1)
        chance = 2.0 ** -bits
        out[both] = np.clip((agree / (8 // bits) - chance) / (1 - chance), 0.0, 1.0)
    return out


def with_fingerprints(docs: DataFrame, text: str = "text", n: int = WORDS_PER_SHINGLE) -> DataFrame:
    """``docs`` with the binary column ``fingerprint``; nothing is shuffled. A column of that name is replaced."""
    kept = [c for c in docs.columns if c != "fingerprint"]
    rows = spread(docs.select(*[F.col(f"`{c}`") for c in kept]))

    def work(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(kept.index(text)).to_pylist()]
            for a, b in slices(texts):
                prints = pa.array(fingerprint_texts(texts[a:b], n), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, prints], names=[*kept, "fingerprint"])

    return rows.mapInArrow(work, T.StructType([*rows.schema.fields, T.StructField("fingerprint", T.BinaryType())]))


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
           "near_edited double, near_next double, part int, kind string, text string")


def _rows(ids, texts, following, n):
    """Result columns of texts and the texts that follow them."""
    edited = []
    for t, after in zip(texts, following, strict=True):
        cut = len(t) // 4
        edited.append(t[:len(t) - cut] + after[:cut])
    own, changed = fingerprint_texts(texts, n), fingerprint_texts(edited, n)
    later = [*own[1:], fingerprint_texts(following[-1:], n)[0]] if texts[1:] == following[:-1] else fingerprint_texts(following, n)
    return [
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
        pa.array(own, pa.binary()), pa.array(changed, pa.binary()),
        pa.array(likeness(own, changed)), pa.array(likeness(own, later)),
    ]


def compare_with_next(docs: DataFrame, n: int = WORDS_PER_SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and likenesses to the edited and to the next text.

    The edited text has its last quarter replaced by the beginning of the next document's. Next is the following
    row by id, nulls last, equal ids by text; after the last row comes the first.

    The rows are range-sorted by id. A task walks its range with one text in hand; only the first and the last row
    of every range, which need a neighbour from another, go on to a second step of two rows per range.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first()]
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # The ranges' keys are sampled, so of a text only its beginning takes part; it parts rows of one id.
    beginning = F.substring("text", 1, RANGE_CHARS).asc_nulls_first()
    rows = rows.repartitionByRange(parts, order[0], beginning).sortWithinPartitions(*order)

    def work(batches):
        part = TaskContext.get().partitionId()
        ids, texts, first = [], [], True

        def made(columns, kind, whole):
            size = len(columns[0])
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([part] * size, pa.int32()), pa.array([kind] * size),
                 pa.array(whole or [None] * size, pa.string())],
                names=[c.split()[0] for c in _SCHEMA.split(", ")])

        def edge(i, t, kind):
            return made([pa.array([i], pa.int64()), *[pa.nulls(1, k) for k in (
                pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]], kind, [t])

        for batch in batches:
            new_ids, new_texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(new_texts):
                ids, texts = ids + new_ids[a:b], texts + new_texts[a:b]
                if first and ids:
                    yield edge(ids[0], texts[0], "head")
                    first = False
                if len(ids) > 1:
                    yield made(_rows(ids[:-1], texts[:-1], texts[1:], n), "done", None)
                    ids, texts = ids[-1:], texts[-1:]
        if ids:
            yield edge(ids[0], texts[0], "last")

    walked = materialize(rows.mapInArrow(work, _SCHEMA), "fingerprints")
    edges = walked.filter("kind <> 'done'").select("doc_id", "part", "kind", "text")
    # Which range comes next is a matter of their numbers; a range's texts then meet by a join.
    in_turn = Window.orderBy("part")
    turns = edges.filter("kind = 'head'").select("part")
    turns = turns.select("part", F.coalesce(F.lead("part").over(in_turn), F.min("part").over(Window.partitionBy())).alias("next"))
    heads = edges.filter("kind = 'head'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    pairs = edges.filter("kind = 'last'").join(turns, "part").join(heads.hint("merge"), "next").select("doc_id", "text", "following")

    def finish(batches):
        for batch in batches:
            ids, texts, after = (batch.column(k).to_pylist() for k in range(3))
            for k in range(len(ids)):
                yield pa.RecordBatch.from_arrays(
                    _rows(ids[k:k + 1], texts[k:k + 1], after[k:k + 1], n),
                    names=[c.split()[0] for c in _SCHEMA.split(", ")[:7]])

    columns = [c.split()[0] for c in _SCHEMA.split(", ")[:7]]
    ends = pairs.repartition(parts, "doc_id").mapInArrow(finish, ", ".join(_SCHEMA.split(", ")[:7]))
    return walked.filter("kind = 'done'").select(*columns).unionByName(ends)


@query()
def op9_fingerprints(spark, folder):
    """Fingerprints of every document and of its edited text, as hexadecimal strings, with likenesses."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return compare_with_next(docs).select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")
