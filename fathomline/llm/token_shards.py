"""Token ids in training order: binary shards of fixed stride, filled by a keyed permutation.

1. Texts are encoded and cut into sequences of ``length`` tokens; each task packs its documents one behind the
   other, each closed by the end token, and pads only its last sequence. The sequences are written once, compressed,
   with their number within the task; this table is what a restart goes on from.
2. Numbers of sequences per task, one row each, give every sequence a number from 0 to N - 1.
3. A Feistel network over the smallest even-bit domain that holds N, keyed and walked along its cycle until it lands
   below N, is a permutation of those numbers: the slot of a sequence in training order. No sort of the whole, no
   table of slots.
4. Sequences go to the task of their slot range, which writes whole shards of ``per_shard`` slots. Slot ``s`` starts
   at byte ``(s % per_shard) * length * 2`` of shard ``s // per_shard``, so training reads on from any slot. A shard is
   written under a name of its own attempt and then renamed, so a repeated task replaces it by the same bytes.
   A folder without a scheme lies in Spark's default file system, never on an executor's own disk.

Ids are unsigned 16-bit little-endian. Defined results: a null or empty text is its end token alone. Repeated rows and
ids are written one by one, null ids are listed as null. An empty table writes no shard and gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomline.llm.registry import query, table
from fathomline.llm.shingles import mixed
from fathomline.session import fresh_path, materialize, spread

LENGTH = 1024
PER_SHARD = 8_192  # 16 MB a shard
KEY = 0x5EED
ROUNDS = 6
BROADCAST_TASKS = 100_000


def _round_keys(key: int, rounds: int) -> np.ndarray:
    first = np.uint64(key * 0x9E3779B97F4A7C15 % 2**64)
    return mixed(first + np.arange(1, rounds + 1, dtype=np.uint64))


def feistel(numbers: np.ndarray, count: int, key: int = KEY, rounds: int = ROUNDS, back: bool = False) -> np.ndarray:
    """The permutation of ``0 .. count - 1`` at each number, or its inverse.

    Halves of equal width are swapped and mixed; a value outside the count walks on. The domain is below four times
    the count, so a walk takes four steps on average.
    """
    half = np.uint64(max(1, (max(count - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = _round_keys(key, rounds)
    value = np.asarray(numbers).astype(np.uint64)
    walking = np.arange(len(value))
    while len(walking):
        x = value[walking]
        left, right = x >> half, x & mask
        for k in (keys[::-1] if back else keys):
            if back:
                left, right = right ^ (mixed(left + k) & mask), left
            else:
                left, right = right, left ^ (mixed(right + k) & mask)
        value[walking] = left << half | right
        walking = walking[value[walking] >= np.uint64(count)]
    return value.astype(np.int64)


@lru_cache(maxsize=1)
def _encoding(path: str):
    import tiktoken

    pattern = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")  # fixed value
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), len(ranks)


def code_table(docs: DataFrame, vocabulary: str, text: str = "text", rows: int = 256) -> np.ndarray:
    """Short codes for ids that are frequent in some rows; only how well stored sequences compress depends on them."""
    def work(batches):
        encoding, _ = _encoding(vocabulary)
        counts = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                counts += np.bincount(encoding.encode_to_numpy(body or "", disallowed_special=()), minlength=1 << 16)
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], names=["counts"])

    found = docs.select(F.col(f"`{text}`")).limit(rows).mapInArrow(work, "counts binary").collect()
    counts = sum((np.frombuffer(r[0], dtype=np.int64) for r in found), np.zeros(1 << 16, dtype=np.int64))
    codes = np.empty(1 << 16, dtype=np.uint16)
    codes[np.argsort(-counts, kind="stable")] = np.arange(1 << 16)
    return codes


def sequences(docs: DataFrame, vocabulary: str, codes: np.ndarray, length: int = LENGTH, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """``task``, ``number`` (within the task), ``n_tokens`` (without padding), ``doc_ids`` and compressed ``tokens``.

    The end token has the first id after the vocabulary's; it also pads. ``tokens`` holds the upper, then the lower
    bytes of the codes.
    """
    rows = spread(docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")))

    def work(batches):
        encoding, end = _encoding(vocabulary)
        task, number = TaskContext.get().partitionId(), 0
        squeeze = zstandard.ZstdCompressor(level=3)
        held, owners, size = [], [], 0  # token arrays, their documents, tokens in all

        def packed(flush):
            nonlocal held, owners, size, number
            flat = np.concatenate(held) if held else np.zeros(0, dtype=np.uint16)
            ends = np.cumsum([len(h) for h in held])
            full = -(-len(flat) // length) if flush else len(flat) // length
            real = np.minimum(length, len(flat) - np.arange(full) * length)
            flat = np.concatenate([flat, np.full(max(0, full * length - len(flat)), end, dtype=np.uint16)])
            ids, payload = [], []
            for k in range(full):
                a, b = k * length, min((k + 1) * length, int(ends[-1]))
                first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(ends, b - 1, side="right")
                ids.append(owners[first:last + 1])
                part = codes[flat[a:a + length]]
                planes = (part >> np.uint16(8)).astype(np.uint8).tobytes() + part.astype(np.uint8).tobytes()
                payload.append(squeeze.compress(planes))
            done = full * length
            keep = [i for i in range(len(held)) if ends[i] > done]
            if keep:
                cut = len(held[keep[0]]) - (int(ends[keep[0]]) - done)
                held, owners = [held[i] for i in keep], [owners[i] for i in keep]
                held[0] = held[0][cut:]
            else:
                held, owners = [], []
            size = sum(len(h) for h in held)
            batch = pa.RecordBatch.from_arrays(
                [pa.array([task] * full, pa.int32()), pa.array(range(number, number + full), pa.int64()),
                 pa.array(real, pa.int32()), pa.array(ids, pa.list_(pa.int64())), pa.array(payload, pa.binary())],
                names=["task", "number", "n_tokens", "doc_ids", "tokens"])
            number += full
            return batch

        for batch in batches:
            for owner, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoding.encode_to_numpy(body or "", disallowed_special=())
                held.append(np.append(ids.astype(np.uint16), np.uint16(end)))
                owners.append(owner)
                size += len(held[-1])
                if size >= 512 * length:
                    yield packed(False)
        if held:
            yield packed(True)

    return rows.mapInArrow(work, "task int, number long, n_tokens int, doc_ids array<long>, tokens binary")


def resolved(spark: SparkSession, folder: str) -> str:
    """The URI of a folder in the file system that Spark takes it to lie in, which for a plain path is the default one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return path.makeQualified(system.getUri(), system.getWorkingDirectory()).toUri().toString()


def _publish(system: fs.FileSystem, name: str, target: str) -> None:
    """Rename an attempt's file to its shard. Where a rename doesn't replace, an earlier attempt's shard is deleted first."""
    try:
        system.move(name, target)
    except OSError:
        if system.get_file_info(target).type != fs.FileType.File:
            raise
        system.delete_file(target)
        system.move(name, target)


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by URI or, outside of Spark jobs, by a local path."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def write_shards(cut: DataFrame, folder: str, codes: np.ndarray, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY) -> DataFrame:
    """Write the sequences to shards below ``folder`` and return where each went.

    ``cut`` holds the rows of ``sequences``, stored (they are read more than once), with the same ``codes``. The result has ``slot``,
    ``shard``, ``byte_offset``, ``n_tokens``, ``doc_ids`` and ``sha256`` of the slot's bytes, one row per sequence. The
    shards are complete when it has been computed.
    """
    spark = cut.sparkSession
    folder = resolved(spark, folder)
    per_task = cut.groupBy("task").agg((F.max("number") + 1).alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(per_task.select("task", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    total, tasks = bases.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    shards = max(1, -(-total // per_shard))
    parts = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1))
    numbered = cut.join(F.broadcast(bases) if tasks <= BROADCAST_TASKS else bases, "task")

    def permute(batches):
        for batch in batches:
            number = batch.column(0).to_numpy() + batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(feistel(number, total, key)), *batch.columns[2:]], names=["slot", "n_tokens", "doc_ids", "tokens"])

    placed = numbered.select("base", "number", "n_tokens", "doc_ids", "tokens").mapInArrow(
        permute, "slot long, n_tokens int, doc_ids array<long>, tokens binary")
    ids_of = np.argsort(codes).astype(np.uint16)
    shard = F.floor(F.col("slot") / per_shard)
    ranged = placed.repartitionById(parts, F.floor(shard * parts / shards).cast("int")).sortWithinPartitions("slot")

    def write(batches):
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        expand = zstandard.ZstdDecompressor()
        stream, at, name = None, -1, ""

        def close():
            if stream is not None:
                stream.close()
                _publish(system, name, shard_path(root, at))

        for batch in batches:
            slots, payload = batch.column(0).to_pylist(), batch.column(3)
            digests = []
            for k, slot in enumerate(slots):
                if slot // per_shard != at:
                    close()
                    at, name = slot // per_shard, f"{root}/attempt-{uuid.uuid4().hex}"
                    stream = system.open_output_stream(name)
                planes = np.frombuffer(expand.decompress(payload[k].as_py()), dtype=np.uint8).astype(np.uint16)
                record = ids_of[planes[:length] << np.uint16(8) | planes[length:]].astype("<u2").tobytes()
                stream.write(record)
                digests.append(hashlib.sha256(record).hexdigest())
            where = np.array(slots, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(where // per_shard), pa.array(where % per_shard * length * 2),
                 batch.column(1), batch.column(2), pa.array(digests)],
                names=["slot", "shard", "byte_offset", "n_tokens", "doc_ids", "sha256"])
        close()

    return ranged.mapInArrow(
        write, "slot long, shard long, byte_offset long, n_tokens int, doc_ids array<long>, sha256 string")


def materialise_training_order(docs: DataFrame, vocabulary: str, folder: str, length: int = LENGTH,
                               per_shard: int = PER_SHARD, key: int = KEY, doc_id: str = "doc_id",
                               text: str = "text") -> DataFrame:
    """Encode ``docs``, write all shards below ``folder`` and return the stored index, one row per sequence."""
    codes = code_table(docs, vocabulary, text)
    cut = materialize(sequences(docs, vocabulary, codes, length, doc_id, text), "sequences")
    return materialize(write_shards(cut, folder, codes, length, per_shard, key), "shard-index")


def read_slots(folder: str, first: int, count: int, length: int = LENGTH, per_shard: int = PER_SHARD):
    """The sequences of ``count`` slots from ``first`` on, as arrays, read in order; stops where the slots end."""
    system, root = _open(folder)
    stride, slot, stop = length * 2, first, first + count
    while slot < stop:
        path = shard_path(root, slot // per_shard)
        info = system.get_file_info(path)
        if info.type != fs.FileType.File:
            return
        begin = slot % per_shard
        wanted = min(stop - slot, per_shard - begin, info.size // stride - begin)
        if wanted <= 0:
            return
        with system.open_input_file(path) as file:
            file.seek(begin * stride)
            for _ in range(wanted):
                yield np.frombuffer(file.read(stride), dtype="<u2")
        slot += wanted


def byte_vocabulary() -> str:
    """The vocabulary file that the registered query uses."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query()
def op8_token_shards(spark: SparkSession, folder: str):
    """Where every sequence of the encoded documents lies in the shards, which are written below the shared folder."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return materialise_training_order(docs, byte_vocabulary(), fresh_path(spark, "shards"))
