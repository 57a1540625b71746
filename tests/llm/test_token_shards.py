import hashlib
from collections import Counter

import numpy as np
import pytest

from fathomline.llm import token_shards as shards
from tests.llm import helpers


@pytest.mark.parametrize("count", [1, 2, 3, 5, 64, 1_000, 4_097])
def test_permutation(count):
    slots = shards.feistel(np.arange(count), count)
    assert sorted(slots) == list(range(count))
    assert (shards.feistel(slots, count, back=True) == np.arange(count)).all()
    if count > 100:
        assert (shards.feistel(np.arange(count), count, key=1) != slots).any()


def test_round_trip_and_resuming(spark, tmp_path):
    docs = spark.read.parquet(f"{helpers.FOLDER}/documents.parquet")
    index = shards.materialise_training_order(docs, shards.byte_vocabulary(), str(tmp_path / "out"), 256, 50).toPandas()
    index = index.sort_values("slot")
    assert index.slot.tolist() == list(range(len(index)))
    assert (index.byte_offset == index.slot % 50 * 512).all() and (index["shard"] == index.slot // 50).all()
    read = list(shards.read_slots(str(tmp_path / "out"), 0, 10**9, 256, 50))
    assert [hashlib.sha256(x.tobytes()).hexdigest() for x in read] == index.sha256.tolist()
    later = list(shards.read_slots(str(tmp_path / "out"), 73, 60, 256, 50))
    assert all((a == b).all() for a, b in zip(later, read[73:133])) and len(later) == 60
    encoding, end = shards._encoding(shards.byte_vocabulary())
    turn = np.argsort(shards.feistel(np.arange(len(read)), len(read), back=True))
    flat = np.concatenate([read[i][:index.n_tokens.iloc[i]] for i in turn])
    parts = np.split(flat, np.flatnonzero(flat == end) + 1)[:-1]
    assert Counter(encoding.decode(p[:-1].tolist()) for p in parts) == Counter(t or "" for _, t, *_ in helpers.documents())
    assert set(np.concatenate([list(x) for x in index.doc_ids])) == {d for d, *_ in helpers.documents()}


def test_odd_rows(spark, tmp_path):
    index = shards.materialise_training_order(helpers.odd(spark), shards.byte_vocabulary(), str(tmp_path / "odd"), 64, 100)
    ids = Counter(d for r in index.collect() for d in set(r.doc_ids))
    assert set(ids) == {r[0] for r in helpers.odd_rows()}
    none = shards.materialise_training_order(helpers.empty(spark), shards.byte_vocabulary(), str(tmp_path / "none"))
    assert none.count() == 0 and list(shards.read_slots(str(tmp_path / "none"), 0, 5)) == []


def test_folders_are_resolved_as_spark_does(spark, tmp_path):
    folder = shards.resolved(spark, str(tmp_path / "a b"))
    assert folder.startswith("file:/") and shards._open(folder)[1] == str(tmp_path / "a b")


def test_repeated_attempt_where_renames_do_not_replace(tmp_path):
    class Strict:
        local = shards.fs.LocalFileSystem()
        get_file_info, delete_file = local.get_file_info, local.delete_file

        def move(self, name, target):
            if self.get_file_info(target).type != shards.fs.FileType.NotFound:
                raise OSError("exists")
            self.local.move(name, target)

    target = tmp_path / "shard"
    for body in (b"first", b"again"):
        (tmp_path / "attempt").write_bytes(body)
        shards._publish(Strict(), str(tmp_path / "attempt"), str(target))
        assert target.read_bytes() == body and not (tmp_path / "attempt").exists()
    with pytest.raises(OSError):
        shards._publish(Strict(), str(tmp_path / "missing"), str(tmp_path / "none"))
