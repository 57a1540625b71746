import hashlib
import random
import zlib
from collections import defaultdict

import duckdb

from fathomline.llm import merkle
from fathomline.llm.catalog import ORACLE_SQL, QUERIES
from tests.llm import helpers


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def record(*values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root of a list of digests and every one's path of (left, right)."""
    paths = [[] for _ in nodes]
    width, level, under = len(nodes), list(nodes), [[i] for i in range(len(nodes))]
    while width > 1:
        runs = [range(a, min(a + 16, width)) for a in range(0, width, 16)]
        for run in runs:
            for i in run:
                for leaf in under[i]:
                    paths[leaf].append(("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i)))
        under = [[x for i in run for x in under[i]] for run in runs]
        level = [digest("".join(level[i] for i in run)) for run in runs]
        width = len(level)
    return level[0], paths


def plain(rows):
    """``(key, leaf, subroot, root, path)`` of ``(doc_id, source, lang, n_chars, text)`` rows."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, record(*r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: (sorted(groups[g], key=lambda x: x[:3]), *tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])])) for g in names}
    root, above = tree([trees[g][1] for g in names])
    return [(x[3][0], x[2], trees[g][1], root, own + above[i]) for i, g in enumerate(names) for x, own in zip(trees[g][0], trees[g][2])]


def got_rows(frame):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [(s["left"].hex(), s["right"].hex()) for s in r.proof])
                   for r in frame.collect()), key=repr)


def test_same_as_sql(spark, rows):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{helpers.FOLDER}/documents.parquet'")
    names = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    want = con.sql(f"select {', '.join(names)} from ({ORACLE_SQL['op12_merkle_manifest']})").fetchall()
    got = rows(QUERIES["op12_merkle_manifest"](spark, helpers.FOLDER), *names)
    assert got == sorted(want, key=repr)
    for r in got:
        assert r[6] or zlib.crc32(str(r[0]).encode()) % 5 == 0


def test_deep_trees_and_many_groups(spark):
    draw = random.Random(1)
    sizes = {None: 3, "a": 4_200, "b": 1, "é": 16, "z": 17, "Z": 257, **{f"s{i:03d}": draw.choice([1, 2, 16, 40]) for i in range(300)}}
    docs = [(draw.randrange(10 ** 6), g, None, 3, f"text {i}") for g, n in sizes.items() for i in range(n)]
    frame = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string")
    assert got_rows(merkle.manifest(frame)) == sorted(plain(docs), key=repr)


def test_one_group_one_row(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    for docs in ([(1, "a", "en", 1, "x")], [(i, "a", None, 1, "x") for i in range(20)], [(1, "a", "en", 1, "x"), (1, "b", "en", 1, "x")]):
        assert got_rows(merkle.manifest(spark.createDataFrame(docs, schema))) == sorted(plain(docs), key=repr)


def test_odd_rows(spark):
    odd = helpers.odd_rows()
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in odd]
    assert got_rows(merkle.manifest(helpers.odd(spark))) == sorted(plain(rows), key=repr)
    assert merkle.manifest(helpers.empty(spark)).count() == 0


def test_fold_and_carry(spark):
    docs = spark.createDataFrame([(i, "a", "en", 1, f"T{i}") for i in range(300)], "doc_id long, source string, lang string, n_chars long, text string")
    found = merkle.manifest(docs, carry={"words": docs.text})
    rows = found.select("doc_id", "words", "root", merkle.folded(found.leaf, found.proof).alias("f")).collect()
    assert all(r.f == r.root and r.words == f"T{r.doc_id}" for r in rows)
