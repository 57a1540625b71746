"""Manifest of a table of documents as a Merkle tree, with a proof for every row found by pointer jumping.

Every row is a leaf, the digest of its columns. The leaves of a group (a source), in the order of their key, are the
bottom of a tree in which every ``FANOUT`` consecutive nodes have one parent; the roots of all groups, in the order of
the groups, are the bottom of a tree of the same kind.

Positions come from one range sort of keys and digests (texts stay where they are) and from counts per range and
group, so a group of any size is spread over the ranges. The tree is built level by level, each a sixteenth of the one
below. Proofs need no walk from the leaves: every node above the leaves starts with its siblings and its parent, and
while some node has not reached the root, all of them join their ancestor, append its siblings and take over its
ancestor. The distance doubles each time, so a tree of depth d takes log2(d) joins of N / 16 rows. Nodes side by side
ask for their common ancestor once, so an ancestor of very many nodes is no hot key. The leaves of a run share all but
their own siblings and are given their proofs where the run is.

Defined results: a null column is hashed as ``-``, other values as their UTF-8 byte count, a colon and the value. A
null group is a group of its own and comes first, null keys come first in their group. Rows of one key are ordered by
their digests; equal rows are leaves of their own with equal digests. A run of one node has no siblings, a single row
is the root. An empty table gives an empty manifest. Only named columns are read; others never matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.registry import query, table
from fathomline.llm.texts import small
from fathomline.operators.ordering import with_row_index
from fathomline.session import materialize

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
NEIGHBOURS = 256  # nodes side by side that ask for their ancestor together
MAX_PIECES = 100_000  # rows of four numbers and a group's name that may be broadcast, some MB

_STEP = "array<struct<left:binary,right:binary>>"
_TOP = -1  # group number of nodes above the groups


def record(*values: Column) -> Column:
    """Digest of a row: hex SHA-256 of its values, each with its length in bytes."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
             for v in (v.cast("string") for v in values)]
    return F.sha2(F.concat(*parts), 256)


def hex_text(digests: Column) -> Column:
    """Binary digests as lowercase hex."""
    return F.lower(F.hex(digests))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex text) and its proof lead to."""
    return F.aggregate(path, leaf, lambda below, step: F.sha2(
        F.concat(hex_text(step["left"]), below, hex_text(step["right"])), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf upwards, each level from left to right."""
    return F.sha2(F.array_join(F.transform(
        path, lambda step: F.concat(hex_text(step["left"]), hex_text(step["right"]))), ""), 256)


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda s, x: F.concat(s, x))


def _parent_digest(kids: Column) -> Column:
    return F.unhex(F.sha2(hex_text(kids), 256))


def _step(kids: Column, i: Column) -> Column:
    """The siblings of child ``i`` among the joined digests of a run."""
    return F.struct(F.substring(kids, F.lit(1), 32 * i).alias("left"),
                    F.substring(kids, 32 * i + 33, F.octet_length(kids)).alias("right"))


def _node(group: Column, level: Column, place: Column) -> Column:
    return F.struct(group.cast("long").alias("group"), level.cast("int").alias("level"), place.cast("long").alias("place"))


def _named(group: Column, level: Column, place: Column, width: Column) -> Column:
    """Name of a node; the root of a group is a bottom node of the tree above the groups."""
    return F.when((width == 1) & (group != _TOP), _node(F.lit(_TOP), F.lit(0), group)).otherwise(_node(group, level, place))


def positions(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``group``, ``key``, ``leaf`` and others) with ``number`` of the group, its ``size`` and the row's ``place`` in it."""
    order = [F.col(c).asc_nulls_first() for c in ("group", "key", "leaf")]
    ranged = materialize(leaves.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), "ordered-leaves")
    ranged = ranged.withColumn("piece", F.shiftright("at", 33))
    pieces = materialize(ranged.groupBy("piece", "group").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")), "pieces")
    groups = with_row_index(pieces.groupBy("group").agg(F.sum("n").alias("size")), ["group"], "number")
    groups = groups.withColumnRenamed("group", "name")
    before = Window.partitionBy("number").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = pieces.join(groups, F.col("group").eqNullSafe(F.col("name"))).select(
        F.col("piece").alias("in_piece"), "name", "number", "size",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    shifts = small(materialize(shifts, "shifts"), MAX_PIECES)
    placed = ranged.join(shifts, (F.col("piece") == F.col("in_piece")) & F.col("group").eqNullSafe(F.col("name")))
    return placed.select(*leaves.columns, "number", "size", (F.col("at") + F.col("shift")).alias("place"))


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """All levels above ``nodes`` (``group``, ``level``, ``place``, ``width`` of its level, ``digest``), with ``kids``."""
    levels = []
    while not (several := nodes.filter("width > 1")).isEmpty():
        runs = several.groupBy(
            "group", (F.col("level") + 1).alias("level"), F.floor(F.col("place") / FANOUT).alias("parent"),
            F.ceil(F.col("width") / FANOUT).alias("width"),
        ).agg(F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("members"))
        runs = runs.select("group", "level", F.col("parent").alias("place"), "width", _joined(F.col("members.digest")).alias("kids"))
        nodes = materialize(runs.withColumn("digest", _parent_digest(F.col("kids"))), "tree-level")
        levels.append(nodes)
    return levels


def _links(level: DataFrame) -> DataFrame:
    """Every child of a level's nodes: its name, its parent, its siblings, and its own digest if it is a group's root."""
    child = F.explode(F.sequence(F.lit(0), (F.octet_length("kids") / 32 - 1).cast("int"))).alias("i")
    rows = level.select("*", child)
    name = _node(F.col("group"), F.col("level") - 1, F.col("place") * FANOUT + F.col("i"))
    is_subroot = (F.col("group") == _TOP) & (F.col("level") == 1)
    return rows.select(
        name.alias("node"), _named(*[F.col(c) for c in ("group", "level", "place", "width")]).alias("ancestor"),
        F.array(_step(F.col("kids"), F.col("i"))).alias("path"),
        F.when(is_subroot, F.substring("kids", 32 * F.col("i") + 1, F.lit(32))).alias("subroot"))


def _reach_root(links: DataFrame, root: Column) -> DataFrame:
    """Links whose ancestor is the root: every round doubles the distance, by a join of the links with themselves."""
    links = materialize(links, "links")
    while not (waiting := links.filter(F.col("ancestor") != root)).isEmpty():
        area = [F.col("node.group").alias("area"), F.floor(F.col("node.place") / NEIGHBOURS).alias("part")]
        waiting = waiting.select("*", *area)
        asked = waiting.select("ancestor", "area", "part").distinct()
        above = links.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("further"),
                             F.col("path").alias("rest"), F.col("subroot").alias("passed"))
        answers = asked.join(above, "ancestor")
        risen = waiting.join(answers, ["ancestor", "area", "part"]).select(
            "node", F.col("further").alias("ancestor"), F.concat("path", "rest").alias("path"),
            F.coalesce("subroot", "passed").alias("subroot"))
        links = materialize(links.filter(F.col("ancestor") == root).unionByName(risen), "links")
    return links


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", columns: tuple[str, ...] = COLUMNS,
             carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``leaf``, ``subroot``, ``root`` (hex text), ``proof`` and the ``carry`` columns.

    ``proof`` holds the digests left and right of the path at every level, from the leaf to the root.
    """
    carry = carry or {}
    leaves = materialize(docs.select(
        F.col(f"`{group}`").alias("group"), F.col(f"`{key}`").alias("key"),
        F.unhex(record(*[F.col(f"`{c}`") for c in columns])).alias("leaf"),
        F.struct(F.lit(0).alias("_"), *[c.alias(name) for name, c in carry.items()]).alias("carried")), "leaves")
    placed = positions(leaves)
    runs = placed.groupBy(F.col("number").alias("group"), "size", F.floor(F.col("place") / FANOUT).alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("place", "leaf", "key", "carried"))).alias("members"))
    lone = F.col("size") == 1
    runs = runs.select("group", F.when(lone, 0).otherwise(1).alias("level"), F.col("run").alias("place"),
                       F.ceil(F.col("size") / FANOUT).alias("width"), "members", _joined(F.col("members.leaf")).alias("kids"))
    runs = materialize(runs.withColumn(
        "digest", F.when(F.col("level") == 0, F.col("kids")).otherwise(_parent_digest(F.col("kids")))), "runs")
    bare = runs.select("group", "level", "place", "width", "digest")
    levels = _levels(bare)
    subroots = bare.filter("width = 1")
    for level in levels:
        subroots = subroots.unionByName(level.filter("width = 1").select(*bare.columns))
    subroots = materialize(subroots, "subroots")
    count = subroots.count()
    top = subroots.select(F.lit(_TOP).alias("group"), F.lit(0).alias("level"), F.col("group").alias("place"),
                          F.lit(count).alias("width"), "digest")
    upper = _levels(top)
    root = _node(F.lit(_TOP), F.lit(len(upper)), F.lit(0))
    found = (upper[-1] if upper else subroots).select("digest").first()
    digest = F.lit(bytes(found[0]) if found else b"")
    links = [_links(level) for level in [*levels, *upper]]
    name = _named(*[F.col(c) for c in ("group", "level", "place", "width")])
    rows = runs.withColumn("node", name)
    if links:
        joined = links[0]
        for more in links[1:]:
            joined = joined.unionByName(more)
        rows = rows.join(_reach_root(joined, root).drop("ancestor"), "node", "left")
    else:
        rows = rows.withColumns({"path": F.lit(None).cast(_STEP), "subroot": F.lit(None).cast("binary")})
    path = F.coalesce("path", F.array().cast(_STEP))
    own = F.transform("members", lambda m, i: F.struct(
        m["key"].alias("key"), m["leaf"].alias("leaf"), m["carried"].alias("carried"),
        F.when(F.col("level") == 0, F.array().cast(_STEP)).otherwise(F.array(_step(F.col("kids"), i))).alias("first")))
    rows = rows.select(path.alias("path"), F.coalesce("subroot", digest).alias("subroot"), F.explode(own).alias("m"))
    return rows.select(
        F.col("m.key").alias(key), hex_text(F.col("m.leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
        hex_text(digest).alias("root"), F.concat("m.first", "path").alias("proof"),
        *[F.col(f"m.carried.{c}").alias(c) for c in carry])


def lower_ascii(text: Column) -> Column:
    """A text with A to Z in lower case and all else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


_CRC = """list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
      lambda s, b: list_reduce(list_prepend(xor(s, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
                               lambda x, z: xor(x >> 1, 3988292384::bigint * (x & 1))))"""


def _leaf_sql(text: str) -> str:
    def part(c):
        return f"coalesce(octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar, '-')"

    return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


@query(f"""
with recursive l as (
  select doc_id, source, {_leaf_sql('text')} as leaf,
         case when xor({_CRC}, 4294967295) % 5 = 0 then
           {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as altered
  from documents
), p as (
  select *, dense_rank() over (order by source nulls first) - 1 as s,
         row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as p,
         count(*) over (partition by source) as width
  from l
), inner_tree as (
  select s, 0 as level, p, width, leaf as digest from p
  union all
  select s, level + 1, p // 16, (width + 15) // 16, sha256(string_agg(digest, '' order by p))
  from inner_tree where width > 1 group by s, level, p // 16, width
), subroots as (
  select s, digest from inner_tree where width = 1
), upper_tree as (
  select 0 as level, s as p, (select count(*) from subroots) as width, digest from subroots
  union all
  select level + 1, p // 16, (width + 15) // 16, sha256(string_agg(digest, '' order by p))
  from upper_tree where width > 1 group by level, p // 16, width
), inner_runs as (
  select s, level, p // 16 as run, list(digest order by p) as kids from inner_tree where width > 1 group by s, level, p // 16
), upper_runs as (
  select level, p // 16 as run, list(digest order by p) as kids from upper_tree where width > 1 group by level, p // 16
), steps as (
  select p.s, p.p, r.level, r.kids, (p.p // (16 ** r.level)::bigint) % 16 + 1 as i
  from p join inner_runs r on r.s = p.s and r.run = p.p // (16 ** (r.level + 1))::bigint
  union all
  select p.s, p.p, 1000 + r.level, r.kids, (p.s // (16 ** r.level)::bigint) % 16 + 1
  from p join upper_runs r on r.run = p.s // (16 ** (r.level + 1))::bigint
), paths as (
  select s, p, list(struct_pack(l := array_to_string(kids[:i - 1], ''), r := array_to_string(kids[i + 1:], '')) order by level) as path
  from steps group by s, p
), done as (
  select p.*, coalesce(path, []) as path, (select digest from subroots where subroots.s = p.s) as subroot,
         (select digest from upper_tree where width = 1) as root
  from p left join paths using (s, p)
), fold as (
  select s, p, path, 1 as i, coalesce(altered, leaf) as digest from done
  union all
  select s, p, path, i + 1, sha256(path[i].l || digest || path[i].r) from fold where i <= len(path)
)
select doc_id, leaf, subroot, root, sha256(coalesce(list_aggregate(list_transform(d.path, lambda x: x.l || x.r), 'string_agg', ''), '')) as proof_sha256,
       f.digest as folded_root, f.digest = root as verified
from done d join fold f using (s, p) where f.i = len(d.path) + 1
""")
def op12_merkle_manifest(spark, folder):
    """Leaf, subroot, root, proof and check of every document; the check of every fifth uses a tampered text."""
    docs = table(spark, folder, "documents").select(*COLUMNS)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    altered = record(*[lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS])
    rows = manifest(docs, carry={"altered": F.when(tampered, F.unhex(altered))})
    rows = rows.withColumn("folded_root", folded(F.coalesce(hex_text(F.col("altered")), F.col("leaf")), F.col("proof")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
