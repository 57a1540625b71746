"""Mixing sources to target weights with whole-document repetition.

Sizes are summed per source, every source gets a target share of all sizes, and the ratio of target
to size is its repetition rate. A document is taken ``floor(rate)`` times, plus once more when a draw
seeded by its id lies below the fraction of the rate. Only built-in functions run.

Targets are limited to ``max_repeat`` times the source's size; what a limited source leaves is shared
again by weight among the others until no target lies above its limit. That fixed point is found in
one pass: sources fill up in the order of limit / weight, so with the sources in that order the level
each would need is a running sum, and the ones below the common level are the limited ones.

Defined results: a null text has size 0, a null source is a source of its own and comes last. Repeated
rows and repeated ids are mixed one by one, equal ids with equal draws; null ids draw by their text.
An empty table gives an empty result. Columns of the input stay; names made here replace clashing ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.registry import query, table
from fathomline.llm.texts import packed, small
from fathomline.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
BROADCAST_SOURCES = 100_000  # rows of four small columns, some MB


def word_count(text: str = "text"):
    """Number of runs without white space."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: float = 3.0,
                   size: str = "size", source: str = "source") -> DataFrame:
    """One row per source: ``source_size``, ``target`` and ``rate``.

    ``docs`` needs the columns ``size`` and ``source``. Partial sums make a hot source one row per task. The
    windows see one row per source, ordered as a whole: they hold as many rows as there are sources.
    """
    sums = docs.groupBy(F.col(source).alias("_source")).agg(F.sum(size).alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    turn = F.row_number().over(by_name)
    table_of = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sums.withColumn("_weight", F.element_at(table_of, (turn - 1) % len(weights) + 1))
    ranked = ranked.withColumn("_limit", F.lit(float(max_repeat)) * F.col("source_size"))
    order = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("_source").asc_nulls_last())
    filled = order.rowsBetween(Window.unboundedPreceding, -1)
    left = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    ranked = ranked.withColumns({
        # The level if all sources before this one are full and this one and all later ones are not.
        "_level": (total - F.coalesce(F.sum("_limit").over(filled), F.lit(0.0))) / F.sum("_weight").over(left),
    })
    ranked = ranked.withColumn("_full", F.col("_level") * F.col("_weight") > F.col("_limit"))
    level = F.min(F.when(~F.col("_full"), F.struct(F.col("_limit") / F.col("_weight"), F.col("_level")))).over(
        Window.partitionBy())
    target = F.least(F.col("_limit"), F.coalesce(level["_level"] * F.col("_weight"), F.col("_limit")))
    ranked = ranked.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return ranked.select("_source", "source_size", "target", F.least(rate, F.lit(float(max_repeat))).alias("rate"))


def draw(key: str = "doc_id", text: str = "text", seed: int = 20_17):
    """A number in [0, 1) that depends on the document's id and the seed only."""
    basis = F.coalesce(F.col(f"`{key}`").cast("string"), F.col(f"`{text}`"), F.lit(""))
    return F.pmod(F.xxhash64(F.lit(seed), basis), F.lit(1 << 52)).cast("double") / float(1 << 52)


def with_copies(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: float = 3.0, seed: int = 20_17,
                key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``rate`` and ``copies``.

    The join brings one row per source to the documents. The sources are counted: up to ``BROADCAST_SOURCES`` rows
    are broadcast, so no document moves; more are joined by a shuffle whose hot partitions Spark splits.
    """
    made = ("size", "source_size", "target", "rate", "copies")
    sized = docs.drop(*[c for c in made if c not in (key, text, source)]).withColumn("size", word_count(text))
    targets = source_targets(sized.select("size", F.col(f"`{source}`").alias("source")), weights, max_repeat)
    targets = small(materialize(targets, "targets"), BROADCAST_SOURCES)
    joined = sized.join(targets, F.col(f"`{source}`").eqNullSafe(F.col("_source")), "left").drop("_source")
    whole = F.floor("rate")
    extra = (draw(key, text, seed) < F.col("rate") - whole).cast("long")
    return joined.withColumn("copies", F.least(whole + extra, F.lit(int(max_repeat))))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: float = 3.0, seed: int = 20_17,
        key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every document as often as the mix takes it, with the columns of ``docs``."""
    rows = packed(docs, key=key, text=text, source=source)
    taken = with_copies(rows, weights, max_repeat, seed, "key", "text", "source").filter(F.col("copies") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")


@query()
def op10_mix_sources(spark, folder):
    """Sizes, targets and words taken of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return with_copies(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
