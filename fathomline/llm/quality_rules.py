"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

A rule names a measure and the closed range a kept document must lie in. All measures of a document
are computed in its row, so nothing is shuffled and a row of any source costs the same.

Defined results: a null text counts as no words, an empty text likewise; both fail the base rule.
Columns of the input that have the name of a measure are replaced, all other columns stay. Repeated
rows are judged one by one. Measures with a zero denominator are 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.registry import query, table
from fathomline.llm.texts import packed

SPACE = r"[\x20\x09-\x0D]+"

# Frequent function words of the languages served.
STOP_WORDS = {
    "en": "the of and to in a is that it was for on are with as be at by this from or an",
    "fr": "le la les de des du et en un une que qui dans pour par sur est au aux avec",
    "de": "der die das und den von zu mit sich auf für ist im nicht ein eine des dem als auch",
    "es": "el la los las de del y en que un una por con para se es al su lo como",
}


@dataclass(frozen=True)
class Rule:
    """A document passes when ``low <= measure <= high``; an open end is None."""

    measure: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value = F.col(self.measure)
        parts = [F.lit(True)]
        if self.low is not None:
            parts.append(value >= F.lit(self.low))
        if self.high is not None:
            parts.append(value <= F.lit(self.high))
        return reduce(lambda a, b: a & b, parts)


RULES = [
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.3),
    Rule("ellipsis_line_ratio", None, 0.3),
]


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The measures of every row, as columns.

    Three-word windows are compared by 64-bit hashes within one document: sorted with their
    positions, equal ones lie side by side, and the words they cover are the union of their ranges.
    """
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "stop_word_ratio",
                "ellipsis_line_ratio", "mean_word_chars", "symbol_ratio", "dup_line_ratio", "repeat_ratio")
    rows = packed(docs, measures, text=text)
    body = F.coalesce(F.col("text"), F.lit(""))
    stops = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    stop_pattern = r"(?<![^\x20\x09-\x0D])(?:" + "|".join(stops) + r")(?![^\x20\x09-\x0D])"
    rows = rows.withColumn("_words", F.filter(F.split(body, SPACE), lambda w: w != ""))
    rows = rows.withColumn("_lines", F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumn("n_words", F.size("_words").cast("long"))
    words, lines = F.col("_words"), F.col("_lines")
    starts = F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), F.col("n_words").cast("int") - 3))
    rows = rows.withColumn("_windows", F.sort_array(F.transform(
        F.coalesce(starts, F.array().cast("array<int>")),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("at")
        ),
    )))
    windows = F.col("_windows")
    rows = rows.withColumn("_again", F.sort_array(F.transform(
        F.filter(windows, lambda x, k: (F.get(windows, k - 1)["h"].eqNullSafe(x["h"]))
                 | (F.get(windows, k + 1)["h"].eqNullSafe(x["h"]))),
        lambda x: x["at"],
    )))
    again = F.col("_again")
    covered = F.aggregate(
        F.transform(again, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(again, k + 1) - at, F.lit(3)))),
        F.lit(0), lambda total, x: total + x,
    )
    n_words, n_lines = F.col("n_words"), F.size(lines)
    rows = rows.withColumns({
        "word_chars": F.length(F.regexp_replace(body, SPACE, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (n_lines - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": covered.cast("long"),
        "stop_word_ratio": _ratio(F.regexp_count(F.lower(body), F.lit(stop_pattern)), n_words),
        "ellipsis_line_ratio": _ratio(F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))), n_lines),
    })
    rows = rows.withColumns({
        "mean_word_chars": _ratio(F.col("word_chars"), n_words),
        "symbol_ratio": _ratio(F.col("n_symbols"), n_words),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), n_lines),
        "repeat_ratio": _ratio(F.col("n_repeat_words"), n_words),
    })
    return rows.select("_row.*", *measures)


def judge(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", min_words: int = 50,
          max_repeat_percent: int = 50) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``kept`` and ``broken_rules`` (names of the measures out of range).

    A document fails the base rule when it has fewer than ``min_words`` words or when more than
    ``max_repeat_percent`` of its words lie in three-word windows found twice or more.
    """
    rules = RULES if rules is None else rules
    rows = with_measures(docs, text)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    broken = F.filter(
        F.array(*[F.when(~r.holds(), F.lit(r.measure)) for r in rules]) if rules else F.array().cast("array<string>"),
        lambda x: x.isNotNull(),
    )
    return rows.withColumns({"base_failed": failed, "broken_rules": broken}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken_rules") == 0)
    )


_STOP_SQL = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words.split()}))


@query(rf"""
with d as (
  select doc_id, coalesce(text, '') as body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
), w as (
  select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as win
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from d)
), r as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) as n from w) where n > 1
), c as (
  select doc_id, count(distinct i + o) as n from r, (select unnest([0, 1, 2]) as o) group by doc_id
), m as (
  select d.doc_id, len(words)::bigint as n_words, length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
         len(lines) as n_lines, len(list_filter(words, lambda x: lower(x) in ({_STOP_SQL}))) as stops,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) as dots
  from d left join c using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(word_chars / nullif(n_words, 0), 0) between 2.0 and 14.0
         and coalesce(n_symbols / nullif(n_words, 0), 0) <= 0.1 and coalesce(stops / nullif(n_words, 0), 0) >= 0.02
         and coalesce(n_dup_lines / nullif(n_lines, 0), 0) <= 0.3 and coalesce(dots / nullif(n_lines, 0), 0) <= 0.3 as kept
from (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
""")
def op1_quality_rules(spark, folder):
    """Base measures and verdict of every document."""
    return judge(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
