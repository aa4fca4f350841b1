"""Quality rules: a threshold table compiled into one native Spark projection.

Every statistic is a DataFrame expression over the whole text; no user function
and no shuffle takes part, so the cost per row depends on that row alone.

Defined results: a null or empty text has no words, so every count is 0 and the
base rule fails; null sources, ids or other columns are carried through; repeated
rows are judged each on its own; an empty table gives an empty result. Three-word
windows are compared by a 64-bit hash inside one text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, words_of

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the four corpus languages.
STOP_WORDS = (
    "the of and to in is that it for was on are as with they be at this have from or by not but"
    " le la les de des du et un une que qui en est pour dans par sur avec au"
    " der die das und den von zu mit sich dem ist im nicht ein auf"
    " el los las y a se del lo con para su al una"
).split()


@dataclass(frozen=True)
class Rule:
    """``numerator`` divided by ``denominator`` must lie in [low, high]; no denominator: the count itself."""

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None


#: Base rules of the contract: at least 50 words, at most half of them repeated (a half of a whole number is exact).
BASE_RULES = (
    Rule("words", "n_words", low=50),
    Rule("repeats", "n_repeat_words", "n_words", high=0.5),
)

#: The method's own verdict.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.05),
    Rule("dup_lines", "n_dup_lines", "n_lines", high=0.5),
)


def compiled(rules: tuple[Rule, ...]) -> Column:
    """One boolean expression, true where every rule holds (cross-multiplied: no division by zero)."""

    def holds(rule: Rule) -> Column:
        value = F.col(rule.numerator)
        scale = F.col(rule.denominator) if rule.denominator else F.lit(1)
        parts = []
        if rule.low is not None:
            parts.append(value >= F.lit(rule.low) * scale)
        if rule.high is not None:
            parts.append(value <= F.lit(rule.high) * scale)
        return reduce(lambda a, b: a & b, parts, F.lit(True))

    return reduce(lambda a, b: a & b, map(holds, rules), F.lit(True))


def _removed(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def measured(docs: DataFrame, *carried: Column, text: str = "text") -> DataFrame:
    """``carried`` plus the statistics of each text (see module docstring)."""
    body = docs.select(F.struct(*carried).alias("row"), text_or_empty(text).alias("body"))
    split = body.select(
        "row",
        words_of(F.col("body")).alias("words"),
        F.filter(F.split("body", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0).alias("lines"),
        _removed(F.col("body"), SYMBOLS).alias("n_symbols"),
        F.char_length(F.translate("body", " \t\n\x0b\x0c\r", "")).alias("word_chars"),
    )
    # windows as (hash, position), sorted so that equal windows are neighbours
    windows = F.transform(
        "words",
        lambda w, i: F.struct(F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("p")),
    )
    in_order = split.select(
        "row",
        "n_symbols",
        "word_chars",
        F.size("words").alias("n_words"),
        F.size(F.filter("words", lambda w: w.isin(STOP_WORDS))).alias("n_stop_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.array_sort(F.slice(windows, 1, F.greatest(F.size("words") - 2, F.lit(0)))).alias("grams"),
    )
    repeated = F.transform(
        "grams",
        lambda g, i: F.when((g.h == F.get("grams", i - 1).h) | (g.h == F.get("grams", i + 1).h), g.p),
    )
    starts = in_order.select(
        *[c for c in in_order.columns if c != "grams"],
        F.array_sort(F.filter(repeated, lambda p: p.isNotNull())).alias("starts"),
    )
    # each repeated window covers three words, fewer where the next one begins earlier
    covered = F.transform("starts", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("starts", i + 1) - p, F.lit(3))))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_stop_words", "n_lines"]
    return starts.select(
        "row",
        *[F.col(c).cast("long").alias(c) for c in counts],
        F.aggregate(covered, F.lit(0), lambda a, b: a + b).cast("long").alias("n_repeat_words"),
    )


def _verdict(stats: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    return stats.withColumn("base_failed", ~compiled(BASE_RULES)).withColumn("kept", ~F.col("base_failed") & compiled(rules))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: its id, the counts, ``base_failed`` and ``kept``."""
    stats = measured(docs, F.col(id_col).alias("id"), text=text)
    judged = _verdict(stats, rules)
    return judged.select(
        F.col("row.id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_stop_words", "n_lines", "base_failed", "kept",
    )


def quality_filter(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, with exactly the columns that came in."""
    stats = measured(docs, *[F.col(f"`{c}`") for c in docs.columns], text=text)
    # a generator, because a filter would be pushed below the projections, each statistic copied into it many times over
    return _verdict(stats, rules).select(F.inline(F.filter(F.array("row"), lambda _: F.col("kept"))))
