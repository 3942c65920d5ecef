"""Quality rules as a short-circuit cascade.

A rule is a named rejection condition over whole texts.  On a bounded sample
the cascade measures what each rule costs and how many rows it rejects, and
orders the rules by rejections per cost; a document then meets the rules in
that order, as one CASE expression that stops at the first rejection.
DataFrame operations only.

Defined results: a null text is an empty one; a document is judged by its own
text alone, so ties, repeated rows and other columns do not matter; an empty
table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions import let
from changeloom.llm.common import SPACE, WORD

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8


def word_array(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_chars(words: Column) -> Column:
    """Code points in words."""
    return F.length(F.array_join(words, "")).cast("long")


def symbol_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(WORD))
    return let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))


def repeated_window_words(words: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of ``width`` words found twice or more.

    Windows are compared by 64-bit hash.  Texts without a repeated window (most
    of them) stop after the distinct count; for the others the windows are
    sorted with their positions, neighbours with equal hashes mark positions,
    and the sorted positions give the words covered: n log n, no pairs.
    """
    def windows(w: Column) -> Column:
        return F.when(F.size(w) >= width,
                      F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)),
                                  lambda i: F.xxhash64(F.slice(w, i, width)))
                      ).otherwise(F.array().cast("array<bigint>"))

    def positions(grams: Column) -> Column:
        keyed = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("p"))))
        marked = let(keyed, lambda s: F.filter(
            F.transform(s, lambda e, i: F.when(
                F.coalesce((F.get(s, i - 1)["g"] == e["g"]), F.lit(False))
                | F.coalesce((F.get(s, i + 1)["g"] == e["g"]), F.lit(False)), e["p"])),
            lambda p: p.isNotNull()))
        return F.array_sort(marked)

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(
            F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    return let(words, lambda w: let(windows(w), lambda g: F.when(
        F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long"))
        .otherwise(let(positions(g), covered))))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and n_lines (lines with a word) of the whole texts."""
    words = word_array(F.col(text_col))
    names = features(F.col(text_col), F.col("_words"))
    return docs.withColumn("_words", words).withColumns(names).drop("_words")


def features(text: Column, words: Column | None = None) -> dict[str, Column]:
    """What the rules look at, as expressions over a text (and its words)."""
    words = word_array(text) if words is None else words
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(WORD))
    return {"n_words": F.size(words).cast("long"), "word_chars": word_chars(words),
            "n_symbols": symbol_count(text), "n_dup_lines": repeated_lines(text),
            "n_repeat_words": repeated_window_words(words), "n_lines": F.size(lines).cast("long")}


@dataclass(frozen=True)
class Rule:
    """Rejects a row when ``reject``, given the row's features, is true."""
    name: str
    reject: Callable[[dict[str, Column]], Column]


# Fewer than 20 words, or over 30 % of the words in repeated windows.
BASE_RULES = (
    Rule("short", lambda f: f["n_words"] < 20),
    Rule("repeats", lambda f: 100 * f["n_repeat_words"] > 30 * f["n_words"]),
)
# Margins are wide, so that plain prose passes: more than a symbol for every five
# words, words of under 2 or over 25 characters on average, and over half of
# the lines repeated.
PRODUCTION_RULES = (
    *BASE_RULES,
    Rule("symbols", lambda f: 5 * f["n_symbols"] > f["n_words"]),
    Rule("short_words", lambda f: f["word_chars"] < 2 * f["n_words"]),
    Rule("long_words", lambda f: f["word_chars"] > 25 * f["n_words"]),
    Rule("dup_lines", lambda f: 2 * f["n_dup_lines"] > f["n_lines"]),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def order_rules(docs: DataFrame, rules=PRODUCTION_RULES, text_col: str = "text",
                id_col: str = "doc_id", sample_rows: int = 2000) -> list[Estimate]:
    """Rules by rejections per second, the most first, measured on a sample of
    about ``sample_rows`` documents (chosen by id hash).  Only the order comes
    from the sample: it decides what is evaluated first, never a verdict."""
    n = docs.select(F.lit(1)).count()
    if n == 0:
        return [Estimate(r, 0.0, 0.0) for r in rules]
    pick = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(max(1, n // sample_rows))) == 0
    sample = docs.where(pick).select(F.col(text_col).alias("text")).repartition(1).cache()
    try:
        rows = max(1, sample.count())
        estimates = []
        for rule in rules:
            hits = sample.select(F.count_if(rule.reject(features(F.col("text")))).alias("n"))
            seconds = []
            for _ in range(2):          # the first run also compiles the rule
                began = time.perf_counter()
                rejected = hits.first()["n"]
                seconds.append(time.perf_counter() - began)
            estimates.append(Estimate(rule, min(seconds) / rows, rejected / rows))
    finally:
        sample.unpersist()
    return sorted(estimates, key=lambda e: (-e.gain, e.rule.name))


def cascade(order: list[Rule], f: dict[str, Column]) -> Column:
    """Name of the first rule of ``order`` that rejects the row, else null; the
    rules after it are not evaluated."""
    out = F.lit(None).cast("string")
    for rule in reversed(order):
        out = F.when(rule.reject(f), F.lit(rule.name)).otherwise(out)
    return out


def quality_filter(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   rules=PRODUCTION_RULES, sample_rows: int = 2000,
                   measured: bool = False) -> DataFrame:
    """The input with ``failed_rule`` (the first rule of the measured order that
    rejects the row, null if none does) and ``kept``.

    With ``measured`` the result also has all columns of ``measures`` and the
    rules read those; without it a rejected row skips the remaining features.
    """
    order = [e.rule for e in order_rules(docs, rules, text_col, id_col, sample_rows)]
    if measured:
        docs = measures(docs, text_col)
        f = {name: F.col(name) for name in features(F.col(text_col))}
    else:
        f = features(F.col(text_col))
    return (docs.withColumn("failed_rule", cascade(order, f))
            .withColumn("kept", F.col("failed_rule").isNull()))
