"""Quality rules: a threshold table compiled into one projection.

Every rule is a row of :data:`RULES` - a measure with its allowed range. :func:`verdict` turns the
table into one boolean Column; all measures are built-in functions, so the whole operator is a
narrow projection: no shuffle, no user function, memory bounded by one text.

Defined results: a null or empty text has no words and fails; extra columns pass through untouched
(the measures live under one struct column, so no input name can clash); repeated rows are judged
each on its own; an empty table gives an empty table.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import BLANKS, WORD, fresh

SYMBOLS = "#*$%&|<>"
#: Frequent function words of the languages served.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "that", "is", "for", "with", "be", "on", "it", "this", "are", "was",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "ist", "im", "nicht", "ein", "eine",
    "de", "la", "le", "et", "les", "des", "en", "un", "une", "que", "qui", "dans", "est", "pour", "par",
    "el", "los", "las", "y", "se", "del", "una", "por", "con", "no", "su", "al", "es", "como",
)
GRAM = 8


class Rule(NamedTuple):
    name: str
    measure: str
    low: float | None
    high: float | None


#: The threshold table. Ranges are inclusive; None means open.
RULES = (
    Rule("enough_words", "n_words", 20, None),
    Rule("word_length", "mean_word_chars", 2, 15),
    Rule("symbols", "symbol_ratio", None, 0.2),
    Rule("stop_words", "stop_word_ratio", 0.02, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.5),
    Rule("repeated_words", "repeat_word_ratio", None, 0.3),
)


def _covered(grams: Column) -> Column:
    """Word positions inside a window whose hash occurs twice or more; ``grams[i]`` is the hash of window i."""
    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # wrapping the array in a one-element array binds it to a lambda variable: it is computed once
    twice = F.transform(F.array(pairs), lambda p: F.filter(
        F.transform(p, lambda x, j: F.when((F.get(p, j - 1)["h"] == x["h"]) | (F.get(p, j + 1)["h"] == x["h"]), x["i"])),
        lambda i: i.isNotNull()))[0]
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        F.sort_array(twice), zero,
        lambda a, i: F.struct((a["n"] + i + GRAM - F.greatest(a["end"], i.cast("long"))).alias("n"),
                              (i + GRAM).cast("long").alias("end")),
        lambda a: a["n"])


def measures(docs: DataFrame, text_col: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` plus a struct column ``into`` with the counts and ratios of ``text_col``."""
    text = F.coalesce(F.col(f"_d.{text_col}"), F.lit(""))
    keep = [F.struct("*").alias("_d")]
    d = docs.select(*keep)
    d = d.select("_d", F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)).alias("_words"))
    d = d.select("_d", "_words", F.transform("_words", lambda w: F.xxhash64(w)).alias("_ids"))
    ids = F.col("_ids")
    grams = F.when(F.size(ids) >= GRAM, F.transform(
        F.sequence(F.lit(0), F.size(ids) - GRAM),
        lambda i: F.xxhash64(*[F.get(ids, i + k) for k in range(GRAM)]))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    d = d.select("_d", F.size("_words").cast("long").alias("n_words"), grams.alias("_grams"), lines.alias("_lines"),
                 F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"))
    g = F.col("_grams")
    d = d.select(
        "_d", "n_words", "n_stop_words",
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(_covered(g)).alias("n_repeat_words"))
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    counts = ["n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words"]
    return d.select("_d.*", F.struct(
        *counts,
        per("word_chars", "n_words").alias("mean_word_chars"),
        per("n_symbols", "word_chars").alias("symbol_ratio"),
        per("n_stop_words", "n_words").alias("stop_word_ratio"),
        per("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        per("n_repeat_words", "n_words").alias("repeat_word_ratio")).alias(into))


def verdict(rules=RULES, of: str = "quality") -> Column:
    """The threshold table as one boolean expression over the measures struct."""
    ok = F.lit(True)
    for r in rules:
        m = F.col(f"{of}.{r.measure}")
        if r.low is not None:
            ok = ok & (m >= F.lit(r.low))
        if r.high is not None:
            ok = ok & (m <= F.lit(r.high))
    return ok


def base_failed(of: str = "quality") -> Column:
    n, rep = F.col(f"{of}.n_words"), F.col(f"{of}.n_repeat_words")
    return (n < 20) | (100 * rep > 30 * n)


def quality_report(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per document: the counts, the base failure and the verdict of the table."""
    q = measures(docs.select("doc_id", "text"), into="_q")
    return q.select("doc_id", *[F.col(f"_q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    base_failed("_q").alias("base_failed"), (~base_failed("_q") & verdict(rules, "_q")).alias("kept"))


def keep_good(docs: DataFrame, rules=RULES) -> DataFrame:
    """The documents that pass, with their own columns only.

    The partition number in the condition keeps the filter above the projection: pushed below it, every
    threshold would bring its own copy of the measures.
    """
    cols = [F.col(f"`{c}`") for c in docs.columns]
    into, part = fresh(docs, "_q"), fresh(docs, "_p")
    q = measures(docs, into=into).withColumn(part, F.spark_partition_id())
    return q.where(~base_failed(into) & verdict(rules, into) & (F.col(part) >= 0)).select(*cols)
