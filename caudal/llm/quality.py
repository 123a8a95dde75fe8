"""Quality rules over whole texts: one threshold table, compiled into Spark expressions.

A rule is a ratio of two measures of a text and the range it must lie in. All measures are
built-in functions over the text and its array of words; no row meets Python, and no row is
shuffled.

Repeated three-word windows are found inside the row: the windows are sorted with their places, and a window
equal to a neighbour is repeated. Texts without an equal pair of windows skip the sort.

Defined cases: a null text has no words, fails the base rules and has zero in all measures; equal
rows and null ids are kept; columns beside id and text are not read; long texts are read whole.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\\x20\\x09-\\x0D]"
MIN_WORDS = 50
REPEATED_PERCENT = 50

# Frequent function words of English, French, German and Spanish, fixed.
STOP_WORDS = (
    "the of and to a in is that for it was on with be as by this are at from "
    "de la le et les des en un du une que pour est qui dans par pas au sur avec "
    "der die und den von zu das sich mit auf für ist nicht im dem ein eine als "
    "el y los se del las por no con su para es al lo"
).split()


class Rule(NamedTuple):
    """`over` per `under` must lie between `least` and `most`; no words count as a ratio of 0."""
    name: str
    over: str
    under: str
    least: float
    most: float


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols", "n_symbols", "n_words", 0.0, 0.3),
    Rule("shouts", "n_shouts", "n_words", 0.0, 0.3),
    Rule("stop_words", "n_stop_words", "n_words", 0.05, 1.0),
    Rule("equal_lines", "n_dup_lines", "n_lines", 0.0, 0.5),
)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of each text of (doc_id, text)."""
    stops = ", ".join(f"'{word}'" for word in STOP_WORDS)
    words = docs.select(
        F.col("doc_id").cast("long"),
        F.expr("coalesce(text, '')").alias("text"),
        F.expr(f"array_remove(split(coalesce(text, ''), '{SPACE}+'), '')").alias("words"))
    windows = words.select(
        "doc_id", "text", "words",
        F.expr("CASE WHEN size(words) >= 3 THEN transform(sequence(0, size(words) - 3), i -> concat("
               "get(words, i), ' ', get(words, i + 1), ' ', get(words, i + 2))) END").alias("windows"),
        F.expr(f"filter(split(text, '\\n'), l -> l rlike '{SPACE.replace('[', '[^')}')").alias("lines"))
    marked = windows.select(
        "doc_id", "text", "words", "lines",
        F.expr("CASE WHEN size(array_distinct(windows)) < size(windows) THEN "
               "sort_array(transform(windows, (w, i) -> struct(w AS w, i AS i))) END").alias("sorted"))
    placed = marked.select(
        "doc_id", "text", "words", "lines",
        F.expr("sort_array(filter(transform(sorted, (e, j) -> CASE WHEN e.w <=> get(sorted, j - 1).w "
               "OR e.w <=> get(sorted, j + 1).w THEN e.i ELSE -1 END), p -> p >= 0))").alias("places"))
    return placed.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.expr("regexp_count(text, '[#*$%&|<>]')").cast("long").alias("n_symbols"),
        F.expr("regexp_count(text, '!')").cast("long").alias("n_shouts"),
        F.expr(f"size(filter(words, w -> lower(w) IN ({stops})))").cast("long").alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("coalesce(aggregate(transform(places, (p, k) -> least(3, coalesce(get(places, k + 1), p + 3) - p)), "
               "0L, (a, x) -> a + x), 0L)").alias("n_repeat_words"))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one condition; null or missing words never pass by accident."""
    passed = F.lit(True)
    for rule in rules:
        ratio = F.when(F.col(rule.under) > 0, F.col(rule.over) / F.col(rule.under)).otherwise(F.lit(0.0))
        passed = passed & ratio.between(rule.least, rule.most)
    return passed


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of (doc_id, text): the measures, base_failed and kept."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return (measures(docs).withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & verdict(rules)))
