"""Repeated passages by sparse suffixes, grouped by fingerprints.

Suffixes are kept only at minimiser positions: of each window of MIN_WORDS words, the place of its
K-word phrase with the smallest hash. Equal windows have equal minimisers, so every passage of
MIN_WORDS words or more that occurs twice has kept suffixes at the same places of both copies.

A kept suffix stands for the run of windows whose minimiser it is, and has fingerprints of the phrase at the
minimiser and of the whole stretch of words that the run covers. Nothing is sorted, no neighbours are compared and
no match is extended word by word: the neighbour with the longest common words to the right of a minimiser need not be the one
that agrees to its left, so neighbours alone would lose windows. Suffixes are grouped instead:

* Suffixes with the same phrase and stretch match over all of it. All but the first (by doc_id and place) are repeats.
* Suffixes with the same phrase but different stretches match over a part at most. Of each
  stretch only the first occurrence is taken further: the fingerprints of all its windows are grouped by
  phrase and window.

Equal keys meet by hash-partitioned grouping with map-side combining instead of one global sort; a phrase that a third of all documents hold is one row per task
there, and rows get their group's first occurrence by joins that adaptive execution can split. Phrase and
stretch (or window) are compared by 128 bits together.

A word is a repeat if it lies in a window of MIN_WORDS words that occurs earlier (smaller doc_id, or the
same document and an earlier place). Words are compared with A-Z lower-cased.

Defined cases: a null text has no words; texts below MIN_WORDS words have no windows; equal rows are
ordered by the row number; a null doc_id sorts first; columns beside id and text are not read by the
search and are kept by the removal.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.near_dedup import _mixed, hashed_words, windows_of
from caudal.llm.shared import in_batches, keyed_join, numbered, release, scope, staged, unused

MIN_WORDS = 50
PHRASE = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return (np.cumprod(np.full(size, _BASE)), np.cumprod(np.full(size, _INVERSE)))


class Fingerprints:
    """Fingerprints of stretches of one text's words, from running sums of a polynomial."""

    def __init__(self, words: np.ndarray):
        size = 1 << max(14, len(words).bit_length())
        powers, self._inverse = _powers(size)
        self._sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * powers[:len(words)], out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return _mixed(value ^ _mixed((ends - starts).astype(np.uint64)))


def runs_of(words: np.ndarray, min_words: int = MIN_WORDS, phrase: int = PHRASE):
    """(phrase hash, stretch fingerprint, first window, last window) of each kept suffix, and Fingerprints."""
    if len(words) < min_words:
        return None
    phrases = windows_of(words, phrase)
    place = np.arange(len(phrases), dtype=np.uint64)
    least = (phrases & np.uint64(0xFFFFFFFF00000000)) | place  # leftmost of equal ones
    width, reach = min_words - phrase + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if width > reach:
        least = np.minimum(least[:-(width - reach)], least[width - reach:])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)  # the minimiser of each window
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    prints = Fingerprints(words)
    keys = phrases[at[first]].view(np.int64)
    # The place of the minimiser in the stretch is part of its identity.
    stretches = _mixed(prints.of(first, last + min_words) ^ (at[first] - first).astype(np.uint64))
    return keys, stretches.view(np.int64), first, last, prints


def _kept_suffixes(docs: DataFrame, min_words: int, phrase: int) -> DataFrame:
    def each(columns):
        out = {k: [] for k in ("doc_id", "row", "phrase", "stretch", "first", "last")}
        for doc_id, row, text in zip(columns["doc_id"], columns["row"], columns["text"], strict=True):
            runs = runs_of(hashed_words(text), min_words, phrase)
            if runs is None:
                continue
            keys, stretches, first, last, _ = runs
            out["doc_id"].extend([doc_id] * len(keys))
            out["row"].append(np.full(len(keys), row))
            for name, values in (("phrase", keys), ("stretch", stretches), ("first", first), ("last", last)):
                out[name].append(values)
        yield out | {name: np.concatenate(out[name]) if out[name] else np.zeros(0, np.int64)
                     for name in ("row", "phrase", "stretch", "first", "last")}

    return in_batches(docs, each, "doc_id long, row long, phrase long, stretch long, first int, last int")


def _windows(docs: DataFrame, wanted: DataFrame, min_words: int, phrase: int) -> DataFrame:
    """Every window of the wanted runs: phrase, window fingerprint, doc_id, row, place."""
    asked = wanted.groupBy("row").agg(F.collect_list("first").alias("firsts"))

    def each(columns):
        out = {k: [] for k in ("phrase", "window", "doc_id", "row", "place")}
        for row, doc_id, firsts, text in zip(
                columns["row"], columns["doc_id"], columns["firsts"], columns["text"], strict=True):
            keys, _, first, last, prints = runs_of(hashed_words(text), min_words, phrase)
            by_start = {start: n for n, start in enumerate(first.tolist())}
            for n in map(by_start.__getitem__, firsts.tolist()):
                places = np.arange(first[n], last[n] + 1)
                out["window"].append(prints.of(places, places + min_words).view(np.int64))
                out["place"].append(places)
                out["phrase"].append(np.full(len(places), keys[n]))
                out["row"].append(np.full(len(places), row))
                out["doc_id"].extend([doc_id] * len(places))
        yield out | {name: np.concatenate(out[name]) if out[name] else np.zeros(0, np.int64)
                     for name in ("phrase", "window", "row", "place")}

    return in_batches(asked.join(docs, "row"), each, "phrase long, window long, doc_id long, row long, place int",
                      "row", "doc_id", "firsts", "text")


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, phrase: int = PHRASE,
                      number: str | None = None) -> DataFrame:
    """One row per maximal stretch of repeated words: doc_id, row, start_word, end_word, source_ids.

    The end is exclusive; source_ids are the documents in which its windows occur first. `number` is a column that
    numbers the rows the same at each reading; without it the rows are numbered here.
    """
    with scope() as work:
        if number is None:
            docs = docs.select("doc_id", "text")
            number = "row"
            docs = numbered(docs, number)
        docs = docs.select(F.col("doc_id").cast("long"), "text", F.col(number).alias("row"))
        everything = staged(_kept_suffixes(docs, min_words, phrase), "zstd")
        repeated = everything.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("phrase")
        suffixes = staged(keyed_join(everything, repeated, ["phrase"], "left_semi"), "zstd")
        work.drop(everything)
        release(docs.sparkSession)
        stretches = staged(suffixes.groupBy("phrase", "stretch").agg(
            F.min(F.struct("doc_id", "row", "first", "last")).alias("origin"), F.count(F.lit(1)).alias("copies")), "zstd")
        whole = staged(
            keyed_join(suffixes, stretches.filter("copies > 1"), ["phrase", "stretch"])
            .filter("NOT (row = origin.row AND first = origin.first)")
            .select("doc_id", "row", F.col("first").alias("start"), (F.col("last") + min_words).alias("end"),
                    F.col("origin.doc_id").alias("source")), "zstd")
        work.drop(suffixes)
        release(docs.sparkSession)

        several = stretches.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("phrase")
        wanted = staged(keyed_join(stretches, several, ["phrase"]).select("origin.row", "origin.first"), "zstd")
        work.drop(stretches)
        release(docs.sparkSession)
        windows = staged(_windows(docs, wanted, min_words, phrase), "zstd")
        work.drop(wanted)
        release(docs.sparkSession)
        origins = windows.groupBy("phrase", "window").agg(
            F.min(F.struct("doc_id", "row", "place")).alias("origin"), F.count(F.lit(1)).alias("copies"))
        parts = (keyed_join(windows, origins.filter("copies > 1"), ["phrase", "window"])
                 .filter("NOT (row = origin.row AND place = origin.place)")
                 .select("doc_id", "row", F.col("place").alias("start"), (F.col("place") + min_words).alias("end"),
                         F.col("origin.doc_id").alias("source")))

        in_text = Window.partitionBy("row").orderBy("start", "end")
        reach = F.max("end").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
        joined = (whole.unionByName(parts)
                  .withColumn("_new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
                  .withColumn("_stretch", F.sum("_new").over(in_text)))
        return work.result(joined.groupBy("row", "_stretch").agg(
            F.first("doc_id").alias("doc_id"), F.min("start").alias("start_word"), F.max("end").alias("end_word"),
            F.sort_array(F.collect_set("source")).alias("source_ids")).drop("_stretch"), "zstd")


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after them."""
    data = text.encode()
    starts = [m.start() for m in _WORD.finditer(data)] + [len(data)]
    out, kept = [], 0
    for first, end in sorted(spans):
        out.append(data[kept:starts[first]])
        kept = max(kept, starts[end])
    out.append(data[kept:])
    return b"".join(out).decode()


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, phrase: int = PHRASE) -> DataFrame:
    """The documents without their repeated passages, all columns kept; n_chars, if there, follows the text.

    Each row loses its own passages, also among rows with one doc_id or none. A row of which no word stays is left out.
    """
    columns, schema = list(docs.columns), docs.schema
    number, found = unused(docs, "number"), unused(docs, "spans")
    docs = numbered(docs, number)
    spans = (repeated_passages(docs, min_words, phrase, number).groupBy(F.col("row").alias(number))
             .agg(F.collect_list(F.struct("start_word", "end_word")).alias(found)))

    def each(batch):
        out = {name: [] for name in columns}
        for row in zip(*(batch[name] for name in [*columns, found]), strict=True):
            values, spans = dict(zip(columns, row[:-1], strict=True)), row[-1]
            if spans:
                text = without_words(values["text"], [(s["start_word"], s["end_word"]) for s in spans])
                if not text.encode().split():
                    continue
                values["text"] = text
                if "n_chars" in values:
                    values["n_chars"] = len(text)
            for name, value in values.items():
                out[name].append(value)
        yield out

    return in_batches(docs.join(spans, number, "left").drop(number), each, schema)
