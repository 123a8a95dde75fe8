"""Spelling variants of the words of a corpus, by dense prefix-suffix tiling.

1. Letter runs of every text are counted for each batch and then over the corpus. By a checksum of id and
   run, one run in DROP_EVERY loses a letter; these are the misspellings that the search should lead back.
2. Two words are near if they differ by one inserted, deleted or replaced code point. Let `size` be the length of the
   shorter one. The edit leaves either the first size // 2 code points or the rest of them as they are, so near words meet
   in a group of (size, side, that half). Words of `size` and `size + 1` code points take part.
3. A group is compared in tiles: its words are rows of two padded code-point matrices, one aligned left and one right.
   For a tile of two blocks, columns are compared until words part: common prefix and common suffix. A
   pair whose prefix plus suffix reaches the longer length minus one is one edit apart. A pair that has both halves in
   common counts on the left side only.
4. A tile gives each word's number of near words and its best one, never pairs. Groups of more than BLOCK words are dealt into
   blocks, and each pair of blocks is a task's group of its own; small groups share tiles, kept apart by a mask.
5. A word's form is the near word that is most frequent, if it is RATIO times as frequent. Roots follow the
   forms by pointer doubling; a form has at least ten times its word's count, so paths are short.

Defined cases: a null text has no words; a null doc_id is the empty text in the checksum; repeated rows count again; equal
counts are decided by code-point order; words of any length are compared whole; an empty table gives an empty result; columns beside id
and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.shared import dealt, in_batches, keyed_join, scope, staged

LEAST = 7
DROP_EVERY = 31
MIN_COUNT = 2
RATIO = 10
BLOCK = 2048
AT_ONCE = 50_000
TILE = 256
CELLS = 1 << 22  # code points of the rows of one tile at most, but for a single pair of rows
_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}
_STATS = "word string, n_near long, best_n long, best string"


def spelled(doc_id, run: str, every: int = DROP_EVERY) -> str:
    """The run without the code point that the checksum of id and run picks, if it picks one."""
    value = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if value % every:
        return run
    at = value % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least: int = LEAST, every: int = DROP_EVERY) -> DataFrame:
    """word, n: how often each word of at least `least` code points occurs."""
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")

    def each(columns):
        found: Counter[str] = Counter()
        for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
            for run, times in Counter(runs.findall((text or "").translate(_LOWER))).items():
                word = spelled(doc_id, run, every)
                if len(word) >= least:
                    found[word] += times
        yield {"word": list(found), "n": list(found.values())}

    counted = in_batches(docs.select(F.col("doc_id").cast("long"), "text"), each, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def halves(words: DataFrame, least: int = LEAST) -> DataFrame:
    """word, n and each group that it is compared in: size, side (0 left, 1 right), cluster."""
    length = F.char_length("word")
    rows = words.withColumn("size", F.explode(F.array(length, length - 1))).filter(F.col("size") >= least)
    rows = rows.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    first = (F.col("size") / 2).cast("int")
    # From the left, size // 2 code points; from the right, the rest of the shorter word.
    half = F.when(F.col("side") == 0, F.substr("word", F.lit(1), first)).otherwise(
        F.substr("word", length - (F.col("size") - first) + 1))
    return rows.select("word", "n", "size", "side", F.xxhash64("size", "side", half).alias("cluster"))


class Matrices:
    """Words as code points, aligned left and right and padded; their runs have code points below 256."""

    def __init__(self, words: list[str]):
        data = [word.encode("latin-1") for word in words]
        self.lengths = np.array([len(d) for d in data])
        width = int(self.lengths.max())
        self.left = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in data), np.uint8).reshape(-1, width)
        self.right = np.frombuffer(b"".join(d.rjust(width, b"\0") for d in data), np.uint8).reshape(-1, width)[:, ::-1]


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many first columns each row of `a` has in common with each row of `b`."""
    same = np.ones((len(a), len(b)), bool)
    count = np.zeros((len(a), len(b)), np.int32)
    for column in range(a.shape[1]):
        same &= a[:, column, None] == b[None, :, column]
        if not same.any():
            break
        count += same
    return count


def tile(words: Matrices, a: slice | np.ndarray, b: slice | np.ndarray, size: int, side: int) -> np.ndarray:
    """Which rows of `a` and `b` are one edit apart, as far as this group decides it."""
    prefix = _common(words.left[a], words.left[b])
    shorter = np.minimum.outer(words.lengths[a], words.lengths[b])
    longer = np.maximum.outer(words.lengths[a], words.lengths[b])
    fits = (prefix >= size // 2 if side == 0 else prefix < size // 2) & (shorter == size)
    if not fits.any():
        return fits
    suffix = _common(words.right[a], words.right[b])
    return fits & (prefix + suffix >= longer - 1)


def near_pairs(words: Matrices, clusters: np.ndarray, size: int, side: int, left: np.ndarray | None = None,
               right: np.ndarray | None = None):
    """Places (i, j) of near words. Rows are sorted by cluster, or `left` and `right` are two blocks of one cluster."""
    step = max(1, min(TILE, CELLS // (words.left.shape[1] * TILE) or 1))
    found_i, found_j = [], []

    def take(a: np.ndarray, b: np.ndarray, within: bool) -> None:
        near = tile(words, a, b, size, side)
        if within:
            near &= (clusters[a][:, None] == clusters[b][None, :]) & (a[:, None] < b[None, :])
        i, j = np.nonzero(near)
        found_i.append(a[i])
        found_j.append(b[j])

    if left is not None:
        for at in range(0, len(left), step):
            for to in range(0, len(right), step):
                take(left[at:at + step], right[to:to + step], False)
    else:
        rows = len(clusters)
        ends = np.searchsorted(clusters, clusters, side="right")  # of each row's cluster
        for at in range(0, rows, step):
            own = np.arange(at, min(at + step, rows))
            for to in range(at, int(ends[own[-1]]), step):
                take(own, np.arange(to, min(to + step, rows)), True)
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def _compared(rows: pd.DataFrame) -> pd.DataFrame:
    """Near words of all rows of a part: for each word their number and the best of them."""
    out = []
    for (size, side, low, high), group in rows.groupby(["size", "side", "low", "high"], sort=False):
        whole = low == high
        # In a part of its own, a cluster's block meets itself or another one; else clusters are told apart.
        group = group.sort_values("cluster", kind="stable")
        words = group["word"].to_numpy()
        own = group["own"].to_numpy()
        i, j = near_pairs(Matrices(words.tolist()), group["cluster"].to_numpy(), int(size), int(side),
                          *(() if whole else (np.flatnonzero(own), np.flatnonzero(~own))))
        if len(i):
            counts = group["n"].to_numpy()
            here, there = np.concatenate([i, j]), np.concatenate([j, i])
            out.append(pd.DataFrame({"word": words[here], "best_n": counts[there], "best": words[there]}))
    if not out:
        return pd.DataFrame({"word": [], "n_near": [], "best_n": [], "best": []})
    pairs = pd.concat(out).sort_values(["word", "best_n", "best"], ascending=[True, False, True])
    best = pairs.groupby("word", sort=False)
    return best.first().join(best.size().rename("n_near")).reset_index()[["word", "n_near", "best_n", "best"]]


def near_words(words: DataFrame, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """word, n_near, best_n, best of the words that have near ones."""
    entries = halves(words, least)
    sizes = entries.groupBy("cluster").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    with scope() as work:
        shared = staged(keyed_join(entries, sizes, ["cluster"]).withColumn("uid", F.xxhash64("word")))
        parts = dealt(shared, "members", block, AT_ONCE, shared.count())
        stats = (parts.groupBy("part").applyInPandas(_compared, _STATS).groupBy("word").agg(
            F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("top")))
        return work.result(stats.select("word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.best")))


def roots_of(forms: DataFrame) -> DataFrame:
    """word, root: where the forms lead, each step doubling the distance."""
    with scope() as work:
        roots = staged(forms.select("word", F.col("form").alias("root")))
        while True:
            further = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
            moved = staged(keyed_join(roots, further, ["root"], "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
            work.drop(roots)
            roots = moved.drop("_moved")
            done = moved.filter("_moved").isEmpty()
            if done:
                return work.result(roots)


def spelling_variants(docs: DataFrame, least: int = LEAST, every: int = DROP_EVERY, min_count: int = MIN_COUNT,
                      ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    with scope() as work:
        words = staged(word_counts(docs, least, every).filter(F.col("n") >= min_count))
        near = near_words(words, least, block)
        fits = F.col("best_n") >= ratio * F.col("n")
        known = staged(words.join(near, "word", "left").select(
            "word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(fits, F.col("best_n")).alias("form_n")))
        roots = roots_of(known.filter("form IS NOT NULL"))
        return work.result(known.join(roots, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
