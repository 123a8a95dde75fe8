"""MinHash near-dedup with sequential Bayesian verification.

1. Each text becomes the set of its five-word shingles, as sorted 64-bit hashes, and a signature of
   BANDS * ROWS minimum hashes. Texts with the same words are one class from here on (equal digest
   of the word sequence), so copies are never compared.
2. Classes that agree on all rows of a band share a bucket. A pair at the threshold misses all bands with a
   probability of 1e-7 (similarity 0.85; 2e-5 at 0.8).
3. In a bucket, signatures are compared batch by batch. After each batch a pair is pruned if, given its
   agreements, the posterior probability that its similarity reaches the threshold is below MISS; the
   posterior under a uniform prior is a beta distribution, so this is a least number of agreements for each
   batch. The surviving pairs of a bucket only need to be known up to connection: a spanning forest
   of them is emitted, not the pairs. A bucket of more than BLOCK classes is a star first, each member against four
   centres; only members that are not connected by then meet the others, in blocks.
4. Each class is verified on the full sets against one survivor, its smallest one: two texts for each class. What is
   linked is contracted. The other survivors connect components to clusters; all links that are left lie within them.
5. In each cluster, members outside the largest component meet all members: pairs of different
   components are pruned the same way, and survivors are verified on the full sets. Again a spanning forest is
   emitted, now of exact links.
6. Connected components of the exact links; every row gets its class's component.

No group grows with the data, and rows are copied about twice where a bucket or cluster is mostly connected, whatever its
size. Only where thousands of classes are alike in their signatures but are not linked, copies and comparisons grow
with their number times the cluster's, in blocks of BLOCK.

Defined cases: a null text or a text without words has an empty set, no links and is its own
component; fewer than five words are one shingle; equal rows are linked like other copies; a null doc_id
takes part, and gives a null component where no other id is in it; columns beside id and text are not
read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.components import components, refined
from caudal.llm.shared import crossing, dealt, in_batches, keyed_join, numbered, release, scope, staged

SHINGLE = 5
PERCENT = 85
ROWS = 5
BANDS = 27
BATCH = 27
MISS = 1e-6
BLOCK = 1024
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            self[word] = value
        return value


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def hashed_words(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased; bytes.split() splits at the same six characters."""
    words = (text or "").encode().lower().split()
    return np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))


def windows_of(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of `size` words; a shorter text is one window."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = _mixed(out * _MIX + words[k:len(words) - size + 1 + k])
    return out


@lru_cache(maxsize=4)
def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240229)
    return (random.integers(0, 1 << 32, (count, 1), dtype=np.uint32) | np.uint32(1),
            random.integers(0, 1 << 32, (count, 1), dtype=np.uint32))


def signature(shingles: np.ndarray, count: int) -> np.ndarray:
    """Minima of `count` hash functions over the set."""
    factors, terms = _functions(count)
    least = np.full(count, 0xFFFFFFFF, np.uint32)
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    for at in range(0, len(folded), 512):
        np.minimum(least, (factors * folded[at:at + 512] + terms).min(axis=1), out=least)
    return least


def band_keys(minima: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One 64-bit key for each band, of its number and its rows."""
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    table = minima.reshape(bands, rows).astype(np.uint64)
    for row in range(rows):
        keys = _mixed(keys * _MIX + table[:, row])
    return keys.view(np.int64)


def short(minima: np.ndarray) -> bytes:
    """16 bits of each minimum: enough to compare, as unequal minima agree once in 65,536 times."""
    return ((minima * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2").tobytes()


@lru_cache(maxsize=8)
def least_agreements(threshold: float, count: int, batch: int, miss: float) -> tuple[int, ...]:
    """For each batch, the least agreements so far that leave the threshold a posterior above `miss`."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for seen in range(batch, count + 1, batch):
        for agreements in range(seen + 1):
            logs = agreements * np.log(grid) + (seen - agreements) * np.log1p(-grid)
            weights = np.exp(logs - logs.max())
            if weights[grid >= threshold].sum() / weights.sum() >= miss:
                break
        out.append(agreements)
    return tuple(out)


def survivors(left: np.ndarray, right: np.ndarray, threshold: float, same: bool):
    """Pairs (i, j) of rows of two signature matrices that no batch pruned, likeliest first."""
    count = left.shape[1]
    bounds = least_agreements(threshold, count, BATCH, MISS)
    found_i, found_j, found_n = [], [], []
    for i in range(len(left)):
        first = i + 1 if same else 0
        rows = np.arange(first, len(right))
        agreed = np.zeros(len(rows), np.int64)
        for step, bound in enumerate(bounds):
            part = slice(step * BATCH, (step + 1) * BATCH)
            agreed += (right[rows, part] == left[i, part]).sum(axis=1)
            stay = agreed >= bound
            rows, agreed = rows[stay], agreed[stay]
            if not len(rows):
                break
        if len(rows):
            found_i.append(np.full(len(rows), i))
            found_j.append(rows)
            found_n.append(agreed)
    if not found_i:
        return []
    i, j, n = map(np.concatenate, (found_i, found_j, found_n))
    order = np.argsort(-n, kind="stable")
    return zip(i[order].tolist(), j[order].tolist(), strict=True)


class Forest:
    """Union-find over the rows of one group."""

    def __init__(self, size: int):
        self._above = list(range(size))

    def root(self, node: int) -> int:
        above = self._above
        while above[node] != node:
            above[node] = above[above[node]]
            node = above[node]
        return node

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self._above[max(a, b)] = min(a, b)
        return a != b


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union holds for two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    place = np.searchsorted(a, b)
    place[place == len(a)] = 0
    shared = int((a[place] == b).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def signed_documents(docs: DataFrame, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """uid, doc_id, n_shingles, the digest of the words, band keys and the signature."""
    def each(columns):
        out = {k: [] for k in ("uid", "doc_id", "n_shingles", "words", "bands", "signature")}
        for uid, doc_id, text in zip(columns["uid"], columns["doc_id"], columns["text"], strict=True):
            shingles = np.unique(windows_of(hashed_words(text), SHINGLE))
            out["uid"].append(uid)
            out["doc_id"].append(doc_id)
            out["n_shingles"].append(len(shingles))
            if not len(shingles):
                for name in ("words", "bands", "signature"):
                    out[name].append(None)
                continue
            minima = signature(shingles, rows * bands)
            sequence = b" ".join(text.encode().lower().split())
            out["words"].append(hashlib.blake2b(sequence, digest_size=16).digest())
            out["bands"].append(band_keys(minima, rows, bands))
            out["signature"].append(short(minima))
        yield out

    return in_batches(docs, each,
                      "uid long, doc_id long, n_shingles long, words binary, bands array<long>, signature binary")


def _forest(threshold: float):
    """A function from the rows of a part to a spanning forest (a, b) of the surviving pairs in its clusters."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found_a, found_b = [], []
        for _, group in rows.groupby("cluster", sort=False):
            group = group.sort_values("uid", kind="stable")
            uids = group["uid"].to_numpy()
            minima = np.frombuffer(b"".join(group["signature"]), "<u2").reshape(len(group), -1)
            forest = Forest(len(group))
            for i, j in survivors(minima, minima, threshold, True):
                if forest.join(i, j):
                    found_a.append(uids[j])
                    found_b.append(uids[i])
        return pd.DataFrame({"a": np.array(found_a, np.int64), "b": np.array(found_b, np.int64)})
    return run


def _across(threshold: float, percent: int | None):
    """A function from a part of `crossing` to links (a, b), one for each two labels it connects.

    With `percent`, links are verified on the full sets of the texts, and are given as labels; without it
    survivors are links, given as the classes themselves.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = [links(group) for _, group in rows.groupby(["cluster", "_block", "_chunk"], sort=False)]
        pairs = np.array([pair for pairs in found for pair in pairs], np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs.max(axis=1), "b": pairs.min(axis=1)})

    def links(group: pd.DataFrame) -> list[tuple[int, int]]:
        minor = group["minor"].to_numpy()
        left, right = np.flatnonzero(minor), np.flatnonzero(~minor)
        out = []
        if len(left) and len(right):
            ends = group["label" if percent else "uid"].to_numpy()
            names, places = np.unique(group["label"].to_numpy(), return_inverse=True)
            forest = Forest(len(names))
            minima = np.frombuffer(b"".join(group["signature"]), "<u2").reshape(len(group), -1)
            texts = group["text"].tolist() if percent else None
            sets: dict[int, np.ndarray] = {}

            def shingles(place: int) -> np.ndarray:
                if place not in sets:
                    sets[place] = np.unique(windows_of(hashed_words(texts[place]), SHINGLE))
                return sets[place]

            for i, j in survivors(minima[left], minima[right], threshold, False):
                i, j = int(left[i]), int(right[j])
                if forest.root(places[i]) != forest.root(places[j]) and (
                        percent is None or similar(shingles(i), shingles(j), percent)):
                    forest.join(places[i], places[j])
                    out.append((ends[i], ends[j]))
        return out
    return run


def _surviving(threshold: float):
    """Batches (uid, signature, centre, other) to the links that no batch of the signature prunes."""
    def each(columns):
        a, b = [], []
        for uid, own, centre, other in zip(*(columns[c] for c in ("uid", "signature", "centre", "other")), strict=True):
            pair = [np.frombuffer(data, "<u2").reshape(1, -1) for data in (own, other)]
            if list(survivors(*pair, threshold, False)):
                a.append(max(uid, centre))
                b.append(min(uid, centre))
        yield {"a": a, "b": b}
    return each


def verified(edges: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) whose two texts are similar on their full sets."""
    def each(columns):
        kept = [similar(*(np.unique(windows_of(hashed_words(text), SHINGLE)) for text in pair), percent)
                for pair in zip(columns["left"], columns["right"], strict=True)]
        yield {name: [v for v, keep in zip(columns[name], kept, strict=True) if keep] for name in ("a", "b")}

    # Both joins may meet a hot smaller end: many classes are verified against one.
    texts = keyed_join(edges, docs.select(F.col("uid").alias("a"), F.col("text").alias("left")), ["a"])
    texts = keyed_join(texts, docs.select(F.col("uid").alias("b"), F.col("text").alias("right")), ["b"])
    return in_batches(texts, each, "a long, b long", "a", "b", "left", "right")


def candidate_edges(reps: DataFrame, threshold: float, block: int) -> DataFrame:
    """Edges (a, b), a > b, that connect all classes whose signatures survive in a common bucket."""
    with scope() as work:
        entries = reps.select("uid", F.explode("bands").alias("cluster"))
        signed = reps.select("uid", "signature")
        sizes = entries.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        shared = staged(keyed_join(entries, sizes, ["cluster"]), "zstd")
        few = shared.filter(F.col("size") <= block)
        parts = dealt(few.join(signed, "uid"), "size", block, 4 * block, few.count())
        edges = staged(parts.groupBy("part").applyInPandas(_forest(threshold), "a long, b long").distinct())
        many = shared.filter(F.col("size") > block)
        if not many.isEmpty():
            random = F.struct(F.xxhash64("uid", "cluster"), "uid")
            centres = many.groupBy("cluster").agg(F.array(
                F.min("uid"), F.max("uid"), F.min(random)["uid"], F.max(random)["uid"]).alias("centres"))
            pairs = (keyed_join(many, centres, ["cluster"])
                     .select("uid", F.explode("centres").alias("centre")).filter("uid != centre").distinct())
            pairs = keyed_join(pairs, signed.withColumnsRenamed({"uid": "centre", "signature": "other"}), ["centre"])
            star = in_batches(pairs.join(signed, "uid"), _surviving(threshold), "a long, b long",
                              "uid", "signature", "centre", "other")
            edges = staged(edges.unionByName(star).distinct())
            labels = components(edges).select(F.col("id").alias("uid"), F.col("component").alias("label"))
            named = (many.join(labels, "uid", "left").withColumn("label", F.coalesce("label", "uid"))
                     .join(signed, "uid").select("cluster", "uid", "label", "signature"))
            rest = crossing(named, "cluster", "label", block).groupBy("part").applyInPandas(
                _across(threshold, None), "a long, b long")
            edges = edges.unionByName(rest).distinct()
        return work.result(edges)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS,
                    block: int = BLOCK, number: str | None = None) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, n_shingles, component_id, kept (and `number`, if given).

    `number` is a column that numbers the rows the same at each reading; without it they are numbered here.
    """
    threshold = percent / 100
    with scope() as work:
        if number is None:
            docs = numbered(docs.select("doc_id", "text"), "uid")
        docs = docs.select(F.col("doc_id").cast("long"), "text", F.col(number or "uid").alias("uid"))
        signed = staged(signed_documents(docs, rows, bands))
        classes = staged(signed.filter("words IS NOT NULL").groupBy("words").agg(F.min("uid").alias("class")))
        reps = staged(signed.join(classes.select(F.col("class").alias("uid")), "uid", "left_semi")
                      .select("uid", "bands", "signature"))
        edges = candidate_edges(reps, threshold, block)
        release(docs.sparkSession)

        first = staged(verified(edges.groupBy("a").agg(F.min("b").alias("b")), docs, percent))
        known = components(first)
        # Edges between what is not connected yet, and the clusters that they make of it.
        ends = {c: known.select(F.col("id").alias(c), F.col("component").alias(f"_{c}")) for c in ("a", "b")}
        open_edges = keyed_join(keyed_join(edges, ends["a"], ["a"], "left"), ends["b"], ["b"], "left").select(
            F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).filter("a != b").distinct()
        open_edges = staged(open_edges)
        exact = known
        if not open_edges.isEmpty():
            clusters = components(open_edges).select(F.col("id").alias("label"), F.col("component").alias("cluster"))
            nodes = edges.select(F.col("a").alias("uid")).unionByName(edges.select(F.col("b").alias("uid"))).distinct()
            named = (nodes.join(known.select(F.col("id").alias("uid"), F.col("component").alias("label")), "uid", "left")
                     .withColumn("label", F.coalesce("label", "uid")))
            named = keyed_join(named, clusters, ["label"]).join(reps.select("uid", "signature"), "uid")
            rest = crossing(named, "cluster", "label", block)
            met = rest.join(docs.select("uid", "text"), "uid")
            second = met.groupBy("part").applyInPandas(_across(threshold, percent), "a long, b long")
            exact = refined(known, staged(second.distinct()))

        linked = (keyed_join(signed.select("uid", "doc_id", "n_shingles", "words"), classes, ["words"], "left")
                  .join(exact.select(F.col("id").alias("class"), "component"), "class", "left")
                  .withColumn("root", F.coalesce("component", "class", "uid")))
        linked = work.result(linked.select("uid", "doc_id", "n_shingles", "root"), "zstd")
    least = linked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("least"))
    return keyed_join(linked, least, ["root"]).select(
        "doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"),
        (F.col("uid") == F.col("least.uid")).alias("kept"),
        *([F.col("uid").alias(number)] if number else []))
