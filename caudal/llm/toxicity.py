"""Toxicity by a convolutional text classifier, trained here in numpy.

A text is the sequence of its words (A-Z lower-cased, punctuation at the edges dropped). A word's vector
is the sum of hashed embeddings of the word and of its beginnings. Filters of several widths slide over the sequence; each filter's largest response over the
whole text, rectified, feeds a logistic output. Training is stochastic gradient descent with AdaGrad; through the
max pooling a gradient reaches one window for each text and filter only.

The classifier is fitted on at most SAMPLE labelled documents, the first ones by a hash of doc_id; all
documents are scored over their whole texts. A fifth of the labels (crc32 of doc_id mod 5 is 0) is held out, and
another fifth is not trained on but calibrates a threshold for each language: all its documents are scored, and
thresholds come from histograms of the scores. A language without both labels there has the threshold of all
languages together. `flagged` is score >= threshold. The language never enters a score.

Defined cases: a null text is empty and gets the score of a text without words; a null doc_id is not
held out; labels that disagree on a document count as toxic; labels without a document, without a
value, or documents without a label only lack training; without any labels all scores are 0.5 and nothing is flagged
unless it reaches the default threshold; columns beside doc_id, text and lang are not read.
"""

from __future__ import annotations

import string
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.shared import in_batches, staged
from caudal.llm.token_files import id_lists

SAMPLE = 8000
FOLDS = 5
BUCKETS = 1 << 18
WIDTH = 8
FILTERS = 8
SPANS = (1, 2, 3)
PREFIXES = (4, 5, 6, 7)
PARTS = 1 + len(PREFIXES)
WORDS_KEPT = 300_000
SEEN = 36_000  # documents shown in training, over as many epochs as that takes
RATE = 0.08
DEFAULT = 0.5
BINS = 10_000
WORDS_AT_ONCE = 1 << 16
_EDGES = string.punctuation.encode()


def features_of(word: bytes) -> list[int]:
    """Buckets of a word and of its beginnings; a word no longer than a beginning repeats its own bucket."""
    text = word.strip(_EDGES).decode(errors="replace")
    own = zlib.crc32(text.encode()) % BUCKETS
    return [own, *(zlib.crc32(b"\0" + text[:n].encode()) % BUCKETS if len(text) > n else own for n in PREFIXES)]


class _Words(dict):
    """Words to rows of a table of their features; both are emptied when they are full."""

    def __init__(self):
        self.features = np.zeros((1 << 16, PARTS), np.int32)

    def __missing__(self, word: bytes) -> int:
        row = len(self)
        if row == len(self.features):
            self.features = np.concatenate([self.features, np.zeros_like(self.features)])
        self.features[row] = features_of(word)
        self[word] = row
        return row


@lru_cache(maxsize=1)
def _words() -> _Words:
    return _Words()


def word_ids(text: str | None) -> np.ndarray:
    """Feature buckets of each word of a text, one row per word."""
    known = _words()
    if len(known) > WORDS_KEPT:
        known.clear()
    words = (text or "").encode().lower().split()
    rows = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    return known.features[rows]


def _padding(places: int) -> np.ndarray:
    return np.full((places, PARTS), BUCKETS, np.int32)


class TextCnn:
    """Embeddings, one filter bank per width, and the logistic output. The last embedding is the padding."""

    def __init__(self, seed: int = 7):
        random = np.random.default_rng(seed)
        self.embedding = (random.standard_normal((BUCKETS + 1, WIDTH)) * 0.1).astype(np.float32)
        self.embedding[BUCKETS] = 0
        self.filters = [(random.standard_normal((span, WIDTH, FILTERS)) * 0.5).astype(np.float32) for span in SPANS]
        for bank in self.filters:  # the first number of a vector is its evidence, see `start`
            bank[:, 0] = np.abs(bank[:, 0])
        self.bias = np.zeros(len(SPANS) * FILTERS, np.float32)
        self.output = np.abs(random.standard_normal(len(SPANS) * FILTERS) * 0.3).astype(np.float32)
        self.offset = np.float32(0.0)

    def responses(self, ids: np.ndarray) -> np.ndarray:
        """Response of each filter at each place; windows reach into two places of padding at the end."""
        padded = np.concatenate([ids, _padding(SPANS[-1] - 1)])
        vectors = self.embedding[padded].sum(axis=1)
        size = len(ids)
        return np.concatenate([sum(vectors[j:j + size] @ bank[j] for j in range(len(bank)))
                               for bank in self.filters], axis=1)

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        """Logits of many texts at once, texts divided by padding."""
        gap = _padding(SPANS[-1] - 1)
        parts, starts, ends, place = [], [], [], 0
        for ids in texts:
            ids = ids if len(ids) else gap[:1]
            parts += [ids, gap]
            starts.append(place)
            ends.append(place + len(ids))
            place += len(ids) + len(gap)
        found = self.responses(np.concatenate(parts))
        bounds = np.column_stack([starts, ends]).ravel()
        pooled = np.maximum.reduceat(found, bounds, axis=0)[::2]
        return np.maximum(pooled + self.bias, 0) @ self.output + self.offset

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        out, at = [], 0
        while at < len(texts):
            end, words = at, 0
            while end < len(texts) and (end == at or words + len(texts[end]) <= WORDS_AT_ONCE):
                words += len(texts[end])
                end += 1
            out.append(self._long(texts[at]) if words > 4 * WORDS_AT_ONCE else self.logits(texts[at:end]))
            at = end
        logits = np.concatenate(out) if out else np.zeros(0)
        return 1 / (1 + np.exp(-logits.astype(np.float64)))

    def _long(self, ids: np.ndarray) -> np.ndarray:
        """One very long text, in overlapping parts; the maximum over the parts is that over the text."""
        reach = SPANS[-1] - 1
        pooled = np.full(len(self.bias), -np.inf, np.float32)
        for at in range(0, len(ids), WORDS_AT_ONCE):
            part = ids[at:at + WORDS_AT_ONCE + reach]
            inner = len(part) if at + WORDS_AT_ONCE + reach >= len(ids) else WORDS_AT_ONCE
            pooled = np.maximum(pooled, self.responses(part)[:inner].max(axis=0))
        return np.array([np.maximum(pooled + self.bias, 0) @ self.output + self.offset])

    def start(self, texts: list[np.ndarray], labels: np.ndarray) -> None:
        """Let the first number of each embedding be the log odds of label 1 for texts with that feature.

        Max pooling trains one window per filter and text, so without this start a feature of few
        texts would hardly ever be looked at. Rare features are shrunk towards zero.
        """
        found = np.zeros((2, BUCKETS + 1), np.float32)
        for ids, label in zip(texts, labels, strict=True):
            found[int(label), np.unique(ids)] += 1
        totals = np.array([(labels == 0).sum(), (labels == 1).sum()])
        odds = (np.log((found[1] + 0.5) / (totals[1] + 1)) - np.log((found[0] + 0.5) / (totals[0] + 1)))
        seen = found.sum(axis=0)
        self.embedding[:, 0] = np.clip(odds * seen / (seen + 4), -4, 4) * 0.25
        self.embedding[BUCKETS] = 0

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, seen_documents: int = SEEN, rate: float = RATE,
            batch: int = 32, seed: int = 11) -> None:
        random = np.random.default_rng(seed)
        self.start(texts, labels)
        positive = max(1, int(labels.sum()))
        weights = np.where(labels == 1, max(1.0, np.sqrt((len(labels) - positive) / positive)), 1.0).astype(np.float32)
        dense = [*self.filters, self.bias, self.output]
        seen = [np.full(p.shape, 1e-3, np.float32) for p in dense]
        seen_rows = np.full(BUCKETS + 1, 1e-3, np.float32)
        seen_offset = 1e-3
        for _ in range(-(-seen_documents // max(1, len(texts)))):
            order = random.permutation(len(texts))
            for at in range(0, len(order), batch):
                rows = order[at:at + batch]
                gradients, touched, change, offset = self._gradients(
                    [texts[r] for r in rows], labels[rows], weights[rows])
                for parameter, gradient, total in zip(dense, gradients, seen, strict=True):
                    total += gradient * gradient
                    parameter -= rate * gradient / np.sqrt(total)
                seen_rows[touched] += (change * change).mean(axis=1)
                self.embedding[touched] -= rate * change / np.sqrt(seen_rows[touched])[:, None]
                self.embedding[BUCKETS] = 0
                seen_offset += offset * offset
                self.offset = np.float32(self.offset - rate * offset / np.sqrt(seen_offset))

    def _gradients(self, texts, labels, weights):
        size, filters = len(texts), len(self.bias)
        reach = SPANS[-1] - 1
        pooled = np.empty((size, filters), np.float32)
        windows = np.empty((size, filters, SPANS[-1], PARTS), np.int64)  # features of each filter's best window
        for n, ids in enumerate(texts):
            ids = ids if len(ids) else _padding(1)
            found = self.responses(ids)
            best = found.argmax(axis=0)
            pooled[n] = found[best, np.arange(filters)]
            padded = np.concatenate([ids, _padding(reach)])
            windows[n] = padded[best[:, None] + np.arange(SPANS[-1])]
        active = pooled + self.bias > 0
        features = np.where(active, pooled + self.bias, 0)
        scores = 1 / (1 + np.exp(-(features @ self.output + self.offset)))
        error = ((scores - labels) * weights / size).astype(np.float32)
        inner = error[:, None] * self.output * active
        banks, touched, changes = [], [], []
        for k, (span, bank) in enumerate(zip(SPANS, self.filters, strict=True)):
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            gradient = np.empty_like(bank)
            for j in range(span):
                ids = windows[:, own, j]
                gradient[j] = np.einsum("nf,nfd->df", inner[:, own], self.embedding[ids].sum(axis=2))
                touched.append(ids.ravel())
                change = (inner[:, own, None] * bank[j].T[None]).reshape(-1, WIDTH)
                changes.append(np.repeat(change, PARTS, axis=0))
            banks.append(gradient)
        rows, place = np.unique(np.concatenate(touched), return_inverse=True)
        change = np.zeros((len(rows), WIDTH), np.float32)
        np.add.at(change, place, np.concatenate(changes))
        return [*banks, inner.sum(axis=0), features.T @ error], rows, change, float(error.sum())


def threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The threshold of single documents; DEFAULT without both labels."""
    order = np.argsort(scores, kind="stable")
    found = threshold_of(scores[order], scores[order], np.ones(len(order)), labels[order])
    return DEFAULT if found is None else found


def threshold_of(least: np.ndarray, most: np.ndarray, documents: np.ndarray, toxic: np.ndarray) -> float | None:
    """Where F0.5 is best: halfway between a score that is flagged and the next lower one; None without both labels.

    Documents come in groups of rising scores: the least and the largest score, all documents and toxic ones.
    """
    if not 0 < toxic.sum() < documents.sum():
        return None
    least, most, documents, toxic = least[::-1], most[::-1], documents[::-1], toxic[::-1]
    quality = 1.25 * np.cumsum(toxic) / (0.25 * toxic.sum() + np.cumsum(documents))
    at = int(np.flatnonzero(quality == quality.max())[-1])
    below = most[at + 1] if at + 1 < len(most) else 0.0
    return float(np.clip((least[at] + below) / 2, 0.05, 0.95))


def fold(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic and whether it calibrates, of each document with a label outside the held-out fold.

    Fold 1 calibrates. If it or the rest has no document, a fourth by another hash does.
    """
    marked = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(fold() != 0)
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    present = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    found = staged(marked.join(present, "doc_id").withColumn("calibrates", fold() == 1))
    if len(found.select("calibrates").distinct().collect()) < 2:
        found = found.withColumn("calibrates", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS - 1)) == 1)
        if found.filter("NOT calibrates").isEmpty():
            found = found.withColumn("calibrates", F.lit(False))
    return found


def labelled_sample(docs: DataFrame, marked: DataFrame, most: int = SAMPLE) -> DataFrame:
    """Of at most `most` labelled documents that do not calibrate: toxic and word ids."""
    chosen = (marked.filter("NOT calibrates").select("doc_id", "toxic")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))

    def each(columns):
        yield {"doc_id": columns["doc_id"], "toxic": columns["toxic"],
               "ids": id_lists([word_ids(t).tobytes() for t in columns["text"]])}

    # The sample is bounded, so that the join reads texts where they are.
    texts = (docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")
             .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    return in_batches(texts, each, "doc_id long, toxic int, ids array<int>", "doc_id", "toxic", "text")


def calibrated(scored: DataFrame, marked: DataFrame) -> dict[str | None, float]:
    """The threshold of all labelled documents that calibrate (under None) and of each language with both labels.

    `scored` has doc_id, lang and score of every document. What comes to the driver is a histogram of BINS bins for each
    language.
    """
    rows = scored.join(marked.filter("calibrates").select("doc_id", "toxic"), "doc_id")
    bins = (rows.groupBy("lang", F.floor(F.col("score") * BINS).alias("bin"))
            .agg(F.min("score").alias("least"), F.max("score").alias("most"), F.count(F.lit(1)).alias("documents"),
                 F.sum("toxic").alias("toxic")).toPandas())

    def found(part):
        part = part.groupby("bin").agg({"least": "min", "most": "max", "documents": "sum", "toxic": "sum"})
        return threshold_of(*(part[name].to_numpy(np.float64) for name in ("least", "most", "documents", "toxic")))

    pooled = found(bins)
    out = {None: DEFAULT if pooled is None else pooled}
    for language, part in bins.groupby("lang"):
        own = found(part)
        if own is not None:
            out[language] = own
    return out


def train(docs: DataFrame, marked: DataFrame, most: int = SAMPLE) -> TextCnn | None:
    """The classifier, fitted on a bounded sample of the labelled documents that do not calibrate; None without any."""
    rows = labelled_sample(docs, marked, most).toArrow().sort_by([("doc_id", "ascending")])
    if not rows.num_rows:
        return None
    texts = [np.asarray(ids.values, np.int32).reshape(-1, PARTS) for ids in rows["ids"]]
    model = TextCnn()
    model.fit(texts, rows["toxic"].to_numpy().astype(np.float32))
    return model


def toxicity(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, number: str | None = None) -> DataFrame:
    """One row per row of (doc_id, text, lang): doc_id, held_out, score, predicted, threshold, flagged.

    Every document is scored once; its score is staged, and thresholds and verdicts are read from there. `number` is a
    column that numbers the rows, which is handed out too.
    """
    marked = labelled(docs, labels)
    model = train(docs, marked, most)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS * WIDTH numbers at any input
    rows = [F.col(number).alias("row")] if number else [F.lit(0).cast("long").alias("row")]

    def each(columns):
        model = shared.value
        texts = [word_ids(text) for text in columns["text"]]
        scores = model.scores(texts) if model else np.full(len(texts), 0.5)
        yield {name: columns[name] for name in ("doc_id", "lang", "row")} | {"score": scores}

    scored = staged(in_batches(
        docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"), *rows), each,
        "doc_id long, lang string, row long, score double"), "zstd")
    thresholds = calibrated(scored, marked) if model else {None: DEFAULT}
    limit = F.lit(thresholds[None])
    for language, value in thresholds.items():
        if language is not None:
            limit = F.when(F.col("lang") == language, F.lit(value)).otherwise(limit)
    return (scored.withColumn("threshold", limit)
            .select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold",
                    (F.col("score") >= F.col("threshold")).alias("flagged"),
                    *([F.col("row").alias(number)] if number else [])))
