"""Language-model scores of whole texts: smoothed word counts as the base, and the attention model of attention.py.

Base: counts of words over all training documents. The most frequent words, HEAD at most, are
broadcast; each text's other words are rows that join the count table by shuffle, so the vocabulary may have
any size.

Model: subword ids of the text, A-Z lower-cased and words divided by one space.

1. One pass over all documents writes their subword ids and counts the words and subwords of training documents.
2. A pass over all ids counts each subword's neighbours among the most frequent subwords; the counts are
   summed and projected in Spark, and one vector for each subword comes to the driver, which forms the classes.
3. At most SAMPLE training documents (the first by a hash of doc_id) give the first weights on the driver, and
   nothing else.
4. A further pass over all ids counts each subword by the class before it, and trains the weights in
   every task on all windows of its documents, so that every subword is a target once. The tasks' weights are
   averaged, weighted by their windows. What is sent grows with the number of tasks, so with the data;
   what comes to the driver is one set of weights and one count for each class and subword.
5. A last pass scores all documents from their ids.

Training documents are those whose crc32 of doc_id mod FOLDS is not HELD.

Defined cases: a null text is empty and has only its end; a null doc_id counts as training; equal rows count
as often as they occur; with no training documents all counts are 0 and the model is the untrained one; columns beside
doc_id and text are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, compress, count, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.attention import (
    CLASSES,
    NEAR,
    Attention,
    Vocabulary,
    classes_of,
    marked,
    neighbours,
    projected,
    windows_of,
)
from caudal.llm.shared import in_batches, in_partitions, keyed_join, staged
from caudal.llm.tokens import byte_level_core, token_bytes

FOLDS, HELD = 7, 2
HEAD = 200_000
SAMPLE = 1500
SAMPLE_WINDOWS = 90_000
WINDOWS_AT_ONCE = 8192
COUNTED_AT_ONCE = 300_000
PAIRS_AT_ONCE = 2_000_000
NEAR_AT_ONCE = 1 << 30  # a count in 32 bits holds this
ROWS_AT_ONCE = 1_000_000
TEXTS_AT_ONCE = 250
_STEPS = 8  # of the count histogram for each doubling


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD, F.lit(False))


def subwords(text: str | None, tokenizer: str) -> np.ndarray:
    """Subword ids of the words; bytes.split() splits at the six characters between words."""
    words = (text or "").encode().lower().split()
    data = byte_level_core(tokenizer)(" " + b" ".join(words).decode()) if words else b""
    return np.frombuffer(data, "<u4").astype(np.int64)


class _Words:
    """Distinct words by number and their subwords, COUNTED_AT_ONCE or a batch more; texts are encoded by looking words up.

    No subword crosses the space before a word, unless the word before ends in white space of another kind; a text with
    such a word is encoded as a whole.
    """

    def __init__(self, tokenizer: str):
        self._tokenizer = tokenizer
        pieces, special = token_bytes(tokenizer)
        self._leading = np.array([piece[:1] == b" " and n not in special for n, piece in enumerate(pieces)])
        self._cut = not any(pieces[n].split() != [pieces[n]] for n in special)  # no special token has white space
        self._number: dict[bytes, int] = defaultdict(count().__next__)
        self._ids, self._starts, self._sizes = np.zeros(0, "<i4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._open = np.zeros(0, bool)

    def __len__(self) -> int:
        return len(self._number)

    def __iter__(self) -> Iterator[bytes]:
        return iter(self._number)

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """The subword ids of each text, its number of words, and the numbers of all words."""
        split = [(text or "").encode().lower().split() for text in texts]
        lengths = np.array([len(words) for words in split], np.int64)
        words = np.fromiter(map(self._number.__getitem__, chain.from_iterable(split)), np.int64, lengths.sum())
        self._learn(list(islice(self._number, len(self._sizes), None)))
        sizes = self._sizes[words]
        ends = np.cumsum(sizes)
        ids = self._ids[np.arange(sizes.sum()) + np.repeat(self._starts[words] - (ends - sizes), sizes)]
        stops = np.append(0, ends)[np.append(0, np.cumsum(lengths))]
        out = [ids[start:stop] for start, stop in pairwise(stops.tolist())]
        for n in np.unique(np.repeat(np.arange(len(texts)), lengths)[self._open[words]]).tolist():
            out[n] = subwords(texts[n], self._tokenizer)
        return out, lengths, words

    def _learn(self, new: list[bytes]) -> None:
        """Encode new words in one text, in which a subword with a leading space is the first of its word."""
        apart = np.array([not _ends_in_space(word) for word in new], bool) & self._cut
        plain = [word for word, own in zip(new, apart.tolist(), strict=True) if own]
        sizes = np.zeros(len(new), np.int64)
        if plain:
            found = subwords(b" ".join(plain).decode(), self._tokenizer)
            first = np.flatnonzero(self._leading[found])
            if len(first) != len(plain):
                raise ValueError(f"{self._tokenizer} does not keep words apart")
            sizes[apart] = np.diff(first, append=len(found))
            self._ids = np.concatenate([self._ids, found.astype("<i4")])
        self._starts = np.concatenate([self._starts, self._sizes.sum() + np.cumsum(sizes) - sizes])
        self._sizes = np.concatenate([self._sizes, sizes])
        self._open = np.concatenate([self._open, ~apart])


def _ends_in_space(word: bytes) -> bool:
    if 32 <= word[-1] < 128:
        return False
    last = word.decode()[-1]
    return last.isspace() or last == "\u180e"


def prepared(docs: DataFrame, tokenizer: str, size: int) -> DataFrame:
    """Rows of documents, with their subword ids as bytes, and rows that count words or subwords.

    Counted are documents that are not held out: words (the end of a text is the empty word) and subwords (the end is
    `size` - 1).
    """
    def run(batches):
        words, tokens, ends = _Words(tokenizer), np.zeros(size, np.int64), 0
        counts = np.zeros(0, np.int64)

        def counted(word, token, number):
            none = pa.nulls(len(number))
            yield {"doc_id": none, "held_out": none, "ids": none, "word": word, "token": token,
                   "count": number}

        def count_words():
            found = np.flatnonzero(counts)
            names = list(compress(words, counts.tolist()))
            return counted(pa.array(names, pa.binary()), pa.nulls(len(names)), counts[found])

        for batch in batches:
            for at in range(0, len(batch["text"]), TEXTS_AT_ONCE):
                part = slice(at, at + TEXTS_AT_ONCE)
                held = np.array(batch["held_out"][part], bool)
                ids, lengths, used = words.encode(batch["text"][part])
                now = np.bincount(used[np.repeat(~held, lengths)], minlength=len(words))
                now[:len(counts)] += counts
                counts = now
                learned = [own for own, out in zip(ids, held.tolist(), strict=True) if not out]
                tokens += np.bincount(np.concatenate([*learned, np.zeros(0, np.int64)]), minlength=size)
                ends += len(learned)
                none = pa.nulls(len(ids))
                yield {"doc_id": batch["doc_id"][part], "held_out": held, "word": none, "token": none, "count": none,
                       "ids": [own.astype("<i4", copy=False).tobytes() for own in ids]}
                if len(words) > COUNTED_AT_ONCE:
                    yield from count_words()
                    words, counts = _Words(tokenizer), np.zeros(0, np.int64)
        yield from count_words()
        tokens[-1] += ends
        found = np.flatnonzero(tokens)
        yield from counted(pa.nulls(len(found)), found, tokens[found])
        if ends:
            yield from counted(pa.array([b""], pa.binary()), pa.nulls(1), np.array([ends]))

    return in_partitions(docs.withColumn("held_out", held_out()), run,
                         "doc_id long, held_out boolean, ids binary, word binary, token int, count long",
                         "doc_id", "text", "held_out")


def head_words(words: DataFrame, most: int = HEAD) -> int:
    """The least count from which on there are at most `most` words, from a histogram of bounded size."""
    step = F.floor(F.log2(F.col("count")) * _STEPS)
    histogram = words.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.min("count").alias("least")).orderBy(F.desc("step")).collect()
    total, least = 0, None
    for row in histogram:
        total += row["n"]
        if total > most:
            break
        least = row["least"]
    return least if least is not None else (histogram[0]["least"] + 1 << 40 if histogram else 1)


def encoded(training: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and subword ids of each document, as bytes."""
    def each(columns):
        yield {"doc_id": columns["doc_id"],
               "ids": [subwords(text, tokenizer).astype("<i4").tobytes() for text in columns["text"]]}

    return in_batches(training, each, "doc_id long, ids binary", "doc_id", "text")


def _ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i4").astype(np.int64)


def subword_classes(texts: DataFrame, counts: np.ndarray) -> np.ndarray:
    """The class of each subword by its neighbours in all of `texts`, as `cluster` forms them."""
    size = len(counts)
    places = np.append(marked(counts), -1).astype(np.int32)  # the last stands between texts
    shared = texts.sparkSession.sparkContext.broadcast(places)  # one number for each subword

    def count(batches):
        near, seen = np.zeros((size + 1) * NEAR, np.int32), 0

        def rows():
            found = np.flatnonzero(near[:size * NEAR])
            for at in range(0, len(found), ROWS_AT_ONCE):
                part = found[at:at + ROWS_AT_ONCE]
                yield {"token": part // NEAR, "mark": part % NEAR, "count": near[part]}

        between = np.array([size], "<i4").tobytes()
        for batch in batches:
            ids = np.frombuffer(between.join(batch["ids"]), "<i4")
            for at in range(0, len(ids), PAIRS_AT_ONCE):
                codes = np.sort(neighbours(ids[at:at + PAIRS_AT_ONCE + 1], shared.value))
                first = np.flatnonzero(np.diff(codes, prepend=-1))
                near[codes[first]] += np.diff(first, append=len(codes)).astype(np.int32)
                seen += len(codes)
                if seen >= NEAR_AT_ONCE:
                    yield from rows()
                    near[:], seen = 0, 0
        yield from rows()

    def project(columns):
        near = np.zeros((len(columns["token"]), NEAR), np.float32)
        for row, marks, numbers in zip(near, columns["marks"], columns["counts"], strict=True):
            row[marks] = numbers
        total, vectors = projected(near)
        yield {"token": columns["token"], "total": total, "vector": list(vectors)}

    summed = (in_partitions(texts, count, "token int, mark int, count long", "ids")
              .groupBy("token", "mark").agg(F.sum("count").alias("count"))
              .groupBy("token").agg(F.collect_list("mark").alias("marks"), F.collect_list("count").alias("counts")))
    table = in_batches(summed, project, "token int, total double, vector array<float>").toArrow()  # a row per subword
    table = table.sort_by([("token", "ascending")])
    vectors = [v.values.to_numpy() for v in table["vector"]]
    return classes_of(size, table["token"].to_numpy(), table["total"].to_numpy(),
                      np.stack(vectors) if vectors else np.zeros((0, 1), np.float32))


def _sample(texts: DataFrame, most: int) -> list[np.ndarray]:
    chosen = (texts.filter("doc_id IS NOT NULL").select("doc_id").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    table = texts.join(chosen, "doc_id").select("doc_id", "ids").toArrow().sort_by([("doc_id", "ascending")])
    return [_ids(data) for data in table["ids"].to_pylist()]


class _Training:
    """Fits a model to all windows it is given, WINDOWS_AT_ONCE or fewer at a time; `weight` counts them."""

    def __init__(self, model: Attention, vocabulary: Vocabulary):
        self.model, self._vocabulary = model, vocabulary
        self._held, self._waiting, self.weight = [], 0, 0

    def add(self, *texts: np.ndarray) -> None:
        rows, classes, _ = windows_of(texts, self._vocabulary)
        at = 0
        while at < len(rows):
            end = at + WINDOWS_AT_ONCE - self._waiting
            self._held.append((rows[at:end], classes[at:end]))
            self._waiting += len(self._held[-1][0])
            at = end
            if self._waiting == WINDOWS_AT_ONCE:
                self.finish()

    def finish(self) -> None:
        if self._held:
            self.model.fit(*map(np.concatenate, zip(*self._held, strict=True)), rate=1e-3)
        self.weight += self._waiting
        self._held, self._waiting = [], 0


def train(training: DataFrame, counts: np.ndarray, tokenizer: str, sample: int = SAMPLE) -> tuple[Attention, Vocabulary]:
    """Weights and tables after the sample on the driver and the passes over all training documents.

    Those that come with their `ids`, from a staged table, are not encoded again.
    """
    size = len(counts)
    texts = training if "ids" in training.columns else staged(encoded(training, tokenizer))
    vocabulary = Vocabulary(counts, subword_classes(texts, counts))
    model = Attention(vocabulary)
    parts = _sample(texts, sample)
    if parts:
        rows, classes, _ = windows_of(parts, vocabulary)
        chosen = np.random.default_rng(1).permutation(len(rows))[:SAMPLE_WINDOWS]
        model.fit(rows[chosen], classes[chosen])
    shared = training.sparkSession.sparkContext.broadcast((model, vocabulary))  # fixed sizes

    def run(batches):
        started, vocabulary = shared.value
        own = Attention(vocabulary)
        own.load(started.flat())
        pairs = np.zeros((CLASSES + 1) * size, np.int64)
        training = _Training(own, vocabulary)
        places, waiting = [], 0
        for batch in batches:
            texts = list(map(_ids, batch["ids"]))
            for ids in texts:
                places.append(vocabulary.befores(ids) * size + np.append(ids, vocabulary.end))
                waiting += len(places[-1])
                if waiting >= PAIRS_AT_ONCE:
                    pairs += np.bincount(np.concatenate(places), minlength=len(pairs))
                    places, waiting = [], 0
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                training.add(*texts[at:at + TEXTS_AT_ONCE])
        training.finish()
        weight = training.weight
        if places:
            pairs += np.bincount(np.concatenate(places), minlength=len(pairs))
        found = np.flatnonzero(pairs)
        yield {"kind": np.zeros(len(found), np.int32), "at": found,
               "total": pairs[found].astype(np.float64), "weight": np.zeros(len(found))}
        if weight:
            values = own.flat().astype(np.float64)
            yield {"kind": np.ones(len(values), np.int32), "at": np.arange(len(values)),
                   "total": values * weight, "weight": np.full(len(values), float(weight))}

    learned = (in_partitions(texts, run, "kind int, at long, total double, weight double", "ids")
               .groupBy("kind", "at").agg(F.sum("total").alias("total"), F.sum("weight").alias("weight")))
    table = learned.toArrow()  # one row for each class and subword, and for each weight
    kind, at, total, weight = (table[name].to_numpy() for name in ("kind", "at", "total", "weight"))
    pairs = np.zeros((CLASSES + 1) * size, np.float32)
    pairs[at[kind == 0]] = total[kind == 0]
    values = model.flat().astype(np.float64)
    values[at[kind == 1]] = total[kind == 1] / weight[kind == 1]
    model.load(values)
    return model, Vocabulary(counts, vocabulary.classes, pairs.reshape(CLASSES + 1, size))


def lm_scores(docs: DataFrame, tokenizer: str, vocabulary_size: int, head: int = HEAD,
              sample: int = SAMPLE) -> DataFrame:
    """One row per row of (doc_id, text): the counts, base_score and score of the contract."""
    rows = staged(prepared(docs.select(F.col("doc_id").cast("long"), "text"), tokenizer, vocabulary_size + 1))
    counted = staged(rows.filter("count IS NOT NULL").groupBy("word", "token").agg(F.sum("count").alias("count")))
    docs = rows.filter("count IS NULL").select("doc_id", "held_out", "ids")
    words = counted.filter("word IS NOT NULL").select("word", "count")
    total, distinct = words.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    least = head_words(words, head)
    known = words.filter(F.col("count") >= least).toArrow()  # at most `head` rows
    logs = dict(zip(known["word"].to_pylist(), np.log10(known["count"].to_numpy() + 1.0).tolist(), strict=True))
    tokens = counted.filter("token IS NOT NULL").select("token", "count").toArrow()
    counts = np.zeros(vocabulary_size + 1)
    counts[tokens["token"].to_numpy()] = tokens["count"].to_numpy()
    model, vocabulary = train(docs.filter("NOT held_out"), counts, tokenizer, sample)
    shared = docs.sparkSession.sparkContext.broadcast((logs, model, vocabulary))  # fixed sizes and `head` words

    def each(columns):
        logs, model, vocabulary = shared.value
        out = {k: [] for k in ("row", "doc_id", "n_tokens", "n_known", "logs", "score", "word")}
        tails = {"row": [], "word": [], "n_tokens": []}
        pieces, _ = token_bytes(tokenizer)
        texts = [_ids(data) for data in columns["ids"]]
        for row, doc_id, ids in zip(columns["row"], columns["doc_id"], texts, strict=True):
            words = b"".join(map(pieces.__getitem__, ids.tolist())).split()  # as `subwords` had them
            words.append(b"")
            found = list(map(logs.get, words))
            if None in found:
                rare = Counter(compress(words, [own is None for own in found]))
                tails["row"] += [row] * len(rare)
                tails["word"] += rare
                tails["n_tokens"] += rare.values()
                found = [own for own in found if own is not None]
            for name, value in (("row", row), ("doc_id", doc_id), ("n_tokens", len(words)), ("n_known", len(found)),
                                ("logs", float(sum(found)))):
                out[name].append(value)
        out["score"] = model.score(texts, vocabulary)
        out["word"] = [None] * len(out["row"])
        yield out
        nothing = [None] * len(tails["row"])
        yield tails | {"doc_id": nothing, "n_known": nothing, "logs": nothing, "score": nothing}

    scored = staged(in_batches(docs.withColumn("row", F.monotonically_increasing_id()), each,
                               "row long, doc_id long, n_tokens long, n_known long, logs double, score double, "
                               "word binary"))
    rare = scored.filter("word IS NOT NULL").select("row", "word", "n_tokens")
    found = (keyed_join(rare, words, ["word"]).groupBy("row")
             .agg(F.sum("n_tokens").alias("more"),
                  F.sum(F.col("n_tokens") * F.log10(F.col("count") + 1.0)).alias("more_logs")))
    smoothing = float(np.log10(total + distinct + 1))
    return (scored.filter("word IS NULL").join(found, "row", "left").select(
        "doc_id", held_out().alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * smoothing).alias("base_score"),
        "score"))
