"""The trained models: gradients, held-out accuracy and the base figures against brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from caudal.llm import lm_scoring
from caudal.llm import toxicity as toxic_module
from caudal.llm.attention import (
    BATCH,
    CLASSES,
    CONTEXT,
    RATE,
    STRIDE,
    Attention,
    Vocabulary,
    cluster,
    windows,
    windows_of,
)
from caudal.llm.lm_scoring import head_words, lm_scores
from caudal.llm.tokens import token_bytes
from caudal.llm.toxicity import DEFAULT, PARTS, TextCnn, threshold, toxicity, word_ids
from rows import documents, empty

BYTE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.1"


def test_cnn_gradients():
    model = TextCnn()
    texts = [word_ids("alpha beta gamma delta"), word_ids("beta"), word_ids("")]
    labels, weights = np.array([1.0, 0.0, 1.0]), np.ones(3)
    model.embedding, model.filters = model.embedding.astype(np.float64), [f.astype(np.float64) for f in model.filters]
    model.output, model.bias = model.output.astype(np.float64), model.bias.astype(np.float64) + 0.05

    def loss():
        p = 1 / (1 + np.exp(-model.logits(texts)))
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    gradients, rows, change, _ = model._gradients(texts, labels, weights)
    for parameter, gradient in ((model.filters[1], gradients[1]), (model.output, gradients[-1]),
                                (model.embedding, None)):
        place = (0, 1, 2) if gradient is gradients[1] else (3,) if parameter.ndim == 1 else (int(rows[0]), 2)
        want = change[0][2] if gradient is None else gradient[place]
        old = parameter[place]
        parameter[place] = old + 1e-4
        up = loss()
        parameter[place] = old - 1e-4
        down = loss()
        parameter[place] = old
        assert math.isclose((up - down) / 2e-4, want, rel_tol=2e-2, abs_tol=1e-5)


def test_scores_do_not_depend_on_the_batch():
    model = TextCnn()
    texts = [word_ids(" ".join(random.Random(n).choices("ab cd ef gh ij kl".split(), k=n))) for n in range(0, 40)]
    together = model.scores(texts)
    alone = np.concatenate([model.scores([t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)
    long = np.concatenate(texts * 400)
    assert long.shape[1] == PARTS
    assert np.allclose(model._long(long), model.logits([long]), atol=1e-4)


def test_threshold():
    assert threshold(np.array([0.9, 0.8, 0.2, 0.1]), np.array([1, 1, 0, 0])) == 0.5
    assert threshold(np.array([0.9]), np.array([1])) == DEFAULT


def test_toxicity_on_held_out_documents(session):
    docs, labels = (session.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    marked = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity(docs.join(labels.select("doc_id"), "doc_id"), labels).collect()
    held = [r for r in rows if r.held_out]
    assert {r.held_out for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0} == {True}
    right = sum(r.predicted == marked[r.doc_id] for r in held) / len(held)
    flagged = [r for r in held if r.flagged]
    assert right > 0.92 and all(0 <= r.score <= 1 for r in rows)
    assert sum(marked[r.doc_id] for r in flagged) / len(flagged) > 0.8


def test_toxicity_cases(session):
    labels = session.createDataFrame([(0, 1), (1, 0), (1, 1), (3, None), (None, 1), (99, 0)], "doc_id long, toxic int")
    docs = documents(session)
    rows = toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(r.predicted == int(r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    none = toxicity(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert toxicity(empty(session), labels).count() == 0


def small_vocabulary(size=60):
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 50, size).astype(float)
    return counts, Vocabulary(counts, rng.integers(0, CLASSES, size))


def test_windows_score_each_token_once():
    _, vocabulary = small_vocabulary()
    for size in (0, 1, STRIDE - 1, STRIDE, 3 * CONTEXT + 5):
        ids = np.arange(size) % 59
        rows, classes, count = windows(ids, vocabulary)
        assert count == size + 1 and rows.shape[1] == CONTEXT
        assert classes[classes >= 0].tolist() == vocabulary.classes[np.append(ids, 59)].tolist()


def test_probabilities_sum_to_one_and_look_back_only():
    _, vocabulary = small_vocabulary()
    model = Attention(vocabulary)
    ids = np.array([3, 1, 4, 1, 5, 9, 2, 6])
    within = 10.0 ** vocabulary.within
    for before in (0, CLASSES):
        sums = np.bincount(vocabulary.classes, weights=within[before], minlength=CLASSES)
        assert np.allclose(sums[np.unique(vocabulary.classes)], 1, atol=1e-4)
    assert np.allclose(np.exp(model.forward(windows(ids, vocabulary)[0])).sum(axis=2), 1, atol=1e-5)
    longer = np.append(ids, [7, 7])
    first, second = (model.forward(windows(x, vocabulary)[0])[0, :len(ids)] for x in (ids, longer))
    assert np.allclose(first, second, atol=1e-6)
    rows, classes, _ = windows(ids, vocabulary)
    logs = model.forward(rows)
    by_hand = sum(logs[0, t, c] for t, c in enumerate(classes[0]) if c >= 0) / math.log(10) + vocabulary.within[
        vocabulary.befores(ids), np.append(ids, vocabulary.end)].sum()
    assert math.isclose(model.score([ids], vocabulary)[0], by_hand, rel_tol=1e-4)


def test_attention_gradients():
    _, vocabulary = small_vocabulary()
    model = Attention(vocabulary)
    rows, classes, _ = windows(np.arange(50) % 59, vocabulary)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    gradients = model.gradients(rows, classes)

    def loss():
        logs = model.forward(rows)
        batch, place = np.nonzero(classes >= 0)
        return -logs[batch, place, classes[batch, place]].mean()

    for name, gradient in gradients.items():
        place = (int(rows[1, 12]), 3) if name == "embed" else tuple(n // 2 for n in gradient.shape)
        old = model.p[name][place]
        model.p[name][place] = old + 1e-5
        up = loss()
        model.p[name][place] = old - 1e-5
        down = loss()
        model.p[name][place] = old
        assert math.isclose((up - down) / 2e-5, gradient[place], rel_tol=1e-3, abs_tol=1e-8), name


def test_training_learns():
    rng = random.Random(8)
    texts = [np.array([n % 7 if n % 2 else rng.choice((20, 21)) for n in range(120)]) for _ in range(40)]
    counts = np.bincount(np.concatenate(texts), minlength=60).astype(float)
    vocabulary = Vocabulary(counts, cluster(texts, counts))
    model = Attention(vocabulary)
    before = model.score(texts[:5], vocabulary).sum()
    parts = [windows(t, vocabulary)[:2] for t in texts * 12]
    model.fit(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    assert model.score(texts[:5], vocabulary).sum() > before


def base(rows):
    counts = Counter()
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    for i, text in rows:
        if not held[i]:
            counts.update([*(text or "").encode().lower().split(), b""])
    total, distinct = sum(counts.values()), len(counts)
    for i, text in rows:
        words = [*(text or "").encode().lower().split(), b""]
        yield (i, held[i], len(words), sum(counts[w] > 0 for w in words), total,
               round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words), 6))


def test_lm_scores(session):
    docs = documents(session, tuple((50 + n, f"held out or not {n} the cat") for n in range(12)))
    want = Counter(base([(r.doc_id, r.text) for r in docs.collect()]))
    for head in (200_000, 5, 0):
        rows = lm_scores(docs, BYTE, 50257, head=head).collect()
        got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                      for r in rows)
        assert got == want and all(r.score < 0 for r in rows)
    only_held = docs.filter("crc32(cast(doc_id as string)) % 7 = 2")
    assert {(r.train_tokens, r.n_known, r.base_score) for r in lm_scores(only_held, BYTE, 50257).collect()} == {(0, 0, 0.0)}
    assert lm_scores(empty(session), BYTE, 50257).count() == 0


def test_head_is_bounded(session):
    words = session.createDataFrame([(str(n).encode(), 1 + n // 10) for n in range(1000)], "word binary, count long")
    for most in (0, 10, 300, 5000):
        assert words.filter(f"count >= {head_words(words, most)}").count() <= most


def test_every_subword_is_a_training_target_once(monkeypatch):
    _, vocabulary = small_vocabulary()
    fitted = []
    monkeypatch.setattr(lm_scoring, "WINDOWS_AT_ONCE", 8)
    texts = [np.arange(n) % 59 for n in (0, 30, 16 * STRIDE, 40 * STRIDE + 3)]
    model = Attention(vocabulary)
    model.fit = lambda rows, classes, rate: fitted.append((rows, classes))
    training = lm_scoring._Training(model, vocabulary)
    for ids in texts:
        training.add(ids)
    training.finish()
    classes = np.concatenate([c for _, c in fitted])
    assert classes[classes >= 0].tolist() == vocabulary.classes[
        np.concatenate([np.append(ids, vocabulary.end) for ids in texts])].tolist()
    assert training.weight == len(classes) and max(len(r) for r, _ in fitted) <= 8


def test_classes_come_from_all_documents(session):
    rng = random.Random(3)
    rows = [(n if n % 5 else None, " ".join(rng.choices(["ab", "cd", "ef", "gh"], k=4) + [f"w{n % 90}"] * 2) * 3)
            for n in range(700)]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    ids = [lm_scoring.subwords(text, BYTE) for _, text in rows]
    counts = np.bincount(np.concatenate(ids), minlength=50258).astype(float)
    texts = lm_scoring.encoded(docs, BYTE)
    got = lm_scoring.subword_classes(texts, counts)
    assert (got == cluster(ids, counts)).mean() > 0.999
    # The classes do not depend on the sample, and documents without ids count.
    _, one = lm_scoring.train(docs, counts, BYTE, 1)
    _, none = lm_scoring.train(docs, counts, BYTE, 0)
    assert (one.classes == got).all() and (none.classes == got).all() and len(set(got.tolist())) > 4
    assert (one.within == none.within).all()


def test_thresholds_come_from_all_calibrating_documents(session, monkeypatch):
    """Labels without a document take no place in the sample; `de` has one label only; 3000 documents calibrate."""
    fitted = []

    def spread(self, texts, labels):
        fitted.append(len(texts))
        self.embedding *= 20

    monkeypatch.setattr(TextCnn, "fit", spread)
    monkeypatch.setattr(toxic_module, "fold", lambda doc_id="doc_id": F.col(doc_id) % 5)
    model = TextCnn()
    model.embedding *= 20
    score = dict(enumerate(model.scores([word_ids(f"t{n}") for n in range(3000)])))
    middle = {"en": np.quantile(list(score.values()), 0.4), "es": np.quantile(list(score.values()), 0.8)}
    language = {n: "de" if n % 50 == 1 else "en" if n % 3 else "es" for n in score}
    toxic = {n: int(score[n] > middle.get(language[n], 1)) for n in score}
    docs = session.createDataFrame([(n, f"t{n}", language[n]) for n in score], "doc_id long, text string, lang string")
    labels = session.createDataFrame([*toxic.items(), *((n, 1) for n in range(5000, 40000))], "doc_id long, toxic int")
    found = {}
    for row in toxic_module.toxicity(docs, labels, 40).collect():
        assert math.isclose(row.score, score[row.doc_id], abs_tol=1e-6)
        found.setdefault(language[row.doc_id], set()).add(row.threshold)
    assert fitted == [40] and all(len(limits) == 1 for limits in found.values())
    got = {name: limits.pop() for name, limits in found.items()}
    held = [n for n in score if n % 5 == 1]
    for name in ("en", "es"):
        own = [n for n in held if language[n] == name]
        want = threshold(np.array([score[n] for n in own]), np.array([toxic[n] for n in own]))
        assert math.isclose(got[name], want, abs_tol=0.01), name
    # `de` has the threshold of all languages together.
    pooled = threshold(np.array([score[n] for n in held]), np.array([toxic[n] for n in held]))
    assert math.isclose(got["de"], pooled, abs_tol=0.01) and pooled != DEFAULT


def test_texts_are_encoded_once_and_words_come_back(session, monkeypatch):
    rng = random.Random(5)
    texts = [None, "", "  ", "it's  a\tb", "a   b  c", "x\x1c y\x85 z", "<|ENDOFTEXT|>q <|endoftext|>", "ÀÉ é 12!?"]
    texts += ["".join(rng.choices("ab1 !'s\n  \x85é᠎\x1c", k=rng.randint(0, 30))) for _ in range(300)]
    want = [lm_scoring.subwords(text, BYTE).tolist() for text in texts]
    words = lm_scoring._Words(BYTE)
    got = [ids.tolist() for at in range(0, len(texts), 50) for ids in words.encode(texts[at:at + 50])[0]]
    assert got == want
    pieces, _ = token_bytes(BYTE)
    assert all(b"".join(pieces[i] for i in ids).split() == (text or "").encode().lower().split()
               for ids, text in zip(want, texts, strict=True))

    def again(*_):
        raise AssertionError("encoded a second time")

    monkeypatch.setattr(lm_scoring, "encoded", again)
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert lm_scores(docs, BYTE, 50257).count() == len(texts)


def test_windows_of_several_texts_are_those_of_each():
    _, vocabulary = small_vocabulary()
    texts = [np.arange(size) % 59 for size in (0, 1, STRIDE - 1, STRIDE, 3 * CONTEXT + 5, 0)]
    rows, classes, steps = windows_of(texts, vocabulary)
    single = [windows(ids, vocabulary) for ids in texts]
    assert steps.tolist() == [len(own) for own, _, _ in single] and len(windows_of([], vocabulary)[0]) == 0
    assert (rows == np.concatenate([own for own, _, _ in single])).all()
    assert (classes == np.concatenate([own for _, own, _ in single])).all()


def test_fit_moves_the_windows_rows_as_plain_adam_does():
    _, vocabulary = small_vocabulary()
    rows, classes, _ = windows(np.arange(80 * STRIDE) * 7 % 23, vocabulary)
    model, plain = Attention(vocabulary), Attention(vocabulary)
    model.fit(rows, classes)
    first, second = ({n: np.zeros_like(v) for n, v in plain.p.items()} for _ in range(2))
    order = np.random.default_rng(13).permutation(len(rows))
    for step, at in enumerate(range(0, len(order), BATCH), 1):
        batch = order[at:at + BATCH]
        for name, change in plain.gradients(rows[batch], classes[batch]).items():
            first[name] = 0.9 * first[name] + 0.1 * change
            second[name] = 0.99 * second[name] + 0.01 * change ** 2
            plain.p[name] = plain.p[name] - RATE * first[name] / (1 - 0.9 ** step) / (
                np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-7)
    assert all(np.allclose(model.p[n], plain.p[n], atol=1e-3) for n in plain.p)
    unused = np.setdiff1d(np.arange(len(plain.p["embed"])), rows)
    assert (model.p["embed"][unused] == Attention(vocabulary).p["embed"][unused]).all()
    assert model.none_row == vocabulary.none_row
