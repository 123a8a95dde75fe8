"""Exact, near and suffix dedup against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from caudal.llm.components import components
from caudal.llm.exact_dedup import exact_dedup
from caudal.llm.near_dedup import least_agreements, near_duplicates, similar, survivors
from caudal.llm.suffix_dedup import remove_repeats, repeated_passages, without_words
from rows import documents, empty


def lowered(text):
    return (text or "").encode().lower().decode()


def words_of(text):
    return (text or "").encode().lower().split()


def order(doc_id):
    return (doc_id is not None, doc_id or 0)


@pytest.mark.parametrize("block,hashed", [(8192, None), (16, None), (16, lambda b: len(b) % 2), (7, lambda b: 0)])
def test_exact_dedup(session, block, hashed):
    docs = documents(session, ((20, "abcdefgh" * 9), (21, "ABCDEFGH" * 9), (22, "abcdefgh" * 8 + "abcdefgx"),
                               (23, "É"), (24, "é")))
    if hashed:  # every block collides: contents decide
        docs = docs.filter("doc_id IS NULL OR doc_id NOT IN (5, 6, 7)")
    got = exact_dedup(docs, block, **({"hashed": hashed} if hashed else {})).collect()
    groups = defaultdict(list)
    for r in docs.collect():
        groups[lowered(r.text)].append(r.doc_id)
    want = Counter()
    for text, ids in groups.items():
        keep = max(ids, key=order)
        for n, doc_id in enumerate(sorted(ids, key=order, reverse=True)):
            want[doc_id, keep, len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == want


def test_empty_tables(session):
    assert exact_dedup(empty(session)).count() == 0
    assert near_duplicates(empty(session)).count() == 0
    assert repeated_passages(empty(session)).count() == 0
    assert remove_repeats(empty(session)).columns == empty(session).columns


def test_components(session):
    rng = random.Random(4)
    edges = [(n, n + 1) for n in range(100, 160)] + [(7, 7), (5, 3), (3, 9)] + [
        (1000, rng.randrange(1001, 1100)) for _ in range(80)]
    got = {r.id: r.component for r in components(session.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[n] for n in range(100, 161)} == {100}
    assert got[3] == got[5] == got[9] == 3 and 7 not in got
    assert all(c == 1000 for n, c in got.items() if n >= 1000)
    assert components(session.createDataFrame([], "a long, b long")).count() == 0


def test_posterior_bounds_rise_and_keep_the_threshold():
    bounds = least_agreements(0.85, 135, 27, 1e-6)
    assert list(bounds) == sorted(bounds) and bounds[-1] < 0.85 * 135
    rng = np.random.default_rng(1)
    base = rng.integers(0, 60000, 135).astype("<u2")
    close = np.where(rng.random(135) < 0.86, base, 1)
    far = rng.integers(0, 60000, 135).astype("<u2")
    found = set(survivors(np.stack([base]), np.stack([close, far]), 0.85, False))
    assert found == {(0, 0)}


def test_similar_at_the_border():
    a, b = np.arange(100, dtype=np.uint64), np.arange(15, 100, dtype=np.uint64)
    assert similar(a, b, 85) and not similar(a, b[1:], 85) and similar(a, a, 100)


def varied(rng):
    texts = []
    for group in range(6):
        base = [f"g{group}w{rng.randrange(400)}" for _ in range(rng.choice((8, 60, 300)))]
        for _ in range(12):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 40 + 1)):
                text[rng.randrange(len(text))] = f"x{rng.random()}"
            texts.append(" ".join(text))
    return [*texts, "one two", "ONE  two", "one two three four five", "five words are here now extra"]


@pytest.mark.parametrize("block", [1024, 4])
def test_near_duplicates(session, block):
    texts = varied(random.Random(11))
    docs = documents(session, tuple((100 + n, t) for n, t in enumerate(texts))).filter("doc_id IS NOT NULL")
    got = {}
    for r in near_duplicates(docs, block=block).collect():
        got.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    sets = {}
    for r in docs.collect():
        w = words_of(r.text)
        n = min(5, len(w))
        sets[r.doc_id] = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if w else frozenset()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert len({find(i) for i in sets}) < len(sets) - 20
    for i, rows in got.items():
        assert {(n, c) for n, c, _ in rows} == {(len(sets[i]), find(i))}
        assert sum(kept for _, _, kept in rows) == (find(i) == i)


def brute_repeats(rows, size=50):
    """Merged covered words of each row (doc_id, number, text), rows in order."""
    seen, out = set(), []
    for doc_id, _, text in sorted(rows, key=lambda r: (order(r[0]), r[1])):
        w = words_of(text)
        spans = []
        for a in range(len(w) - size + 1):
            window = tuple(w[a:a + size])
            if window in seen:
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = a + size
                else:
                    spans.append([a, a + size])
            seen.add(window)
        out += [(doc_id, a, b) for a, b in spans]
    return out


def test_repeated_passages(session):
    rng = random.Random(5)
    passage = [f"p{n}" for n in range(80)]
    extra = [(200, " ".join(passage[:50])), (201, "lead " + " ".join(passage) + " tail"),
             (202, " ".join(passage[31:])), (203, " ".join(passage[30:]) + " end"), (204, " ".join(["a"] * 200))]
    for n in range(12):
        words = [f"r{rng.randrange(10 ** 6)}" for _ in range(120)]
        at, start = rng.randrange(100), rng.randrange(20)
        extra.append((300 + n, " ".join(words[:at] + passage[start:start + rng.randrange(40, 61)] + words[at:])))
    docs = documents(session, tuple(extra))
    got = repeated_passages(docs).collect()
    want = brute_repeats([(r.doc_id, n, r.text) for n, r in enumerate(docs.collect())])
    assert Counter((r.doc_id, r.start_word, r.end_word) for r in got) == Counter(want)
    assert all(r.source_ids for r in got if r.doc_id == 201) and len(want) > 8


def test_without_words():
    assert without_words("a b  c\nd e ", [(1, 3)]) == "a d e "
    assert without_words("a b", [(0, 2)]) == "" and without_words(" é x", [(0, 1)]) == " x"


def test_removal_keeps_columns_and_clean_texts(session):
    docs = documents(session, ((30, "lead " + " ".join(f"w{n}" for n in range(70)) + " tail"),)).filter(
        "doc_id IS NOT NULL AND doc_id NOT IN (10)")
    before = {r.doc_id: r for r in docs.collect()}
    after = {r.doc_id: r for r in remove_repeats(docs).collect()}
    assert after[30].text == "lead tail" and after[30].n_chars == 9 and after[9].text == "before after"
    assert 6 not in after  # all of it is in 5
    for i in (0, 1, 2, 3, 4, 5, 8, 11, 12):
        assert after[i] == before[i]
    assert remove_repeats(docs).columns == docs.columns
