"""A small causal self-attention language model in numpy.

One head looks back over CONTEXT subwords, with a learned bias for each distance. The next subword is
predicted in two steps: its class from the attended context, and the subword within the class from
smoothed corpus counts, taken apart by the class of the subword before. Windows overlap: each has CONTEXT places, and its last STRIDE places are predicted, so
every subword is predicted exactly once, with at least CONTEXT - STRIDE subwords before it where the text has them.
"""

from __future__ import annotations

import numpy as np

CONTEXT = 24
STRIDE = 16
WIDTH = 16
HIDDEN = 32
CLASSES = 64
OWN = 4096  # the most frequent subwords have an embedding of their own, the others that of their class
MARKS = 256  # the most frequent subwords, beside which neighbours are counted
NEAR = 2 * MARKS
PROJECTED = 48
LEAST = 6
SMOOTHING = 20.0
LARGE = 60.0  # float32 holds exponentials up to this, and their sums
RATE = 4e-3
BATCH = 64
AT_ONCE = 256
SUBWORDS_AT_ONCE = 200_000


class Vocabulary:
    """Class and embedding row of each subword, and its log10 probability within its class.

    `counts` covers all subwords and, last, the end of a text. `classes` gives each its class. `pairs` counts
    each subword by the class of the one before (CLASSES rows and one for the start of a text); it is smoothed by
    the counts without that class, and these by one.
    """

    def __init__(self, counts: np.ndarray, classes: np.ndarray, pairs: np.ndarray | None = None):
        self.end = len(counts) - 1
        self.classes = classes.astype(np.int64)
        mass = np.bincount(self.classes, weights=counts + 1.0, minlength=CLASSES)
        within = (counts + 1.0) / mass[self.classes]
        if pairs is None:
            pairs = np.zeros((CLASSES + 1, len(counts)), np.float32)
        self.within = np.empty_like(pairs, dtype=np.float32)
        for before, row in enumerate(pairs):
            total = np.bincount(self.classes, weights=row, minlength=CLASSES)
            self.within[before] = np.log10((row + SMOOTHING * within) / (total[self.classes] + SMOOTHING))
        rank = np.empty(len(counts), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
        self.row = np.where(rank < OWN, rank, OWN + self.classes)
        self.start_row, self.none_row = OWN + CLASSES, OWN + CLASSES + 1
        self.class_share = np.log(np.maximum(mass, 1.0) / mass.sum())

    def befores(self, ids: np.ndarray) -> np.ndarray:
        """For each target of a text, its end included, the class of the subword before."""
        return np.append(CLASSES, self.classes[ids])


def marked(counts: np.ndarray) -> np.ndarray:
    """For each subword its place among the MARKS most frequent ones, or -1."""
    marks = np.argsort(-counts, kind="stable")[:MARKS]
    place = np.full(len(counts), -1)
    place[marks] = np.arange(len(marks))
    return place


def neighbours(ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A number for each subword of a text and mark beside it: NEAR * subword + mark, MARKS more if the mark follows."""
    before, after = place[ids[:-1]], place[ids[1:]]
    return np.concatenate([(NEAR * ids[1:] + before)[before >= 0], (NEAR * ids[:-1] + MARKS + after)[after >= 0]])


def projected(near: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """From the neighbour counts of subwords, one row of NEAR each: their sums and projected shares."""
    total = near.sum(axis=1, dtype=np.float64)
    projection = np.random.default_rng(seed).standard_normal((NEAR, PROJECTED))
    vectors = np.empty((len(near), PROJECTED), np.float32)  # rounded, so that they do not depend on the batch
    for at in range(0, len(near), AT_ONCE):
        part = slice(at, at + AT_ONCE)
        vectors[part] = np.sqrt(near[part] / np.maximum(total[part], 1)[:, None]) @ projection
    return total, vectors


def classes_of(size: int, tokens: np.ndarray, total: np.ndarray, vectors: np.ndarray, rounds: int = 10) -> np.ndarray:
    """Classes of `size` subwords by k-means of the vectors of those with neighbours.

    Subwords with too few neighbours to tell share the last four classes.
    """
    known = total >= LEAST
    tokens, total, vectors = tokens[known], total[known], vectors[known]
    classes = CLASSES - 4 + np.arange(size) % 4
    groups = CLASSES - 4
    if len(tokens) <= groups:
        return classes
    centres = vectors[np.argsort(-total, kind="stable")[:groups]]
    for _ in range(rounds):
        distance = (centres * centres).sum(axis=1)[None] - 2 * vectors @ centres.T
        own = distance.argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors)
        members = np.bincount(own, minlength=groups)
        centres = np.where(members[:, None] > 0, sums / np.maximum(members, 1)[:, None], centres)
    classes[tokens] = own
    return classes


def cluster(texts: list[np.ndarray], counts: np.ndarray) -> np.ndarray:
    """Classes of subwords by their neighbours in these texts."""
    place, near = marked(counts), np.zeros(len(counts) * NEAR, np.float32)
    for ids in texts:
        np.add.at(near, neighbours(ids, place), 1)
    return classes_of(len(counts), np.arange(len(counts)), *projected(near.reshape(-1, NEAR)))


def windows(ids: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, int]:
    """Embedding rows of all windows of a text, the classes of their targets (-1: none), the number of targets."""
    targets = np.append(ids, vocabulary.end)
    steps = -(-len(targets) // STRIDE)
    places = np.full(CONTEXT - STRIDE + steps * STRIDE, vocabulary.none_row)
    at = CONTEXT - STRIDE
    places[at] = vocabulary.start_row
    places[at + 1:at + len(targets)] = vocabulary.row[ids]
    view = np.lib.stride_tricks.sliding_window_view(places, CONTEXT)[::STRIDE]
    padded = np.full(steps * STRIDE, -1)
    padded[:len(targets)] = vocabulary.classes[targets]
    return view, padded.reshape(steps, STRIDE), len(targets)


def windows_of(texts: list[np.ndarray], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of several texts one after the other, as `windows` gives them, and how many each text has."""
    sizes = np.array([len(ids) for ids in texts], np.int64)
    steps = sizes // STRIDE + 1
    at = (np.cumsum(steps) - steps) * STRIDE  # the first target of each text
    own = np.arange(sizes.sum()) + np.repeat(at - (np.cumsum(sizes) - sizes), sizes)
    first = CONTEXT - STRIDE
    ahead = np.arange(len(texts)) * first  # each text has so many more places than targets
    ids = np.concatenate([*texts, np.zeros(0, np.int64)])
    places = np.full(steps.sum() * STRIDE + len(texts) * first, vocabulary.none_row)
    places[at + ahead + first] = vocabulary.start_row
    places[own + np.repeat(ahead, sizes) + first + 1] = vocabulary.row[ids]
    classes = np.full(steps.sum() * STRIDE, -1)
    classes[own] = vocabulary.classes[ids]
    classes[at + sizes] = vocabulary.classes[vocabulary.end]
    starts = np.arange(steps.sum()) * STRIDE + np.repeat(ahead, steps)
    view = np.lib.stride_tricks.sliding_window_view(places, CONTEXT) if len(texts) else np.zeros((0, CONTEXT), np.int64)
    return view[starts], classes.reshape(-1, STRIDE), steps


_DISTANCE = (np.arange(CONTEXT - STRIDE, CONTEXT)[:, None] - np.arange(CONTEXT)[None]).astype(np.int64)
_LATER = np.where(_DISTANCE < 0, np.float32(-1e9), np.float32(0))
_SELF = (_DISTANCE == 0).astype(np.float32)
_APART = np.abs(_DISTANCE)
_FIRST = CONTEXT - STRIDE
_OWN = np.arange(STRIDE) * (CONTEXT + 1) + _FIRST  # each place's look at itself


def _room(kept: dict, name: str, shape: tuple[int, ...], kind: np.dtype) -> np.ndarray:
    """The array of this name, a new one where the last had another shape; its values are those of the last use."""
    found = kept.get(name)
    if found is None or found.shape != shape:
        found = kept[name] = np.empty(shape, kind)
    return found


def _summed(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Rows of WIDTH values, summed by their number."""
    cells = (at[:, None] * WIDTH + np.arange(WIDTH)).ravel()
    return np.bincount(cells, values.ravel(), minlength=size * WIDTH).reshape(size, WIDTH)


class Attention:
    """Parameters by name, all float32."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 3):
        random = np.random.default_rng(seed)

        def table(*shape, scale):
            return (random.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "embed": table(OWN + CLASSES + 2, WIDTH, scale=0.3),
            "query": table(WIDTH, WIDTH, scale=0.25), "key": table(WIDTH, WIDTH, scale=0.25),
            "value": table(WIDTH, WIDTH, scale=0.25), "bias": np.zeros(CONTEXT, np.float32),
            "hidden": table(2 * WIDTH, HIDDEN, scale=0.2), "hidden0": np.zeros(HIDDEN, np.float32),
            "out": table(HIDDEN, CLASSES, scale=0.1), "out0": vocabulary.class_share.astype(np.float32),
        }
        self.none_row = vocabulary.none_row

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[name].ravel() for name in sorted(self.p)])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for name in sorted(self.p):
            own = self.p[name]
            self.p[name] = values[at:at + own.size].reshape(own.shape).astype(np.float32)
            at += own.size

    def _three(self) -> np.ndarray:
        """Query (scaled), key and value tables side by side."""
        p = self.p
        return np.concatenate([p["query"] * np.float32(WIDTH ** -0.5), p["key"], p["value"]], axis=1)

    def _looks(self, mapped: np.ndarray, rows: np.ndarray, kept: dict) -> tuple[np.ndarray, np.ndarray]:
        """How the last STRIDE places of each window weigh its places, and the sums of these weights."""
        n, kind = len(rows), mapped.dtype
        q, k = mapped[:, _FIRST:, :WIDTH], mapped[:, :, WIDTH:2 * WIDTH]
        weights = np.matmul(q, k.transpose(0, 2, 1), out=_room(kept, "weights", (n, STRIDE, CONTEXT), kind))
        weights += self.p["bias"][_APART] + _LATER
        # A place looks at itself at least, also where nothing else is before it.
        none = rows == self.none_row
        if none.any():
            some = np.flatnonzero(none.any(axis=1))
            weights[some] -= np.float32(1e9) * none[some].astype(np.float32)[:, None, :] * (1 - _SELF)
        # Each place's look at itself bounds its largest weight from below.
        if weights.max() > LARGE or weights.reshape(n, -1)[:, _OWN].min() < -LARGE:
            weights -= weights.max(axis=2, keepdims=True)
        np.exp(weights, out=weights)
        return weights, (weights.reshape(-1, CONTEXT) @ np.ones((CONTEXT, 1), kind)).reshape(n, STRIDE, 1)

    def _hidden(self, rows: np.ndarray, kept: dict) -> np.ndarray:
        """The hidden layer at the last STRIDE places of each window; its last column is one, to meet the bias.

        `kept` holds arrays that the gradients need, and lends them to the next call.
        """
        p = self.p
        n, kind = len(rows), p["embed"].dtype
        x = np.take(p["embed"], rows.ravel(), axis=0, out=_room(kept, "x", (n * CONTEXT, WIDTH), kind), mode="clip")
        mapped = _room(kept, "mapped", (n, CONTEXT, 3 * WIDTH), kind)
        # Products of flat tables are one call each, those of stacks one for each window.
        np.matmul(x, self._three(), out=mapped.reshape(-1, 3 * WIDTH))
        weights, total = self._looks(mapped, rows, kept)
        weights /= total
        mixed = np.matmul(weights, mapped[:, :, 2 * WIDTH:], out=_room(kept, "mixed", (n, STRIDE, WIDTH), kind))
        joined = _room(kept, "joined", (n * STRIDE, 2 * WIDTH + 1), kind)
        places = joined.reshape(n, STRIDE, -1)
        places[:, :, :WIDTH] = x.reshape(n, CONTEXT, WIDTH)[:, _FIRST:]
        places[:, :, WIDTH:-1] = mixed
        joined[:, -1] = 1
        hidden = _room(kept, "hidden", (n * STRIDE, HIDDEN + 1), kind)
        np.matmul(joined, np.vstack([p["hidden"], p["hidden0"]]), out=hidden[:, :-1])
        hidden[:, -1] = 1
        return np.maximum(hidden, 0, out=hidden)

    def forward(self, rows: np.ndarray) -> np.ndarray:
        """Log probabilities (natural) of the classes for the last STRIDE places of each window."""
        logits = self._hidden(rows, {}) @ np.vstack([self.p["out"], self.p["out0"]])
        logits -= logits.max(axis=1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return logits.reshape(len(rows), STRIDE, CLASSES)

    def tables(self) -> tuple[np.ndarray, ...]:
        """For each embedding row its query, key and value and its part in the hidden layer, and the further layers."""
        p = self.p
        return (p["embed"] @ self._three(), p["embed"] @ p["hidden"][:WIDTH] + p["hidden0"], p["hidden"][WIDTH:],
                np.vstack([p["out"], p["out0"]]))

    def log_classes(self, rows: np.ndarray, classes: np.ndarray, tables: tuple[np.ndarray, ...], kept: dict) -> np.ndarray:
        """Log probability (natural) of the given class at each predicted place."""
        by_row, late, inner, out = tables
        n, kind = len(rows), by_row.dtype
        mapped = _room(kept, "mapped", (n, CONTEXT, 3 * WIDTH), kind)
        np.take(by_row, rows, axis=0, out=mapped, mode="clip")
        weights, total = self._looks(mapped, rows, kept)
        mixed = np.matmul(weights, mapped[:, :, 2 * WIDTH:], out=_room(kept, "mixed", (n, STRIDE, WIDTH), kind))
        mixed /= total
        hidden = np.take(late, rows[:, _FIRST:].ravel(), axis=0, mode="clip",
                         out=_room(kept, "hidden", (n * STRIDE, HIDDEN), kind))
        hidden += np.matmul(mixed.reshape(-1, WIDTH), inner, out=_room(kept, "more", hidden.shape, kind))
        np.maximum(hidden, 0, out=hidden)
        logits = np.matmul(hidden, out[:-1], out=_room(kept, "logits", (n * STRIDE, CLASSES), kind))
        logits += out[-1]
        own = np.take(logits, np.arange(0, logits.size, CLASSES) + classes.ravel())
        if np.abs(own).max() > LARGE or logits.max() > LARGE:
            most = logits.max(axis=1, keepdims=True)
            logits -= most
            own -= most[:, 0]
        np.exp(logits, out=logits)
        return (own - np.log(logits @ np.ones(CLASSES, kind))).reshape(classes.shape)

    def gradients(self, rows: np.ndarray, classes: np.ndarray, kept: dict | None = None) -> dict[str, np.ndarray]:
        """Of the mean cross entropy; classes of -1 are not counted. `kept` lends arrays from call to call."""
        kept = {} if kept is None else kept
        p = self.p
        n, kind = len(rows), p["embed"].dtype
        hidden = self._hidden(rows, kept)
        x, mapped, weights, mixed, joined = (kept[name] for name in ("x", "mapped", "weights", "mixed", "joined"))
        change = np.matmul(hidden, np.vstack([p["out"], p["out0"]]),
                           out=_room(kept, "change", (n * STRIDE, CLASSES), kind))
        if change.max() > LARGE or change.min() < -LARGE:
            change -= change.max(axis=1, keepdims=True)
        np.exp(change, out=change)
        counted = classes.ravel() >= 0
        share = counted.astype(kind) / kind.type(max(1, np.count_nonzero(counted)))
        change *= (share / (change @ np.ones(CLASSES, kind)))[:, None]
        # A place without a target has no share, whichever class it is taken from.
        change.ravel()[np.arange(0, change.size, CLASSES) + classes.ravel()] -= share
        out = hidden.T @ change
        inner = np.matmul(change, p["out"].T, out=_room(kept, "inner", (n * STRIDE, HIDDEN), kind))
        inner *= hidden[:, :-1] > 0
        first = joined.T @ inner
        back = np.matmul(inner, p["hidden"].T, out=_room(kept, "back", (n * STRIDE, 2 * WIDTH), kind))
        late, looked = back.reshape(n, STRIDE, 2 * WIDTH)[:, :, :WIDTH], back.reshape(n, STRIDE, 2 * WIDTH)[:, :, WIDTH:]
        q, k, v = mapped[:, _FIRST:, :WIDTH], mapped[:, :, WIDTH:2 * WIDTH], mapped[:, :, 2 * WIDTH:]
        to_mapped = _room(kept, "to_mapped", mapped.shape, kind)
        to_mapped[:, :_FIRST, :WIDTH] = 0
        np.matmul(weights.transpose(0, 2, 1), looked, out=to_mapped[:, :, 2 * WIDTH:])
        scores = np.matmul(looked, v.transpose(0, 2, 1), out=_room(kept, "scores", weights.shape, kind))
        mixed *= looked
        scores -= (mixed.reshape(-1, WIDTH) @ np.ones((WIDTH, 1), kind)).reshape(n, STRIDE, 1)
        scores *= weights
        np.matmul(scores, k, out=to_mapped[:, _FIRST:, :WIDTH])
        np.matmul(scores.transpose(0, 2, 1), q, out=to_mapped[:, :, WIDTH:2 * WIDTH])
        flat = to_mapped.reshape(-1, 3 * WIDTH)
        three = x.T @ flat
        places = np.matmul(flat, self._three().T, out=_room(kept, "places", x.shape, kind))
        places.reshape(n, CONTEXT, WIDTH)[:, _FIRST:] += late
        distances = (np.ones((1, n), kind) @ scores.reshape(n, -1))[0]
        return {"out": out[:-1], "out0": out[-1], "hidden": first[:-1], "hidden0": first[-1],
                "bias": np.bincount(_APART.ravel(), weights=distances, minlength=CONTEXT),
                "query": three[:, :WIDTH] * np.float32(WIDTH ** -0.5), "key": three[:, WIDTH:2 * WIDTH],
                "value": three[:, 2 * WIDTH:], "embed": _summed(places, rows.ravel(), len(p["embed"]))}

    def fit(self, rows: np.ndarray, classes: np.ndarray, seed: int = 13, rate: float = RATE) -> None:
        """One pass of Adam over windows in random order.

        All parameters lie in one array. Embedding rows that no window has would not move, so they stay out of it.
        """
        random = np.random.default_rng(seed)
        whole = self.p["embed"]
        used = np.zeros(len(whole), bool)
        used[rows] = True
        used[self.none_row] = True
        number = np.cumsum(used) - 1
        rows, none_row = number[rows], self.none_row
        self.none_row = number[none_row]
        self.p["embed"] = whole[used]
        names = sorted(self.p)
        flat = np.concatenate([self.p[name].ravel() for name in names])
        ends = np.cumsum([self.p[name].size for name in names])
        for name, part in zip(names, np.split(flat, ends[:-1]), strict=True):
            self.p[name] = part.reshape(self.p[name].shape)
        first, second, step_by, kept = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat), {}
        order = random.permutation(len(rows))
        for step, at in enumerate(range(0, len(order), BATCH), 1):
            batch = order[at:at + BATCH]
            found = self.gradients(rows[batch], classes[batch], kept)
            change = np.concatenate([found[name].ravel() for name in names], dtype=np.float32, casting="same_kind")
            np.subtract(change, first, out=step_by)
            step_by *= np.float32(0.1)
            first += step_by
            np.square(change, out=change)
            change -= second
            change *= np.float32(0.01)
            second += change
            even = np.sqrt(1 - 0.99 ** step)
            np.sqrt(second, out=step_by)
            step_by += np.float32(1e-7 * even)
            np.divide(first, step_by, out=step_by)
            step_by *= np.float32(rate * even / (1 - 0.9 ** step))
            flat -= step_by
        whole[used] = self.p["embed"]
        self.p["embed"], self.none_row = whole, none_row

    def score(self, texts: list[np.ndarray], vocabulary: Vocabulary) -> np.ndarray:
        """log10 probability of each text, its end included."""
        out, tables, kept = np.zeros(len(texts)), self.tables(), {}
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < SUBWORDS_AT_ONCE:
                size += len(texts[end]) + 1
                end += 1
            out[at:end] = self._scores(texts[at:end], vocabulary, tables, kept)
            at = end
        return out

    def _scores(self, texts: list[np.ndarray], vocabulary: Vocabulary, tables: tuple[np.ndarray, ...],
                kept: dict) -> np.ndarray:
        rows, classes, steps = windows_of(texts, vocabulary)
        logs = np.empty(len(rows))
        for at in range(0, len(rows), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            found = self.log_classes(rows[part], np.maximum(classes[part], 0), tables, kept)
            logs[part] = np.where(classes[part] >= 0, found, 0).sum(axis=1, dtype=np.float64)
        within = [vocabulary.within[vocabulary.befores(ids), np.append(ids, vocabulary.end)].sum(dtype=np.float64)
                  for ids in texts]
        return np.array(within) + np.add.reduceat(logs, np.cumsum(steps) - steps) / np.log(10)
