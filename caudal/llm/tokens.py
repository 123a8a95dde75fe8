"""Token ids of whole texts by a tokenizer file of the `tokenizers` library, a cache of pieces before it.

A text is cut at spaces where no token can cross: before a space that follows a character
other than white space, or, for a tokenizer that drops white space, at every space. The library
encodes each distinct piece; the ids of a text are those of its pieces, one after the other. The cache
is bounded by two generations of pieces; pieces over LONG characters are not kept.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

# The split pattern of the byte-level format, fixed.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED = 400_000
LONG = 200
SEGMENT = 1 << 20
# Letters and then punctuation: two runs that no token crosses. Not the apostrophe, which may start a
# contraction, nor the brackets of special tokens.
_TAILED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\[-`{-~]+)")
_CUT = re.compile(r"(?<=[^\s᠎]) ")


def segments(text: str, size: int = SEGMENT):
    """The text in parts of about `size` characters, cut before a space that follows a non-space."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def _open(piece: str) -> bool:
    return not piece or piece[-1].isspace() or piece[-1] == "᠎"


@contextmanager
def _no_cycles() -> Iterator[None]:
    """Work on very many small objects without cycles, which the cycle collector would look through again and again."""
    paused = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if paused:
            gc.enable()


class _Pieces(dict):
    """Piece to ids. A new piece gets an empty bytearray at once, which `fill` fills for all users.

    A piece of letters and punctuation is its letters and its punctuation. A piece after which a cut may be wrong gets None.
    """

    def __init__(self, encode_many, keeps_space: bool):
        super().__init__()
        self.old: dict[str, bytes | None] = {}
        self._encode, self._keeps_space = encode_many, keeps_space
        self._prefix = " " if keeps_space else ""
        self._tails: dict[str, bytes] = {}
        self._todo: dict[str, bytearray] = {}
        self._stems: list[tuple[str, str, str]] = []

    def __missing__(self, piece: str):
        if piece in self.old:
            value = self[piece] = self.old[piece]
            return value
        if self._keeps_space and _open(piece):
            self[piece] = None
            return None
        value = self[piece] = bytearray()
        if piece and not piece[-1].isalpha() and (tailed := _TAILED.fullmatch(piece)):
            stem, tail = tailed.groups()
            self._stems.append((piece, stem, tail))
            self[stem]
        else:
            self._todo[piece] = value
        return value

    def fill(self) -> None:
        if self._todo:
            prefix = self._prefix
            encoded = self._encode([prefix + piece for piece in self._todo])
            for (piece, value), ids in zip(self._todo.items(), encoded, strict=True):
                value += ids
                self[piece] = ids
        tails = list({tail for _, _, tail in self._stems} - self._tails.keys())
        if len(self._tails) > LONG:
            self._tails, tails = {}, list({tail for _, _, tail in self._stems})
        self._tails.update(zip(tails, self._encode(tails), strict=True))
        for piece, stem, tail in self._stems:
            value = self[piece]
            value += self[stem]
            value += self._tails[tail]
            self[piece] = bytes(value)

    def settle(self, cached: int) -> None:
        """After a batch: let long pieces go, and start a new generation if this one is full."""
        for piece in [p for p in (*self._todo, *(s[0] for s in self._stems)) if len(p) > LONG]:
            self.pop(piece, None)
        self._todo, self._stems = {}, []
        if len(self) > cached:
            self.old = dict(self)
            self.clear()


class PieceCache:
    """`encode_many` maps a list of strings to their ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encode_many, keeps_space: bool, cached: int = CACHED):
        self._encode, self._keeps_space, self._cached = encode_many, keeps_space, cached
        self._pieces = _Pieces(encode_many, keeps_space)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as bytes; a null text is empty."""
        with _no_cycles():
            return self._ids(texts)

    def _ids(self, texts: list[str | None]) -> list[bytes]:
        if not self._keeps_space:
            texts = [text and text.replace("\n", " ") for text in texts]
        parts = [[s.split(" ") for s in segments(text)] if text else [] for text in texts]
        get = self._pieces.__getitem__
        found = [[list(map(get, split)) for split in part] for part in parts]
        self._pieces.fill()
        if self._keeps_space:
            out = [b"".join(map(self._joined, part, ids))
                   for part, ids in zip(parts, found, strict=True)]
        else:
            out = [b"".join(map(b"".join, ids)) for ids in found]
        self._pieces.settle(self._cached)
        return out

    def _joined(self, split: list[str], ids: list[bytes | None]) -> bytes:
        """The first piece of a text has no space before it, and the last may end as it likes."""
        first, last = split[0], split[-1]
        if len(split) == 1:
            return self._encode([first])[0]
        if not (first and _open(first)):
            ids[0] = self._encode([first])[0] if first else b""
            if ids[-1] is None:
                ids[-1] = self._encode([" " + last])[0]
            try:
                return b"".join(ids)
            except TypeError:  # white space before a space
                pass
        head, *rest = _CUT.split(" ".join(split))
        return b"".join(self._encode([head, *(" " + piece for piece in rest)]))


def byte_letters() -> dict[int, int]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves; the other bytes take characters from 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + n for n, b in enumerate(rest)}


@lru_cache(maxsize=2)
def library_cache(path: str, keeps_space: bool) -> PieceCache:
    """One cache for each Python worker and tokenizer file.

    A piece of Latin-1 letters is one word for the normaliser and the splitter, so it goes to
    the library's model without them, many words at once. All other pieces take the whole way.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import numpy as np
    from tokenizers import Tokenizer

    with open(path) as file:
        described = json.load(file)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    described |= {"normalizer": None, "added_tokens": [], "truncation": None, "padding": None,
                  "pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": "\n"}}
    words = Tokenizer.from_str(json.dumps(described))
    words.model._resize_cache(0)  # the words that come here are new ones
    letters = byte_letters()

    def ids_of(by: Tokenizer, texts: list[str]) -> list[np.ndarray]:
        return [np.fromiter(e.ids, "<u4", len(e.ids))
                for e in by.encode_batch_fast(texts, add_special_tokens=False)]

    ends = np.zeros(tokenizer.get_vocab_size(), bool)  # ids that end a word, if the model marks them
    suffix = described["model"].get("end_of_word_suffix")
    if suffix:
        ends[[i for word, i in described["model"]["vocab"].items() if word.endswith(suffix)]] = True

    def spelled(piece: str) -> str:
        if not keeps_space:
            piece = piece.lower()
        if piece.isascii():
            return "Ġ" + piece[1:] if piece[0] == " " else piece
        return piece.encode().decode("latin-1").translate(letters)

    def encode_words(pieces: list[str]) -> list[bytes]:
        """Words between delimiters; the delimiter, or a word's last token, tells them apart."""
        if suffix:
            (ids,) = ids_of(words, ["\n".join(map(spelled, pieces))])
            stops = (np.flatnonzero(ends[ids]) + 1).tolist()
        else:
            encodings = words.encode_batch(["\n".join(map(spelled, pieces))])[0]
            ids = np.fromiter(encodings.ids, "<u4", len(encodings.ids))
            of = np.array(encodings.word_ids)
            stops = (np.flatnonzero(np.diff(of, append=-1)) + 1).tolist()
        data, start, out = ids.tobytes(), 0, []
        for stop in stops:
            out.append(data[4 * start:4 * stop])
            start = stop
        return out

    def is_word(piece: str) -> bool:
        word = piece[1:] if piece[:1] == " " else piece
        return word.isalpha() and len(word) <= LONG and (word.isascii() or max(word) <= "\xff")

    def encode_many(texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        simple = [i for i, text in enumerate(texts) if is_word(text)] if len(texts) > 8 else []
        if simple:
            for i, ids in zip(simple, encode_words([texts[i] for i in simple]), strict=True):
                out[i] = ids
        taken = set(simple)
        rest = [i for i, text in enumerate(texts) if text and i not in taken]
        for i, ids in zip(rest, ids_of(tokenizer, [texts[i] for i in rest]), strict=True):
            out[i] = ids.tobytes()
        return out

    return PieceCache(encode_many, keeps_space)


@lru_cache(maxsize=1)
def byte_level_core(path: str):
    """A function from text to ids, as `tokenizers` gives them for a byte-level file.

    The merge table of the file runs on the core of `tiktoken`, which is several times
    faster on words that were not seen before; special tokens in a text get their ids.
    """
    import tiktoken

    with open(path) as file:
        described = json.load(file)
    byte_of = {chr(code): byte for byte, code in byte_letters().items()}
    ranks = {bytes(byte_of[c] for c in word): i for word, i in described["model"]["vocab"].items()}
    special = {token["content"]: token["id"] for token in described["added_tokens"]}
    core = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(text: str | None) -> bytes:
        out = array("I")
        for part in segments(text or ""):
            if any(token in part for token in special):
                out.extend(core.encode(part, allowed_special="all"))
            else:
                out.extend(core.encode_ordinary(part))
        return out.tobytes()

    return ids


@lru_cache(maxsize=1)
def token_bytes(path: str) -> tuple[list[bytes], set[int]]:
    """The bytes of each id of a byte-level file, and the ids of special tokens."""
    with open(path) as file:
        described = json.load(file)
    byte_of = {chr(code): byte for byte, code in byte_letters().items()}
    out = {i: bytes(byte_of[c] for c in word) for word, i in described["model"]["vocab"].items()}
    special = {token["id"]: token["content"].encode() for token in described["added_tokens"]}
    out |= special
    return [out.get(i, b"") for i in range(max(out) + 1)], set(special)
