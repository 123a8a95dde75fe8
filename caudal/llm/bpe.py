"""Byte-level BPE encoding by backtracking, and decoding by an offset table.

Encoding a run of bytes: an Aho-Corasick automaton over the reversed tokens reads the run backwards
and gives the longest token that starts at each place. From the left, the longest token is taken if it may
follow the token before it; otherwise the next shorter token that is its prefix, and if none is left,
the token before it is taken back and the place is marked as one that no valid encoding reaches. Each place is
marked once at most, so the work is linear in the length.

Two tokens may stand side by side if merging their bytes by rank leaves exactly these two. That
is read off the merge table by undoing merges at the touching ends, latest first: a merge across the
border that ranks before the undone one would have come first. The answers are kept in a table of
bounded size.

Texts are split into runs by the pattern of the byte-level format, special tokens before that;
pieces of text that were seen before come from a bounded cache (tokens.py).

Defined cases: a null text is empty, has no tokens and decodes to the empty text; equal rows and null
ids are kept; columns beside id and text are not read; long texts are encoded in parts that no token
crosses.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.shared import in_batches
from caudal.llm.token_files import id_lists
from caudal.llm.tokens import PATTERN, PieceCache, byte_letters

PAIRS_KEPT = 300_000
DECODED_AT_ONCE = 1 << 18


class ByteBpe:
    """Encoder and decoder of one tokenizer file. Tokens are numbered by rank inside: bytes, then merges."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path) as file:
            described = json.load(file)
        vocabulary, merges = described["model"]["vocab"], described["model"]["merges"]
        letters = {byte: chr(code) for byte, code in byte_letters().items()}
        self._letters = {byte: ord(letter) for byte, letter in letters.items()}
        bytes_of = {letter: byte for byte, letter in letters.items()}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        words = [*letters.values(), *(a + b for a, b in pairs)]
        rank = {word: n for n, word in enumerate(words)}
        self._id = np.array([vocabulary[word] for word in words], "<u4")
        self._length = [len(word) for word in words]
        self._parts = [(n, n) for n in range(len(letters))] + [(rank[a], rank[b]) for a, b in pairs]
        self._merged = {(rank[a], rank[b]): rank[a + b] for a, b in pairs}
        self._shorter = [next((rank[w[:n]] for n in range(len(w) - 1, 0, -1) if w[:n] in rank), -1)
                         for w in words]
        self._longest = ahocorasick.Automaton()
        for word, n in rank.items():
            self._longest.add_word(word[::-1], n)
        self._longest.make_automaton()
        self._fits: dict[tuple[int, int], bool] = {}

        self._special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self._split = regex.compile(PATTERN)
        self._marks = (regex.compile("(" + "|".join(map(regex.escape, self._special)) + ")")
                       if self._special else None)

        spelled = {i: bytes(bytes_of[c] for c in w) for w, i in vocabulary.items()}
        spelled |= {i: content.encode() for content, i in self._special.items()}
        table = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self._offsets = np.cumsum([0, *map(len, table)])
        self._bytes = np.frombuffer(b"".join(table), np.uint8)
        self.cache = PieceCache(self._encode_many, keeps_space=True)

    def fits(self, left: int, right: int) -> bool:
        """Whether `left` and `right` stay as they are when their bytes are merged together."""
        known = self._fits.get((left, right))
        if known is None:
            known = self._merges_to(left, right)
            if len(self._fits) >= PAIRS_KEPT:
                self._fits.clear()
            self._fits[left, right] = known
        return known

    def _merges_to(self, left: int, right: int) -> bool:
        undone = len(self._parts)  # merges of this rank or later have not happened yet
        while True:
            across = self._merged.get((left, right))
            if across is not None and across < undone:
                return False
            # Undo the later of the two merges; between equal tokens the left one came first.
            sides = [(left, 0), (right, 1)] if left > right else [(right, 1), (left, 0)]
            for token, is_right in sides:
                inner, outer = self._parts[token] if is_right else self._parts[token][::-1]
                if inner != token:
                    break
            else:
                return True
            if is_right:
                undone, right = token + 1, inner
            else:
                undone, left = token, inner

    def encode_run(self, run: str) -> list[int]:
        """Ranks of one run, given in the letters that stand for its bytes."""
        size = len(run)
        starts = [-1] * size
        for end, token in self._longest.iter(run[::-1]):
            place = size - 1 - end
            if self._length[token] > (self._length[starts[place]] if starts[place] >= 0 else 0):
                starts[place] = token
        length, shorter = self._length, self._shorter
        reachable = bytearray(b"\1") * (size + 1)
        tokens: list[int] = []
        place, token = 0, starts[0]
        while place < size:
            last = tokens[-1] if tokens else -1
            while True:
                end = place + length[token]
                if reachable[end] and (last < 0 or self.fits(last, token)):
                    tokens.append(token)
                    place = end
                    token = starts[place] if place < size else -1
                    break
                token = shorter[token]
                if token < 0:
                    reachable[place] = 0
                    token = tokens.pop()
                    place -= length[token]
                    break
        return tokens

    def _encode_text(self, text: str) -> bytes:
        if self._marks is not None and "<" in text:
            parts = self._marks.split(text)
        else:
            parts = [text]
        out = []
        for part in parts:
            if part in self._special:
                out.append(np.array([self._special[part]], "<u4").tobytes())
                continue
            runs = [part] if part.isascii() and part[1:].isalpha() and (
                part[0] == " " or part[0].isalpha()) else self._split.findall(part)
            ranks = [t for run in runs
                     for t in self.encode_run(run.encode().decode("latin-1").translate(self._letters))]
            out.append(self._id[ranks].tobytes() if ranks else b"")
        return b"".join(out)

    def _encode_many(self, texts: list[str]) -> list[bytes]:
        return [self._encode_text(text) for text in texts]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.cache.ids(texts)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens: gathered from the table by each token's offset and length."""
        out = []
        for at in range(0, len(ids), DECODED_AT_ONCE):
            part = ids[at:at + DECODED_AT_ONCE].astype(np.int64)
            first = self._offsets[part]
            size = self._offsets[part + 1] - first
            ends = np.cumsum(size)
            places = np.repeat(first - (ends - size), size) + np.arange(ends[-1])
            out.append(self._bytes[places].tobytes())
        return b"".join(out)

    def decode_text(self, ids: np.ndarray) -> str:
        return self.decode(ids).decode("utf-8", errors="replace")


@lru_cache(maxsize=1)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder for each Python worker and file."""
    return ByteBpe(path)


def bpe_encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ids (array of int) of each row of (doc_id, text)."""
    def each(columns):
        yield {"doc_id": columns["doc_id"], "ids": id_lists(byte_bpe(tokenizer).encode(columns["text"]))}

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), each, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and text of each row of (doc_id, ids); null ids give the empty text."""
    def each(columns):
        bpe = byte_bpe(tokenizer)
        yield {"doc_id": columns["doc_id"],
               "text": [bpe.decode_text(np.asarray(ids)) if ids is not None else ""
                        for ids in columns["ids"]]}

    return in_batches(encoded.select("doc_id", "ids"), each, "doc_id long, text string")


def bpe_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encode and decode each text; the number of tokens and digests of both results."""
    def each(columns):
        bpe = byte_bpe(tokenizer)
        encoded = bpe.encode(columns["text"])
        decoded = (bpe.decode_text(np.frombuffer(ids, "<u4")) for ids in encoded)
        yield {"doc_id": columns["doc_id"],
               "n_tokens": [len(ids) // 4 for ids in encoded],
               "ids_sha256": [hashlib.sha256(ids).hexdigest() for ids in encoded],
               "decoded_sha256": [hashlib.sha256(text.encode()).hexdigest() for text in decoded]}

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), each,
                      "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
