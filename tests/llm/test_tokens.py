"""BPE, token files and packing against the tokenizers library."""

import gc
import hashlib
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caudal.llm.bpe import bpe_decode, bpe_digest, bpe_encode, byte_bpe
from caudal.llm.packing import best_fit, crossover, cut, evolve, fitness, pack_documents
from caudal.llm.token_files import read_tokens, token_file_digest, write_tokens
from caudal.llm.tokens import PieceCache, byte_level_core, library_cache, segments
from rows import documents, empty

os.environ["TOKENIZERS_PARALLELISM"] = "false"
BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  ", "a  b", "a   b c", " a", "a ", "a\n b", "a \nb  \n c ", "x <|endoftext|> y<|endoftext|>z ",
       "it's  'S 't", "é́ ́a", "  a  b", "İ ΑΣ Σ", "tab\t x\x1c y\x85 z", "日本 語  テスト😀", "᠎ a᠎ b",
       "a" * 500 + " b", "ﬁ Å", "ÉTÉ ß ª µ ÿ × a×b", "a!! b###% c#<|endoftext|> é.,. ÉÀ!|", "A. b, C., .,  . , é.",
       "ab" * 700 + "\n\n\n", " \0 x\0y <|startoftext|>"]


def library(path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def expected(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path,keeps_space", [(BYTE, True), (WORD, False)])
def test_piece_cache_equals_library(path, keeps_space):
    tokenizer, cache = library(path), library_cache(path, keeps_space)
    letters = "abcdefg éàÉ\n.,<|>  'st1ñ漢!#"
    texts = ODD + ["".join(random.Random(n).choices(letters, k=n % 150)) for n in range(300)]
    for _ in range(2):  # the second time from the cache
        for text, ids in zip(texts, cache.ids(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == expected(tokenizer, text), text


def test_cache_generations_are_bounded():
    calls = []

    def encode(texts):
        calls.extend(texts)
        return [bytes([len(t)]) for t in texts]

    cache = PieceCache(encode, keeps_space=False, cached=10)
    for n in range(30):
        cache.ids([f"p{n} q{n} r{n}"])
    assert len(cache._pieces) <= 13 and len(cache._pieces.old) <= 13
    assert cache.ids([None, "p29"]) == [b"", b"\3"]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=120))
def test_backtracking_equals_library(text):
    bpe, tokenizer = byte_bpe(BYTE), library(BYTE)
    ids = np.frombuffer(bpe.encode([text])[0], "<u4")
    assert ids.tolist() == expected(tokenizer, text)
    assert bpe.decode_text(ids) == tokenizer.decode(ids.tolist(), skip_special_tokens=False)
    assert byte_level_core(BYTE)(text) == ids.tobytes()


def test_backtracking_on_odd_texts():
    bpe, tokenizer = byte_bpe(BYTE), library(BYTE)
    for text in ODD:
        assert np.frombuffer(bpe.encode([text])[0], "<u4").tolist() == expected(tokenizer, text), text


def test_segments_join_to_the_text():
    text = "ab cd  ef\n gh " * 40
    parts = list(segments(text, 25))
    assert "".join(parts) == text and len(parts) > 10
    assert list(segments("x" * 100, 10)) == ["x" * 100]


def test_bpe_frames(session):
    docs = documents(session)
    tokenizer = library(BYTE)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    got = sorted(map(str, bpe_digest(docs, BYTE).collect()))
    want = []
    for doc_id, text in texts:
        ids = expected(tokenizer, text)
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want.append(f"Row(doc_id={doc_id}, n_tokens={len(ids)}, "
                    f"ids_sha256='{hashlib.sha256(np.array(ids, '<u4').tobytes()).hexdigest()}', "
                    f"decoded_sha256='{hashlib.sha256(decoded.encode()).hexdigest()}')")
    assert got == sorted(want)
    back = bpe_decode(bpe_encode(docs, BYTE), BYTE)
    assert sorted(r.text for r in back.collect()) == sorted(t for _, t in texts)
    assert bpe_digest(empty(session), BYTE).count() == 0


def test_token_files(session, tmp_path):
    docs = documents(session)
    tokenizer = library(WORD)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, expected(tokenizer, r.text) + [2]) for r in docs.collect()),
                  key=lambda r: r[:2])
    got = token_file_digest(docs, WORD, keeps_space=False, end_id=2).collect()
    got = sorted((r.start, r.n_tokens, r.ids_crc32, r.doc_id) for r in got)
    assert [r[3] for r in got] == [r[1] if r[0] else None for r in rows]
    start, seen, want = 0, [], []
    for r in got:
        assert r[0] == start
        start += r[1]
        seen.append((r[3], r[1], r[2]))
    for known, doc_id, ids in rows:
        want.append((doc_id if known else None, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(map(str, seen)) == sorted(map(str, want))
    assert token_file_digest(empty(session), WORD, keeps_space=False, end_id=2).count() == 0
    write_tokens(docs, str(tmp_path / "t"), WORD, keeps_space=False, end_id=2)
    plan = read_tokens(session, str(tmp_path / "t")).filter("doc_id = 5").select("n_tokens")._jdf.queryExecution(
    ).executedPlan().toString()
    assert "EqualTo(doc_id,5)" in plan and "ids" not in plan.split("ReadSchema")[1]


def test_token_file_layout(session, tmp_path):
    import pyarrow.parquet as pq

    write_tokens(documents(session), str(tmp_path / "t"), WORD, keeps_space=False, end_id=2)
    group = pq.ParquetFile(sorted((tmp_path / "t").glob("*.parquet"))[0]).metadata.row_group(0)
    columns = {group.column(n).path_in_schema: group.column(n) for n in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    assert columns["doc_id"].has_offset_index and columns["doc_id"].has_column_index


def test_cut():
    assert cut(1) == [(0, 1)] and cut(2048) == [(0, 2048)]
    assert cut(2049) == [(0, 1), (1, 2048)] and cut(6000, 2048) == [(0, 1904), (1904, 2048), (3952, 2048)]


def test_crossover_keeps_every_piece_once_and_bins_whole():
    random_ = np.random.default_rng(0)
    lengths = np.sort(random_.integers(1, 100, 400))[::-1]
    people = []
    for _ in range(2):
        bins, free = np.zeros(400, np.int64), []
        best_fit(random_.permutation(400).tolist(), lengths.tolist(), bins, free, 100)
        people.append(bins)
    child = crossover(people[0], people[1], lengths, lengths.tolist(), 100, random_)
    assert np.bincount(child, weights=lengths).max() <= 100 and len(child) == 400
    assert set(child) == set(range(child.max() + 1))
    best = evolve(lengths, [], 100, random_)
    assert fitness(best, lengths, 100) <= fitness(people[0], lengths, 100)
    decreasing, free = np.zeros(400, np.int64), []
    best_fit(range(400), lengths.tolist(), decreasing, free, 100)
    assert best.max() + 1 <= len(free)


def test_packing(session):
    docs = documents(session)
    tokenizer = library(BYTE)
    got = pack_documents(docs, BYTE).collect()
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append(r)
    for rows in by_sequence.values():
        place = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= 2048
    want = []
    for r in docs.collect():
        ids = np.array([*expected(tokenizer, r.text), 0], "<u4")
        for piece, (start, length) in enumerate(cut(len(ids))):
            want.append((r.doc_id, piece, start, length, zlib.crc32(ids[start:start + length].tobytes())))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got)
    total = sum(r.length for r in got)
    assert len(by_sequence) <= -(-total // 2048) + 1
    assert pack_documents(empty(session), BYTE).count() == 0


@pytest.mark.parametrize("on", [True, False])
def test_encoding_pauses_the_cycle_collector(on):
    seen = []

    def encode_many(texts):
        seen.append(gc.isenabled())
        if "broken" in texts:
            raise ValueError("broken")
        return [text.encode() for text in texts]

    before = gc.isenabled()
    try:
        (gc.enable if on else gc.disable)()
        assert PieceCache(encode_many, False).ids(["a b", None]) == [b"ab", b""]
        assert gc.isenabled() == on
        with pytest.raises(ValueError):
            PieceCache(encode_many, False).ids(["broken"])
        assert gc.isenabled() == on and not any(seen)
    finally:
        (gc.enable if before else gc.disable)()
