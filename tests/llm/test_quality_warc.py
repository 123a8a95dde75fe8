"""Quality rules and WARC archives against brute force."""

import base64
import gzip
import hashlib
import re
from collections import Counter

import pytest

from caudal.llm.quality import quality
from caudal.llm.warc import (arc_entries, archived_pages, convert, iso_date, read_arc, read_warc, revisits,
                             warc_entries, write_arc)
from rows import documents, empty


def base(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    counts = Counter(grams)
    covered = {p for i, g in enumerate(grams) if counts[g] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality(session):
    docs = documents(session, (
        (40, " \n a\x0bb a b a b\n\n a\n a\n"), (41, "x y z x y z x\xa0y z"), (42, "\n"), (43, "a b c d a b c"),
        (44, " ".join(f"of{n} the the{n}" for n in range(40))), (45, " ".join(f"w{n}###" for n in range(80))),
        (46, " ".join(f"the word{n}$$$ of" for n in range(80)))))
    got = {(r.doc_id, r.word_chars): r for r in quality(docs).collect()}
    for r in docs.collect():
        want = base(r.text)
        row = got[r.doc_id, want[1]]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert row.base_failed == failed and not (failed and row.kept)
    kept = {i for (i, _), r in got.items() if r.kept}
    assert 44 in kept and not kept & {45, 46}
    assert quality(empty(session)).count() == 0
    plan = quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Pandas|Arrow", plan)


PAGES = "page_id long, url string, html string, record long, payload string"
ROWS = [(1, None, None), (2, "http://a b/é\n", ""), (3, "x", "dup\r\n\r\nWARC/1.1\r\n\n"),
        (4, None, "dup\r\n\r\nWARC/1.1\r\n\n"), (None, "u", "dup\r\n\r\nWARC/1.1\r\n\n"),
        (4, None, "dup\r\n\r\nWARC/1.1\r\n\n"), (None, None, "solo\r"), (10, "y", "\n"), (11, "z", "漢字 " * 3000)]


def pages(session):
    return session.createDataFrame([(*row, 0, "p") for row in ROWS], PAGES)


@pytest.mark.parametrize("at_least", [0, 5])
def test_archived_pages(session, at_least):
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in archived_pages(pages(session), at_least).collect())
    low = -1
    best, want, done = {}, Counter(), set()
    for page, _, html in ROWS:
        payload = (html or "").encode()
        best[payload] = max(best.get(payload, low), low if page is None else page)
    for page, _, html in ROWS:
        payload, number = (html or "").encode(), low if page is None else page
        response = len(payload) < at_least or number == best[payload] and (payload, number) not in done
        done.add((payload, number))
        want[page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
             "response" if response else "revisit", None if response else best[payload]] += 1
    assert got == want


def test_empty_pages(session):
    assert archived_pages(session.createDataFrame([], PAGES)).count() == 0


def test_versions_and_records(session, tmp_path):
    numbered = pages(session).coalesce(1).drop("record").selectExpr("*", "monotonically_increasing_id() AS record")
    write_arc(numbered, str(tmp_path / "arc"), (1, 2), archive_bytes=1)
    heads = [gzip.decompress(f.read_bytes()).split(b"\n") for f in (tmp_path / "arc").glob("*.gz")]
    assert len(heads) == len(ROWS) and {h[1].split(b" ")[0] for h in heads} == {b"1", b"2"}
    entries = read_arc(session, str(tmp_path / "arc")).collect()
    assert Counter(e.payload for e in entries) == Counter((html or "").encode() for _, _, html in ROWS)
    assert revisits(read_arc(session, str(tmp_path / "arc"))).count() == 4
    convert(session, str(tmp_path / "arc"), str(tmp_path / "warc"))
    kinds = Counter()
    for file in (tmp_path / "warc").glob("*.gz"):
        for kind, fields, block in warc_entries(gzip.decompress(file.read_bytes())):
            kinds[kind] += 1
            assert fields["WARC-Record-ID"].startswith("<urn:uuid:") and fields["WARC-Date"] == "2024-01-01T00:00:00Z"
            assert fields["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
    assert kinds["response"] == 5 and kinds["revisit"] == 4 and kinds["warcinfo"] >= 1
    ids = {r.record_id for r in read_warc(session, str(tmp_path / "warc")).collect()}
    assert len(ids) == len(ROWS)


def test_broken_archive():
    with pytest.raises(ValueError):
        list(arc_entries(b"filedesc://a 0.0.0.0 20240101000000 text/plain 99\n1 0 x\n"))
    assert iso_date("199701") == "1997-01-01T00:00:00Z" and iso_date("19970203040506") == "1997-02-03T04:05:06Z"
