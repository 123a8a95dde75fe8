"""The stages on repeated rows and nulls, which the small tables do not have."""

import os
from collections import Counter

import pytest

from caudal.llm import exact_dedup, near_dedup, stages, suffix_dedup
from caudal.llm.shared import crossing, scope, staged
from rows import WORDS, documents


def left(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def test_exact_and_near_keep_one_row_of_each_group(session):
    docs = documents(session, ((None, "another text that no other row has"),))
    rows = left(docs)
    texts = {}
    for (doc_id, text), n in rows.items():
        texts.setdefault((text or "").lower(), []).extend([doc_id] * n)
    exact = stages.exact(session, docs, "")
    assert exact.columns == docs.columns
    got = left(exact)
    assert Counter((text or "").lower() for _, text in got.elements()) == Counter(dict.fromkeys(texts, 1))
    for doc_id, text in got:
        assert doc_id == max(texts[(text or "").lower()], key=lambda i: (i is not None, i))
    near = stages.near(session, docs, "")
    assert near.columns == docs.columns
    # No links without words; copies and long parts are linked, the smallest id stays.
    assert left(near) == rows - Counter([(1, "THE CAT sat on the mat."), (10, "a  b\n\n c <|endoftext|> d")]) - Counter(
        {key: n for key, n in rows.items() if key[0] in (6, 7, 9)})


def test_only_toxic_rows_go(session, monkeypatch):
    docs = documents(session, ((None, "toxic"), (10, "toxic")))
    labels = session.createDataFrame([(1, 0)], "doc_id long, toxic int")
    real = stages.toxicity
    monkeypatch.setattr(stages, "table", lambda *_: labels)
    monkeypatch.setattr(stages, "toxicity", lambda rows, labels, number: real(rows, labels, number=number).drop("flagged").join(
        rows.selectExpr(number, "text <=> 'toxic' AS flagged"), number))
    kept = stages.toxic(session, docs, "")
    assert kept.columns == docs.columns and left(kept) == left(documents(session))


def test_each_row_loses_its_own_passages(session):
    long = " ".join(f"z{n}" for n in range(60))
    docs = documents(session, ((None, "x " + WORDS), (None, WORDS + " y"), (20, long), (20, long), (20, None),
                               (20, "short"), (21, long + " end")))
    want = left(docs)
    # By hand: of the null ids the first holds WORDS, of id 20 the first row holds `long`.
    want -= Counter([(None, WORDS + " y"), (8, WORDS), (9, "before " + WORDS.upper() + " after"), (20, long),
                     (21, long + " end")])
    want += Counter([(None, "y"), (9, "before after"), (21, "end")])
    for key in [key for key in want if key[0] in (6, 7)]:
        del want[key]
    want[7, "tail"] += 1
    kept = stages.repeats(session, docs, "")
    assert kept.columns == docs.columns
    assert left(kept) == want
    assert all(r.n_chars == len(r.text) for r in kept.collect() if r.text is not None)


def test_each_member_meets_its_own_text_only(session):
    """Of many null ids each row asks for its runs once, whatever the other rows hold."""
    texts = [" ".join(f"q{n if n < 55 else (k, n)}" for n in range(70)) for k in range(6)]
    docs = session.createDataFrame([(n, None, t) for n, t in enumerate(texts + texts)], "row long, doc_id long, text string")
    wanted = session.createDataFrame([(n, 0) for n in range(12)], "row long, first int")
    rows = suffix_dedup._windows(docs, wanted, 50, 8).collect()
    assert len({(r.row, r.place) for r in rows}) == len(rows) and {r.row for r in rows} == set(range(12))
    found = near_dedup.near_duplicates(docs.drop("row")).collect()
    assert len(found) == 12 and sum(r.kept for r in found) == 6


def folders(session):
    root = session.conf.get("spark.checkpoint.dir").removeprefix("file://")
    return {name for name in os.listdir(root) if name.startswith("caudal-llm-")}


def test_scratch_is_deleted(session):
    """An operator leaves its result only, and a stage nothing once the next one begins."""
    docs = documents(session)
    before = folders(session)
    exact_dedup.exact_dedup(docs).collect()
    assert len(folders(session) - before) == 1
    stages.exact(session, docs, "").collect()
    left_over = folders(session)
    kept = stages.exact(session, docs, "")
    assert len(left_over - folders(session)) == 2 and kept.count() > 0
    with pytest.raises(RuntimeError), scope():
        staged(docs)
        raise RuntimeError
    assert len(folders(session) - before) == 3


def test_a_stage_keeps_what_its_input_reads(session):
    """Stages that are called one on another without writing between them."""
    docs = documents(session)
    once = stages.exact(session, docs, "")
    assert left(stages.exact(session, once, "")) == left(once)


def test_a_connected_cluster_is_copied_twice_at_most(session):
    """What is verified in a cluster of 20,000 grows with its size, not with its pairs."""
    rows = session.range(20_000).selectExpr("id AS uid", "0L AS cluster", "if(id % 4000 = 7, id, 1L) AS label")
    met = crossing(rows, "cluster", "label", 1024)
    assert met.count() <= 20_000 + 5 * 20
    minor = met.filter("minor").select("uid", "_block", "_chunk")
    every = met.filter("NOT minor").select(met.uid.alias("other"), "_block", "_chunk")
    pairs = minor.join(every, ["_block", "_chunk"]).select("uid", "other")
    assert pairs.count() == pairs.distinct().count() == 5 * 20_000


def test_minor_rows_of_many_labels_meet_all(session):
    rows = session.range(60).selectExpr("id AS uid", "id div 30 AS cluster", "id div 3 AS label")
    met = crossing(rows, "cluster", "label", 4)
    minor = met.filter("minor").select("cluster", "uid", "label", "_block", "_chunk")
    every = met.filter("NOT minor").select("cluster", met.uid.alias("other"), met.label.alias("theirs"), "_block", "_chunk")
    found = {frozenset((r.uid, r.other)) for r in minor.join(every, ["cluster", "_block", "_chunk"]).filter(
        "label != theirs").collect()}
    assert found == {frozenset((a, b)) for a in range(60) for b in range(60) if a // 30 == b // 30 and a // 3 != b // 3}
