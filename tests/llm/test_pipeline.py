"""The corpus pipeline: each stage against a brute-force version of it, and all queries against their SQL."""

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from caudal.llm.oracle import ORACLE
from caudal.llm.queries import QUERIES
from caudal.llm.shared import table
from caudal.llm.toxicity import toxicity
from compare import differences, duck
from test_dedup import brute_repeats, lowered, words_of

SF_DIR = "/root/testdata/sf0.001"


def test_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= entry_points.queries().keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(entry_points.queries()[name](spark, SF_DIR), duck(SF_DIR), ORACLE[name]) == ""


def test_stages(session, tmp_path):
    docs = table(session, SF_DIR, "documents")
    columns = docs.columns
    kept = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        if name == "toxicity":
            rejected = {r.doc_id for r in toxicity(docs, table(session, SF_DIR, "labels")).collect() if r.flagged}
            want = {i: t for i, t in kept.items() if i not in rejected}
        elif name == "exact dedup":
            last = {lowered(t): i for i, t in sorted(kept.items())}
            want = {i: kept[i] for i in last.values()}
        elif name == "near dedup":
            want = brute_near(kept)
        elif name == "suffix dedup":
            want = brute_removal(kept)
        stage(session, docs, SF_DIR).write.parquet(str(tmp_path / name.replace(" ", "_")))
        docs = session.read.parquet(str(tmp_path / name.replace(" ", "_")))
        if name != "packing":
            assert docs.columns == columns
            kept = {r.doc_id: r.text for r in docs.collect()}
            assert kept == want, name
            assert all(r.n_chars == len(r.text) for r in docs.collect())
    rows = docs.collect()
    assert {r.doc_id for r in rows} == set(kept)
    filled = {}
    for r in rows:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 2048 and len(filled) <= sum(filled.values()) / 2048 * 1.02 + 2


def brute_near(texts):
    sets = {}
    for i, text in texts.items():
        w = words_of(text)
        n = min(5, len(w))
        sets[i] = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if w else frozenset()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: t for i, t in texts.items() if find(i) == i}


def brute_removal(texts):
    from caudal.llm.suffix_dedup import without_words

    spans = {}
    for i, a, b in brute_repeats([(i, 0, t) for i, t in texts.items()]):
        spans.setdefault(i, []).append((a, b))
    out = {i: without_words(t, spans[i]) if i in spans else t for i, t in texts.items()}
    return {i: t for i, t in out.items() if i not in spans or words_of(t)}


def test_run_gives_the_stages_result(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 0
