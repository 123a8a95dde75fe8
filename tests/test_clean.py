import json
from collections import Counter
from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caudal.functions.audit import with_audit, with_date_parts, with_layer_meta
from caudal.operators import clean, profile

NOW = datetime(2024, 1, 2, 3, 4, 5)
slow = settings(max_examples=10, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])
maybe = st.one_of(st.none(), st.integers(0, 3))


@slow
@given(st.lists(st.tuples(maybe, maybe), max_size=10))
def test_split_required_keeps_every_row_once(spark, data):
    df = spark.createDataFrame(data, "a int, b int")
    valid, bad = clean.split_required(df, ["a", "b"])
    got_valid, got_bad = (Counter(tuple(r) for r in part.collect()) for part in (valid, bad))
    assert got_valid + got_bad == Counter(data)
    assert all(None not in row for row in got_valid)


def test_conform_gives_null_for_bad_text(spark):
    df = spark.createDataFrame([("1", "2024-02-29", " ab "), ("x", "xx", None)],
                               "n string, d string, c string")
    got = [tuple(r) for r in clean.conform(df, {"n": "int"}, ("d",), ("c",)).collect()]
    assert got == [(1, date(2024, 2, 29), "AB"), (None, None, None)]


def test_split_range_and_in_range(spark):
    days = [date(1999, 12, 31), date(2000, 1, 1), date(2010, 6, 15), date(2030, 12, 31),
            date(2099, 1, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    low, high = date(2000, 1, 1), date(2030, 12, 31)
    inside, outside = clean.split_range(df, "d", low, high)
    assert {r["d"] for r in inside.collect()} == set(days[1:4])
    assert {r["d"] for r in outside.collect()} == {days[0], days[4], None}
    assert clean.in_range(df, "d", low, high).count() == 4
    assert clean.in_range(df, "d", low, high, keep_null=False).count() == 3


def test_split_refs_treats_null_as_orphan(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a",), (None,)], "k string")
    ok, orphans = clean.split_refs(df, dim, "k")
    assert [r["k"] for r in ok.collect()] == ["a"]
    assert {r["k"] for r in orphans.collect()} == {"b", None}


def test_tags_name_the_first_broken_rule_and_keep_the_row(spark):
    df = clean.start_tags(spark.createDataFrame(
        [("1", "ann", "a"), ("2", None, "zz"), ("3", "bob", "zz")],
        "id string, name string, k string"))
    dim = spark.createDataFrame([("a",)], "k string")
    df = clean.tag(df, F.col("name").isNull(), "MISSING", hidden=("name",))
    df = clean.tag_refs(df, dim, "k", "UNKNOWN")
    assert [r["id"] for r in clean.accepted(df).collect()] == ["1"]
    bad = {r["row_key"]: r for r in clean.rejected(df, "t", ("id",), "B1", NOW).collect()}
    assert {k: r["reason"] for k, r in bad.items()} == {"2": "MISSING", "3": "UNKNOWN"}
    assert json.loads(bad["3"]["payload"]) == {"k": "zz", "id": "3", "name": "bob"}
    assert bad["2"]["source_table"] == "t" and bad["2"]["rejected_at"] == NOW


def test_hidden_columns_are_hashed_in_the_payload(spark):
    df = clean.start_tags(spark.createDataFrame([("1", "x")], "id string, name string"))
    df = clean.tag(df, F.lit(True), "R", hidden=("name",))
    assert json.loads(df.head()[clean.PAYLOAD])["name"].startswith("2d711642")


def test_reject_envelope(spark):
    df = spark.createDataFrame([(1, "p")], "a int, b string")
    row = clean.reject(df, "t", "R", ("a", "b"), "B", NOW).head()
    assert (row["row_key"], json.loads(row["payload"])) == ('["1","p"]', {"a": 1, "b": "p"})
    assert clean.reject(df, "t", "R", ("b",), "B", NOW).head()["row_key"] == "p"


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, 1, "y")],
                               "a int, b int, c string")
    got = {r["column_name"]: r["null_pct"] for r in profile.null_profile(df).collect()}
    assert got == {"b": 66.67, "c": 33.33}
    assert profile.null_profile(df.limit(0)).count() == 0


def test_since_and_next_mark(spark):
    days = ["2024-05-31", "2024-06-01", "2024-06-02", "2099-01-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    assert profile.since(df, "d", None).count() == 4
    assert profile.since(df, "d", "2024-06-01").count() == 2
    assert profile.since(df, "d", "2024-06-01", inclusive=True).count() == 3
    assert profile.next_mark(df, "d", date(2024, 12, 31)).head()[0] == "2024-06-02"
    assert profile.next_mark(df.filter("d > '2098'"), "d", date(2024, 12, 31)).head()[0] is None


def test_quality_report(spark):
    tagged = clean.start_tags(spark.createDataFrame([(1, None), (2, 5), (3, 6), (None, 7)],
                                                    "id int, v int"))
    tagged = clean.tag(tagged, F.col("id").isNull(), "R")
    counts = profile.batch_counts(tagged, clean.REASON, ["id", "v"])
    row = profile.quality_report(counts, "t", "B", NOW).head()
    assert (row["n_input"], row["n_output"], row["n_rejected"], row["pct_conformes"]) == (4, 3, 1, 75.0)
    assert json.loads(row["null_summary"]) == {"v": 33.33}
    empty = profile.batch_counts(tagged.limit(0), clean.REASON, ["id", "v"])
    assert profile.quality_report(empty, "t", "B", NOW).head()["pct_conformes"] == 0.0


def test_audit_columns(spark):
    df = spark.createDataFrame([(date(2024, 3, 7),)], "d date")
    row = with_date_parts(df, "d", ("y", "m", "dd")).head()
    assert (row["y"], row["m"], row["dd"]) == ("2024", "03", "07")
    row = with_audit(df, "core", "B", NOW).head()
    assert (row["_ingestion_timestamp"], row["_source_system"], row["_batch_id"]) == (NOW, "core", "B")
    row = with_layer_meta(df, "silver", "B", NOW).head()
    assert (row["_silver_timestamp"], row["_batch_id_silver"]) == (NOW, "B")


def test_fact_joined_twice_on_a_key_is_shuffled_once(spark):
    from caudal.operators.attach import attach

    facts = spark.range(100).selectExpr("cast(id % 7 as string) AS c", "id AS v")
    dim = spark.range(5).selectExpr("cast(id as string) AS c", "id AS a", "id AS b")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = attach(attach(facts, dim, "c", ["a"]), dim, "c", ["b"])
        plan = both._jdf.queryExecution().executedPlan().toString()
        rows = both.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 3 and both.columns == ["c", "v", "a", "b"]
    assert len(rows) == 100 and all((r.a, r.b) == ((int(r.c),) * 2 if int(r.c) < 5 else (None, None)) for r in rows)
