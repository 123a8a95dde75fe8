from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caudal.operators import keyed
from plans_text import final_plan

slow = settings(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])
pairs = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("abc")),
                 max_size=12)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_upsert_example(spark):
    target = frame(spark, [(1, "a"), (2, "b")])
    source = frame(spark, [(2, "x"), (3, "y")])
    once = keyed.upsert(target, source, ["k"])
    assert rows(once) == Counter({(1, "a"): 1, (2, "x"): 1, (3, "y"): 1})
    assert rows(keyed.upsert(once, source, ["k"])) == rows(once)


@slow
@given(pairs, pairs)
def test_upsert_properties(spark, old, new):
    old, new = dict(old), dict(new)
    target, source = frame(spark, list(old.items())), frame(spark, list(new.items()))
    merged = rows(keyed.upsert(target, source, ["k"]))
    assert merged == Counter((old | new).items())  # keys unique, source wins, others stay


@slow
@given(pairs)
def test_dedup_keeps_the_same_row_in_any_input_order(spark, data):
    def kept(values):
        return rows(keyed.dedup(frame(spark, values).repartition(3), ["k"], [F.col("v").desc()]))

    expected = {}
    for key, value in data:
        expected[key] = max(value, expected.get(key, value))
    assert kept(data) == kept(data[::-1]) == Counter(expected.items())


@slow
@given(pairs, pairs)
def test_except_rows_is_set_difference(spark, left, right):
    got = rows(keyed.except_rows(frame(spark, left), frame(spark, right)))
    assert got == Counter(set(left) - set(right))
    assert got == rows(frame(spark, left).subtract(frame(spark, right)))


def test_dedup_sends_one_row_per_key_and_task(spark):
    """A key with most of the rows is cut down before the shuffle."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 9, 7).otherwise(8).alias("k"), F.col("id").alias("v"))
    kept = keyed.dedup(df, ["k"], [F.col("v").desc()])
    assert sorted(tuple(r) for r in kept.collect()) == [(7, 19_998), (8, 19_999)]
    plan = final_plan(kept)
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


def test_latest(spark):
    df = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", "only", 1)],
                               "t string, mark string, at int")
    got = {tuple(r) for r in keyed.latest(df, "t", "at").collect()}
    assert got == {("a", "new", 2), ("b", "only", 1)}


def test_sample_values_is_repeatable(spark):
    df = frame(spark, [(k, "a") for k in (9, 8, 8, 7, 6, 5, 4)])
    assert [r["k"] for r in keyed.sample_values(df, "k").collect()] == [4, 5, 6, 7, 8]


def test_duplicate_keys(spark):
    assert [tuple(r) for r in keyed.duplicate_keys(frame(spark, [(1, "a"), (1, "b"), (2, "c")]),
                                                   ["k"]).collect()] == [(1, 2)]
