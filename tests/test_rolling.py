import random
import statistics
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caudal.operators.attach import attach
from caudal.operators.clean import REASON, ref_keys, split_refs, start_tags, tag_refs
from caudal.operators.rolling import rolling_stats, suspicious_flag
from plans_text import final_plan

CASES = [
    ("C1", date(2024, 1, 1), 100.0, None, None, 0),
    ("C1", date(2024, 1, 5), 100.0, 100.0, None, 0),
    ("C1", date(2024, 1, 10), 110.0, 100.0, 0.0, 1),
    ("C1", date(2024, 1, 20), 120.0, 103.3333, 5.7735, 0),
    ("C1", date(2024, 1, 20), 500.0, 103.3333, 5.7735, 1),
    ("C1", date(2024, 1, 31), 130.0, 186.0, 175.7271, 0),
    ("C1", date(2024, 3, 10), 500.0, None, None, 0),
    ("C2", date(2024, 1, 1), 10.0, None, None, 0),
    ("C2", date(2024, 1, 2), 12.0, 10.0, None, 0),
    ("C2", date(2024, 2, 1), 99.0, 12.0, None, 0),
]


def movements(spark, rows):
    return spark.createDataFrame([r[:3] for r in rows], "c string, d date, v double")


def test_window_literals(spark):
    df = movements(spark, CASES)
    got = {tuple(r)[:3]: (r["mean_30d"], r["sd_30d"]) for r in
           rolling_stats(df, "c", "d", "v").select("c", "d", "v", "mean_30d", "sd_30d").collect()}
    flags = {(r["c"], r["d"], r["v"]): r["ind_sospechoso"]
             for r in suspicious_flag(df, "c", "d", "v").collect()}
    for client, day, value, mean, sd, flagged in CASES:
        found = got[client, day, value]
        assert found == (pytest.approx(mean, abs=1e-4) if mean is not None else None,
                         pytest.approx(sd, abs=1e-4) if sd is not None else None)
        assert flags[client, day, value] == flagged


def test_equal_amounts_have_no_deviation(spark):
    day = date(2024, 1, 1)
    rows = [("c", day + timedelta(days=i), 6.55) for i in range(9)]
    out = suspicious_flag(movements(spark, rows), "c", "d", "v").agg(F.sum("ind_sospechoso")).head()
    assert out[0] == 0
    sd = rolling_stats(movements(spark, rows), "c", "d", "v").agg(F.max("sd_30d")).head()[0]
    assert sd == 0.0


def test_against_brute_force(spark):
    rng = random.Random(7)
    start = date(2024, 1, 1)
    rows = [(rng.choice("abc"), start + timedelta(days=rng.randrange(120)),
             rng.randrange(1, 5_000_000_000) / 100) for _ in range(300)]
    out = rolling_stats(movements(spark, rows), "c", "d", "v", days=30).collect()
    assert len(out) == len(rows)
    for r in out:
        before = [v for c, d, v in rows if c == r["c"] and 1 <= (r["d"] - d).days <= 30]
        if not before:
            assert r["mean_30d"] is None and r["sd_30d"] is None
            continue
        assert r["mean_30d"] == pytest.approx(statistics.fmean(before), rel=1e-12)
        if len(before) > 1:
            assert r["sd_30d"] == pytest.approx(statistics.stdev(before), rel=1e-9)
        else:
            assert r["sd_30d"] is None


def test_missing_amounts_are_left_out(spark):
    day = date(2024, 1, 1)
    df = spark.createDataFrame(
        [("c", day, 10.0), ("c", day, None), ("c", day + timedelta(days=1), 5.0), (None, day, 1.0)],
        "c string, d date, v double")
    got = {(r["c"], r["d"], r["v"]): r["mean_30d"] for r in rolling_stats(df, "c", "d", "v").collect()}
    assert len(got) == 4 and got["c", day + timedelta(days=1), 5.0] == 10.0


def test_absurd_amounts_do_not_stop_the_job(spark):
    day = date(2024, 1, 1)
    rows = [("c", day + timedelta(days=i // 40), 9e15) for i in range(160)]
    rows += [("c", day + timedelta(days=40), 1.0), ("c", day + timedelta(days=41), 2.0)]
    got = {r["v"]: (r["sd_30d"], r["ind_sospechoso"]) for r in suspicious_flag(
        rolling_stats(movements(spark, rows), "c", "d", "v"), "c", "d", "v").collect()}
    assert got[1.0] == got[2.0] == (None, 0) and got[9e15][1] == 0


def test_large_amounts_keep_their_deviation(spark):
    """Squares of these sums pass 38 digits."""
    rng = random.Random(7)
    first = date(2024, 1, 1)
    rows = [("C1", first + timedelta(days=n // 30), 5e15 + rng.randrange(1000)) for n in range(600)]
    rows += [("C1", first + timedelta(days=20), 9.9e15)] + [
        ("C2", first + timedelta(days=n), 9e15) for n in range(5)] + [("C2", first + timedelta(days=6), 9.1e15)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = rolling_stats(df, "k", "d", "v", 30).select("k", "d", "mean_30d", "sd_30d").distinct().collect()
    for r in got:
        window = [v for k, d, v in rows if k == r["k"] and 1 <= (r["d"] - d).days <= 30]
        if len(window) > 1:
            exact = statistics.stdev([int(v) for v in window])
            assert r["sd_30d"] == pytest.approx(exact, rel=1e-6, abs=1e-6)
    flags = {(r["k"], r["d"]): r["ind_sospechoso"] for r in suspicious_flag(df, "k", "d", "v").collect()}
    assert flags["C1", first + timedelta(days=20)] == 1 and flags["C2", first + timedelta(days=6)] == 1


def test_window_input_is_one_row_per_client_and_day(spark):
    """A client with nearly all rows reaches the window as one row per day."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("c"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("d"),
        (F.col("id") % 1000 / 10.0).alias("v"))
    out = rolling_stats(df, "c", "d", "v")
    assert out.count() == 60_000
    windowed = out._jdf.queryExecution().optimizedPlan().toString()
    assert windowed.index("Window") < windowed.index("Aggregate")  # the aggregate feeds the window


@pytest.fixture
def small_skew_limits(spark):
    """Limits at which some thousand rows already count as a skewed partition."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    saved = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_facts(spark, n=200_000):
    """Two thirds of the rows belong to one client, all on one day."""
    hot = F.col("id") % 3 < 2
    return spark.range(0, n, 1, 8).select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 100)).alias("c"),
        F.date_add(F.lit(date(2024, 1, 1)), F.when(hot, 9).otherwise(F.expr("cast(id div 100 % 20 as int)")))
        .alias("d"),
        (F.col("id") % 500 / 10.0).alias("v"),
        F.col("id").alias("n"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_join_is_split(spark, small_skew_limits, how):
    """A client with most of the rows is spread over several join tasks, although the other
    side comes from a grouping by the same key."""
    facts = hot_facts(spark)
    dim = facts.select("c").distinct().withColumn("segment", F.upper("c"))
    out = attach(facts, dim, "c", ["segment"], how)
    rows = out.collect()
    assert len(rows) == 200_000 and sum(r["n"] for r in rows) == sum(range(200_000))
    assert sum(r["segment"] == "HOT" for r in rows) == 133_334
    assert "skew=true" in final_plan(out)


def test_hot_key_reference_check_is_split(spark, small_skew_limits):
    facts = hot_facts(spark)
    dim = facts.filter("c != 'c1'").select("c")
    ok, orphans = split_refs(facts, ref_keys(dim, "c"), "c")
    assert len(ok.collect()) + orphans.count() == 200_000
    assert "skew=true" in final_plan(ok)
    tagged = tag_refs(start_tags(facts), dim, "c", "R")
    assert sum(r[REASON] == "R" for r in tagged.collect()) == orphans.count() > 0
    assert "skew=true" in final_plan(tagged)


def test_hot_day_of_a_client_is_split(spark, small_skew_limits):
    out = rolling_stats(hot_facts(spark), "c", "d", "v")
    assert len(out.collect()) == 200_000
    assert "skew=true" in final_plan(out)


def test_amounts_past_eighteen_digits_stay_in_the_window(spark):
    day = date(2024, 1, 1)
    rows = [("c", day, 100.0), ("c", day + timedelta(days=1), 2e16), ("c", day + timedelta(days=2), 100.0),
            ("n", day, -3e20), ("n", day + timedelta(days=1), 5e20), ("n", day + timedelta(days=2), 1.0),
            ("b", day, 1e22), ("b", day + timedelta(days=1), 7.0), ("b", day + timedelta(days=40), 8.0),
            ("b", day + timedelta(days=41), 9.0)]
    got = {(r["c"], r["d"]): (r["mean_30d"], r["sd_30d"]) for r in rolling_stats(movements(spark, rows), "c", "d", "v").collect()}
    third = day + timedelta(days=2)
    assert got["c", third] == (pytest.approx(1e16 + 50), pytest.approx(statistics.stdev([100, 2e16])))
    assert got["n", third] == (pytest.approx(1e20), pytest.approx(statistics.stdev([-3e20, 5e20])))
    assert got["b", day + timedelta(days=1)] == (None, None)  # not computed from a part of the window
    assert got["b", day + timedelta(days=41)] == (8.0, None)


def test_small_differences_of_huge_amounts(spark):
    """Amounts around a limb boundary: the parts of the squares must not cancel in floating point."""
    day = date(2024, 1, 1)
    values = [1e10 - 0.01, 1e10, 1e10 + 0.01, 9e20, 9e20 + 262144, 9e20 - 131072]
    rows = [("a", day + timedelta(days=n), v) for n, v in enumerate(values[:3] + [1.0])]
    rows += [("b", day + timedelta(days=n), v) for n, v in enumerate(values[3:] + [1.0])]
    got = {(r["c"], r["v"]): r["sd_30d"] for r in rolling_stats(movements(spark, rows), "c", "d", "v").collect()}
    assert got["a", 1.0] == pytest.approx(0.01, rel=1e-9)
    exact = statistics.stdev([Decimal(repr(v)) for v in values[3:]])  # an amount is what its text says
    assert got["b", 1.0] == pytest.approx(float(exact), rel=1e-6)
