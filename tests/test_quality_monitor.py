import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from caudal.functions.rules import BUCKET_NAMES
from caudal.plans import monitor, quality

NOW = datetime(2024, 1, 2, 3, 4, 5)
NAMES = {"name": "n", "table": "t", "layer": "Gold"}


def result(df):
    row = df.head()
    return row["passed"], json.loads(row["details"]), row["message"]


def test_not_null_and_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert result(quality.check_not_null(df, "k", **NAMES)) == (
        False, {"null_count": 1}, "1 rows without k")
    assert result(quality.check_unique(df, ["k"], **NAMES))[:2] == (
        False, {"total": 3, "distinct": 2, "duplicates": 1})
    assert result(quality.check_unique(df.filter("k is null"), ["k"], **NAMES))[0]
    assert result(quality.check_unique(df.limit(0), ["k"], **NAMES))[0]


def test_in_set_counts_null_and_shows_a_sample(spark):
    good = spark.createDataFrame([(b,) for b in BUCKET_NAMES], "b string")
    assert result(quality.check_in_set(good, "b", BUCKET_NAMES, **NAMES)) == (
        True, {"invalid_count": 0, "sample": []}, "PASSED")
    bad = good.union(spark.createDataFrame([("X",)] * 3 + [(None,)] + [(f"Z{i}",) for i in range(9)],
                                           "b string"))
    passed, details, _ = result(quality.check_in_set(bad, "b", BUCKET_NAMES, **NAMES))
    assert not passed
    assert details == {"invalid_count": 13, "sample": ["NULL", "X", "Z0", "Z1", "Z2"]}


@pytest.mark.parametrize("rate,passed", [(0.0, True), (100.0, True), (-0.1, False), (100.1, False),
                                         (None, False)])
def test_bounds(spark, rate, passed):
    df = spark.createDataFrame([(rate,)], "r double")
    assert result(quality.check_bounds(df, "r", 0, 100, **NAMES))[0] is passed


def test_provision_bound(spark):
    df = spark.createDataFrame([(100.0, 100.0), (100.2, 100.0)], "p double, b double")
    limit = F.col("b") * 1.001
    assert result(quality.check_bounds(df, "p", 0, limit, **NAMES))[1] == {
        "missing": 0, "below": 0, "above": 1}


def test_binary(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "f int")
    assert result(quality.check_binary(df, "f", **NAMES))[:2] == (
        True, {"invalid": 0, "ones": 1, "pct_ones": 25.0})
    assert not result(quality.check_binary(df.union(spark.createDataFrame([(2,)], "f int")), "f",
                                           **NAMES))[0]
    assert result(quality.check_binary(df.limit(0), "f", **NAMES))[1]["pct_ones"] == 0.0


def test_row_counts_and_references(spark):
    full, empty = spark.range(3), spark.range(0)
    passed, details, _ = result(quality.check_row_counts({"a": full, "b": empty}, "n", "Gold"))
    assert not passed and details == {"counts": {"a": 3, "b": 0}}
    fact = spark.createDataFrame([(1,), (1,), (9,), (None,)], "id int")
    dim = spark.createDataFrame([(1,)], "id int")
    assert result(quality.check_references(fact, dim, "id", **NAMES))[1] == {"orphan_records": 2}
    assert result(quality.check_references(fact.filter("id = 1"), dim, "id", **NAMES))[0]


def test_a_check_that_throws_fails_alone(spark):
    def broken():
        return spark.range(1).select("nothing")

    checks = [quality.Check("bad", broken),
              quality.Check("good", lambda: quality.check_not_null(spark.range(2), "id", **NAMES))]
    out = quality.run_suite(spark, checks, NOW)
    got = {r["check_name"]: r["passed"] for r in out.collect()}
    assert got == {"bad": False, "n": True}
    assert quality.suite_status(out) == "CHECKS_FAILED"
    assert quality.suite_status(out.filter("passed")) == "ALL_PASSED"


def log(spark, totals, failed=()):
    rows = [(f"B{i}", total, "SUCCESS") for i, total in enumerate(totals)]
    return spark.createDataFrame(rows + list(failed), "batch_id string, n_records long, status string")


@pytest.mark.parametrize("totals,current,flagged", [
    ([100, 100, 100], 131, True),
    ([100, 100, 100], 130, False),
    ([100, 100, 100], 69, True),
    ([100, 100], 500, False),
    ([900_000] + [100] * 7, 110, False),   # only the last seven count
    ([], 100, False),
])
def test_volume_anomaly(spark, totals, current, flagged):
    failed = [("B7x", 10_000, "FAILED")]
    row = monitor.volume_anomaly(log(spark, totals, failed), current, "B9").head()
    assert row["anomaly_detected"] is flagged
    own = log(spark, totals).union(log(spark, []).union(
        spark.createDataFrame([("B9", current, "SUCCESS")], "a string, b long, c string")))
    assert monitor.volume_anomaly(own, None, "B9").head() == monitor.volume_anomaly(
        log(spark, totals), current, "B9").head()


def test_run_summary(spark):
    counts = spark.createDataFrame(
        [("B9", "bronze", "a", 10, "SUCCESS"), ("B9", "silver", "a", 9, "SUCCESS"),
         ("B9", "gold", "a", 8, "SUCCESS")],
        "batch_id string, layer string, table_name string, records long, status string")
    checks = spark.createDataFrame([("B9", True), ("B9", False)], "batch_id string, passed boolean")
    anomaly = monitor.volume_anomaly(log(spark, [100] * 4), 500, "B9")

    def status(c, k):
        return monitor.run_summary(c, k, anomaly).head()["status"]

    row = monitor.run_summary(counts, checks, anomaly).head()
    assert (row["total_bronze"], row["total_silver"], row["total_gold"]) == (10, 9, 8)
    assert (row["total_checks"], row["passed_checks"], row["failed_checks"]) == (2, 1, 1)
    assert row["status"] == "CHECKS_FAILED"
    assert status(counts, checks.filter("passed")) == "VOLUME_ALERT"
    failed = counts.withColumn("status", F.lit("FAILED"))
    assert status(failed, checks) == "PARTIAL_FAILURE"
