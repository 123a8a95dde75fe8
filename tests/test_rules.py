from datetime import date

import pytest
from pyspark.sql import functions as F

from caudal.functions import rules


def one(spark, ddl, value, column):
    return spark.createDataFrame([(value,)], f"v {ddl}").select(column.alias("r")).head()["r"]


@pytest.mark.parametrize("days,bucket,order,grade,expected,late", [
    (-5, "AL_DIA", 0, "A", 10_000.0, 0),
    (0, "AL_DIA", 0, "A", 10_000.0, 0),
    (1, "RANGO_1", 1, "B", 30_000.0, 1),
    (30, "RANGO_1", 1, "B", 30_000.0, 1),
    (31, "RANGO_2", 2, "C", 200_000.0, 1),
    (60, "RANGO_2", 2, "C", 200_000.0, 1),
    (61, "RANGO_3", 3, "D", 500_000.0, 1),
    (90, "RANGO_3", 3, "D", 500_000.0, 1),
    (91, "DETERIORADO", 4, "E", 1_000_000.0, 1),
    (None, "AL_DIA", 0, "A", 10_000.0, 0),
])
def test_overdue(spark, days, bucket, order, grade, expected, late):
    row = spark.createDataFrame([(days, 1_000_000.0)], "d int, b double").select(
        rules.overdue_bucket("d"), rules.bucket_order("d"), rules.risk_grade("d"),
        rules.provision("b", rules.risk_grade("d")), rules.flag(F.col("d") > 0)).head()
    assert tuple(row) == (bucket, order, grade, expected, late)


@pytest.mark.parametrize("day,hour,expected", [
    (date(2024, 1, 1), "05:59:59", 0),
    (date(2024, 1, 1), "06:00:00", 1),
    (date(2024, 1, 1), "19:59:59", 1),
    (date(2024, 1, 1), "20:00:00", 0),
    (date(2024, 1, 6), "10:00:00", 0),
    (date(2024, 1, 7), "10:00:00", 0),
    (date(2024, 1, 1), None, 0),
    (date(2024, 1, 1), "xx", 0),
])
def test_business_hours(spark, day, hour, expected):
    df = spark.createDataFrame([(day, hour)], "d date, h string")
    assert df.select(rules.business_hours("d", "h").alias("r")).head()["r"] == expected


def test_age(spark):
    born = date(1990, 6, 15)
    assert one(spark, "date", born, rules.age_years("v", date(2024, 6, 14))) == 33
    assert one(spark, "date", born, rules.age_years("v", date(2024, 6, 15))) == 34


def test_rates_and_amounts(spark):
    assert one(spark, "double", 26.8242, rules.monthly_rate("v")) == pytest.approx(2.0, abs=1e-4)
    assert one(spark, "double", 0.0, rules.monthly_rate("v")) == 0
    assert one(spark, "double", 1_000_000.0, rules.to_usd("v")) == 243.9024
    assert one(spark, "double", 1_000_000.0, rules.to_usd("v", 1 / 4000)) == 250.0


@pytest.mark.parametrize("score,band", [(0, "BAJO"), (399, "BAJO"), (400, "MEDIO"), (600, "ALTO"),
                                        (800, "MUY_ALTO"), (None, "MUY_ALTO")])
def test_score_band(spark, score, band):
    assert one(spark, "int", score, rules.score_band("v")) == band


def test_labels(spark):
    segment = rules.label("v", rules.SEGMENT_LABELS)
    assert one(spark, "string", "BASICO", segment) == "Básico (< 2 SMLV)"
    assert one(spark, "string", "OTRO", segment) is None
    assert one(spark, "string", "ATM", rules.channel_label("v")) == "Cajero Automático"
    assert one(spark, "string", "PUNTO_PAGO", rules.channel_label("v")) == "PUNTO_PAGO"


def test_hashes(spark):
    digest = "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"
    assert one(spark, "string", "x", rules.sha256_hex("v")) == digest
    assert one(spark, "string", None, rules.sha256_hex("v")) is None
    assert one(spark, "string", "BOGOTA_CUNDINAMARCA", F.md5("v")) == "f692e47e8950f2706bb983ede30c4534"


def test_clamp_keeps_null(spark):
    assert one(spark, "int", -3, rules.clamp_min("v", 0)) == 0
    assert one(spark, "int", None, rules.clamp_min("v", 0)) is None


def test_safe_pct(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 0.0), (1.0, None)], "p double, w double")
    got = [r["r"] for r in df.select(rules.safe_pct("p", "w").alias("r")).collect()]
    assert got == [33.3333, 0.0, 0.0]
