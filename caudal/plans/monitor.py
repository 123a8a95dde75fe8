"""Run monitoring: batch volumes, the volume anomaly and the one-row run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUCCESS = "SUCCESS"


def batch_totals(log: DataFrame) -> DataFrame:
    """Records per batch over its successful tables."""
    return (
        log.filter(F.col("status") == SUCCESS)
        .groupBy("batch_id").agg(F.sum("n_records").alias("total_records"))
    )


def last_batches(log: DataFrame, batch_id: str, n: int = 7) -> DataFrame:
    """The n newest batches before the given one. Batch ids sort by time."""
    return (
        batch_totals(log.filter(F.col("batch_id") < batch_id))
        .orderBy(F.col("batch_id").desc()).limit(n)
    )


def volume_anomaly(log: DataFrame, current: int | None, batch_id: str, n: int = 7,
                   min_runs: int = 3, pct: float = 30) -> DataFrame:
    """One row: does the current volume differ from the recent mean by more than `pct` percent?

    Where `current` is None, the volume of the batch is read from the log.
    """
    before = last_batches(log, batch_id, n).select(F.lit(False).alias("is_current"),
                                                   "total_records")
    if current is None:
        mine = batch_totals(log.filter(F.col("batch_id") == batch_id))
        before = before.unionByName(mine.select(F.lit(True).alias("is_current"), "total_records"))
        volume = F.coalesce(F.sum(F.when(F.col("is_current"), F.col("total_records"))), F.lit(0))
    else:
        volume = F.lit(current)
    earlier = F.when(~F.col("is_current"), F.col("total_records"))
    row = before.agg(volume.cast("long").alias("current"),
                     F.count(earlier).alias("runs"),
                     F.avg(earlier).alias("mean"))
    enough = F.col("runs") >= min_runs
    diff = F.when(enough & (F.col("mean") > 0),
                  F.abs(F.col("current") - F.col("mean")) / F.col("mean") * 100
                  ).otherwise(F.lit(0.0))
    return row.select(
        F.lit(batch_id).alias("batch_id"),
        (diff > pct).alias("anomaly_detected"),
        "current",
        F.when(enough, F.round("mean", 0)).otherwise(F.lit(0.0)).alias("avg_7d"),
        F.round(diff, 2).alias("pct_diff"),
    )


def run_summary(layer_counts: DataFrame, checks: DataFrame, anomaly: DataFrame) -> DataFrame:
    """One row per batch: records per layer, checks, anomaly and an overall status.

    `layer_counts` has (batch_id, layer, table_name, records, status), `checks` has
    (batch_id, passed), `anomaly` is the frame of `volume_anomaly`.
    """
    def records(layer: str):
        return F.coalesce(F.sum(F.when(F.col("layer") == layer, F.col("records"))), F.lit(0))

    # One grouping over all three inputs instead of joins between them.
    facts = (
        layer_counts.select("batch_id", "layer", "records", "status")
        .unionByName(checks.select("batch_id", "passed"), allowMissingColumns=True)
        .unionByName(anomaly.select("batch_id", "anomaly_detected"), allowMissingColumns=True)
    )
    joined = facts.groupBy("batch_id").agg(
        F.count("layer").alias("tables"),
        records("bronze").alias("total_bronze"),
        records("silver").alias("total_silver"),
        records("gold").alias("total_gold"),
        F.count_if(F.col("status") == "FAILED").alias("failed_tables"),
        F.count("passed").alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.coalesce(F.max("anomaly_detected"), F.lit(False)).alias("anomaly_detected"),
    ).filter("tables > 0").drop("tables")
    status = (
        F.when(F.col("failed_tables") > 0, "PARTIAL_FAILURE")
        .when(F.col("failed_checks") > 0, "CHECKS_FAILED")
        .when(F.col("anomaly_detected"), "VOLUME_ALERT")
        .otherwise("SUCCESS")
    )
    return joined.withColumn("status", status)
