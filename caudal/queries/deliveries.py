"""Queries over a lake after two deliveries: what a batch on changes alone leaves behind.

The second delivery brings the customers of one region, whose loans and movements the first batch had to refuse; rows of
some days, years apart; and newer, refused versions of movements that the first batch accepted. The lake
then has to hold what one batch over all rows gives.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.plans import batch as runs
from caudal.plans import rejects, silver
from caudal.queries import bank
from caudal.sources.tables import Lake, read_log, read_table, release, scratch_lake
from caudal.sources.together import together
from caudal.specs import (
    CLIENT_VALUE, CUSTOMERS, DAILY_KPIS, FACT_PORTFOLIO, FACT_TRANSACTIONS, FEES, LOANS, MOVEMENTS, Batch,
    GoldSpec,
)

AS_OF = date(2001, 8, 1)
FIRST = Batch("BATCH_1", AS_OF, datetime(2024, 6, 1, 7))
SECOND = Batch("BATCH_2", AS_OF, datetime(2024, 6, 2, 7))
LATE_REGION = "ASIA"
LATE_LOANS = ("1997-03", "2001-07")
LATE_FEES = ("1998-05", "2001-07")
LATE_DAYS = ("2024-01-05", "2024-01-28", "2099-01-01")

_lakes: dict[tuple[str, str], Lake] = {}


def _is_late(name: str) -> Column:
    late = {
        CUSTOMERS.name: F.col("depto_res") == LATE_REGION,
        LOANS.name: F.substr("fec_desembolso", F.lit(1), F.lit(7)).isin(*LATE_LOANS),
        FEES.name: F.substr("fec_cobro", F.lit(1), F.lit(7)).isin(*LATE_FEES),
        MOVEMENTS.name: F.col("fec_mov").isin(*LATE_DAYS),
    }
    return F.coalesce(late.get(name, F.lit(False)), F.lit(False))


def two_deliveries(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake after two batches over all rows of the tables, made once for a session and folder."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _lakes:
        lake = scratch_lake(spark)

        def landed(batch: Batch, late: bool) -> list[runs.Outcome]:
            frames = {name: raw(spark, sf_dir) for name, raw in bank.RAW.items()}
            # Tables without a watermark are delivered in full each time.
            return runs.run_bronze(spark, lake, lambda spec, mark: (
                frames[spec.name].filter(_is_late(spec.name) == late) if spec.watermark else frames[spec.name]), batch)

        first = landed(FIRST, late=False) + runs.run_silver(spark, lake, FIRST)
        # Gold reads silver alone, so the second delivery lands meanwhile.
        modelled, second = together([lambda: runs.run_gold(spark, lake, FIRST), lambda: landed(SECOND, late=True)])
        _check(FIRST, first + modelled)
        runs.clean_up(spark, lake, FIRST, keep=1)
        second += runs.run_silver(spark, lake, SECOND)
        runs.clean_up(spark, lake, SECOND, keep=1)  # gold reads the newest silver
        _check(SECOND, second + runs.run_gold(spark, lake, SECOND))
        runs.clean_up(spark, lake, SECOND, keep=1)
        release(spark)
        _lakes[key] = lake
    return _lakes[key]


def _check(batch: Batch, outcomes: list[runs.Outcome]) -> None:
    failed = {name: error for name, _, _, error in outcomes if error}
    if failed:
        raise runs.BatchFailed(f"{batch.batch_id}: {failed}")


def _gold(spec: GoldSpec) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = read_table(spark, two_deliveries(spark, sf_dir), "gold", spec.name, spec.partition_by)
        return df.drop("_gold_timestamp", "_batch_id_gold")
    return query


def refreshed_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accepted movements with their flags, and whether a newer version of them was refused."""
    df = runs.read_silver(spark, two_deliveries(spark, sf_dir), MOVEMENTS)
    return df.select("id_mov", "id_cli", "fec_mov", "vr_mov", "ind_sospechoso", "ind_horario_habil",
                     F.col(silver.SUPERSEDED).alias("superseded"))


def still_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of loans, movements and fees that the second batch has not settled, by reason."""
    entries = rejects.still_rejected(spark, two_deliveries(spark, sf_dir))
    wanted = entries.filter(F.col("source_table").isin(LOANS.name, MOVEMENTS.name, FEES.name))
    return wanted.groupBy("source_table", "reason").agg(
        F.count(F.lit(1)).alias("entries"), F.countDistinct("row_key").alias("row_keys"),
        F.countDistinct("ref_key").alias("ref_keys"))


def second_batch_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality log of the second batch: delivered rows and rejects whose reference has come."""
    log = read_log(spark, two_deliveries(spark, sf_dir), "silver", runs.QUALITY_LOG,
                   "table_name string, batch_id string, n_input long, n_output long, n_rejected long, "
                   "pct_conformes double")
    return log.filter((F.col("batch_id") == SECOND.batch_id) & F.col("table_name").isin(LOANS.name, FEES.name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "facts_after_second_delivery": _gold(FACT_PORTFOLIO),
    "transactions_after_second_delivery": _gold(FACT_TRANSACTIONS),
    "kpis_from_state": _gold(DAILY_KPIS),
    "client_value_from_state": _gold(CLIENT_VALUE),
    "refreshed_flags": refreshed_flags,
    "still_rejected": still_rejected,
    "second_batch_quality": second_batch_quality,
}
