"""Bronze: land source tables as they are, with audit columns and persisted watermarks."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.functions.audit import INGEST_PARTS, with_audit, with_date_parts
from caudal.operators.clean import envelope
from caudal.operators.keyed import without_keys
from caudal.operators.profile import next_mark, since
from caudal.plans.monitor import SUCCESS
from caudal.sources.files import MALFORMED, scan_csv, split_csv
from caudal.sources.jdbc import Partitioning, read_jdbc
from caudal.sources.marks import read_mark, write_mark
from caudal.sources.tables import (
    Lake, append_table, driver_rows, drop_stage, overwrite_table, read_table, stage, table_exists, upsert_table,
)
from caudal.specs import Batch, TableSpec

# Fixed values of the ingestion log.
MB_PER_ROW = 0.0005
SKIPPED = "SKIPPED_NO_NEW_RECORDS"
FAILED = "FAILED"

LOG_SCHEMA = ("table_name string, batch_id string, n_records long, file_size_mb double, "
              "duration_sec double, status string, error_msg string, logged_at timestamp")
ERROR_SCHEMA = "table_name string, batch_id string, error_msg string, failed_at timestamp"
RESULT_SCHEMA = ("batch_id string, layer string, table_name string, records long, "
                 "status string, error_msg string")

# The day whose partition of bronze holds the rows of a batch.
INGEST_DAYS = "_control/ingest_days"
DAYS_SCHEMA = "noted_at timestamp, table_name string, batch_id string, day string"

# Gives the source rows of a table: everything, or the rows from the mark on.
Source = Callable[[TableSpec, str | None], DataFrame]


def frames_source(frames: dict[str, DataFrame], inclusive: bool = True) -> Source:
    """A source over frames at hand (files, CSV, Parquet), keyed by table name."""
    def read(spec: TableSpec, mark: str | None) -> DataFrame:
        df = frames[spec.name]
        return since(df, spec.watermark, mark, inclusive) if spec.watermark else df
    return read


def csv_source(spark: SparkSession, lake: Lake, folder: str, batch: Batch, inclusive: bool = True) -> Source:
    """A source over `<folder>/<table>.csv`. Lines that do not fit the table go to the rejects as they are."""
    def read(spec: TableSpec, mark: str | None) -> DataFrame:
        good, bad = split_csv(scan_csv(spark, f"{folder}/{spec.name}.csv", spec.schema))
        refused = envelope(bad, spec.name, F.lit(MALFORMED), spec.keys, batch.batch_id, batch.now, F.col("line"))
        append_table(refused, lake, "errors", "rejects", kind="malformed", batch_id=batch.batch_id,
                     source_table=spec.name)
        return since(good, spec.watermark, mark, inclusive) if spec.watermark else good
    return read


def jdbc_source(spark: SparkSession, url: str, partitions: dict[str, Partitioning] | None = None,
                inclusive: bool = True, until: date | None = None, **connection: str) -> Source:
    """A source over a relational database; `partitions` says how each table's full scan is split.

    With `until`, the day of the batch, an increment is split from the mark to that day.
    """
    def read(spec: TableSpec, mark: str | None) -> DataFrame:
        watermark = (spec.watermark, mark) if spec.watermark and mark is not None else None
        partition = (partitions or {}).get(spec.name)
        if partition and watermark and until:
            partition = partition.since(*watermark, until)
        return read_jdbc(spark, url, spec.name, partition, watermark=watermark, inclusive=inclusive, **connection)
    return read


def log_ingestion(spark: SparkSession, table: str, batch: Batch, records: int, seconds: float,
                  status: str, error: str = "") -> DataFrame:
    row = (table, batch.batch_id, records, records * MB_PER_ROW, float(seconds), status, error,
           batch.now)
    return driver_rows(spark, [row], LOG_SCHEMA)


def log_error(spark: SparkSession, table: str, batch: Batch, error: str) -> DataFrame:
    return driver_rows(spark, [(table, batch.batch_id, error, batch.now)], ERROR_SCHEMA)


def layer_result(spark: SparkSession, layer: str, batch: Batch,
                 rows: list[tuple[str, int, str, str]]) -> DataFrame:
    """Per-table outcome of a layer: (table, records, status, error)."""
    return driver_rows(spark, [(batch.batch_id, layer, *row) for row in rows], RESULT_SCHEMA)


def overall_status(rows: list[tuple[str, int, str, str]]) -> str:
    return "PARTIAL_FAILURE" if any(status == FAILED for _, _, status, _ in rows) else SUCCESS


def not_yet_landed(incoming: DataFrame, landed: DataFrame, spec: TableSpec,
                   mark: str) -> DataFrame:
    """Incoming rows that bronze does not hold yet, compared on all source columns.

    Only the landed rows from the mark on, and those without a value, are read, since that is what
    the source was asked for.
    """
    recent = since(landed, spec.watermark, mark, inclusive=True)
    return without_keys(incoming, recent, spec.columns)


def ingest_table(spark: SparkSession, lake: Lake, spec: TableSpec, source: Source,
                 batch: Batch, source_system: str = "core") -> tuple[str, int, str, str]:
    """Ingest one table; returns (table, records, status, error) and never raises.

    Full load: the table is replaced. Incremental load: rows from the mark's day on are read
    again (rows of that day may arrive late), those already landed are set aside, and the
    rest replaces rows of the same key. The source is read once, into the table or, for an
    increment, a staged copy. Rows of a batch have one ingest day, so nothing is gathered for their partition.
    """
    started = time.monotonic()

    def done(records: int, status: str, error: str = ""):
        row = log_ingestion(spark, spec.name, batch, records, time.monotonic() - started,
                            status, error)
        # The status is part of the slice: a rerun that finds nothing new is logged beside the
        # run that loaded the rows, and does not replace it.
        append_table(row, lake, "bronze", "_control/ingestion_log",
                     batch_id=batch.batch_id, table_name=spec.name, status=status)
        return spec.name, records, status, error

    try:
        mark = read_mark(spark, lake, spec.name) if spec.watermark else None
        incremental = mark is not None and table_exists(spark, lake, "bronze", spec.name)
        incoming = source(spec, mark if incremental else None).select(*spec.columns)
        if incremental:
            landed = read_table(spark, lake, "bronze", spec.name, INGEST_PARTS)
            incoming = not_yet_landed(incoming, landed, spec, mark)
        rows = with_date_parts(with_audit(incoming, source_system, batch.batch_id, batch.now),
                               "_ingestion_timestamp", INGEST_PARTS)
        if incremental:
            rows = stage(rows, lake, f"bronze_{spec.name}", batch.batch_id)
            if (records := rows.count()) == 0:
                return done(0, SKIPPED)
        # Noted before the rows land: silver finds them by it, whatever happens to the rest of this batch.
        append_table(driver_rows(spark, [(batch.now,)], "noted_at timestamp"), lake, "bronze", INGEST_DAYS,
                     table_name=spec.name, batch_id=batch.batch_id, day=f"{batch.now:%Y-%m-%d}")
        if incremental:
            # Copies within a batch are kept: silver decides which one counts.
            upsert_table(rows, lake, "bronze", spec.name, spec.keys, INGEST_PARTS, unique=False)
        else:
            overwrite_table(rows, lake, "bronze", spec.name, INGEST_PARTS, gather=False)
            rows = read_table(spark, lake, "bronze", spec.name, INGEST_PARTS)
            records = rows.count()
        if spec.watermark:
            highest = next_mark(rows, spec.watermark, batch.as_of).head()["last_watermark"]
            if highest is not None:
                write_mark(spark, lake, spec.name, max(highest, mark or highest),
                           batch.batch_id, batch.now)
        drop_stage(spark, lake, batch.batch_id, f"bronze_{spec.name}")
        return done(records, SUCCESS)
    except Exception as error:  # noqa: BLE001 - one bad table must not stop the others
        append_table(log_error(spark, spec.name, batch, str(error)), lake, "errors",
                     "pipeline_errors", batch_id=batch.batch_id, table_name=spec.name)
        return done(0, FAILED, str(error))
