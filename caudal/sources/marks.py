"""High-water marks: the newest value each table has been ingested up to."""

from __future__ import annotations

from datetime import datetime
from threading import Lock

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from caudal.operators.keyed import latest
from caudal.sources.tables import Lake, driver_rows, read_table, table_exists, upsert_table

MARKS = "_control/watermarks"
# Tables are ingested side by side, and each writes its mark to the one table of marks.
_writing = Lock()
SCHEMA = "table_name string, last_watermark string, batch_id string, updated_at timestamp"


def read_mark(spark: SparkSession, lake: Lake, table: str) -> str | None:
    """The last mark of a table, or None (a full load) where there is none.

    A store that exists but cannot be read raises: it must not turn into a full reload.
    """
    if not table_exists(spark, lake, "bronze", MARKS):
        return None
    marks = read_table(spark, lake, "bronze", MARKS).filter(F.col("table_name") == table)
    row = latest(marks, "table_name", "updated_at").head()
    return row["last_watermark"] if row else None


def write_mark(spark: SparkSession, lake: Lake, table: str, value: str, batch_id: str,
               now: datetime) -> None:
    row = driver_rows(spark, [(table, value, batch_id, now)], SCHEMA)
    with _writing:
        upsert_table(row, lake, "bronze", MARKS, ("table_name",))
