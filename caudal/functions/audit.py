"""Audit, date-part and layer columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INGEST_PARTS = ("_year", "_month", "_day")


def with_audit(df: DataFrame, source: str, batch_id: str, now: datetime) -> DataFrame:
    return df.withColumns({
        "_ingestion_timestamp": F.lit(now).cast("timestamp"),
        "_source_system": F.lit(source),
        "_batch_id": F.lit(batch_id),
    })


def with_date_parts(df: DataFrame, date_col: str, names: tuple[str, ...]) -> DataFrame:
    """Add year, zero-padded month and (with a third name) zero-padded day, as text."""
    day = F.col(date_col)
    parts = (
        F.year(day).cast("string"),
        F.lpad(F.month(day).cast("string"), 2, "0"),
        F.lpad(F.dayofmonth(day).cast("string"), 2, "0"),
    )
    return df.withColumns(dict(zip(names, parts)))


def with_layer_meta(df: DataFrame, layer: str, batch_id: str, now: datetime) -> DataFrame:
    return df.withColumns({
        f"_{layer}_timestamp": F.lit(now).cast("timestamp"),
        f"_batch_id_{layer}": F.lit(batch_id),
    })
