"""Profiling and batch metrics."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(columns: list[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_pct) for the columns that have NULLs: one pass, one row per column."""
    columns = df.columns
    shares = df.agg(F.count("*").alias("_n"), *null_counts(columns))
    pct = {c: F.round(F.col(c) / F.col("_n") * 100, 2).alias(c) for c in columns}
    return (
        shares.filter("_n > 0").select(*pct.values())
        .unpivot([], columns, "column_name", "null_pct")
        .filter("null_pct > 0")
    )


def since(df: DataFrame, column: str, last, inclusive: bool = False) -> DataFrame:
    """Rows after the mark, or all rows where there is no mark yet.

    With `inclusive`, rows of the mark itself and rows without a value come again: neither can be told
    from rows that arrived late, and the caller sets aside what it already has.
    """
    if last is None:
        return df
    mark = F.col(column)
    return df.filter(mark.isNull() | (mark >= F.lit(last)) if inclusive else mark > F.lit(last))


def next_mark(df: DataFrame, column: str, as_of: date) -> DataFrame:
    """The largest value up to `as_of`, as text; one row. Later dates cannot move the mark."""
    day = F.col(column).try_cast("date")
    return df.agg(F.max(F.when(day <= F.lit(as_of), day)).cast("string").alias("last_watermark"))


def quality_report(counts: DataFrame, table: str, batch_id: str, now: datetime,
                   duration_sec: float = 0.0) -> DataFrame:
    """One quality_log row from a one-row frame (n_input, n_output, null_summary map)."""
    share = F.when(F.col("n_input") > 0,
                   F.round(F.col("n_output") / F.col("n_input") * 100, 2)).otherwise(F.lit(0.0))
    return counts.select(
        F.lit(table).alias("table_name"),
        F.lit(batch_id).alias("batch_id"),
        F.col("n_input").cast("long").alias("n_input"),
        F.col("n_output").cast("long").alias("n_output"),
        (F.col("n_input") - F.col("n_output")).cast("long").alias("n_rejected"),
        share.alias("pct_conformes"),
        F.to_json("null_summary").alias("null_summary"),
        F.lit(float(duration_sec)).alias("duration_sec"),
        F.lit(now).cast("timestamp").alias("logged_at"),
    )


def batch_counts(tagged: DataFrame, reason: str, columns: list[str]) -> DataFrame:
    """(n_input, n_output, null_summary) of a tagged batch, in one pass over it."""
    valid = F.col(reason).isNull()
    sums = tagged.agg(
        F.count("*").alias("n_input"),
        F.count_if(valid).alias("n_output"),
        *[F.count_if(valid & F.col(c).isNull()).alias(f"_null_{c}") for c in columns],
    )
    pairs = F.array(*[
        F.struct(F.lit(c).alias("key"),
                 F.round(F.try_divide(F.col(f"_null_{c}") * 100, F.col("n_output")), 2).alias("value"))
        for c in columns])
    return sums.select(
        "n_input", "n_output",
        F.map_from_entries(F.filter(pairs, lambda p: p["value"] > 0)).alias("null_summary"))
