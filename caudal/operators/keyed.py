"""Operators that work by key: keep-one, upsert, set difference, latest rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: list[str | Column], order_by: list[Column] = ()) -> DataFrame:
    """Keep one row per key, the same one on every run.

    The `row_number() = 1` filter lets Spark keep one row per key and task before the
    shuffle (WindowGroupLimit), so a key that holds a large part of the rows sends one row
    per map task and not its whole group.
    """
    # All columns follow `order_by`, so that only identical rows tie.
    window = Window.partitionBy(*keys).orderBy(*order_by, *df.columns)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys; Spark still plans it as an equi-join."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def without_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `df` whose key does not occur in `other`; NULL equals NULL."""
    taken = other.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    match = reduce(lambda a, b: a & b, [df[k].eqNullSafe(taken[f"_k_{k}"]) for k in keys])
    return df.join(taken, match, "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not in the source, plus all source rows."""
    return without_keys(target, source, keys).unionByName(source)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """EXCEPT DISTINCT: distinct rows of `left` that do not occur in `right`.

    One grouped aggregate over both sides: copies of a row collapse before the shuffle, and
    grouping treats NULLs as equal, which is what EXCEPT asks for.
    """
    columns = left.columns
    both = left.withColumn("_right", F.lit(False)).unionByName(
        right.select(*columns).withColumn("_right", F.lit(True)))
    return (
        both.groupBy(*columns).agg(F.max("_right").alias("_right"))
        .filter(~F.col("_right")).drop("_right")
    )


def latest(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """The newest row per key."""
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(order_by, *[c for c in rest if c != order_by]))
    return (
        df.groupBy(key).agg(newest.alias("_row"))
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


def sample_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """Up to n distinct values, smallest first, so that the sample is repeatable."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_first()).limit(n)
