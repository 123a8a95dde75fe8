"""Joins that add dimension attributes to facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SIDE = "_side_key"


def skew_join(fact: DataFrame, side: DataFrame, on: str, how: str) -> DataFrame:
    """Join on `on` such that adaptive execution can split a hot key of the fact.

    Adaptive execution splits a skewed partition only where both inputs arrive straight from
    a shuffle. A side that was grouped or ranked by the same key would be joined in place, and
    all rows of a hot key would end in one task. Joining on the key and its hash asks for a
    partitioning such a side does not have, so it is shuffled once more; it has one row per
    key, which makes that cheap beside the fact. A broadcast side is not affected.

    The hash is no column: it is not shuffled, and a fact that was just joined on the key stays where it is
    for the next join on it.
    """
    rest = [c for c in fact.columns if c != on]
    added = [c for c in side.columns if c != on] if how not in ("left_semi", "left_anti") else []
    side = side.withColumnRenamed(on, _SIDE)
    same = (F.col(on) == F.col(_SIDE)) & (F.hash(F.col(on)) == F.hash(F.col(_SIDE)))
    return fact.join(side, same, how).select(on, *rest, *added)


def attach(df: DataFrame, dim: DataFrame, on: str, columns: list[str],
           how: str = "left") -> DataFrame:
    """Add `columns` of a dimension, unique on `on`, to a fact.

    No broadcast hint: Spark broadcasts the pruned dimension while its size is below
    spark.sql.autoBroadcastJoinThreshold (estimated, or measured by adaptive execution), and
    otherwise merges sorted partitions, splitting those of hot keys.
    """
    return skew_join(df, dim.select(on, *columns), on, how)
