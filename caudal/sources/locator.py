"""Where the keys of a partitioned table are: a narrow table of keys and partitions beside it.

An upsert has to rewrite the partition that holds the old copy of a key, which need not be the one the new row belongs to.
Instead of joining all files of the table, it asks the locator. Rows are only added: a key may have several places, of which
all but the newest are stale. A stale place costs a look at a partition, and nothing else. So does a key that shares the
hash of another, wherefore the locator holds 64-bit hashes and no keys. Files are sorted by a part of the hash, so that an
upsert of few keys reads few row groups of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.sources.lake import Lake

BUCKETS = 4096
FEW = 1000  # buckets that are named in a filter; beyond it all are read
ROW_GROUP = str(4 << 20)


def _path(lake: Lake, layer: str, name: str) -> str:
    return lake.path("_locator", f"{layer}/{name}/hashes")


def _hash(keys: tuple[str, ...]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def _bucket(key: str) -> Column:
    return F.pmod(F.col(key), F.lit(BUCKETS)).cast("int")


def _places(df: DataFrame, keys: tuple[str, ...], parts: tuple[str, ...]) -> DataFrame:
    """A row for each row of the table: copies of a place do no harm."""
    return df.select(_hash(keys).alias("key"), *[F.col(p).cast("string").alias(f"p{n}") for n, p in enumerate(parts)])


def _write(df: DataFrame, lake: Lake, layer: str, name: str, keys, parts, mode: str) -> None:
    rows = _places(df, keys, parts).withColumn("bucket", _bucket("key"))
    rows = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket")
    rows.write.mode(mode).option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(
        _path(lake, layer, name))


def forget(spark: SparkSession, lake: Lake, layer: str, name: str) -> None:
    """Delete a locator; the next upsert makes a new one."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(_path(lake, layer, name))
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def restart(df: DataFrame, lake: Lake, layer: str, name: str, keys: tuple[str, ...], parts: tuple[str, ...]) -> None:
    """Name the places of all rows of a table, whatever was known before."""
    _write(df, lake, layer, name, keys, parts, "overwrite")


def add(df: DataFrame, lake: Lake, layer: str, name: str, keys: tuple[str, ...], parts: tuple[str, ...]) -> None:
    _write(df, lake, layer, name, keys, parts, "append")


def read(spark: SparkSession, lake: Lake, layer: str, name: str, keys: tuple[str, ...],
         parts: tuple[str, ...]) -> DataFrame | None:
    """All places, or None where no locator was written."""
    path = _path(lake, layer, name)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    columns = ["key long", *[f"p{n} string" for n in range(len(parts))], "bucket int"]
    return spark.read.schema(", ".join(columns)).parquet(path)


def partitions_of(known: DataFrame, df: DataFrame, keys: tuple[str, ...], parts: tuple[str, ...]) -> DataFrame:
    """Distinct partitions that hold, or held, a key of `df`."""
    asked = df.select(_hash(keys).alias("key")).distinct()
    buckets = [row[0] for row in asked.select(_bucket("key")).distinct().limit(FEW + 1).collect()]
    if len(buckets) <= FEW:
        known = known.filter(F.col("bucket").isin(buckets))
    return known.join(asked, "key", "left_semi").select(
        *[F.col(f"p{n}").alias(part) for n, part in enumerate(parts)]).distinct()
