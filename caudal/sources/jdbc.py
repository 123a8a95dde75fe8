"""Relational sources and sinks over Spark's JDBC format."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from caudal.operators.profile import since

FETCH_SIZE = 10_000


@dataclass(frozen=True)
class Partitioning:
    """How a JDBC scan is split. Without it Spark reads the table through one connection.

    Give a numeric, date or timestamp column with its bounds, or `predicates` (one task each)
    for tables that have only text keys. Bounds set the stride; rows outside are still read.
    """

    column: str | None = None
    lower: str | None = None
    upper: str | None = None
    num_partitions: int = 8
    predicates: tuple[str, ...] = ()

    def since(self, column: str, mark: str, until: date) -> Partitioning:
        """For the rows from a mark on: bounds from the mark to the day of the batch, if the mark's column is the one
        that splits the scan. Bounds of the full load would leave all new rows to the last task."""
        if self.column != column:
            return self
        upper = max(until, date.fromisoformat(mark) + timedelta(days=1))
        return replace(self, lower=mark, upper=str(upper))

    def options(self) -> dict[str, str]:
        if self.column is None:
            return {}
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.num_partitions),
        }


def jdbc_options(url: str, table: str, partition: Partitioning | None = None,
                 fetchsize: int = FETCH_SIZE, **connection: str) -> dict[str, str]:
    """Reader options. Credentials come from the caller and are stored nowhere."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetchsize), **connection}
    return options | (partition.options() if partition else {})


def read_jdbc(spark: SparkSession, url: str, table: str, partition: Partitioning | None = None,
              fetchsize: int = FETCH_SIZE, watermark: tuple[str, object] | None = None,
              inclusive: bool = False, **connection: str) -> DataFrame:
    """Scan a table, fully or from a high-water mark on.

    The mark is a typed DataFrame filter, which Spark pushes into the source's WHERE clause.
    """
    if partition and partition.predicates:
        df = spark.read.jdbc(url, table, predicates=list(partition.predicates),
                             properties={"fetchsize": str(fetchsize), **connection})
    else:
        options = jdbc_options(url, table, partition, fetchsize, **connection)
        df = spark.read.format("jdbc").options(**options).load()
    if watermark is None:
        return df
    column, last = watermark
    return since(df, column, last, inclusive)


def load_jdbc(tables: dict[str, DataFrame], url: str, order: list[str],
              batchsize: int = FETCH_SIZE, **connection: str) -> None:
    """Reload tables in foreign-key order: empty children first, then fill parents first.

    `order` lists parents before children. Emptying asks for TRUNCATE TABLE, which some databases refuse for a
    table that a foreign key points to, even if the child is empty; there, delete the rows beforehand.
    """
    properties = {"batchsize": str(batchsize), **connection}
    for name in reversed(order):
        (tables[name].limit(0).write.option("truncate", "true")
         .jdbc(url, name, mode="overwrite", properties=properties))
    for name in order:
        tables[name].write.jdbc(url, name, mode="append", properties=properties)
