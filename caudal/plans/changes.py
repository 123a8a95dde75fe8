"""What a batch changed in silver, so that gold derives and merges only that.

Silver notes, for each table and batch, the partitions it rewrote, and the keys of customers and products that are new or whose
attributes facts copy. The changed rows of a partition are those with the batch's id. Notes add up until a gold layer has
succeeded as a whole; merging a change twice changes nothing, so a gold layer that failed half-way is simply run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.operators.attach import skew_join
from caudal.operators.keyed import without_keys
from caudal.sources.lake import Lake
from caudal.sources.tables import append_table, driver_rows, drop_log, read_log, stage
from caudal.specs import CUSTOMERS, PRODUCTS, Batch, TableSpec

PARTS = "_control/changed_parts"
KEYS = "_control/changed_keys"
PARTS_SCHEMA = "anio string, mes string, table_name string, batch_id string"
KEYS_SCHEMA = "key string, table_name string, batch_id string"


def _slice(spark: SparkSession, lake: Lake, name: str, schema: str, spec: TableSpec, batch: Batch) -> DataFrame:
    notes = read_log(spark, lake, "silver", name, schema)
    return notes.filter((F.col("table_name") == spec.name) & (F.col("batch_id") == batch.batch_id))


def note_parts(spark: SparkSession, lake: Lake, spec: TableSpec, batch: Batch,
               parts: list[tuple[str | None, ...]]) -> None:
    """Add partitions to the note of a table and batch. A rerun of the batch keeps those of the first run."""
    before = {(r.anio, r.mes) for r in _slice(spark, lake, PARTS, PARTS_SCHEMA, spec, batch).collect()}
    rows = driver_rows(spark, sorted(before | {tuple(p) for p in parts}, key=str), "anio string, mes string")
    append_table(rows, lake, "silver", PARTS, table_name=spec.name, batch_id=batch.batch_id)


def changed_keys(valid: DataFrame, existing: DataFrame | None, spec: TableSpec) -> DataFrame:
    """Keys of rows that are new, or differ from the existing ones in an attribute that facts copy."""
    columns = [*spec.keys, *spec.watched]
    rows = valid.select(*columns)
    fresh = rows if existing is None else without_keys(rows, existing, columns)
    return fresh.select(F.col(spec.keys[0]).cast("string").alias("key")).distinct()


def note_keys(spark: SparkSession, lake: Lake, spec: TableSpec, batch: Batch, keys: DataFrame) -> None:
    """Add keys to the note of a table and batch. A rerun, which finds fewer, keeps those of the first run."""
    before = _slice(spark, lake, KEYS, KEYS_SCHEMA, spec, batch).select("key")
    both = stage(keys.unionByName(before).distinct(), lake, f"keys_{spec.name}", batch.batch_id)
    append_table(both, lake, "silver", KEYS, table_name=spec.name, batch_id=batch.batch_id)


@dataclass(frozen=True)
class ChangeSet:
    """Changes of silver that gold has not merged yet."""

    batches: tuple[str, ...]
    parts: dict[str, list[tuple[str | None, str | None]]]
    keys: DataFrame

    def months(self, *specs: TableSpec) -> list[tuple[str, str]]:
        """Distinct partitions of the tables, those without a date left out."""
        found = {part for spec in specs for part in self.parts.get(spec.name, [])}
        return sorted(part for part in found if None not in part)

    def changed(self, spec: TableSpec, name: str) -> DataFrame:
        return self.keys.filter(F.col("table_name") == spec.name).select(F.col("key").alias(name)).distinct()


def read_changes(spark: SparkSession, lake: Lake) -> ChangeSet:
    """Driver data: a row per batch since the last good gold layer, table and partition."""
    noted = read_log(spark, lake, "silver", PARTS, PARTS_SCHEMA).distinct().collect()
    keys = read_log(spark, lake, "silver", KEYS, KEYS_SCHEMA)
    parts: dict[str, list[tuple[str | None, str | None]]] = {}
    for row in noted:
        parts.setdefault(row.table_name, []).append((row.anio, row.mes))
    batches = {row.batch_id for row in noted}
    return ChangeSet(tuple(sorted(batches)), parts, keys)


def forget_changes(spark: SparkSession, lake: Lake) -> None:
    drop_log(spark, lake, "silver", PARTS)
    drop_log(spark, lake, "silver", KEYS)


def in_parts(parts: list[tuple[str | None, str | None]], columns: tuple[str, ...]) -> Column:
    """Whether a row lies in one of the partitions; a filter on partition columns only."""
    inside = F.lit(False)
    for year in sorted({year for year, _ in parts}, key=str):
        months = [month for y, month in parts if y == year]
        here = F.col(columns[0]).eqNullSafe(F.lit(year))
        named = [month for month in months if month is not None]
        there = F.col(columns[1]).isin(named) if named else F.lit(False)
        if None in months:
            there = there | F.col(columns[1]).isNull()
        inside = inside | (here & there)
    return inside


def changed_rows(rows: DataFrame, spec: TableSpec, changes: ChangeSet) -> DataFrame:
    """Silver rows that a batch wrote, and those of customers and products whose attributes changed.

    Rows of the batches are found in their partitions alone. The others may lie anywhere, so the table is joined to
    the changed keys, if there are any.
    """
    parts = changes.parts.get(spec.name, [])
    ours = in_parts(parts, spec.silver_parts) & F.col("_batch_id_silver").isin(list(changes.batches))
    written = rows.filter(ours)
    customers, products = changes.changed(CUSTOMERS, "id_cli"), changes.changed(PRODUCTS, "cod_prod")
    if customers.isEmpty() and products.isEmpty():
        return written
    elsewhere = rows.filter(~F.coalesce(ours, F.lit(False)))
    elsewhere = skew_join(elsewhere, customers.withColumn("_client", F.lit(True)), "id_cli", "left")
    elsewhere = skew_join(elsewhere, products.withColumn("_product", F.lit(True)), "cod_prod", "left")
    hit = elsewhere.filter("_client OR _product").select(*rows.columns)
    return written.unionByName(hit)
