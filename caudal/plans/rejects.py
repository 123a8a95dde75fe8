"""Rejects that wait for a row of another table, and their second chance.

A reject names the reference it lacks (`ref_key`). Once that row exists, the refused row is cleaned again, from the copy that the
reject keeps; bronze is not read for it. Rejects of other reasons are never looked at again. An entry is closed when
its row was accepted, or refused for another reason. Both kinds are directories of their own, so a batch reads the
waiting ones only. Rejects are compared by a digest of what makes them the same, so that the text of a row is shuffled
only where the row itself goes on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.operators.clean import REASON, rejected, row_key
from caudal.sources.lake import Lake
from caudal.sources.tables import append_table, log_slices, read_log
from caudal.specs import REFERENCE_OF, UNKNOWN_CLIENT, UNKNOWN_PRODUCT, Batch, TableSpec

REJECTS = "rejects"
CLOSED = "rejects_closed"
WAITING, FINAL = "waiting", "final"
SCHEMA = ("reason string, row_key string, payload string, rejected_at timestamp, ref_key string, "
          "kind string, batch_id string, source_table string")
# A closed entry is named by its digest; logs of before have the columns themselves.
CLOSED_SCHEMA = "same binary, reason string, row_key string, payload string, batch_id string, source_table string"
# What makes a reject the same one in a later batch.
SAME = ["reason", "row_key", "payload"]


def read_rejects(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_log(spark, lake, "errors", REJECTS, SCHEMA)


def _digest() -> Column:
    """128 bits of SHA-256 over the lengths and texts of SAME; NULL has no length."""
    lengths = [F.coalesce(F.octet_length(c).cast("string"), F.lit("-")) for c in SAME]
    text = F.concat_ws(":", *lengths, *[F.coalesce(c, F.lit("")) for c in SAME])
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _matching(entries: DataFrame, others: DataFrame, how: str) -> DataFrame:
    other = others.select(_digest().alias("_other"))
    marked = entries.withColumn("_same", _digest())
    return marked.join(other, F.col("_same") == F.col("_other"), how).drop("_same")


def _not_closed(entries: DataFrame, closed: DataFrame) -> DataFrame:
    """Entries that no later batch has closed."""
    other = closed.select(F.col("source_table").alias("_source"), F.col("batch_id").alias("_batch_id"),
                          F.coalesce("same", _digest()).alias("_other"))
    match = ((F.col("_same") == F.col("_other")) & (F.col("source_table") == F.col("_source"))
             & (F.col("batch_id") < F.col("_batch_id")))
    return entries.withColumn("_same", _digest()).join(other, match, "left_anti").drop("_same")


def has_entries(spark: SparkSession, lake: Lake, spec: TableSpec, batch: Batch) -> bool:
    """Whether other batches have logged rejects of a table."""
    return any(name == spec.name and number != batch.batch_id
               for _, number, name in log_slices(spark, lake, "errors", REJECTS, 3))


def has_closed(spark: SparkSession, lake: Lake, spec: TableSpec, batch: Batch) -> bool:
    """Whether other batches have closed rejects of a table."""
    return any(name == spec.name and number != batch.batch_id
               for number, name in log_slices(spark, lake, "errors", CLOSED, 2))


def open_rejects(spark: SparkSession, lake: Lake, spec: TableSpec, batch: Batch,
                 kinds: tuple[str, ...] = (WAITING, FINAL)) -> DataFrame:
    """Rejects of a table from other batches that no later one has closed."""
    entries = read_rejects(spark, lake).filter(
        F.col("kind").isin(*kinds) & (F.col("source_table") == spec.name) & (F.col("batch_id") != batch.batch_id))
    if not has_closed(spark, lake, spec, batch):
        return entries
    closed = read_log(spark, lake, "errors", CLOSED, CLOSED_SCHEMA).filter(
        (F.col("source_table") == spec.name) & (F.col("batch_id") != batch.batch_id))
    return _not_closed(entries, closed)


def still_rejected(spark: SparkSession, lake: Lake) -> DataFrame:
    """All rejects that no later batch has closed."""
    return _not_closed(read_rejects(spark, lake), read_log(spark, lake, "errors", CLOSED, CLOSED_SCHEMA))


def arrived_refs(entries: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """(reason, ref_key): the references that waiting entries lack and that exist by now."""
    known = customers.select(F.lit(UNKNOWN_CLIENT).alias("reason"), F.col("id_cli").alias("ref_key")).unionByName(
        products.select(F.lit(UNKNOWN_PRODUCT).alias("reason"), F.col("cod_prod").alias("ref_key")))
    return entries.select("reason", "ref_key").distinct().join(known, ["reason", "ref_key"], "left_semi")


def lacking(entries: DataFrame, refs: DataFrame) -> DataFrame:
    """The entries that lack one of the references. Once `refs` is staged, its size tells Spark whether the entries
    have to be shuffled."""
    return entries.join(refs, ["reason", "ref_key"], "left_semi")


def arrived(entries: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The waiting entries whose missing reference exists by now."""
    return lacking(entries, arrived_refs(entries, customers, products))


def refused_rows(entries: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows as they were refused, in the columns of the source."""
    return entries.select(F.from_json("payload", spec.schema).alias("_row")).select("_row.*").select(*spec.columns)


def reject_writes(tagged: DataFrame, lake: Lake, spec: TableSpec, batch: Batch,
                  known: DataFrame | None) -> list[Callable[[], None]]:
    """Steps, independent of each other, that log the refused rows of a staged delivery, but for those that the open
    rejects `known`, if there are any, have. Equal rows refused for the same reason lack the same reference, so the waiting ones are
    compared to waiting ones only, and the others to others."""
    refused = rejected(tagged, spec.name, spec.keys, batch.batch_id, batch.now, REFERENCE_OF)

    def write(kind: str, part: str) -> None:
        fresh = refused.filter(part)
        if known is not None:
            fresh = _matching(fresh, known.filter(part), "left_anti")
        append_table(fresh, lake, "errors", REJECTS, kind=kind, batch_id=batch.batch_id, source_table=spec.name)

    return [lambda: write(WAITING, "ref_key IS NOT NULL"), lambda: write(FINAL, "ref_key IS NULL")]


def write_rejects(tagged: DataFrame, lake: Lake, spec: TableSpec, batch: Batch, known: DataFrame) -> None:
    """The steps of `reject_writes`, one after the other."""
    for write in reject_writes(tagged, lake, spec, batch, known):
        write()


def close_rejects(tagged: DataFrame, lake: Lake, spec: TableSpec, batch: Batch, entries: DataFrame,
                  ready: DataFrame) -> None:
    """Close waiting entries: those that were cleaned again and not refused as before, and those of rows that the
    batch accepted in another version. A refused version settles nothing."""
    refused = rejected(tagged, spec.name, spec.keys, batch.batch_id, batch.now)
    accepted = tagged.filter(F.col(REASON).isNull()).select(row_key(spec.keys).alias("row_key"))
    settled = ready.select(_digest().alias("same")).join(refused.select(_digest().alias("same")), "same", "left_anti")
    replaced = entries.select("row_key", _digest().alias("same")).join(accepted, "row_key", "left_semi")
    done = settled.unionByName(replaced.select("same")).distinct()
    append_table(done, lake, "errors", CLOSED, batch_id=batch.batch_id, source_table=spec.name)
