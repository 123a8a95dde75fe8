"""Cleaning: type conformance, defaults, and splits into valid and rejected rows.

Two styles of split are offered. `split_*` give the two frames directly. `tag` marks every row
with the first rule it breaks, so that a table with several rules is evaluated once and both
outputs are read from that one result.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.functions.rules import sha256_hex
from caudal.operators.attach import skew_join

REASON = "_reason"
PAYLOAD = "_payload"


def conformed(column: str, casts: dict[str, str], dates: tuple[str, ...], upper: tuple[str, ...],
              date_format: str = "yyyy-MM-dd") -> Column:
    """The column after casting, date parsing and code normalisation, as an expression."""
    if column in casts:
        return F.col(column).try_cast(casts[column])
    if column in dates:
        return F.try_to_date(F.col(column), date_format)
    if column in upper:
        return F.upper(F.trim(F.col(column)))
    return F.col(column)


def conform(df: DataFrame, casts: dict[str, str] | None = None, dates: tuple[str, ...] = (),
            upper: tuple[str, ...] = ()) -> DataFrame:
    """Cast, parse ISO dates and normalise codes. Text that does not parse becomes NULL."""
    casts = casts or {}
    columns = {c: conformed(c, casts, dates, upper) for c in (*casts, *dates, *upper)}
    return df.withColumns(columns) if columns else df


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.fillna(defaults) if defaults else df


def mask_pii(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: sha256_hex(c) for c in columns}) if columns else df


def all_present(columns: list[str | Column]) -> Column:
    tests = [(F.col(c) if isinstance(c, str) else c).isNotNull() for c in columns]
    return reduce(lambda a, b: a & b, tests)


def within(day: str | Column, low: date, high: date) -> Column:
    day = F.col(day) if isinstance(day, str) else day
    return day.between(F.lit(low), F.lit(high))


def in_range(df: DataFrame, column: str, low: date, high: date,
             keep_null: bool = True) -> DataFrame:
    """Keep rows whose date lies within the limits, and by default those without a date."""
    inside = within(column, low, high)
    return df.filter(F.col(column).isNull() | inside if keep_null else inside)


def split_required(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all columns present, the others). No shuffle; copies stay copies."""
    present = all_present(columns)
    return df.filter(present), df.filter(~present)


def split_range(df: DataFrame, column: str, low: date, high: date) -> tuple[DataFrame, DataFrame]:
    """(rows within the limits, rows outside). Rows without a value are outside."""
    inside = F.coalesce(within(column, low, high), F.lit(False))
    return df.filter(inside), df.filter(~inside)


def ref_keys(dim: DataFrame, key: str) -> DataFrame:
    """Distinct keys of a reference table, kept distributed."""
    return dim.select(key).filter(F.col(key).isNotNull()).distinct()


def split_refs(df: DataFrame, dim: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose reference exists, orphans). A NULL reference is an orphan."""
    keys = dim.select(on)
    return skew_join(df, keys, on, "left_semi"), skew_join(df, keys, on, "left_anti")


def start_tags(df: DataFrame) -> DataFrame:
    empty = F.lit(None).cast("string")
    return df.withColumns({REASON: empty, PAYLOAD: empty})


def tag(df: DataFrame, broken: Column, reason: str, hidden: tuple[str, ...] = ()) -> DataFrame:
    """Give the reason to rows that break the rule and have none yet.

    The row as it stands is kept as JSON, with `hidden` columns hashed. Only rejected rows pay
    for that text, and only they carry it through later shuffles.
    """
    first = F.col(REASON).isNull() & F.coalesce(broken, F.lit(False))
    shown = [sha256_hex(c).alias(c) if c in hidden else F.col(c)
             for c in df.columns if c not in (REASON, PAYLOAD) and not c.startswith("_known")]
    return df.withColumns({
        REASON: F.when(first, F.lit(reason)).otherwise(F.col(REASON)),
        PAYLOAD: F.when(first, F.to_json(F.struct(*shown))).otherwise(F.col(PAYLOAD)),
    })


def with_known(df: DataFrame, dim: DataFrame, on: str, name: str = "_known") -> DataFrame:
    """Add `name`: true where the reference exists, else NULL.

    A single left join instead of a semi and an anti join: the fact is shuffled once. Spark
    broadcasts the key list while it is under the broadcast limit; beyond it a sort-merge
    join is used, and adaptive execution splits the partition of a hot key.
    """
    return skew_join(df, ref_keys(dim, on).withColumn(name, F.lit(True)), on, "left")


def tag_refs(df: DataFrame, dim: DataFrame, on: str, reason: str) -> DataFrame:
    """Tag rows whose reference does not exist."""
    return tag(with_known(df, dim, on), F.col("_known").isNull(), reason).drop("_known")


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON, PAYLOAD)


def rejected(tagged: DataFrame, table: str, keys: tuple[str, ...], batch_id: str,
             now: datetime, references: dict[str, str] | None = None) -> DataFrame:
    """The refused rows in the reject layout. `references` gives, for reasons that wait for a row of
    another table, the column that names it; its value is the reject's `ref_key`."""
    ref_key = F.lit(None).cast("string")
    for reason, column in (references or {}).items():
        if column in tagged.columns:
            ref_key = F.when(F.col(REASON) == reason, F.col(column).cast("string")).otherwise(ref_key)
    return envelope(tagged.filter(F.col(REASON).isNotNull()), table, F.col(REASON), keys,
                    batch_id, now, F.col(PAYLOAD), ref_key)


def reject(df: DataFrame, table: str, reason: str, keys: tuple[str, ...], batch_id: str,
           now: datetime) -> DataFrame:
    """Wrap rows of any table in the common reject layout."""
    return envelope(df, table, F.lit(reason), keys, batch_id, now,
                    F.to_json(F.struct(*df.columns)))


def row_key(keys: tuple[str, ...]) -> Column:
    """A row's key as one text: the value of a single key, else a JSON list, in which NULL keeps its place."""
    parts = [F.col(k).cast("string") for k in keys]
    return F.coalesce(parts[0], F.lit("")) if len(parts) == 1 else F.to_json(F.array(*parts))


def envelope(df: DataFrame, table: str, reason: Column, keys: tuple[str, ...], batch_id: str,
             now: datetime, payload: Column, ref_key: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(table).alias("source_table"),
        reason.alias("reason"),
        F.lit(batch_id).alias("batch_id"),
        row_key(keys).alias("row_key"),
        payload.alias("payload"),
        F.lit(now).cast("timestamp").alias("rejected_at"),
        (F.lit(None).cast("string") if ref_key is None else ref_key).alias("ref_key"),
    )
