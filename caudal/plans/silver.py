"""Silver: one function per source table.

Each takes the raw frame and returns it cleaned and tagged: rows with an empty `_reason` are
valid, the others carry the reason and the row as landed. `accepted` and `rejected` in
`caudal.operators.clean` read the two outputs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.functions.rules import beyond_money, business_hours, clamp_min
from caudal.operators.attach import skew_join
from caudal.operators.clean import (
    PAYLOAD, REASON, all_present, conform, conformed, fill_defaults, mask_pii, start_tags, tag,
    with_known, within,
)
from caudal.operators.keyed import dedup, same_key, without_keys
from caudal.operators.rolling import suspicious_flag
from caudal.specs import (
    AMOUNT_OUT_OF_RANGE, BRANCHES, CUSTOMERS, DATE_MAX, DATE_MIN, DATE_OUT_OF_RANGE, FEES, LOANS, MISSING_REQUIRED,
    MOVEMENTS, PRODUCTS, UNKNOWN_CLIENT, UNKNOWN_PRODUCT, TableSpec,
)

# Marks existing rows that are only flagged again, beside the rows of a delivery.
REFRESHED = "_refreshed"
# Marks accepted rows of which a newer version was refused.
SUPERSEDED = "_superseded"


def _newest_per_key(df: DataFrame, spec: TableSpec) -> DataFrame:
    order = [F.col(spec.watermark).desc_nulls_last()] if spec.watermark else []
    return dedup(df.select(*spec.columns), list(spec.keys), order)


def _parsed(spec: TableSpec, column: str) -> Column:
    return conformed(column, spec.casts, spec.dates, spec.upper)


def _require(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Tag rows without a required value (one that does not parse counts as missing) or with an amount that
    exact sums cannot hold."""
    present = all_present([_parsed(spec, c) for c in spec.required])
    df = tag(start_tags(df), ~present, MISSING_REQUIRED, spec.pii)
    if not spec.money:
        return df
    beyond = reduce(lambda a, b: a | b, [beyond_money(_parsed(spec, c)) for c in spec.money])
    return tag(df, beyond, AMOUNT_OUT_OF_RANGE, spec.pii)


def _dates_in_range(df: DataFrame, spec: TableSpec, column: str) -> DataFrame:
    outside = ~within(_parsed(spec, column), DATE_MIN, DATE_MAX)
    return tag(df, outside, DATE_OUT_OF_RANGE, spec.pii)


def _conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    return fill_defaults(conform(df, spec.casts, spec.dates, spec.upper), spec.defaults)


def _require_refs(df: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Tag rows of unknown clients, then those of unknown products.

    Both lookups come before the tags, so that the text of a row refused here is made after the last shuffle. Clients are
    looked up last: what is next joined to customers lies where it has to be.
    """
    client, product = "_known_client", "_known_product"
    columns = df.columns
    df = with_known(with_known(df, products, "cod_prod", product), customers, "id_cli", client)
    df = df.select(*columns, client, product)
    for known, key, reason in ((client, "id_cli", UNKNOWN_CLIENT), (product, "cod_prod", UNKNOWN_PRODUCT)):
        df = tag(df.select(key, *[c for c in df.columns if c != key]), F.col(known).isNull(), reason)
    return df.drop(client, product)


def silver_customers(df: DataFrame) -> DataFrame:
    df = _require(_newest_per_key(df, CUSTOMERS), CUSTOMERS)
    df = _dates_in_range(df, CUSTOMERS, "fec_nac")  # a missing birth date is allowed
    return mask_pii(_conform(df, CUSTOMERS), CUSTOMERS.pii)


def silver_products(df: DataFrame) -> DataFrame:
    return _conform(_require(_newest_per_key(df, PRODUCTS), PRODUCTS), PRODUCTS)


def silver_branches(df: DataFrame) -> DataFrame:
    return _conform(_require(_newest_per_key(df, BRANCHES), BRANCHES), BRANCHES)


def silver_loans(df: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    df = _require(_newest_per_key(df, LOANS), LOANS)
    df = _require_refs(df, customers, products)
    return _conform(df, LOANS).withColumn("dias_mora_act", clamp_min("dias_mora_act", 0))


def prepare_movements(df: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Tagged movements before the flags.

    Exact copies collapse to one. Of the valid rows that still share an id, the latest date
    wins; rejected rows are kept beside it. Both are one keep-one step: valid rows group by
    id, rejected rows by id and content.
    """
    df = _require(df.select(*MOVEMENTS.columns), MOVEMENTS)
    df = _require_refs(df, customers, products)
    df = _conform(_dates_in_range(df, MOVEMENTS, "fec_mov"), MOVEMENTS)
    return dedup(df, ["id_mov", PAYLOAD], [F.col("fec_mov").desc_nulls_last()])


def flag_movements(df: DataFrame, days: int = 30, sigmas: float = 3) -> DataFrame:
    """Add the suspicion and business-hours flags; only valid rows count in the window."""
    df = suspicious_flag(df, "id_cli", "fec_mov", "vr_mov", days, sigmas,
                         history=df.filter(F.col(REASON).isNull()))
    return df.withColumn("ind_horario_habil", business_hours("fec_mov", "hra_mov"))


def silver_movements(df: DataFrame, customers: DataFrame, products: DataFrame,
                     days: int = 30, sigmas: float = 3) -> DataFrame:
    return flag_movements(prepare_movements(df, customers, products), days, sigmas)


def changed_days(new: DataFrame, existing: DataFrame) -> DataFrame:
    """(id_cli, day): where accepted `new` rows change a client's history, by adding a row or by taking the place
    of an existing one. A refused version changes nothing: the accepted one stays."""
    added = new.filter(F.col(REASON).isNull())
    ids = added.select("id_mov").distinct()
    replaced = existing.join(ids, "id_mov", "left_semi")
    both = added.select("id_cli", "fec_mov").unionByName(replaced.select("id_cli", "fec_mov"))
    return both.select("id_cli", F.col("fec_mov").alias("day")).distinct()


def window_spans(days: DataFrame, length: int = 30) -> DataFrame:
    """(id_cli, _start, _end, _again): the stretches of a client's history that a refresh has to read.

    A changed day enters the windows of the `length` days after it. These intervals are merged where they meet;
    `_again` lists the merged ones as (after, to), in which rows are flagged again. Intervals that are close enough for
    the rows before one to be those of another form one stretch from _start to _end, so a row lies in one stretch
    at most. There is a row per changed day of a client at most, whatever the size of its history.
    """
    by_day = Window.partitionBy("id_cli").orderBy("day")
    gap = F.datediff("day", F.lag("day").over(by_day))
    merged = (days.withColumn("_no", F.sum(F.when(gap > length, 1).otherwise(0)).over(by_day))
              .groupBy("id_cli", "_no").agg(F.min("day").alias("after"), F.date_add(F.max("day"), length).alias("to")))
    by_start = Window.partitionBy("id_cli").orderBy("after")
    apart = F.datediff("after", F.lag("to").over(by_start)) > length
    return (merged.withColumn("_no", F.sum(F.when(apart, 1).otherwise(0)).over(by_start))
            .groupBy("id_cli", "_no")
            .agg(F.date_sub(F.min("after"), length).alias("_start"), F.max("to").alias("_end"),
                 F.array_sort(F.collect_list(F.struct("after", "to"))).alias("_again"))
            .drop("_no"))


def span_months(spans: DataFrame) -> DataFrame:
    """Distinct months ('yyyyMM') that the stretches touch."""
    months = F.explode(F.expr("sequence(trunc(_start, 'MM'), trunc(_end, 'MM'), interval 1 month)"))
    return spans.select(months.alias("_first")).select(F.date_format("_first", "yyyyMM").alias("month")).distinct()


def refresh_movements(new: DataFrame, existing: DataFrame, spans: DataFrame,
                      days: int = 30, sigmas: float = 3) -> DataFrame:
    """Flags of the new rows, and again of the clients' existing rows whose window they enter.

    `existing` holds silver rows of at least the months of `spans` (see `window_spans`). The result has all new
    rows and those existing rows that lie in an interval to flag again; REFRESHED marks these.
    """
    columns = new.columns
    ids = new.filter(F.col(REASON).isNull()).select("id_mov").distinct()
    others = existing.join(ids, "id_mov", "left_anti")
    near = skew_join(others, spans, "id_cli", "inner").filter(F.col("fec_mov").between(F.col("_start"), F.col("_end")))
    again = F.exists("_again", lambda i: (F.col("fec_mov") > i["after"]) & (F.col("fec_mov") <= i["to"]))
    empty = F.lit(None).cast("string")
    mark = F.col(SUPERSEDED) if SUPERSEDED in existing.columns else F.lit(False)
    near = near.withColumns({REASON: empty, PAYLOAD: empty}).select(
        *columns, again.alias(REFRESHED), mark.alias(SUPERSEDED))
    both = new.withColumns({REFRESHED: F.lit(None).cast("boolean"), SUPERSEDED: F.lit(False)}).unionByName(near)
    flagged = flag_movements(both, days, sigmas)
    return flagged.filter(F.coalesce(REFRESHED, F.lit(True))).withColumn(REFRESHED, F.col(REFRESHED).isNotNull())


def superseded_rows(tagged: DataFrame, existing: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Existing rows of which `tagged` has a refused version and no accepted one, with the mark set.

    They stay accepted: windows, facts and checks read them like others, whatever is cleaned.
    """
    refused = tagged.filter(F.col(REASON).isNotNull()).select(*keys).distinct()
    refused = without_keys(refused, tagged.filter(F.col(REASON).isNull()), list(keys))
    hit = existing.join(refused, same_key(existing, refused, list(keys)), "left_semi")
    return hit.withColumn(SUPERSEDED, F.lit(True))


def silver_fees(df: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    df = _require(_newest_per_key(df, FEES), FEES)
    return _conform(_require_refs(df, customers, products), FEES)
