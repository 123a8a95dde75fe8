"""One batch through all layers, as plain function calls in one Spark application."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import suppress
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.functions.audit import INGEST_PARTS, with_date_parts, with_layer_meta
from caudal.functions.rules import COP_TO_USD
from caudal.operators.clean import REASON, accepted
from caudal.operators.keyed import without_keys
from caudal.operators.profile import batch_counts, quality_report
from caudal.plans import bronze, changes, gold, rejects, silver, state
from caudal.plans.bronze import FAILED, LOG_SCHEMA, Source, layer_result, overall_status
from caudal.plans.monitor import SUCCESS, run_summary, volume_anomaly
from caudal.plans.quality import run_suite, standard_checks
from caudal.sources import locator
from caudal.sources.marks import MARKS
from caudal.sources.tables import (
    Lake, append_table, driver_rows, drop_stage, drop_superseded, read_log, read_table, release, replace_partitions,
    stage, table_exists, upsert_table,
)
from caudal.sources.together import together
from caudal.specs import (
    BRANCHES, CLIENT_VALUE, CUSTOMERS, DAILY_KPIS, DIM_CHANNELS, DIM_CUSTOMERS, DIM_GEOGRAPHY,
    CLIENT_NUMBERS, DIM_PRODUCTS, FACT_PORTFOLIO, FACT_TRANSACTIONS, FEES, GOLD_TABLES, INCOME_STATE, LOANS, MOVEMENTS,
    PORTFOLIO_STATE, PRODUCTS, SOURCE_TABLES, STATE_TABLES, Batch, GoldSpec, TableSpec,
)

QUALITY_LOG = "_control/quality_log"
GOLD_RATE = "_control/usd_rate"
WINDOW_DAYS = 30

Outcome = tuple[str, int, str, str]


class BatchFailed(RuntimeError):
    """Some tables of a layer failed; raised once all tables of the layer were tried."""


@dataclass(frozen=True)
class Settings:
    usd_rate: float = COP_TO_USD
    source_system: str = "core"
    # Where reference checks look keys up: "silver" (only accepted rows count) or "bronze"
    # (any landed row counts).
    refs_from: str = "silver"
    # What silver cleans of loans, movements and fees: "new" takes the rows of batches it has not
    # seen and those whose reference has come, "all" takes everything in bronze again, with the same result.
    # Customers, products and branches are always cleaned in full.
    scope: str = "new"
    keep_snapshots: int = 2


def run_bronze(spark: SparkSession, lake: Lake, source: Source, batch: Batch,
               settings: Settings = Settings(),
               only: tuple[TableSpec, ...] = SOURCE_TABLES) -> list[Outcome]:
    return together([lambda s=spec: bronze.ingest_table(spark, lake, s, source, batch, settings.source_system)
                      for spec in SOURCE_TABLES if spec in only])


def read_silver(spark: SparkSession, lake: Lake, spec: TableSpec) -> DataFrame:
    return read_table(spark, lake, "silver", spec.name, spec.silver_parts)


@dataclass(frozen=True)
class Delivery:
    """What silver cleans of a table in one batch: its rows and their number."""

    rows: DataFrame
    n_rows: int
    waiting: DataFrame | None = None  # open rejects that lack a reference
    ready: DataFrame | None = None  # those of them whose reference has come; their rows are in the delivery
    whole: bool = True  # all of bronze, with rows that earlier batches have refused


def _silver_table(spark: SparkSession, lake: Lake, spec: TableSpec, tagged: DataFrame,
                  delivery: Delivery, batch: Batch, started: float) -> int:
    """Evaluate a tagged frame once, then write valid rows, rejects, changes and the quality report."""
    staged = stage(tagged, lake, f"silver_{spec.name}", batch.batch_id)
    delivered = staged
    if silver.REFRESHED in staged.columns:  # rows flagged again are no part of the delivery
        delivered = staged.filter(~F.col(silver.REFRESHED))
        staged = staged.drop(silver.REFRESHED)
    again = table_exists(spark, lake, "silver", spec.name)
    existing = read_silver(spark, lake, spec) if again else None
    valid = accepted(staged)
    if silver.SUPERSEDED not in valid.columns:
        valid = valid.withColumn(silver.SUPERSEDED, F.lit(False))
    marked = None
    if again:
        around = _around(spark, lake, spec, existing, delivered.filter(F.col(REASON).isNotNull()))
        marked = silver.superseded_rows(delivered, around, spec.keys)
        marked = stage(marked, lake, f"silver_{spec.name}_superseded", batch.batch_id)
        valid = without_keys(valid, marked, list(spec.keys)) if silver.REFRESHED in tagged.columns else valid
    if spec.watched:
        changes.note_keys(spark, lake, spec, batch, changes.changed_keys(valid, existing, spec))
    valid = with_layer_meta(valid, "silver", batch.batch_id, batch.now)
    if spec.partition_date:
        valid = with_date_parts(valid, spec.partition_date, spec.silver_parts)
    if marked is not None:
        marked = with_layer_meta(marked, "silver", batch.batch_id, batch.now)
        valid = valid.unionByName(_refreshed_mark(staged, marked, spec).select(*valid.columns))

    def write_valid() -> None:
        touched = upsert_table(valid, lake, "silver", spec.name, spec.keys, spec.silver_parts,
                               unique=False)  # cleaning leaves one row per key
        if spec.silver_parts:
            changes.note_parts(spark, lake, spec, batch, touched)

    # All read staged rows and what earlier batches wrote, and none what another writes.
    known = delivery.waiting
    if delivery.whole:
        logged = rejects.has_entries(spark, lake, spec, batch)
        known = rejects.open_rejects(spark, lake, spec, batch) if logged else None
    writes = [write_valid, *rejects.reject_writes(delivered, lake, spec, batch, known)]
    if delivery.waiting is not None:
        writes.append(lambda: rejects.close_rejects(delivered, lake, spec, batch, delivery.waiting, delivery.ready))
    together(writes)
    # Last, since silver takes a batch that has a report as done.
    columns = [c for c in valid.columns if c in spec.columns]
    counts = batch_counts(delivered, REASON, columns).withColumn("n_input", F.lit(delivery.n_rows))
    report = quality_report(counts, spec.name, batch.batch_id, batch.now,
                            time.monotonic() - started)
    append_table(report, lake, "silver", QUALITY_LOG,
                 batch_id=batch.batch_id, table_name=spec.name)
    drop_stage(spark, lake, batch.batch_id, *_staged_for(spec))
    if spec.silver_parts:
        release(spark)
    return read_silver(spark, lake, spec).count()


def _staged_for(spec: TableSpec) -> list[str]:
    """Names of the copies that a silver table stages on its way."""
    name = f"silver_{spec.name}"
    return [name, f"{name}_superseded", f"{name}_new", f"{name}_spans",
            *[f"{step}_{spec.name}" for step in ("waiting", "arrived", "ready", "pending", "keys")]]


def _around(spark: SparkSession, lake: Lake, spec: TableSpec, existing: DataFrame, asked: DataFrame) -> DataFrame:
    """Silver rows of the partitions that hold a key of `asked`, or all where no locator says so."""
    known = locator.read(spark, lake, "silver", spec.name, spec.keys, spec.silver_parts) if spec.silver_parts else None
    if known is None:
        return existing
    found = locator.partitions_of(known, asked, spec.keys, spec.silver_parts).collect()  # bounded by the partitions
    return existing.filter(changes.in_parts([tuple(row) for row in found], spec.silver_parts))


def _refreshed_mark(staged: DataFrame, marked: DataFrame, spec: TableSpec) -> DataFrame:
    """Superseded rows as they are after the batch: a row that is flagged again keeps its new flags."""
    flags = [c for c in ("ind_sospechoso", "ind_horario_habil") if c in staged.columns and c in marked.columns]
    if not flags:
        return marked
    new = accepted(staged).select(*spec.keys, *[F.col(c).alias(f"_new_{c}") for c in flags])
    out = marked.join(new, list(spec.keys), "left")
    return out.withColumns({c: F.coalesce(f"_new_{c}", c) for c in flags}).drop(*[f"_new_{c}" for c in flags])


def unseen_batches(spark: SparkSession, lake: Lake, spec: TableSpec, batch: Batch) -> list[tuple[str, str]]:
    """(batch, ingest day) of what bronze has landed and silver has not reported on."""
    days = read_log(spark, lake, "bronze", bronze.INGEST_DAYS, bronze.DAYS_SCHEMA)
    log = read_log(spark, lake, "silver", QUALITY_LOG, "table_name string, batch_id string")
    reported = log.filter((F.col("table_name") == spec.name) & (F.col("batch_id") != batch.batch_id))
    open_days = days.filter(F.col("table_name") == spec.name).join(
        reported.select("batch_id").distinct(), "batch_id", "left_anti")
    return [(r.batch_id, r.day) for r in open_days.select("batch_id", "day").distinct().collect()]


def unseen_rows(spark: SparkSession, lake: Lake, spec: TableSpec, batch: Batch) -> DataFrame:
    """Bronze rows of the batches that silver has not reported on, from the days on which they were landed."""
    found = unseen_batches(spark, lake, spec, batch)
    landed = read_table(spark, lake, "bronze", spec.name, INGEST_PARTS)
    day = F.concat_ws("-", *[F.col(part) for part in INGEST_PARTS])
    return landed.filter(day.isin(sorted({day for _, day in found}))
                         & F.col("_batch_id").isin(sorted({name for name, _ in found})))


@dataclass(frozen=True)
class Found:
    """What a delivery is made of, as far as it can be found before the tables it refers to are cleaned."""

    landed: DataFrame
    new: DataFrame | None = None  # none at first: all of bronze is the delivery
    waiting: DataFrame | None = None


def find(spark: SparkSession, lake: Lake, spec: TableSpec, batch: Batch, scope: str) -> Found:
    """The rows of bronze that a batch has to clean, and the open rejects that lack a reference."""
    landed = read_table(spark, lake, "bronze", spec.name, INGEST_PARTS)
    if not table_exists(spark, lake, "silver", spec.name):
        return Found(landed)

    def open_rejects() -> DataFrame:
        entries = rejects.open_rejects(spark, lake, spec, batch, (rejects.WAITING,))
        if not rejects.has_closed(spark, lake, spec, batch):
            return entries  # files of earlier batches, as they are
        return stage(entries, lake, f"waiting_{spec.name}", batch.batch_id)

    new, waiting = together([
        lambda: (landed if scope == "all" else unseen_rows(spark, lake, spec, batch)).select(*spec.columns),
        open_rejects])
    return Found(landed, new, waiting)


def pending(spark: SparkSession, lake: Lake, spec: TableSpec, batch: Batch, refs: tuple[DataFrame, DataFrame],
            scope: str, found: Found) -> Delivery:
    """The delivery of a batch: all of bronze at first, then the unseen rows and the rejects whose reference has come."""
    landed, new, waiting = found.landed, found.new, found.waiting
    if new is None:
        return Delivery(landed, landed.count())  # counted from file footers
    whole = scope == "all"
    come = stage(rejects.arrived_refs(waiting, *refs), lake, f"arrived_{spec.name}", batch.batch_id)
    ready = stage(rejects.lacking(waiting, come), lake, f"ready_{spec.name}", batch.batch_id)
    retried = rejects.refused_rows(ready, spec)
    if whole:  # bronze has most of them
        retried = without_keys(retried, landed, spec.columns)
    rows = stage(new.unionByName(retried), lake, f"pending_{spec.name}", batch.batch_id)
    return Delivery(rows, rows.count(), waiting, ready, whole)


def _changed_movements(spark: SparkSession, lake: Lake, df: DataFrame, customers: DataFrame,
                       products: DataFrame, batch: Batch) -> DataFrame:
    """Clean the delivered movements, and flag them together with the rows around them.

    Prepared rows are staged, since the flags read them twice. Of silver, the months around changed days are read.
    """
    name = f"silver_{MOVEMENTS.name}"
    new = stage(silver.prepare_movements(df, customers, products), lake, f"{name}_new", batch.batch_id)
    if not table_exists(spark, lake, "silver", MOVEMENTS.name):
        return silver.flag_movements(new, WINDOW_DAYS)
    existing = read_silver(spark, lake, MOVEMENTS)
    spans = silver.window_spans(silver.changed_days(new, existing), WINDOW_DAYS)
    spans = stage(spans, lake, f"{name}_spans", batch.batch_id)
    months = sorted(row[0] for row in silver.span_months(spans).collect())  # 372 at most: dates are checked
    parts = [(month[:4], month[4:]) for month in months]
    around = existing.filter(changes.in_parts(parts, MOVEMENTS.silver_parts))
    return silver.refresh_movements(new, around, spans, WINDOW_DAYS)


def run_silver(spark: SparkSession, lake: Lake, batch: Batch, settings: Settings = Settings(),
               only: tuple[TableSpec, ...] = SOURCE_TABLES) -> list[Outcome]:
    def raw(spec: TableSpec) -> DataFrame:
        return read_table(spark, lake, "bronze", spec.name, INGEST_PARTS)

    def refs() -> tuple[DataFrame, DataFrame]:
        if settings.refs_from == "bronze":
            return raw(CUSTOMERS), raw(PRODUCTS)
        return read_silver(spark, lake, CUSTOMERS), read_silver(spark, lake, PRODUCTS)

    steps: list[tuple[TableSpec, Callable[[DataFrame], DataFrame]]] = [
        (CUSTOMERS, silver.silver_customers),
        (PRODUCTS, silver.silver_products),
        (BRANCHES, silver.silver_branches),
        (LOANS, lambda df: silver.silver_loans(df, *refs())),
        (MOVEMENTS, lambda df: _changed_movements(spark, lake, df, *refs(), batch)),
        (FEES, lambda df: silver.silver_fees(df, *refs())),
    ]

    referring = (LOANS, MOVEMENTS, FEES)  # to customers and products, which are cleaned before them
    found: dict[str, Found] = {}

    def look(spec: TableSpec) -> None:
        """While customers and products are cleaned. A failure is that of the table, which then looks again."""
        with suppress(Exception):
            found[spec.name] = find(spark, lake, spec, batch, settings.scope)

    def one(spec: TableSpec, clean: Callable[[DataFrame], DataFrame]) -> int:
        started = time.monotonic()
        if spec in referring:
            seen = found.get(spec.name) or find(spark, lake, spec, batch, settings.scope)
            delivery = pending(spark, lake, spec, batch, refs(), settings.scope, seen)
        else:
            rows = raw(spec)
            delivery = Delivery(rows, rows.count())
        return _silver_table(spark, lake, spec, clean(delivery.rows), delivery, batch, started)

    def tables(later: bool) -> list[Callable[[], Outcome]]:
        return [lambda s=spec, c=clean: _try(s.name, lambda: one(s, c))
                for spec, clean in steps if spec in only and (spec in referring) == later]

    first = tables(False)
    looks = [lambda s=spec: look(s) for spec in referring if spec in only] if first else []
    return together([*first, *looks])[:len(first)] + together(tables(True))


def run_gold(spark: SparkSession, lake: Lake, batch: Batch,
             settings: Settings = Settings()) -> list[Outcome]:
    """Dimensions in full; facts, states and what is read from them by the changes of silver."""
    noted = changes.read_changes(spark, lake)
    rate_changed = _rate_changed(spark, lake, settings.usd_rate)

    def clean(spec: TableSpec) -> DataFrame:
        return read_silver(spark, lake, spec)

    def built(spec: GoldSpec) -> DataFrame:
        return read_table(spark, lake, "gold", spec.name, spec.partition_by)

    def exists(spec: GoldSpec) -> bool:
        return table_exists(spark, lake, "gold", spec.name)

    def changed(spec: TableSpec, fact: GoldSpec, whole: bool = False) -> DataFrame:
        rows = clean(spec)
        return changes.changed_rows(rows, spec, noted) if exists(fact) and not whole else rows

    def merge(spec: GoldSpec, rows: DataFrame, stable_partitions: bool = False,
              gather: bool = True) -> list[tuple[str | None, ...]]:
        rows = with_layer_meta(rows, "gold", batch.batch_id, batch.now)
        # A first load writes the rows once; an upsert reads them more than once.
        again = exists(spec)
        if again:
            rows = stage(rows, lake, f"gold_{spec.name}", batch.batch_id)
        touched = upsert_table(rows, lake, "gold", spec.name, spec.keys, spec.partition_by, unique=again,
                               stable_partitions=stable_partitions, gather=gather)
        drop_stage(spark, lake, batch.batch_id, f"gold_{spec.name}")
        return touched

    def staged_again(spec: GoldSpec, rows: DataFrame, name: str) -> DataFrame:
        """Rows of a state table, staged if it exists: a first load reads them once."""
        return stage(rows, lake, name, batch.batch_id) if exists(spec) else rows

    def keep(spec: GoldSpec, rows: DataFrame) -> None:
        """Write recomputed months of a state table. They are whole, with zeros for keys that are gone, so they take the
        place of the month as it was."""
        replace_partitions(rows, lake, "gold", spec.name, spec.partition_by)

    def merge_portfolio() -> None:
        again = exists(PORTFOLIO_STATE) and exists(FACT_PORTFOLIO)
        touched = merge(FACT_PORTFOLIO, gold.build_fact_portfolio(
            changed(LOANS, FACT_PORTFOLIO), clean(CUSTOMERS), built(DIM_PRODUCTS)))
        fact = built(FACT_PORTFOLIO)
        if again:
            fact = fact.filter(changes.in_parts(touched, FACT_PORTFOLIO.partition_by))
        known = built(CLIENT_NUMBERS) if exists(CLIENT_NUMBERS) else None
        placed = stage(state.new_clients(known, fact), lake, "gold_clients", batch.batch_id)
        numbers = stage(state.numbered_clients(known, placed), lake, "gold_numbers", batch.batch_id)
        upsert_table(numbers, lake, "gold", CLIENT_NUMBERS.name, CLIENT_NUMBERS.keys, unique=False)
        now = staged_again(PORTFOLIO_STATE, state.portfolio_state(fact, built(CLIENT_NUMBERS)), "gold_state")
        if again:
            before = built(PORTFOLIO_STATE).filter(changes.in_parts(touched, PORTFOLIO_STATE.partition_by))
            now = now.unionByName(stage(state.emptied_portfolio(before, now), lake, "gold_state_gone", batch.batch_id))
        keep(PORTFOLIO_STATE, now)
        drop_stage(spark, lake, batch.batch_id, "gold_clients", "gold_numbers", "gold_state", "gold_state_gone")

    def income(months: list[tuple[str, str]] | None) -> DataFrame:
        """Income rows of some months (partitions of silver), or of all."""
        frames = [clean(spec) for spec in (FEES, LOANS, MOVEMENTS)]
        if months is not None:
            frames = [df.filter(changes.in_parts(months, spec.silver_parts))
                      for df, spec in zip(frames, (FEES, LOANS, MOVEMENTS), strict=True)]
        return state.income_rows(*frames, built(DIM_PRODUCTS))

    def merge_value() -> None:
        months = None
        if exists(INCOME_STATE):
            found = set(noted.months(FEES, LOANS, MOVEMENTS))
            products = noted.changed(PRODUCTS, "cod_prod")
            if not products.isEmpty():  # a new rate changes the interest of all months with its loans
                rows = clean(LOANS).join(products, "cod_prod", "left_semi").select(*LOANS.silver_parts).distinct()
                found |= {tuple(row) for row in rows.collect() if None not in row}
            months = sorted(found)
        now = staged_again(INCOME_STATE, state.income_state(income(months)), "gold_income")
        if months is not None:
            before = built(INCOME_STATE).filter(changes.in_parts(months, INCOME_STATE.partition_by))
            now = now.unionByName(stage(state.emptied_income(before, now), lake, "gold_income_gone", batch.batch_id))
        keep(INCOME_STATE, now)
        drop_stage(spark, lake, batch.batch_id, "gold_income", "gold_income_gone")
        _, partly = state.whole_months(batch.as_of)
        edges = income([(period[:4], period[5:]) for period in partly])
        merge(CLIENT_VALUE, state.value_from_state(built(INCOME_STATE), edges, clean(CUSTOMERS), batch.as_of))

    steps: list[tuple[GoldSpec, Callable[[], object]]] = [
        (DIM_CUSTOMERS, lambda: merge(DIM_CUSTOMERS, gold.build_dim_customers(clean(CUSTOMERS), batch.as_of))),
        (DIM_PRODUCTS, lambda: merge(DIM_PRODUCTS, gold.build_dim_products(clean(PRODUCTS)))),
        (DIM_GEOGRAPHY, lambda: merge(DIM_GEOGRAPHY, gold.build_dim_geography(clean(BRANCHES)))),
        (DIM_CHANNELS, lambda: merge(DIM_CHANNELS, gold.build_dim_channels(
            clean(BRANCHES), changed(MOVEMENTS, DIM_CHANNELS)))),
        (FACT_TRANSACTIONS, lambda: merge(FACT_TRANSACTIONS, gold.build_fact_transactions(
            changed(MOVEMENTS, FACT_TRANSACTIONS, rate_changed), clean(CUSTOMERS), built(DIM_PRODUCTS),
            settings.usd_rate))),
        (FACT_PORTFOLIO, merge_portfolio),
        (CLIENT_VALUE, merge_value),
        # Its month is that of fecha_calculo, a part of the key, and a batch has one.
        (DAILY_KPIS, lambda: merge(DAILY_KPIS, state.kpis_from_state(built(PORTFOLIO_STATE), batch.as_of),
                                   stable_partitions=True, gather=False)),
    ]

    def one(spec: GoldSpec, work: Callable[[], object]) -> int:
        work()
        if spec.partition_by:
            release(spark)
        return built(spec).count()

    def run(names: tuple[GoldSpec, ...]) -> list[Outcome]:
        return [_try(spec.name, lambda s=spec, w=work: one(s, w)) for spec, work in steps if spec in names]

    # Facts read dimensions, and the KPIs read the state that the loan fact leaves.
    outcomes = []
    for groups in (((DIM_CUSTOMERS,), (DIM_PRODUCTS,), (DIM_GEOGRAPHY,), (DIM_CHANNELS,)),
                   ((FACT_PORTFOLIO, DAILY_KPIS), (CLIENT_VALUE,), (FACT_TRANSACTIONS,))):
        outcomes += [found for part in together([lambda g=group: run(g) for group in groups]) for found in part]
    order = [spec.name for spec, _ in steps]
    outcomes.sort(key=lambda outcome: order.index(outcome[0]))
    if overall_status(outcomes) == SUCCESS:
        append_table(driver_rows(spark, [(float(settings.usd_rate),)], "usd_rate double"), lake, "gold", GOLD_RATE)
        changes.forget_changes(spark, lake)
    return outcomes


def _rate_changed(spark: SparkSession, lake: Lake, rate: float) -> bool:
    """Whether the facts were last converted at another rate; then all of them are built again."""
    before = read_log(spark, lake, "gold", GOLD_RATE, "usd_rate double").head()
    return before is None or before["usd_rate"] != float(rate)


def _try(name: str, work: Callable[[], int]) -> Outcome:
    try:
        return name, work(), SUCCESS, ""
    except Exception as error:  # noqa: BLE001 - one bad table must not stop the others
        return name, 0, FAILED, str(error)


def run_checks(spark: SparkSession, lake: Lake, batch: Batch) -> DataFrame:
    partitions = {spec.name: spec.partition_by for spec in GOLD_TABLES}
    partitions |= {spec.name: spec.silver_parts for spec in SOURCE_TABLES}

    def read(layer: str, name: str) -> DataFrame:
        return read_table(spark, lake, layer, name, partitions.get(name, ()))

    results = run_suite(spark, standard_checks(read), batch.now)
    append_table(results, lake, "errors", "quality_check_results", batch_id=batch.batch_id)
    return results


def run_batch(spark: SparkSession, lake: Lake, source: Source, batch: Batch,
              settings: Settings = Settings()) -> DataFrame:
    """Ingest, clean, model and check one batch; returns its one-row summary.

    A layer with failed tables is finished and then ends the batch with BatchFailed; its summary row is
    written all the same, and staged copies are dropped. Failed expectations and volume alerts only show
    in the summary.
    """
    results = []
    try:
        return _run_layers(spark, lake, source, batch, settings, results)
    except BatchFailed:
        _summarise(spark, lake, batch, results,
                   spark.createDataFrame([], "passed boolean").withColumn("batch_id", F.lit(batch.batch_id)))
        raise
    finally:
        drop_stage(spark, lake, batch.batch_id)


def _run_layers(spark: SparkSession, lake: Lake, source: Source, batch: Batch, settings: Settings,
                results: list[DataFrame]) -> DataFrame:
    for layer, run in (
        ("bronze", lambda: run_bronze(spark, lake, source, batch, settings)),
        ("silver", lambda: run_silver(spark, lake, batch, settings)),
        ("gold", lambda: run_gold(spark, lake, batch, settings)),
    ):
        outcomes = run()
        results.append(layer_result(spark, layer, batch, outcomes))
        append_table(results[-1], lake, "errors", "layer_results",
                     batch_id=batch.batch_id, layer=layer)
        if overall_status(outcomes) != SUCCESS:
            bad = {name: error for name, _, status, error in outcomes if status == FAILED}
            raise BatchFailed(f"{layer}: {bad}")

    checks = run_checks(spark, lake, batch).withColumn("batch_id", F.lit(batch.batch_id))
    summary = _summarise(spark, lake, batch, results, checks)
    clean_up(spark, lake, batch, settings.keep_snapshots)
    return summary


def _summarise(spark: SparkSession, lake: Lake, batch: Batch, results: list[DataFrame],
               checks: DataFrame) -> DataFrame:
    """Write and return the summary row over the layers that were run."""
    log = read_log(spark, lake, "bronze", "_control/ingestion_log", LOG_SCHEMA)
    anomaly = volume_anomaly(log, None, batch.batch_id)
    summary = run_summary(reduce(DataFrame.unionByName, results), checks, anomaly)
    append_table(summary, lake, "errors", "run_summary", batch_id=batch.batch_id)
    return summary


def clean_up(spark: SparkSession, lake: Lake, batch: Batch, keep: int) -> None:
    """Drop the staged copies of the batch and snapshots nobody reads any more."""
    drop_stage(spark, lake, batch.batch_id)
    for spec in SOURCE_TABLES:
        drop_superseded(spark, lake, "bronze", spec.name, INGEST_PARTS, keep)
        drop_superseded(spark, lake, "silver", spec.name, spec.silver_parts, keep)
    for spec in (*GOLD_TABLES, *STATE_TABLES):
        drop_superseded(spark, lake, "gold", spec.name, spec.partition_by, keep)
    drop_superseded(spark, lake, "bronze", MARKS, (), keep)
