"""The query catalog: one entry per operator, each a call of the library on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.functions import rules
from caudal.functions.audit import with_audit, with_date_parts
from caudal.operators import clean, keyed, profile
from caudal.operators.attach import attach
from caudal.operators.rolling import rolling_stats, suspicious_flag
from caudal.plans import gold, monitor, quality, silver, views
from caudal.queries import bank, deliveries
from caudal.queries.bank import table
from caudal.sources.tables import scratch_lake, stage
from caudal.specs import (
    CUSTOMERS, DATE_MAX, DATE_MIN, MISSING_REQUIRED, UNKNOWN_CLIENT,
)

AS_OF = date(2001, 8, 1)
PEOPLE_AS_OF = date(2024, 12, 31)
NOW = datetime(2024, 1, 31, 7, 0, 0)
BATCH_ID = "BATCH_20240131_070000"
LAST_MONTH = "200107"


class Bank:
    """Frames of all layers over one data directory.

    Lazy by default. Queries that read the same table several times pass `staged`: silver tables
    and the loan fact are then written once to the checkpoint folder and read from there, as
    the batch does with its layer tables. Tables named in `once` are read in one place and not staged.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, staged: bool = False, once: tuple[str, ...] = ()):
        self.spark, self.sf_dir, self.once = spark, sf_dir, once
        self.lake = scratch_lake(spark) if staged else None

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df, self.lake, name, BATCH_ID) if self.lake and name not in self.once else df

    def fetch(self, *names: str) -> Bank:
        """Stage several tables that do not depend on each other as concurrent jobs."""
        with ThreadPoolExecutor(len(names)) as pool:
            list(pool.map(lambda name: getattr(self, name), names))
        return self

    def raw(self, name: str) -> DataFrame:
        return bank.RAW[name](self.spark, self.sf_dir)

    # Tagged silver frames: valid rows and rejects together.
    @cached_property
    def tagged_customers(self) -> DataFrame:
        return silver.silver_customers(self.raw("TB_CLIENTES_CORE"))

    @cached_property
    def tagged_products(self) -> DataFrame:
        return silver.silver_products(self.raw("TB_PRODUCTOS_CAT"))

    @cached_property
    def tagged_branches(self) -> DataFrame:
        return silver.silver_branches(self.raw("TB_SUCURSALES_RED"))

    @cached_property
    def tagged_loans(self) -> DataFrame:
        return silver.silver_loans(self.raw("TB_OBLIGACIONES"), self.customers, self.products)

    @cached_property
    def tagged_movements(self) -> DataFrame:
        return silver.silver_movements(self.raw("TB_MOV_FINANCIEROS"), self.customers,
                                       self.products)

    @cached_property
    def tagged_fees(self) -> DataFrame:
        return silver.silver_fees(self.raw("TB_COMISIONES_LOG"), self.customers,
                                  self.products)

    # Valid silver rows.
    @cached_property
    def customers(self) -> DataFrame:
        return self._kept(clean.accepted(self.tagged_customers), "customers")

    @cached_property
    def products(self) -> DataFrame:
        return self._kept(clean.accepted(self.tagged_products), "products")

    @cached_property
    def branches(self) -> DataFrame:
        return self._kept(clean.accepted(self.tagged_branches), "branches")

    @cached_property
    def loans(self) -> DataFrame:
        return self._kept(clean.accepted(self.tagged_loans), "loans")

    @cached_property
    def movements(self) -> DataFrame:
        return self._kept(clean.accepted(self.tagged_movements), "movements")

    @cached_property
    def fees(self) -> DataFrame:
        return self._kept(clean.accepted(self.tagged_fees), "fees")

    # Gold.
    @cached_property
    def dim_customers(self) -> DataFrame:
        return gold.build_dim_customers(self.customers, PEOPLE_AS_OF)

    @cached_property
    def dim_products(self) -> DataFrame:
        return gold.build_dim_products(self.products)

    @cached_property
    def dim_geography(self) -> DataFrame:
        return gold.build_dim_geography(self.branches)

    @cached_property
    def dim_channels(self) -> DataFrame:
        return gold.build_dim_channels(self.branches, self.movements)

    @cached_property
    def transactions(self) -> DataFrame:
        return gold.build_fact_transactions(self.movements, self.customers,
                                            self.dim_products)

    @cached_property
    def portfolio(self) -> DataFrame:
        fact = gold.build_fact_portfolio(self.loans, self.customers, self.dim_products)
        return self._kept(fact, "portfolio")

    @cached_property
    def client_value(self) -> DataFrame:
        # The loan fact has each loan once, with all that interest is made of.
        loans = self.portfolio if "loans" in self.once else self.loans
        return gold.build_client_value(self.fees, loans, self.movements,
                                       self.dim_products, self.customers, AS_OF)

    @cached_property
    def kpis(self) -> DataFrame:
        return gold.build_daily_kpis(self.portfolio, AS_OF)

    def read(self, layer: str, name: str) -> DataFrame:
        frames = {
            "TB_CLIENTES_CORE": "customers",
            "TB_MOV_FINANCIEROS": "movements",
            "dim_clientes": "dim_customers",
            "dim_productos": "dim_products",
            "dim_geografia": "dim_geography",
            "dim_canal": "dim_channels",
            "fact_transacciones": "transactions",
            "fact_cartera": "portfolio",
            "fact_rentabilidad_cliente": "client_value",
            "kpis_diarios_cartera": "kpis",
        }
        return getattr(self, frames[name])

    @cached_property
    def ingestion_log(self) -> DataFrame:
        """Orders as an ingestion log: a batch per month, a table per priority."""
        status = F.when(F.col("table_name") == "5-LOW", "FAILED").otherwise("SUCCESS")
        return (
            table(self.spark, self.sf_dir, "orders")
            .groupBy(F.date_format("o_orderdate", "yyyyMM").alias("batch_id"),
                     F.col("o_orderpriority").alias("table_name"))
            .agg(F.count("*").alias("n_records"))
            .withColumn("status", status)
        )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))


# --- ingest -------------------------------------------------------------------------------

def incremental_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    fresh = profile.since(orders, "o_orderdate", datetime(2000, 1, 1))
    return fresh.select("o_orderkey", "o_custkey", "o_totalprice",
                        F.col("o_orderdate").cast("date").alias("o_orderdate"))


def incremental_with_nulls(spark, sf_dir):
    """The inclusive scan also brings rows without a value of the watermark column."""
    day = F.nullif(F.col("o_orderdate").cast("date"), F.lit(date(1998, 3, 5)))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"))
    return profile.since(orders, "day", date(2000, 1, 1), inclusive=True)


def next_watermark(spark, sf_dir):
    return profile.next_mark(table(spark, sf_dir, "orders"), "o_orderdate", date(2000, 6, 30))


def latest_watermark(spark, sf_dir):
    marks = (
        _orders(spark, sf_dir).groupBy(F.col("o_orderpriority").alias("table_name"),
                                       F.col("o_orderstatus").alias("batch_id"))
        .agg(F.max("o_orderdate").cast("string").alias("last_watermark"),
             F.max("o_orderkey").alias("updated_at"))
    )
    return keyed.latest(marks, "table_name", "updated_at")


def audit_columns(spark, sf_dir):
    df = with_audit(table(spark, sf_dir, "customer"), "core", BATCH_ID, NOW)
    stamp = F.date_format("_ingestion_timestamp", "yyyy-MM-dd HH:mm:ss")
    return df.withColumn("_ingestion_timestamp", stamp)


def date_parts(spark, sf_dir):
    df = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return with_date_parts(df, "o_orderdate", ("_year", "_month", "_day"))


def upsert_orders(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_orderstatus",
                                           "o_totalprice")
    target = orders.filter(F.col("o_orderdate") < date(2000, 1, 1))
    source = orders.filter("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("X"))
    return keyed.upsert(target, source, ["o_orderkey"])


# --- clean --------------------------------------------------------------------------------

def dedup_by_key(spark, sf_dir):
    return keyed.dedup(_lineitem(spark, sf_dir), ["l_orderkey", "l_linenumber"],
                       [F.col("l_shipdate").desc_nulls_last()])


def dedup_exact(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "user_id", "day", "event_type", "value")
    return keyed.dedup(events, ["user_id", "day", "event_type"])


def required_split(spark, sf_dir):
    valid, bad = clean.split_required(bank.raw_customers(spark, sf_dir), list(CUSTOMERS.required))
    return valid.withColumn("reason", F.lit(None).cast("string")).unionByName(
        bad.withColumn("reason", F.lit(MISSING_REQUIRED)))


def ref_valid(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return clean.split_refs(documents, table(spark, sf_dir, "labels"), "doc_id")[0]


def ref_orphans(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    known = clean.ref_keys(table(spark, sf_dir, "labels"), "doc_id")
    return clean.split_refs(documents, known, "doc_id")[1]


def birthdate_range(spark, sf_dir):
    born = clean.conform(bank.raw_customers(spark, sf_dir).select("id_cli", "fec_nac"),
                         dates=("fec_nac",))
    return clean.in_range(born, "fec_nac", DATE_MIN, DATE_MAX)


def out_of_range_dates(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return clean.split_range(orders, "o_orderdate", date(1996, 1, 1), date(2000, 12, 31))[1]


def conform_types(spark, sf_dir):
    text = _orders(spark, sf_dir).select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("total"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("string"))
        .otherwise(F.col("o_orderpriority")).alias("day"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_custkey").cast("string"))
        .otherwise(F.col("o_orderpriority")).alias("customer"),
    )
    return clean.conform(text, {"total": "double", "customer": "int"}, ("day",))


def normalise_codes(spark, sf_dir):
    padded = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("segment"))
    return clean.conform(padded, upper=("segment",))


def fill_defaults(spark, sf_dir):
    raw = bank.raw_customers(spark, sf_dir).select("id_cli", *CUSTOMERS.defaults)
    return clean.fill_defaults(raw, CUSTOMERS.defaults)


def clamp_overdue(spark, sf_dir):
    lines = bank.overdue_lines(spark, sf_dir)
    return lines.withColumn("dias_mora_act", rules.clamp_min("dias_mora_act", 0))


def except_rows(spark, sf_dir):
    events = _events(spark, sf_dir)
    columns = ["user_id", "day", "event_type"]
    return keyed.except_rows(events.select(*columns), events.filter("value > 50").select(*columns))


def reject_rows(spark, sf_dir):
    bank_ = Bank(spark, sf_dir)
    orders = _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("id_oblig"), F.col("o_custkey").cast("string").alias("id_cli"))
    orphans = clean.split_refs(orders, bank_.customers, "id_cli")[1]
    return clean.reject(orphans, "orders", UNKNOWN_CLIENT, ("id_oblig",), BATCH_ID, NOW).select(
        "source_table", "reason", "batch_id", "row_key",
        F.col("payload").isNotNull().alias("has_payload"))


def null_profile(spark, sf_dir):
    return profile.null_profile(bank.raw_customers(spark, sf_dir))


def quality_report(spark, sf_dir):
    tagged = Bank(spark, sf_dir).tagged_customers
    counts = profile.batch_counts(tagged, clean.REASON, CUSTOMERS.columns)
    report = profile.quality_report(counts, CUSTOMERS.name, BATCH_ID, NOW)
    return report.drop("duration_sec", "logged_at")


def mask_pii(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return clean.mask_pii(customers, ("c_name",))


def rolling_30d(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "user_id", "day", "value")
    stats = rolling_stats(events, "user_id", "day", "value")
    return stats.withColumn("sd_30d", F.round("sd_30d", 5))


def rolling_large(spark, sf_dir):
    """Amounts a million million times as large: past 64 bits, and their squares past 38 digits."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate",
                                           (F.col("o_totalprice") * 1e12).alias("amount"))
    stats = rolling_stats(orders, "o_custkey", "o_orderdate", "amount", 365, "mean", "sd")
    scaled = {c: F.round(F.col(c) / 1e12, 4).alias(c) for c in ("mean", "sd")}
    return suspicious_flag(orders, "o_custkey", "o_orderdate", "amount", days=365).select(
        "o_orderkey", "ind_sospechoso").join(stats.select("o_orderkey", *scaled.values()), "o_orderkey")


def suspicious_flag_orders(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate",
                                           "o_totalprice")
    return suspicious_flag(orders, "o_custkey", "o_orderdate", "o_totalprice", days=365)


def business_hours(spark, sf_dir):
    events = _events(spark, sf_dir).select(
        "event_id", "day", F.date_format("ts", "HH:mm:ss").alias("hour"))
    return events.withColumn("ind_horario_habil", rules.business_hours("day", "hour"))


def _tagged(method: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        return getattr(Bank(spark, sf_dir), method).drop(clean.PAYLOAD)
    return query


def _layer(method: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        return getattr(Bank(spark, sf_dir), method)
    return query


# --- rules --------------------------------------------------------------------------------

def overdue_buckets(spark, sf_dir):
    days = "dias_mora_act"
    return bank.overdue_lines(spark, sf_dir).drop("l_extendedprice").withColumns({
        "bucket_mora": rules.overdue_bucket(days),
        "bucket_mora_orden": rules.bucket_order(days),
        "clasificacion_regulatoria": rules.risk_grade(days),
        "ind_en_mora": rules.flag(F.col(days) > 0),
    })


def provision(spark, sf_dir):
    grade = rules.risk_grade("dias_mora_act")
    return bank.overdue_lines(spark, sf_dir).withColumn(
        "provision_estimada", rules.provision("l_extendedprice", grade))


def segment_label(spark, sf_dir):
    coded = clean.conform(bank.raw_customers(spark, sf_dir).select("id_cli", "cod_segmento"),
                          upper=("cod_segmento",))
    # Customers of one segment get a code without a label.
    coded = coded.fillna({"cod_segmento": "OTRO"})
    return coded.withColumn("segmento_label", rules.label("cod_segmento", rules.SEGMENT_LABELS))


def age_years(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "o_orderkey", rules.age_years("o_orderdate", AS_OF).alias("edad"))


def monthly_rate(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", rules.monthly_rate("p_size").alias("tasa_mensual_pct"))


def score_bands(spark, sf_dir):
    score = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") / 10)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", rules.score_band(score).alias("rango_score_buro"))


def usd_amounts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", rules.to_usd("o_totalprice").alias("vr_usd"))


# --- gold parts ---------------------------------------------------------------------------

def attach_segment(spark, sf_dir):
    """Inner attach: orders of customers that silver accepts, with their segment."""
    orders = _orders(spark, sf_dir).select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("id_cli"))
    return attach(orders, Bank(spark, sf_dir).customers, "id_cli", ["cod_segmento"], "inner")


def commissions_12m(spark, sf_dir):
    fees = gold.monthly_fees(Bank(spark, sf_dir).fees, AS_OF)
    return fees.withColumn("total_comisiones", F.col("total_comisiones").cast("double"))


def interest_income(spark, sf_dir):
    bank_ = Bank(spark, sf_dir)
    interest = gold.monthly_interest(bank_.loans, bank_.dim_products, AS_OF)
    return interest.withColumn(
        "ingreso_intereses_est", F.round("ingreso_intereses_est", 2).cast("double"))


def monthly_income(spark, sf_dir):
    bank_ = Bank(spark, sf_dir)
    income = gold.monthly_income(
        gold.monthly_fees(bank_.fees, AS_OF),
        gold.monthly_interest(bank_.loans, bank_.dim_products, AS_OF))
    return income.select("id_cli", "periodo", *[
        F.round(c, 2).cast("double").alias(c)
        for c in ("total_comisiones", "ingreso_intereses_est", "ingreso_total_mes")])


def active_months(spark, sf_dir):
    return gold.active_months(Bank(spark, sf_dir).movements, date(2024, 1, 30))


# --- checks -------------------------------------------------------------------------------

def _names(table_name: str, name: str, layer: str = "Gold") -> dict[str, str]:
    return {"name": name, "table": table_name, "layer": layer}


def check_key_not_null(spark, sf_dir):
    return quality.check_not_null(bank.raw_customers(spark, sf_dir), "cod_segmento",
                                  **_names("customer", "expect_pk_not_null", "Silver"))


def check_duplicate_keys(spark, sf_dir):
    return quality.check_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
                                **_names("lineitem", "expect_no_duplicate_pk"))


def check_bucket_values(spark, sf_dir):
    return quality.check_in_set(bank.raw_customers(spark, sf_dir), "cod_segmento",
                                ("ELITE", "Premium"),
                                **_names("customer", "expect_bucket_mora_valid_values"))


def invalid_sample(spark, sf_dir):
    events = table(spark, sf_dir, "events").filter(~F.col("event_type").isin("view", "click"))
    return keyed.sample_values(events, "event_type", 5)


def check_provision(spark, sf_dir):
    days = "dias_mora_act"
    lines = bank.overdue_lines(spark, sf_dir).withColumn(
        "provision_estimada", rules.provision("l_extendedprice", rules.risk_grade(days)))
    return quality.check_bounds(
        lines, "provision_estimada", 0, F.col("l_extendedprice") * 1.001,
        **_names("lineitem", "expect_provision_non_negative_and_consistent"))


def check_flag_binary(spark, sf_dir):
    flagged = suspicious_flag_orders(spark, sf_dir)
    return quality.check_binary(flagged, "ind_sospechoso",
                                **_names("orders", "expect_ind_sospechoso_binary", "Silver"))


def check_row_counts(spark, sf_dir):
    names = ("customer", "orders", "lineitem", "part", "supplier")
    tables = {name: table(spark, sf_dir, name) for name in names}
    return quality.check_row_counts(tables, "expect_minimum_row_count_gold", "Gold")


def check_references(spark, sf_dir):
    return quality.check_references(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id",
        **_names("documents", "expect_fact_cartera_cli_referential_integrity"))


def check_rate_range(spark, sf_dir):
    rates = table(spark, sf_dir, "customer").withColumn("rate", F.col("c_acctbal") / 80)
    return quality.check_bounds(rates, "rate", 0, 100,
                                **_names("customer", "expect_tasa_mora_pct_in_range"))


def quality_suite(spark, sf_dir):
    # Loans are read by their fact and fees by client value alone.
    bank_ = Bank(spark, sf_dir, staged=True, once=("loans", "fees")).fetch("customers", "products", "branches")
    checks = quality.standard_checks(bank_.fetch("portfolio", "movements").read)
    return quality.suite(checks).select("check_name", "table_name", "layer", "passed", "message",
                                        "details")


# --- monitoring ---------------------------------------------------------------------------

def batch_totals(spark, sf_dir):
    return monitor.batch_totals(Bank(spark, sf_dir).ingestion_log)


def last_batches(spark, sf_dir):
    return monitor.last_batches(Bank(spark, sf_dir).ingestion_log, LAST_MONTH)


def volume_anomaly(spark, sf_dir):
    return monitor.volume_anomaly(Bank(spark, sf_dir).ingestion_log, None, LAST_MONTH)


def layer_counts(spark, sf_dir):
    """Row counts of three layers, by month of the order as the batch."""
    bank_ = Bank(spark, sf_dir, staged=True).fetch("customers", "products")
    month = F.date_format("fec_desembolso", "yyyyMM").alias("batch_id")

    def counted(df: DataFrame, layer: str, name: str) -> DataFrame:
        return df.groupBy(month).agg(F.count("*").alias("records")).select(
            "batch_id", F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "records",
            F.lit("SUCCESS").alias("status"))

    raw = bank_.raw("TB_OBLIGACIONES").withColumn("fec_desembolso",
                                                  F.to_date("fec_desembolso", "yyyy-MM-dd"))
    # Read once and only to be counted, so the fact is not staged.
    portfolio = gold.build_fact_portfolio(bank_.loans, bank_.customers, bank_.dim_products)
    return (counted(raw, "bronze", "TB_OBLIGACIONES")
            .unionByName(counted(bank_.loans, "silver", "TB_OBLIGACIONES"))
            .unionByName(counted(portfolio, "gold", "fact_cartera")))


def run_summary(spark, sf_dir):
    checks = check_row_counts(spark, sf_dir).unionByName(check_references(spark, sf_dir))
    checks = checks.withColumn("batch_id", F.lit(LAST_MONTH))
    return monitor.run_summary(layer_counts(spark, sf_dir), checks, volume_anomaly(spark, sf_dir))


def masked_customers(spark, sf_dir):
    return views.analyst_view(Bank(spark, sf_dir).dim_customers)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "daily_kpis": _layer("kpis"),
    "overdue_buckets": overdue_buckets,
    "provision": provision,
    "clamp_overdue": clamp_overdue,
    "incremental_scan": incremental_scan,
    "incremental_with_nulls": incremental_with_nulls,
    "next_watermark": next_watermark,
    "latest_watermark": latest_watermark,
    "audit_columns": audit_columns,
    "date_parts": date_parts,
    "upsert_orders": upsert_orders,
    "dedup_by_key": dedup_by_key,
    "dedup_exact": dedup_exact,
    "required_split": required_split,
    "ref_valid": ref_valid,
    "ref_orphans": ref_orphans,
    "birthdate_range": birthdate_range,
    "out_of_range_dates": out_of_range_dates,
    "conform_types": conform_types,
    "normalise_codes": normalise_codes,
    "fill_defaults": fill_defaults,
    "except_rows": except_rows,
    "reject_rows": reject_rows,
    "null_profile": null_profile,
    "quality_report": quality_report,
    "mask_pii": mask_pii,
    "rolling_30d": rolling_30d,
    "rolling_large": rolling_large,
    "suspicious_flag": suspicious_flag_orders,
    "business_hours": business_hours,
    "silver_customers": _tagged("tagged_customers"),
    "silver_products": _tagged("tagged_products"),
    "silver_branches": _tagged("tagged_branches"),
    "silver_loans": _tagged("tagged_loans"),
    "silver_movements": _tagged("tagged_movements"),
    "silver_fees": _tagged("tagged_fees"),
    "segment_label": segment_label,
    "age_years": age_years,
    "monthly_rate": monthly_rate,
    "score_bands": score_bands,
    "usd_amounts": usd_amounts,
    "dim_clientes": _layer("dim_customers"),
    "dim_products": _layer("dim_products"),
    "dim_geography": _layer("dim_geography"),
    "dim_canal": _layer("dim_channels"),
    "attach_segment": attach_segment,
    "fact_transactions": _layer("transactions"),
    "fact_portfolio": _layer("portfolio"),
    "commissions_12m": commissions_12m,
    "interest_income": interest_income,
    "monthly_income": monthly_income,
    "active_months": active_months,
    "client_value": _layer("client_value"),
    "check_key_not_null": check_key_not_null,
    "check_duplicate_keys": check_duplicate_keys,
    "check_bucket_values": check_bucket_values,
    "invalid_sample": invalid_sample,
    "check_provision": check_provision,
    "check_flag_binary": check_flag_binary,
    "check_row_counts": check_row_counts,
    "check_references": check_references,
    "check_rate_range": check_rate_range,
    "quality_suite": quality_suite,
    "batch_totals": batch_totals,
    "last_batches": last_batches,
    "volume_anomaly": volume_anomaly,
    "layer_counts": layer_counts,
    "run_summary": run_summary,
    "masked_customers": masked_customers,
    **deliveries.QUERIES,
}
