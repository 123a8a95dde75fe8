"""Gold: dimensions, facts and KPIs, as functions from silver frames to frames."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.functions import rules
from caudal.functions.audit import with_date_parts
from caudal.functions.rules import flag, money
from caudal.operators.attach import attach

COLLECTED = "COBRADO"
ACTIVE = "ACTIVO"


def build_dim_customers(customers: DataFrame, as_of: date) -> DataFrame:
    return customers.select(
        "id_cli",
        F.concat_ws(" ", "nomb_cli", "apell_cli").alias("nombre_completo"),
        F.col("nomb_cli").alias("nombre_hash"),
        F.col("apell_cli").alias("apellido_hash"),
        F.col("num_doc").alias("num_doc_hash"),
        "tip_doc",
        "fec_nac",
        rules.age_years("fec_nac", as_of).alias("edad"),
        "fec_alta",
        "cod_segmento",
        rules.label("cod_segmento", rules.SEGMENT_LABELS).alias("segmento_label"),
        "score_buro",
        "ciudad_res",
        "depto_res",
        "estado_cli",
        flag(F.col("estado_cli") == ACTIVE).alias("ind_activo"),
        "canal_adquis",
    )


def build_dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        "cod_prod",
        "desc_prod",
        F.col("desc_prod").alias("desc_negocio"),
        "tip_prod",
        F.col("tip_prod").alias("familia"),
        "tasa_ea",
        rules.monthly_rate("tasa_ea").alias("tasa_mensual_pct"),
        "plazo_max_meses",
        "cuota_min",
        "comision_admin",
        "estado_prod",
        flag(F.col("estado_prod") == ACTIVE).alias("ind_activo"),
    )


def build_dim_geography(branches: DataFrame) -> DataFrame:
    """One row per city and department. Decimal sums make the averages independent of row order."""
    def average(column: str):
        exact = F.sum(F.col(column).cast("decimal(18,8)")).cast("double")
        return F.try_divide(exact, F.count(column))

    return (
        branches.groupBy("ciudad", "depto")
        .agg(average("latitud").alias("latitud_ref"),
             average("longitud").alias("longitud_ref"),
             F.count("*").alias("n_puntos"))
        .withColumn("id_geo", F.md5(F.concat_ws("_", "ciudad", "depto")))
    )


def channels(branches: DataFrame, movements: DataFrame) -> DataFrame:
    """Physical and digital channel codes. Each side is made distinct before the union, so a
    movement table of any size contributes a handful of rows per task."""
    physical = branches.select(F.col("tip_punto").alias("cod_canal"),
                               F.lit("FISICO").alias("tipo_canal"))
    digital = movements.select("cod_canal", F.lit("DIGITAL").alias("tipo_canal"))
    return physical.unionByName(digital).distinct()


def build_dim_channels(branches: DataFrame, movements: DataFrame) -> DataFrame:
    return channels(branches, movements).select(
        "cod_canal",
        "tipo_canal",
        F.md5(F.concat_ws("_", "cod_canal", "tipo_canal")).alias("id_canal"),
        rules.channel_label("cod_canal").alias("desc_canal"),
    )


def build_fact_transactions(movements: DataFrame, customers: DataFrame, dim_products: DataFrame,
                            rate: float = rules.COP_TO_USD) -> DataFrame:
    df = attach(movements, customers, "id_cli", ["cod_segmento"], how="inner")
    df = attach(df, dim_products, "cod_prod", ["familia"])
    df = with_date_parts(df, "fec_mov", ("anio_mov", "mes_mov"))
    return df.select(
        "id_mov", "id_cli", "cod_prod", "num_cuenta", "fec_mov", "hra_mov", "anio_mov", "mes_mov",
        "vr_mov", rules.to_usd("vr_mov", rate).alias("vr_mov_usd"), "tip_mov", "cod_canal",
        "cod_ciudad", "cod_estado_mov", "id_dispositivo", "cod_segmento",
        F.col("familia").alias("familia_producto"), "ind_sospechoso", "ind_horario_habil",
    )


def build_fact_portfolio(loans: DataFrame, customers: DataFrame,
                         dim_products: DataFrame) -> DataFrame:
    df = attach(loans, customers, "id_cli", ["cod_segmento", "ciudad_res", "depto_res"])
    df = attach(df, dim_products, "cod_prod", ["desc_prod", "tip_prod"])
    df = with_date_parts(df, "fec_desembolso", ("anio_desembolso", "mes_desembolso"))
    grade = rules.risk_grade("dias_mora_act")
    return df.select(
        "id_oblig", "id_cli", "cod_prod", "vr_aprobado", "vr_desembolsado", "sdo_capital",
        "vr_cuota", "fec_desembolso", "fec_venc", "anio_desembolso", "mes_desembolso",
        "dias_mora_act",
        rules.overdue_bucket("dias_mora_act").alias("bucket_mora"),
        rules.bucket_order("dias_mora_act").alias("bucket_mora_orden"),
        "num_cuotas_pend",
        grade.alias("clasificacion_regulatoria"),
        rules.provision("sdo_capital", grade).alias("provision_estimada"),
        flag(F.col("dias_mora_act") > 0).alias("ind_en_mora"),
        "cod_segmento", "ciudad_res", "depto_res", "desc_prod", "tip_prod",
    )


def monthly_fees(fees: DataFrame, as_of: date, months: int = 12) -> DataFrame:
    """Collected commissions per client and month of the trailing window."""
    return (
        fees.filter((F.col("estado_cobro") == COLLECTED)
                    & rules.in_trailing_months("fec_cobro", months, as_of))
        .groupBy("id_cli", rules.period("fec_cobro").alias("periodo"))
        .agg(F.sum(money("vr_comision")).alias("total_comisiones"))
    )


def monthly_interest(loans: DataFrame, dim_products: DataFrame, as_of: date,
                     months: int = 12) -> DataFrame:
    """Estimated interest per client and month of disbursement in the trailing window."""
    rate = F.col("tasa_mensual_pct").cast("decimal(9,4)")
    interest = money("sdo_capital") * rate * F.lit("0.01").cast("decimal(3,2)")
    recent = loans.filter(rules.in_trailing_months("fec_desembolso", months, as_of))
    return (
        attach(recent, dim_products, "cod_prod", ["tasa_mensual_pct"])
        .groupBy("id_cli", rules.period("fec_desembolso").alias("periodo"))
        .agg(F.sum(interest).alias("ingreso_intereses_est"))
    )


def monthly_income(fees: DataFrame, interest: DataFrame) -> DataFrame:
    """Full outer join of both incomes by client and month, missing sides as 0."""
    joined = fees.join(interest, ["id_cli", "periodo"], "outer").fillna(0)
    return joined.withColumn("ingreso_total_mes", F.col("total_comisiones").cast("decimal(30,2)")
                             + F.col("ingreso_intereses_est"))


def active_months(movements: DataFrame, as_of: date, months: int = 12) -> DataFrame:
    """Number of distinct months with a movement in the trailing window, per client."""
    recent = movements.filter(rules.in_trailing_months("fec_mov", months, as_of))
    return (
        recent.groupBy("id_cli")
        .agg(F.countDistinct(rules.period("fec_mov")).alias("meses_activo"))
    )


def client_value(monthly: DataFrame) -> DataFrame:
    def total(column: str):
        return F.round(F.sum(column), 2).cast("double")

    return monthly.groupBy("id_cli").agg(
        total("ingreso_total_mes").alias("cltv_12m"),
        total("total_comisiones").alias("total_comisiones_12m"),
        total("ingreso_intereses_est").alias("total_intereses_12m"),
    )


def build_client_value(fees: DataFrame, loans: DataFrame, movements: DataFrame,
                       dim_products: DataFrame, customers: DataFrame, as_of: date,
                       months: int = 12) -> DataFrame:
    income = monthly_income(monthly_fees(fees, as_of, months),
                            monthly_interest(loans, dim_products, as_of, months))
    df = attach(client_value(income), active_months(movements, as_of, months), "id_cli",
                ["meses_activo"])
    df = attach(df, customers, "id_cli", ["cod_segmento", "estado_cli"])
    return df.select(
        "id_cli", "cltv_12m", "total_comisiones_12m", "total_intereses_12m",
        F.coalesce("meses_activo", F.lit(0)).alias("meses_activo"),
        "cod_segmento", "estado_cli",
        F.date_format(F.lit(as_of), "yyyy-MM").alias("periodo_calculo"),
    )


def build_daily_kpis(portfolio: DataFrame, as_of: date) -> DataFrame:
    overdue = F.col("ind_en_mora") == 1

    def amount(total):
        return F.round(total, 2).cast("double")

    kpis = portfolio.groupBy(
        F.lit(as_of).alias("fecha_calculo"), "cod_prod", "tip_prod", "cod_segmento", "depto_res",
    ).agg(
        F.count("id_oblig").alias("total_obligaciones_activas"),
        amount(F.sum(money("sdo_capital"))).alias("monto_total_cartera"),
        amount(rules.sum_if(money("sdo_capital"), overdue)).alias("monto_en_mora"),
        amount(F.sum(money("provision_estimada"))).alias("provision_total_estimada"),
        rules.count_distinct_if("id_cli", overdue).alias("clientes_con_mora"),
    ).withColumn("tasa_mora_pct", rules.safe_pct("monto_en_mora", "monto_total_cartera"))
    return with_date_parts(kpis, "fecha_calculo", ("anio_calculo", "mes_calculo"))
