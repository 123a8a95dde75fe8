"""The shared Parquet tables read as raw bank tables.

Missing values, unknown references, copies and bad dates all follow from the tables' own
columns, so that every cleaning rule has work to do on the whole data. `oracle.py` holds the
same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.functions.rules import label


# Declared, so that opening a table starts no job to look at file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _day(column: str) -> Column:
    return F.col(column).cast("date")


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"])


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _regions(spark, sf_dir)
    df = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == places["n_nationkey"])
    segments = {"AUTOMOBILE": " basico", "BUILDING": "estandar ", "FURNITURE": "Premium",
                "HOUSEHOLD": "ELITE"}
    documents = {"AFRICA": " cc", "AMERICA": "ce ", "ASIA": "nit", "EUROPE": "PP"}
    states = {"AFRICA": "activo", "AMERICA": "ACTIVO ", "ASIA": "inactivo", "EUROPE": " bloqueado"}
    born = F.date_add(F.lit("2000-01-01").cast("date"), F.floor(F.col("c_acctbal") / 2).cast("int"))
    return df.select(
        _text("c_custkey").alias("id_cli"),
        F.col("c_name").alias("nomb_cli"),
        F.col("n_name").alias("apell_cli"),
        F.coalesce(label("r_name", documents), F.lit("cc")).alias("tip_doc"),
        F.concat(F.lit("D"), _text("c_custkey")).alias("num_doc"),
        F.when(F.col("n_name") != "NATION_7", born.cast("string")).alias("fec_nac"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey")).cast("string")
        .alias("fec_alta"),
        label("c_mktsegment", segments).alias("cod_segmento"),
        F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 10).cast("int"))
        .alias("score_buro"),
        F.when(F.col("n_name") != "NATION_3", F.col("n_name")).alias("ciudad_res"),
        F.col("r_name").alias("depto_res"),
        F.coalesce(label("r_name", states), F.lit("activo")).alias("estado_cli"),
        F.when(F.col("r_name") != "ASIA", F.lit("WEB")).alias("canal_adquis"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"ECONOMY": "credito ", "STANDARD": "CREDITO", "SMALL": " ahorro", "MEDIUM": "ahorro",
             "LARGE": "Transaccional"}
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("cod_prod"),
        F.col("p_name").alias("desc_prod"),
        label("p_type", kinds).alias("tip_prod"),
        (F.col("p_size") * F.lit(0.72)).alias("tasa_ea"),
        F.col("p_size").alias("plazo_max_meses"),
        F.when(F.col("p_size") > 10, F.col("p_retailprice")).alias("cuota_min"),
        F.col("p_retailprice").alias("comision_admin"),
        F.when(F.col("p_size") <= 40, F.lit("activo ")).otherwise(F.lit("descontinuado"))
        .alias("estado_prod"),
    )


def raw_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = _regions(spark, sf_dir)
    df = table(spark, sf_dir, "supplier").join(places, F.col("s_nationkey") == places["n_nationkey"])
    kinds = {"AFRICA": "sucursal", "AMERICA": " corresponsal", "ASIA": "atm ",
             "EUROPE": "Punto_Pago"}
    return df.select(
        _text("s_suppkey").alias("cod_suc"),
        F.col("s_name").alias("nom_suc"),
        F.coalesce(label("r_name", kinds), F.lit("sucursal")).alias("tip_punto"),
        F.when(F.col("n_name") != "NATION_5", F.lower("n_name")).alias("ciudad"),
        F.lower("r_name").alias("depto"),
        (F.col("s_acctbal") / 1000).alias("latitud"),
        (F.col("s_acctbal") / -500).alias("longitud"),
        F.when(F.col("s_acctbal") > 0, F.lit(1)).alias("activo"),
    )


def raw_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events; purchases arrive twice, the larger ones the second time with a bad date."""
    events = table(spark, sf_dir, "events").withColumn("fec_mov", _day("ts").cast("string"))
    again = events.filter("event_type = 'purchase'").withColumn(
        "fec_mov", F.when(F.col("value") > 100, F.lit("2099-01-01")).otherwise(F.col("fec_mov")))
    codes = {"view": "app_movil", "click": "portal_web ", "purchase": "corresponsal",
             "signup": "atm", "error": " banca_telefonica"}
    kind = F.col("event_type")
    return events.unionByName(again).select(
        _text("event_id").alias("id_mov"),
        _text("user_id").alias("id_cli"),
        F.get_json_object("props", "$.k").alias("cod_prod"),
        F.when(kind != "error", F.concat(F.lit("CTA"), _text("user_id"))).alias("num_cuenta"),
        "fec_mov",
        F.date_format("ts", "HH:mm:ss").alias("hra_mov"),
        F.when(F.col("value") >= 1, F.col("value")).alias("vr_mov"),
        F.concat(F.lit(" "), kind).alias("tip_mov"),
        label("event_type", codes).alias("cod_canal"),
        F.when(kind != "view", F.concat(F.lit("C"), _text("user_id"))).alias("cod_ciudad"),
        F.lit("APROBADO").alias("cod_estado_mov"),
        F.when(kind != "click", F.concat(F.lit("DEV"), _text("user_id"))).alias("id_dispositivo"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])


def overdue_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their days from order to shipment."""
    return _lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.datediff(_day("l_shipdate"), _day("o_orderdate")).alias("dias_mora_act"))


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as loans. Order and line number repeat, so ids do too."""
    return _lines(spark, sf_dir).select(
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("id_oblig"),
        _text("o_custkey").alias("id_cli"),
        _text("l_partkey").alias("cod_prod"),
        F.col("o_totalprice").alias("vr_aprobado"),
        F.col("l_extendedprice").alias("vr_desembolsado"),
        F.col("l_extendedprice").alias("sdo_capital"),
        F.col("l_quantity").alias("vr_cuota"),
        _day("o_orderdate").cast("string").alias("fec_desembolso"),
        _day("l_shipdate").cast("string").alias("fec_venc"),
        F.datediff(_day("l_shipdate"), _day("o_orderdate")).alias("dias_mora_act"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("num_cuotas_pend"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("calif_riesgo"),
    )


def raw_fees(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [_text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    fee = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(4,2)")
    states = {"F": " cobrado"}
    return _lines(spark, sf_dir).select(
        F.concat_ws("-", *keys).alias("id_comision"),
        _text("o_custkey").alias("id_cli"),
        _text("l_partkey").alias("cod_prod"),
        _day("l_shipdate").cast("string").alias("fec_cobro"),
        F.when(F.col("l_tax") > 0, F.round(fee, 2).cast("double")).alias("vr_comision"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("tipo_"), F.lower("l_returnflag")))
        .alias("tip_comision"),
        label("l_linestatus", states).alias("estado_cobro"),
    )


RAW = {
    "TB_CLIENTES_CORE": raw_customers,
    "TB_PRODUCTOS_CAT": raw_products,
    "TB_SUCURSALES_RED": raw_branches,
    "TB_OBLIGACIONES": raw_loans,
    "TB_MOV_FINANCIEROS": raw_movements,
    "TB_COMISIONES_LOG": raw_fees,
}
