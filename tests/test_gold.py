from datetime import date

import pytest

from bank_rows import frames
from caudal.operators.clean import accepted
from caudal.plans import gold, silver, views

AS_OF = date(2024, 12, 31)


@pytest.fixture(scope="module")
def tables(spark):
    raw = frames(spark)
    customers = accepted(silver.silver_customers(raw["TB_CLIENTES_CORE"]))
    products = accepted(silver.silver_products(raw["TB_PRODUCTOS_CAT"]))
    refs = (customers, products)
    return {
        "customers": customers,
        "products": products,
        "branches": accepted(silver.silver_branches(raw["TB_SUCURSALES_RED"])),
        "loans": accepted(silver.silver_loans(raw["TB_OBLIGACIONES"], *refs)),
        "movements": accepted(silver.silver_movements(raw["TB_MOV_FINANCIEROS"], *refs)),
        "fees": accepted(silver.silver_fees(raw["TB_COMISIONES_LOG"], *refs)),
        "dim_products": gold.build_dim_products(products),
    }


def test_dim_customers(tables):
    rows = {r["id_cli"]: r for r in gold.build_dim_customers(tables["customers"], AS_OF).collect()}
    assert rows["C1"]["edad"] == 23 and rows["C2"]["edad"] is None
    assert rows["C1"]["segmento_label"] == "Premium (5-15 SMLV)"
    assert (rows["C1"]["ind_activo"], rows["C2"]["ind_activo"]) == (1, 0)
    assert rows["C1"]["nombre_completo"] == f"{rows['C1']['nombre_hash']} {rows['C1']['apellido_hash']}"


def test_dim_products(tables):
    rows = {r["cod_prod"]: r for r in tables["dim_products"].collect()}
    assert rows["P1"]["tasa_mensual_pct"] == pytest.approx(2.0, abs=1e-4)
    assert (rows["P1"]["familia"], rows["P1"]["ind_activo"], rows["P2"]["ind_activo"]) == (
        "CREDITO", 1, 0)


def test_dim_geography(tables):
    row = gold.build_dim_geography(tables["branches"]).head()
    assert tuple(row) == ("BOGOTA", "CUNDINAMARCA", 4.5, -73.5, 2,
                          "f692e47e8950f2706bb983ede30c4534")


def test_dim_channels(tables):
    rows = {(r["cod_canal"], r["tipo_canal"]): r["desc_canal"] for r in
            gold.build_dim_channels(tables["branches"], tables["movements"]).collect()}
    assert rows == {
        ("SUCURSAL", "FISICO"): "Sucursal Física", ("ATM", "FISICO"): "Cajero Automático",
        ("ATM", "DIGITAL"): "Cajero Automático", ("APP_MOVIL", "DIGITAL"): "Aplicación Móvil"}


def test_fact_transactions(tables):
    fact = gold.build_fact_transactions(tables["movements"], tables["customers"],
                                        tables["dim_products"])
    row = {r["id_mov"]: r for r in fact.collect()}["M3"]
    assert (row["anio_mov"], row["mes_mov"], row["familia_producto"], row["cod_segmento"]) == (
        "2010", "06", "CREDITO", "PREMIUM")
    assert row["vr_mov_usd"] == 0.0024


def test_fact_portfolio_and_kpis(tables):
    fact = gold.build_fact_portfolio(tables["loans"], tables["customers"], tables["dim_products"])
    rows = {r["id_oblig"]: r for r in fact.collect()}
    assert (rows["L1"]["bucket_mora"], rows["L1"]["provision_estimada"], rows["L1"]["ind_en_mora"]
            ) == ("AL_DIA", 10_000.0, 0)
    assert (rows["L2"]["bucket_mora"], rows["L2"]["provision_estimada"], rows["L2"]["mes_desembolso"]
            ) == ("RANGO_2", 200_000.0, "02")
    kpis = {r["cod_segmento"]: r for r in gold.build_daily_kpis(fact, AS_OF).collect()}
    assert (kpis["BASICO"]["tasa_mora_pct"], kpis["BASICO"]["clientes_con_mora"]) == (100.0, 1)
    assert (kpis["PREMIUM"]["tasa_mora_pct"], kpis["PREMIUM"]["clientes_con_mora"]) == (0.0, 0)
    assert (kpis["PREMIUM"]["anio_calculo"], kpis["PREMIUM"]["mes_calculo"]) == ("2024", "12")


def test_client_value(tables):
    out = gold.build_client_value(tables["fees"], tables["loans"], tables["movements"],
                                  tables["dim_products"], tables["customers"], AS_OF)
    row = {r["id_cli"]: r for r in out.collect()}["C1"]
    assert row["total_comisiones_12m"] == 150.0
    assert row["total_intereses_12m"] == pytest.approx(20_000.0, abs=1)
    assert row["cltv_12m"] == pytest.approx(row["total_comisiones_12m"] + row["total_intereses_12m"])
    assert (row["meses_activo"], row["cod_segmento"], row["periodo_calculo"]) == (1, "PREMIUM", "2024-12")


def test_analyst_view(spark, tables):
    dim = gold.build_dim_customers(tables["customers"], AS_OF)
    views.create_analyst_view(dim, "masked")
    row = {r["id_cli"]: r for r in spark.table("masked").collect()}["C1"]
    assert row["nombre_ofuscado"].endswith("****") and len(row["nombre_ofuscado"]) == 8
    assert row["doc_ofuscado"].startswith("***") and row["rango_score_buro"] == "ALTO"
    assert not {"ciudad_res", "nombre_hash", "score_buro"} & set(spark.table("masked").columns)
