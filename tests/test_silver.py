from datetime import date

import pytest

from bank_rows import frames
from caudal.operators.clean import REASON, accepted
from caudal.plans import silver

MISSING, CLIENT, PRODUCT, RANGE = (
    "CAMPO_OBLIGATORIO_NULO", "ID_CLI_NO_EXISTE_EN_DIMENSION", "COD_PROD_NO_EXISTE_EN_DIMENSION",
    "FECHA_FUERA_DE_RANGO")


@pytest.fixture(scope="module")
def raw(spark):
    return frames(spark)


@pytest.fixture(scope="module")
def customers(raw):
    return silver.silver_customers(raw["TB_CLIENTES_CORE"])


@pytest.fixture(scope="module")
def products(raw):
    return silver.silver_products(raw["TB_PRODUCTOS_CAT"])


def reasons(df, key):
    return {r[key]: r[REASON] for r in df.collect()}


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_customers(customers):
    assert reasons(customers, "id_cli") == {
        "C1": None, "C2": None, "C3": RANGE, "C4": MISSING, "C5": None, "C6": MISSING}
    rows = by_key(accepted(customers), "id_cli")
    assert (rows["C1"]["cod_segmento"], rows["C1"]["tip_doc"], rows["C1"]["estado_cli"]) == (
        "PREMIUM", "CC", "ACTIVO")
    assert rows["C1"]["fec_alta"] == date(2024, 1, 2) and len(rows["C1"]["nomb_cli"]) == 64
    assert (rows["C2"]["score_buro"], rows["C2"]["ciudad_res"], rows["C2"]["canal_adquis"]) == (
        0, "DESCONOCIDO", "NO_INFORMADO")
    assert rows["C5"]["fec_nac"] is None
    # No reject shows a name or a document number.
    payloads = "".join(r["_payload"] or "" for r in customers.collect())
    assert "not a date" in payloads and "Segment" not in payloads and "444" not in payloads


def test_products_and_branches(raw, products):
    assert reasons(products, "cod_prod") == {"P1": None, "P2": None, "P3": MISSING}
    rows = by_key(products, "cod_prod")
    assert (rows["P1"]["tip_prod"], rows["P1"]["comision_admin"], rows["P2"]["cuota_min"]) == (
        "CREDITO", 0.0, 0.0)
    branches = silver.silver_branches(raw["TB_SUCURSALES_RED"])
    assert reasons(branches, "cod_suc") == {"S1": None, "S2": None, "S3": MISSING}
    assert by_key(branches, "cod_suc")["S1"]["ciudad"] == "BOGOTA"
    assert by_key(branches, "cod_suc")["S2"]["activo"] == 0


def test_loans(raw, customers, products):
    loans = silver.silver_loans(raw["TB_OBLIGACIONES"], accepted(customers), accepted(products))
    assert reasons(loans, "id_oblig") == {"L1": None, "L2": None, "L3": CLIENT, "L4": PRODUCT,
                                          "L5": MISSING}
    rows = by_key(loans, "id_oblig")
    assert (rows["L1"]["dias_mora_act"], rows["L1"]["num_cuotas_pend"], rows["L1"]["calif_riesgo"]
            ) == (0, 0, "A")
    assert rows["L2"]["dias_mora_act"] == 45  # the newer of the two


def test_movements(raw, customers, products):
    out = silver.silver_movements(raw["TB_MOV_FINANCIEROS"], accepted(customers),
                                  accepted(products))
    got = sorted((r["id_mov"], r[REASON] or "") for r in out.collect())
    assert got == [("M1", ""), ("M2", ""), ("M2", RANGE), ("M3", ""), ("M4", CLIENT),
                   ("M5", PRODUCT), ("M6", MISSING), ("M7", MISSING), ("M8", "")]
    rows = by_key(accepted(out), "id_mov")
    assert rows["M2"]["fec_mov"] == date(2024, 3, 5)
    assert (rows["M1"]["ind_horario_habil"], rows["M8"]["ind_horario_habil"]) == (1, 0)
    assert (rows["M8"]["num_cuenta"], rows["M8"]["cod_canal"]) == ("DESCONOCIDO", "ATM")
    assert "xx" in "".join(r["_payload"] or "" for r in out.collect())


def test_an_id_whose_valid_rows_differ_keeps_the_latest(spark, customers, products):
    from bank_rows import movement
    from caudal.specs import MOVEMENTS
    rows = [movement("M", day="2024-03-01", value=1.0), movement("M", day="2024-03-09", value=2.0),
            movement("M", day="2099-01-01", value=3.0), movement("M", day="2098-01-01", value=3.0)]
    out = silver.silver_movements(spark.createDataFrame(rows, MOVEMENTS.schema),
                                  accepted(customers), accepted(products))
    assert [r["vr_mov"] for r in accepted(out).collect()] == [2.0]
    assert out.filter(f"{REASON} is not null").count() == 2


def test_rejected_rows_do_not_count_in_the_window(spark, customers, products):
    from bank_rows import movement
    from caudal.specs import MOVEMENTS
    rows = [movement("A", day="2024-03-01", value=10.0), movement("B", day="2024-03-02", value=10.0),
            movement("X", day="2024-03-03", value=9e6, product="P9"),
            movement("C", day="2024-03-04", value=11.0)]
    out = silver.silver_movements(spark.createDataFrame(rows, MOVEMENTS.schema),
                                  accepted(customers), accepted(products))
    assert by_key(accepted(out), "id_mov")["C"]["ind_sospechoso"] == 1


def test_fees(raw, customers, products):
    fees = silver.silver_fees(raw["TB_COMISIONES_LOG"], accepted(customers), accepted(products))
    assert reasons(fees, "id_comision") == {"F1": None, "F2": None, "F3": None, "F4": None,
                                            "F5": CLIENT, "F6": MISSING}
    rows = by_key(fees, "id_comision")
    assert (rows["F1"]["tip_comision"], rows["F1"]["estado_cobro"]) == ("CUOTA", "COBRADO")
    assert (rows["F4"]["tip_comision"], rows["F4"]["estado_cobro"]) == ("NO_INFORMADO", "PENDIENTE")
