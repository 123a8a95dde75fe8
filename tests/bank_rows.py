"""Small literal bank tables."""

from caudal.specs import BRANCHES, CUSTOMERS, FEES, LOANS, MOVEMENTS, PRODUCTS

CUSTOMER_ROWS = [
    ("C1", "Ana", "Rojas", " cc", "111", "2001-05-01", "2024-01-02", " premium", 700, "BOGOTA",
     "CUNDINAMARCA", "activo", "WEB"),
    ("C2", "Luis", "Paz", "CE", "222", None, "2024-02-03", "BASICO", None, None, "ANTIOQUIA",
     "INACTIVO", None),
    ("C3", "Old", "Born", "CC", "333", "1985-01-01", "2024-02-03", "ELITE", 500, "CALI", "VALLE",
     "ACTIVO", "WEB"),
    ("C4", "No", "Segment", "CC", "444", "2002-01-01", "2024-02-03", None, 500, "CALI", "VALLE",
     "ACTIVO", "WEB"),
    ("C5", "Odd", "Birth", "CC", "555", "xx", "2024-02-03", "ESTANDAR", 500, "CALI", "VALLE",
     "ACTIVO", "WEB"),
    ("C6", "Bad", "Start", "CC", "666", "2002-01-01", "not a date", "ESTANDAR", 500, "CALI",
     "VALLE", "ACTIVO", "WEB"),
]
PRODUCT_ROWS = [
    ("P1", "Credito libre", " credito", 26.8242, 60, 100.0, None, "activo"),
    ("P2", "Ahorro", "AHORRO", 0.0, 0, None, 5.0, "DESCONTINUADO"),
    ("P3", "Sin tipo", None, 1.0, 12, 1.0, 1.0, "ACTIVO"),
]
BRANCH_ROWS = [
    ("S1", "Centro", "sucursal", " bogota", "cundinamarca", 4.0, -74.0, 1),
    ("S2", "Norte", "ATM", "BOGOTA", "CUNDINAMARCA", 5.0, -73.0, None),
    ("S3", "Nada", "ATM", None, "VALLE", 1.0, 1.0, 1),
]
LOAN_ROWS = [
    ("L1", "C1", "P1", 1.5e6, 1e6, 1e6, 5e4, "2024-03-05", "2025-03-05", -3, None, None),
    ("L2", "C2", "P1", 1e6, 1e6, 1e6, 5e4, "2024-02-01", "2025-02-01", 45, 3, "C"),
    ("L3", "C9", "P1", 1e6, 1e6, 1e6, 5e4, "2024-02-01", "2025-02-01", 0, 3, "A"),
    ("L4", "C1", "P9", 1e6, 1e6, 1e6, 5e4, "2024-02-01", "2025-02-01", 0, 3, "A"),
    ("L5", "C1", "P1", 1e6, None, 1e6, 5e4, "2024-02-01", "2025-02-01", 0, 3, "A"),
    ("L2", "C2", "P1", 1e6, 1e6, 1e6, 5e4, "2024-01-01", "2025-02-01", 99, 3, "C"),
]
FEE_ROWS = [
    ("F1", "C1", "P1", "2024-03-10", 100.0, "cuota", " cobrado"),
    ("F2", "C1", "P1", "2023-12-31", 50.0, "CUOTA", "COBRADO"),
    ("F3", "C1", "P1", "2023-12-30", 70.0, None, "COBRADO"),
    ("F4", "C1", "P1", "2024-04-01", 30.0, None, None),
    ("F5", "C9", "P1", "2024-04-01", 30.0, None, "COBRADO"),
    ("F6", "C1", "P1", "2024-04-01", None, None, "COBRADO"),
]


def movement(id_mov, client="C1", product="P1", day="2024-03-04", hour="10:00:00", value=10.0,
             channel="app_movil", account="A1"):
    return (id_mov, client, product, account, day, hour, value, "pago", channel, None, "APROBADO",
            None)


MOVEMENT_ROWS = [
    movement("M1"),
    movement("M1"),                                   # exact copy
    movement("M2", day="2099-01-01"),                 # rejected, and again with a good date
    movement("M2", day="2024-03-05"),
    movement("M3", day="2010-06-15"),                 # old but inside the limits
    movement("M4", client="C9"),
    movement("M5", product="P9"),
    movement("M6", value=None),
    movement("M7", day="xx"),
    movement("M8", client="C2", hour="22:00:00", channel=" ATM", account=None),
]


def frames(spark):
    rows = [(CUSTOMERS, CUSTOMER_ROWS), (PRODUCTS, PRODUCT_ROWS), (BRANCHES, BRANCH_ROWS),
            (LOANS, LOAN_ROWS), (MOVEMENTS, MOVEMENT_ROWS), (FEES, FEE_ROWS)]
    return {spec.name: spark.createDataFrame(data, spec.schema) for spec, data in rows}
