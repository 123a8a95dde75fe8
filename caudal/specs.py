"""One declaration per source table: schema, keys, watermark and cleaning rules."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql.types import StructType

# Business limits for dates (fixed values).
DATE_MIN = date(2000, 1, 1)
DATE_MAX = date(2030, 12, 31)

# Reject reasons (fixed values).
MISSING_REQUIRED = "CAMPO_OBLIGATORIO_NULO"
UNKNOWN_CLIENT = "ID_CLI_NO_EXISTE_EN_DIMENSION"
UNKNOWN_PRODUCT = "COD_PROD_NO_EXISTE_EN_DIMENSION"
DATE_OUT_OF_RANGE = "FECHA_FUERA_DE_RANGO"
AMOUNT_OUT_OF_RANGE = "VALOR_FUERA_DE_RANGO"
# The column that names the missing row, of reasons that pass once that row exists.
REFERENCE_OF = {UNKNOWN_CLIENT: "id_cli", UNKNOWN_PRODUCT: "cod_prod"}


@dataclass(frozen=True)
class Batch:
    """Identity and clock of one run. Nothing in the library reads the wall clock for data."""

    batch_id: str
    as_of: date
    now: datetime


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    keys: tuple[str, ...]
    watermark: str | None = None
    required: tuple[str, ...] = ()
    casts: dict[str, str] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    pii: tuple[str, ...] = ()
    money: tuple[str, ...] = ()
    watched: tuple[str, ...] = ()  # attributes that facts copy: a change of one changes the facts of the row
    partition_date: str | None = None  # silver is partitioned by year and month of this date

    @property
    def silver_parts(self) -> tuple[str, ...]:
        return ("_anio", "_mes") if self.partition_date else ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return [part.split()[0] for part in self.ddl.split(", ")]


CUSTOMERS = TableSpec(
    name="TB_CLIENTES_CORE",
    ddl=("id_cli string, nomb_cli string, apell_cli string, tip_doc string, num_doc string, "
         "fec_nac string, fec_alta string, cod_segmento string, score_buro int, "
         "ciudad_res string, depto_res string, estado_cli string, canal_adquis string"),
    keys=("id_cli",),
    watermark="fec_alta",
    required=("id_cli", "tip_doc", "fec_alta", "cod_segmento", "depto_res", "estado_cli"),
    casts={"score_buro": "int"},
    dates=("fec_nac", "fec_alta"),
    upper=("cod_segmento", "estado_cli", "tip_doc"),
    defaults={"score_buro": 0, "ciudad_res": "DESCONOCIDO", "canal_adquis": "NO_INFORMADO"},
    pii=("nomb_cli", "apell_cli", "num_doc"),
    watched=("cod_segmento", "ciudad_res", "depto_res"),
)

PRODUCTS = TableSpec(
    name="TB_PRODUCTOS_CAT",
    ddl=("cod_prod string, desc_prod string, tip_prod string, tasa_ea double, "
         "plazo_max_meses int, cuota_min double, comision_admin double, estado_prod string"),
    keys=("cod_prod",),
    required=("cod_prod", "tip_prod"),
    casts={"tasa_ea": "double", "plazo_max_meses": "int", "cuota_min": "double",
           "comision_admin": "double"},
    upper=("tip_prod", "estado_prod"),
    defaults={"cuota_min": 0.0, "comision_admin": 0.0},
    watched=("desc_prod", "tip_prod", "tasa_ea"),
)

BRANCHES = TableSpec(
    name="TB_SUCURSALES_RED",
    ddl=("cod_suc string, nom_suc string, tip_punto string, ciudad string, depto string, "
         "latitud double, longitud double, activo int"),
    keys=("cod_suc",),
    required=("cod_suc", "ciudad"),
    casts={"latitud": "double", "longitud": "double", "activo": "int"},
    upper=("ciudad", "depto", "tip_punto"),
    defaults={"activo": 0},
)

LOANS = TableSpec(
    name="TB_OBLIGACIONES",
    ddl=("id_oblig string, id_cli string, cod_prod string, vr_aprobado double, "
         "vr_desembolsado double, sdo_capital double, vr_cuota double, fec_desembolso string, "
         "fec_venc string, dias_mora_act int, num_cuotas_pend int, calif_riesgo string"),
    keys=("id_oblig",),
    watermark="fec_desembolso",
    required=("id_oblig", "id_cli", "cod_prod", "vr_desembolsado"),
    casts={"vr_aprobado": "double", "vr_desembolsado": "double", "sdo_capital": "double",
           "vr_cuota": "double", "dias_mora_act": "int"},
    dates=("fec_desembolso", "fec_venc"),
    defaults={"num_cuotas_pend": 0, "calif_riesgo": "A"},
    money=("vr_aprobado", "vr_desembolsado", "sdo_capital", "vr_cuota"),
    partition_date="fec_desembolso",
)

MOVEMENTS = TableSpec(
    name="TB_MOV_FINANCIEROS",
    ddl=("id_mov string, id_cli string, cod_prod string, num_cuenta string, fec_mov string, "
         "hra_mov string, vr_mov double, tip_mov string, cod_canal string, cod_ciudad string, "
         "cod_estado_mov string, id_dispositivo string"),
    keys=("id_mov",),
    watermark="fec_mov",
    required=("id_mov", "id_cli", "vr_mov", "fec_mov"),
    casts={"vr_mov": "double"},
    dates=("fec_mov",),
    upper=("cod_canal", "tip_mov"),
    defaults={"num_cuenta": "DESCONOCIDO", "cod_ciudad": "DESCONOCIDO",
              "id_dispositivo": "DESCONOCIDO"},
    money=("vr_mov",),
    partition_date="fec_mov",
)

FEES = TableSpec(
    name="TB_COMISIONES_LOG",
    ddl=("id_comision string, id_cli string, cod_prod string, fec_cobro string, "
         "vr_comision double, tip_comision string, estado_cobro string"),
    keys=("id_comision",),
    watermark="fec_cobro",
    required=("id_comision", "id_cli", "vr_comision"),
    casts={"vr_comision": "double"},
    dates=("fec_cobro",),
    defaults={"tip_comision": "NO_INFORMADO", "estado_cobro": "PENDIENTE"},
    upper=("tip_comision", "estado_cobro"),
    money=("vr_comision",),
    partition_date="fec_cobro",
)

SOURCE_TABLES = (CUSTOMERS, PRODUCTS, BRANCHES, LOANS, MOVEMENTS, FEES)


@dataclass(frozen=True)
class GoldSpec:
    name: str
    keys: tuple[str, ...]
    partition_by: tuple[str, ...] = ()


DIM_CUSTOMERS = GoldSpec("dim_clientes", ("id_cli",))
DIM_PRODUCTS = GoldSpec("dim_productos", ("cod_prod",))
DIM_GEOGRAPHY = GoldSpec("dim_geografia", ("id_geo",))
# A code can be both a physical point and a digital channel, so the code alone is no key.
DIM_CHANNELS = GoldSpec("dim_canal", ("cod_canal", "tipo_canal"))
FACT_TRANSACTIONS = GoldSpec("fact_transacciones", ("id_mov",), ("anio_mov", "mes_mov"))
FACT_PORTFOLIO = GoldSpec("fact_cartera", ("id_oblig",), ("anio_desembolso", "mes_desembolso"))
CLIENT_VALUE = GoldSpec("fact_rentabilidad_cliente", ("id_cli",))
DAILY_KPIS = GoldSpec(
    "kpis_diarios_cartera",
    ("fecha_calculo", "cod_prod", "tip_prod", "cod_segmento", "depto_res"),
    ("anio_calculo", "mes_calculo"),
)
# What gold keeps beside its tables, so that a change of some months leaves the others unread.
INCOME_STATE = GoldSpec("_state/ingresos", ("id_cli", "periodo"), ("_anio", "_mes"))
PORTFOLIO_STATE = GoldSpec(
    "_state/cartera",
    ("_anio", "_mes", "cod_prod", "tip_prod", "cod_segmento", "depto_res", "bucket"), ("_anio", "_mes"))
CLIENT_NUMBERS = GoldSpec("_state/clientes", ("id_cli",))
STATE_TABLES = (INCOME_STATE, PORTFOLIO_STATE, CLIENT_NUMBERS)
GOLD_TABLES = (DIM_CUSTOMERS, DIM_PRODUCTS, DIM_GEOGRAPHY, DIM_CHANNELS, FACT_TRANSACTIONS,
               FACT_PORTFOLIO, CLIENT_VALUE, DAILY_KPIS)
