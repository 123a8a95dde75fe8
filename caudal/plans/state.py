"""Aggregates that gold keeps by month, so that a change recomputes the months it touches and no others.

* Income: a row per client and month, with sums and counts. Client value adds up twelve of them; of the first and last month
  of the trailing window, which it may cover in part, it reads the rows.
* Portfolio: a row per month of disbursement, KPI group and block of client numbers, with sums, counts and the set of the
  block's clients with overdue loans. Sums add up over months; sets are united, so a client with loans of several
  months counts once. Clients are numbered from 0 on when they first appear, and keep their numbers. A set is an array of
  at most BLOCK small integers; a bitmap has 4 KB also where a group has one client.

A month is recomputed as a whole from its partition. Keys that a month no longer has get rows of zeros.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.functions import rules
from caudal.functions.audit import with_date_parts
from caudal.functions.rules import money
from caudal.operators.attach import attach, skew_join
from caudal.operators.keyed import without_keys
from caudal.plans.gold import COLLECTED
from caudal.specs import INCOME_STATE, PORTFOLIO_STATE

BLOCK = 4096  # client numbers whose sets share a row
INTEREST = "decimal(38,8)"
GROUP = ("cod_prod", "tip_prod", "cod_segmento", "depto_res")


# Income ---------------------------------------------------------------------------------

def income_rows(fees: DataFrame, loans: DataFrame, movements: DataFrame, dim_products: DataFrame) -> DataFrame:
    """What each row adds to its client and day: id_cli, day, fees, interest, incomes, movements."""
    def part(df: DataFrame, day: str, fee, interest, incomes: int, moved: int) -> DataFrame:
        return df.select("id_cli", F.col(day).alias("day"), fee.cast("decimal(24,2)").alias("fees"),
                         interest.cast(INTEREST).alias("interest"), F.lit(incomes).cast("long").alias("incomes"),
                         F.lit(moved).cast("long").alias("movements"))

    none = F.lit(0)
    rate = F.col("tasa_mensual_pct").cast("decimal(9,4)")
    interest = money("sdo_capital") * rate * F.lit("0.01").cast("decimal(3,2)")
    priced = attach(loans, dim_products, "cod_prod", ["tasa_mensual_pct"])
    return (part(fees.filter(F.col("estado_cobro") == COLLECTED), "fec_cobro", money("vr_comision"), none, 1, 0)
            .unionByName(part(priced, "fec_desembolso", none, F.coalesce(interest, none.cast(INTEREST)), 1, 0))
            .unionByName(part(movements, "fec_mov", none, none, 0, 1)).filter("day IS NOT NULL"))


def income_state(rows: DataFrame) -> DataFrame:
    """Income rows summed up by client and month; one grouping, which combines on the map side."""
    out = rows.groupBy("id_cli", rules.period("day").alias("periodo")).agg(
        F.sum("fees").alias("fees"), F.sum("interest").alias("interest"),
        F.sum("incomes").alias("incomes"), F.sum("movements").alias("movements"))
    return with_date_parts(out.withColumn("_first", F.to_date(F.concat("periodo", F.lit("-01")))), "_first",
                           INCOME_STATE.partition_by).drop("_first")


def emptied_income(before: DataFrame, now: DataFrame) -> DataFrame:
    """Rows of zeros for clients that the recomputed months no longer have."""
    gone = without_keys(before, now, list(INCOME_STATE.keys))
    zero = {name: F.lit(0).cast(kind) for name, kind in now.dtypes if name in ("fees", "interest", "incomes", "movements")}
    return gone.withColumns(zero).select(*now.columns)


def whole_months(as_of: date, months: int = 12) -> tuple[list[str], list[str]]:
    """(periods that the trailing window covers, periods that it covers in part). Both are at most `months` + 1 long."""
    year, month = divmod(as_of.year * 12 + as_of.month - 1 - months, 12)
    last = (date(year + (month == 11), (month + 1) % 12 + 1, 1) - timedelta(days=1)).day
    first = date(year, month + 1, min(as_of.day, last))
    whole, partly = [], []
    for n in range(months + 1):
        y, m = divmod(first.year * 12 + first.month - 1 + n, 12)
        begin = date(y, m + 1, 1)
        end = date(y + (m == 11), (m + 1) % 12 + 1, 1) - timedelta(days=1)
        (whole if first <= begin and end <= as_of else partly).append(f"{begin:%Y-%m}")
    return whole, partly


def value_from_state(state: DataFrame, edge_rows: DataFrame, customers: DataFrame, as_of: date,
                     months: int = 12) -> DataFrame:
    """Client value from whole months of the state and the income rows of the months that are covered in part."""
    whole, partly = whole_months(as_of, months)
    edges = income_state(edge_rows.filter(rules.in_trailing_months("day", months, as_of)
                                          & rules.period("day").isin(partly)))
    columns = ["id_cli", "periodo", "fees", "interest", "incomes", "movements"]
    monthly = state.filter(F.col("periodo").isin(whole)).select(*columns).unionByName(edges.select(*columns))
    total = F.col("fees").cast("decimal(30,2)") + F.col("interest").cast(INTEREST)

    def rounded(column):
        return F.round(F.sum(column), 2).cast("double")

    value = monthly.groupBy("id_cli").agg(
        rounded(F.when(F.col("incomes") > 0, total)).alias("cltv_12m"), rounded("fees").alias("total_comisiones_12m"),
        rounded("interest").alias("total_intereses_12m"), F.sum("incomes").alias("_incomes"),
        F.count_if(F.col("movements") > 0).alias("meses_activo")).filter("_incomes > 0")
    value = attach(value, customers, "id_cli", ["cod_segmento", "estado_cli"])
    return value.select("id_cli", "cltv_12m", "total_comisiones_12m", "total_intereses_12m", "meses_activo",
                        "cod_segmento", "estado_cli", F.date_format(F.lit(as_of), "yyyy-MM").alias("periodo_calculo"))


# Portfolio ------------------------------------------------------------------------------

def new_clients(known: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Clients of the rows that have no number yet, sorted over the tasks. To be staged: each reading may sort
    them over the tasks in another way."""
    ids = rows.select("id_cli").filter("id_cli IS NOT NULL").distinct()
    if known is not None:
        ids = without_keys(ids, known, ["id_cli"])
    return (ids.repartitionByRange("id_cli").sortWithinPartitions("id_cli")
            .withColumn("_id", F.monotonically_increasing_id()))


def numbered_clients(known: DataFrame | None, placed: DataFrame) -> DataFrame:
    """(id_cli, number) of `new_clients`, numbered without gaps after the known ones.

    A number is the place in sorted order: the count of the tasks before, and the place in its own.
    """
    first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).head()[0] if known is not None else 0
    placed = placed.withColumn("_task", F.shiftright("_id", 33))
    counts = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_from"))
    # One row per task.
    before = counts.select("_task", "_from", (F.sum("_n").over(Window.orderBy("_task")) - F.col("_n")).alias("_before"))
    return placed.join(before, "_task").select(
        "id_cli", (F.lit(first) + F.col("_before") + F.col("_id") - F.col("_from")).cast("long").alias("number"))


def portfolio_state(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """The loan fact summed up by month of disbursement, KPI group and block of clients."""
    overdue = F.col("ind_en_mora") == 1
    rows = skew_join(fact, numbers, "id_cli", "left")
    return rows.groupBy(
        F.col("anio_desembolso").alias("_anio"), F.col("mes_desembolso").alias("_mes"), *GROUP,
        F.floor(F.col("number") / BLOCK).alias("bucket"),
    ).agg(
        F.count("id_oblig").alias("loans"), F.sum(money("sdo_capital")).alias("balance"),
        rules.sum_if(money("sdo_capital"), overdue).cast("decimal(34,2)").alias("overdue"),
        F.sum(money("provision_estimada")).alias("provision"),
        F.collect_set(F.when(overdue, F.pmod("number", F.lit(BLOCK)).cast("int"))).alias("clients"),
    )


def emptied_portfolio(before: DataFrame, now: DataFrame) -> DataFrame:
    """Rows of zeros for groups that the recomputed months no longer have."""
    gone = without_keys(before, now, list(PORTFOLIO_STATE.keys))
    zero = {name: F.lit(0).cast(kind) for name, kind in now.dtypes if name in ("loans", "balance", "overdue", "provision")}
    return gone.withColumns({**zero, "clients": F.array().cast("array<int>")}).select(*now.columns)


def kpis_from_state(state: DataFrame, as_of: date) -> DataFrame:
    """The daily KPIs: sums over months and blocks, and the distinct clients of their sets, in one grouping."""
    measures = ("loans", "balance", "overdue", "provision")
    sums = state.select(*GROUP, *measures, F.lit(None).cast("long").alias("client"))
    none = [F.lit(None).cast(kind).alias(name) for name, kind in sums.dtypes if name in measures]
    member = F.explode("clients").alias("_place")
    members = state.select(*GROUP, "bucket", member).select(
        *GROUP, *none, (F.col("bucket") * BLOCK + F.col("_place")).alias("client"))

    def amount(column: str):
        return F.round(F.sum(column), 2).cast("double")

    kpis = sums.unionByName(members).groupBy(F.lit(as_of).alias("fecha_calculo"), *GROUP).agg(
        F.sum("loans").alias("total_obligaciones_activas"), amount("balance").alias("monto_total_cartera"),
        amount("overdue").alias("monto_en_mora"), amount("provision").alias("provision_total_estimada"),
        F.countDistinct("client").alias("clientes_con_mora"),
    ).filter("total_obligaciones_activas > 0")
    kpis = kpis.withColumn("tasa_mora_pct", rules.safe_pct("monto_en_mora", "monto_total_cartera"))
    return with_date_parts(kpis, "fecha_calculo", ("anio_calculo", "mes_calculo"))
