"""DuckDB SQL for the catalog, written independently of the Spark code.

`PARTS` holds the raw, silver and gold tables as common table expressions; each query names
the ones it needs.
"""

from __future__ import annotations

PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def _part(name: str, needs: tuple[str, ...], sql: str) -> None:
    PARTS[name] = (needs, sql)


def _with(needs: tuple[str, ...], final: str) -> str:
    """The final SELECT, preceded by the parts it needs in order of dependence."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in PARTS[name][0]:
                visit(other)
            ordered.append(name)

    for name in needs:
        visit(name)
    parts = ",\n".join(f"{name} AS ({PARTS[name][1].strip()})" for name in ordered)
    return f"WITH {parts}\n{final.strip()}" if parts else final.strip()


# --- raw tables ---------------------------------------------------------------------------

_part("places", (), """
    SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
""")

_part("raw_customers", ("places",), """
    SELECT CAST(c_custkey AS VARCHAR) AS id_cli, c_name AS nomb_cli, n_name AS apell_cli,
        CASE r_name WHEN 'AFRICA' THEN ' cc' WHEN 'AMERICA' THEN 'ce ' WHEN 'ASIA' THEN 'nit'
            WHEN 'EUROPE' THEN 'PP' ELSE 'cc' END AS tip_doc,
        'D' || CAST(c_custkey AS VARCHAR) AS num_doc,
        CASE WHEN n_name <> 'NATION_7' THEN CAST(
            DATE '2000-01-01' + CAST(floor(c_acctbal / 2) AS INTEGER) AS VARCHAR) END AS fec_nac,
        CAST(DATE '2024-01-01' + c_nationkey AS VARCHAR) AS fec_alta,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN ' basico' WHEN 'BUILDING' THEN 'estandar '
            WHEN 'FURNITURE' THEN 'Premium' WHEN 'HOUSEHOLD' THEN 'ELITE' END AS cod_segmento,
        CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 10) AS INTEGER) END AS score_buro,
        nullif(n_name, 'NATION_3') AS ciudad_res,
        r_name AS depto_res,
        CASE r_name WHEN 'AFRICA' THEN 'activo' WHEN 'AMERICA' THEN 'ACTIVO '
            WHEN 'ASIA' THEN 'inactivo' WHEN 'EUROPE' THEN ' bloqueado' ELSE 'activo'
            END AS estado_cli,
        CASE WHEN r_name <> 'ASIA' THEN 'WEB' END AS canal_adquis
    FROM customer JOIN places ON c_nationkey = n_nationkey
""")

_part("raw_products", (), """
    SELECT CAST(p_partkey AS VARCHAR) AS cod_prod, p_name AS desc_prod,
        CASE p_type WHEN 'ECONOMY' THEN 'credito ' WHEN 'STANDARD' THEN 'CREDITO'
            WHEN 'SMALL' THEN ' ahorro' WHEN 'MEDIUM' THEN 'ahorro'
            WHEN 'LARGE' THEN 'Transaccional' END AS tip_prod,
        CAST(p_size AS DOUBLE) * CAST(0.72 AS DOUBLE) AS tasa_ea,
        p_size AS plazo_max_meses,
        CASE WHEN p_size > 10 THEN p_retailprice END AS cuota_min,
        p_retailprice AS comision_admin,
        CASE WHEN p_size <= 40 THEN 'activo ' ELSE 'descontinuado' END AS estado_prod
    FROM part
""")

_part("raw_branches", ("places",), """
    SELECT CAST(s_suppkey AS VARCHAR) AS cod_suc, s_name AS nom_suc,
        CASE r_name WHEN 'AFRICA' THEN 'sucursal' WHEN 'AMERICA' THEN ' corresponsal'
            WHEN 'ASIA' THEN 'atm ' WHEN 'EUROPE' THEN 'Punto_Pago' ELSE 'sucursal'
            END AS tip_punto,
        lower(nullif(n_name, 'NATION_5')) AS ciudad, lower(r_name) AS depto,
        s_acctbal / 1000 AS latitud, s_acctbal / -500 AS longitud,
        CASE WHEN s_acctbal > 0 THEN 1 END AS activo
    FROM supplier JOIN places ON s_nationkey = n_nationkey
""")

_part("raw_movements", (), """
    SELECT CAST(event_id AS VARCHAR) AS id_mov, CAST(user_id AS VARCHAR) AS id_cli,
        props ->> '$.k' AS cod_prod,
        CASE WHEN event_type <> 'error' THEN 'CTA' || user_id END AS num_cuenta,
        fec_mov, strftime(ts, '%H:%M:%S') AS hra_mov,
        CASE WHEN value >= 1 THEN value END AS vr_mov,
        ' ' || event_type AS tip_mov,
        CASE event_type WHEN 'view' THEN 'app_movil' WHEN 'click' THEN 'portal_web '
            WHEN 'purchase' THEN 'corresponsal' WHEN 'signup' THEN 'atm'
            WHEN 'error' THEN ' banca_telefonica' END AS cod_canal,
        CASE WHEN event_type <> 'view' THEN 'C' || user_id END AS cod_ciudad,
        'APROBADO' AS cod_estado_mov,
        CASE WHEN event_type <> 'click' THEN 'DEV' || user_id END AS id_dispositivo
    FROM (
        SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS fec_mov FROM events
        UNION ALL
        SELECT *, CASE WHEN value > 100 THEN '2099-01-01'
            ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END
        FROM events WHERE event_type = 'purchase'
    )
""")

_part("lines", (), """
    SELECT *, CAST(l_shipdate AS DATE) AS shipped, CAST(o_orderdate AS DATE) AS ordered,
        CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INTEGER) AS days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")

_part("raw_loans", ("lines",), """
    SELECT l_orderkey || '-' || l_linenumber AS id_oblig,
        CAST(o_custkey AS VARCHAR) AS id_cli, CAST(l_partkey AS VARCHAR) AS cod_prod,
        o_totalprice AS vr_aprobado, l_extendedprice AS vr_desembolsado,
        l_extendedprice AS sdo_capital, l_quantity AS vr_cuota,
        CAST(ordered AS VARCHAR) AS fec_desembolso, CAST(shipped AS VARCHAR) AS fec_venc,
        days AS dias_mora_act, nullif(l_linenumber, 7) AS num_cuotas_pend,
        nullif(l_returnflag, 'N') AS calif_riesgo
    FROM lines
""")

_part("raw_fees", ("lines",), """
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
            AS id_comision,
        CAST(o_custkey AS VARCHAR) AS id_cli, CAST(l_partkey AS VARCHAR) AS cod_prod,
        CAST(shipped AS VARCHAR) AS fec_cobro,
        CASE WHEN l_tax > 0 THEN CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
            * CAST(l_tax AS DECIMAL(4,2)), 2) AS DOUBLE) END AS vr_comision,
        CASE WHEN l_returnflag <> 'N' THEN 'tipo_' || lower(l_returnflag) END AS tip_comision,
        CASE l_linestatus WHEN 'F' THEN ' cobrado' END AS estado_cobro
    FROM lines
""")

# --- silver -------------------------------------------------------------------------------

_part("t_customers", ("raw_customers",), """
    SELECT id_cli, sha256(nomb_cli) AS nomb_cli, sha256(apell_cli) AS apell_cli,
        upper(trim(tip_doc)) AS tip_doc, sha256(num_doc) AS num_doc,
        CAST(fec_nac AS DATE) AS fec_nac, CAST(fec_alta AS DATE) AS fec_alta,
        upper(trim(cod_segmento)) AS cod_segmento, coalesce(score_buro, 0) AS score_buro,
        coalesce(ciudad_res, 'DESCONOCIDO') AS ciudad_res, depto_res,
        upper(trim(estado_cli)) AS estado_cli,
        coalesce(canal_adquis, 'NO_INFORMADO') AS canal_adquis,
        CASE WHEN cod_segmento IS NULL THEN 'CAMPO_OBLIGATORIO_NULO'
            WHEN CAST(fec_nac AS DATE) < DATE '2000-01-01'
              OR CAST(fec_nac AS DATE) > DATE '2030-12-31' THEN 'FECHA_FUERA_DE_RANGO'
            END AS _reason
    FROM raw_customers
""")
_part("s_customers", ("t_customers",), "SELECT * EXCLUDE (_reason) FROM t_customers WHERE _reason IS NULL")

_part("t_products", ("raw_products",), """
    SELECT cod_prod, desc_prod, upper(trim(tip_prod)) AS tip_prod, tasa_ea, plazo_max_meses,
        coalesce(cuota_min, 0.0) AS cuota_min, comision_admin,
        upper(trim(estado_prod)) AS estado_prod,
        CASE WHEN tip_prod IS NULL THEN 'CAMPO_OBLIGATORIO_NULO' END AS _reason
    FROM raw_products
""")
_part("s_products", ("t_products",), "SELECT * EXCLUDE (_reason) FROM t_products WHERE _reason IS NULL")

_part("t_branches", ("raw_branches",), """
    SELECT cod_suc, nom_suc, upper(trim(tip_punto)) AS tip_punto, upper(trim(ciudad)) AS ciudad,
        upper(trim(depto)) AS depto, latitud, longitud, coalesce(activo, 0) AS activo,
        CASE WHEN ciudad IS NULL THEN 'CAMPO_OBLIGATORIO_NULO' END AS _reason
    FROM raw_branches
""")
_part("s_branches", ("t_branches",), "SELECT * EXCLUDE (_reason) FROM t_branches WHERE _reason IS NULL")

_part("t_loans", ("raw_loans", "s_customers", "s_products"), """
    SELECT id_oblig, id_cli, cod_prod, vr_aprobado, vr_desembolsado, sdo_capital, vr_cuota,
        CAST(fec_desembolso AS DATE) AS fec_desembolso, CAST(fec_venc AS DATE) AS fec_venc,
        CASE WHEN dias_mora_act < 0 THEN 0 ELSE dias_mora_act END AS dias_mora_act,
        coalesce(num_cuotas_pend, 0) AS num_cuotas_pend,
        coalesce(calif_riesgo, 'A') AS calif_riesgo,
        CASE WHEN id_cli NOT IN (SELECT id_cli FROM s_customers)
                THEN 'ID_CLI_NO_EXISTE_EN_DIMENSION'
            WHEN cod_prod NOT IN (SELECT cod_prod FROM s_products)
                THEN 'COD_PROD_NO_EXISTE_EN_DIMENSION' END AS _reason
    FROM raw_loans
    QUALIFY row_number() OVER (PARTITION BY id_oblig ORDER BY fec_desembolso DESC NULLS LAST,
        id_oblig NULLS FIRST, id_cli NULLS FIRST, cod_prod NULLS FIRST, vr_aprobado NULLS FIRST,
        vr_desembolsado NULLS FIRST, sdo_capital NULLS FIRST, vr_cuota NULLS FIRST,
        raw_loans.fec_desembolso NULLS FIRST, raw_loans.fec_venc NULLS FIRST,
        raw_loans.dias_mora_act NULLS FIRST, raw_loans.num_cuotas_pend NULLS FIRST,
        raw_loans.calif_riesgo NULLS FIRST) = 1
""")
_part("s_loans", ("t_loans",), "SELECT * EXCLUDE (_reason) FROM t_loans WHERE _reason IS NULL")

_part("m_tagged", ("raw_movements", "s_customers", "s_products"), """
    SELECT *, CASE WHEN vr_mov IS NULL THEN 'CAMPO_OBLIGATORIO_NULO'
            WHEN id_cli NOT IN (SELECT id_cli FROM s_customers)
                THEN 'ID_CLI_NO_EXISTE_EN_DIMENSION'
            WHEN cod_prod IS NULL OR cod_prod NOT IN (SELECT cod_prod FROM s_products)
                THEN 'COD_PROD_NO_EXISTE_EN_DIMENSION'
            WHEN CAST(fec_mov AS DATE) > DATE '2030-12-31'
              OR CAST(fec_mov AS DATE) < DATE '2000-01-01' THEN 'FECHA_FUERA_DE_RANGO'
            END AS _reason
    FROM raw_movements
""")
_part("m_kept", ("m_tagged",), """
    SELECT DISTINCT * FROM m_tagged WHERE _reason IS NOT NULL
    UNION ALL
    SELECT * FROM (SELECT * FROM m_tagged WHERE _reason IS NULL
        QUALIFY row_number() OVER (PARTITION BY id_mov ORDER BY fec_mov DESC) = 1)
""")
_part("m_stats", ("m_kept",), """
    SELECT id_mov, avg(vr_mov * 100) OVER w AS mean, stddev_samp(vr_mov * 100) OVER w AS sd
    FROM (SELECT id_mov, id_cli, CAST(fec_mov AS DATE) AS day,
                 round(vr_mov * 100) / 100 AS vr_mov FROM m_kept WHERE _reason IS NULL)
    WINDOW w AS (PARTITION BY id_cli ORDER BY day
        RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)
""")
_part("m_rejected_stats", ("m_kept",), """
    SELECT r.id_cli, r.day, avg(v.vr_mov * 100) AS mean, stddev_samp(v.vr_mov * 100) AS sd
    FROM (SELECT DISTINCT id_cli, CAST(fec_mov AS DATE) AS day FROM m_kept
          WHERE _reason IS NOT NULL) r
    JOIN (SELECT DISTINCT id_cli, CAST(fec_mov AS DATE) AS day FROM m_kept
          WHERE _reason IS NULL) d ON d.id_cli = r.id_cli AND d.day = r.day
    JOIN (SELECT id_cli, CAST(fec_mov AS DATE) AS day, vr_mov FROM m_kept
          WHERE _reason IS NULL) v
      ON v.id_cli = r.id_cli AND v.day BETWEEN r.day - 30 AND r.day - 1
    GROUP BY r.id_cli, r.day
""")
_part("t_movements", ("m_kept", "m_stats", "m_rejected_stats"), """
    SELECT k.id_mov, k.id_cli, cod_prod, coalesce(num_cuenta, 'DESCONOCIDO') AS num_cuenta,
        CAST(fec_mov AS DATE) AS fec_mov, hra_mov, vr_mov, upper(trim(tip_mov)) AS tip_mov,
        upper(trim(cod_canal)) AS cod_canal, coalesce(cod_ciudad, 'DESCONOCIDO') AS cod_ciudad,
        cod_estado_mov, coalesce(id_dispositivo, 'DESCONOCIDO') AS id_dispositivo,
        CASE WHEN _reason IS NULL AND vr_mov * 100 > s.mean + 3 * s.sd THEN 1
             WHEN _reason IS NOT NULL AND vr_mov * 100 > r.mean + 3 * r.sd THEN 1
             ELSE 0 END AS ind_sospechoso,
        CASE WHEN dayofweek(CAST(fec_mov AS DATE)) BETWEEN 1 AND 5
              AND CAST(substr(hra_mov, 1, 2) AS INTEGER) BETWEEN 6 AND 19 THEN 1 ELSE 0
              END AS ind_horario_habil,
        _reason
    FROM m_kept k
    LEFT JOIN m_stats s ON k._reason IS NULL AND s.id_mov = k.id_mov
    LEFT JOIN m_rejected_stats r ON k._reason IS NOT NULL AND r.id_cli = k.id_cli
        AND r.day = CAST(k.fec_mov AS DATE)
""")
_part("s_movements", ("t_movements",), "SELECT * EXCLUDE (_reason) FROM t_movements WHERE _reason IS NULL")

_part("t_fees", ("raw_fees", "s_customers", "s_products"), """
    SELECT id_comision, id_cli, cod_prod, CAST(fec_cobro AS DATE) AS fec_cobro, vr_comision,
        upper(trim(coalesce(tip_comision, 'NO_INFORMADO'))) AS tip_comision,
        upper(trim(coalesce(estado_cobro, 'PENDIENTE'))) AS estado_cobro,
        CASE WHEN vr_comision IS NULL THEN 'CAMPO_OBLIGATORIO_NULO'
            WHEN id_cli NOT IN (SELECT id_cli FROM s_customers)
                THEN 'ID_CLI_NO_EXISTE_EN_DIMENSION'
            WHEN cod_prod NOT IN (SELECT cod_prod FROM s_products)
                THEN 'COD_PROD_NO_EXISTE_EN_DIMENSION' END AS _reason
    FROM raw_fees
    QUALIFY row_number() OVER (PARTITION BY id_comision ORDER BY raw_fees.fec_cobro DESC,
        id_cli, cod_prod, raw_fees.fec_cobro, vr_comision NULLS FIRST,
        raw_fees.tip_comision NULLS FIRST, raw_fees.estado_cobro NULLS FIRST) = 1
""")
_part("s_fees", ("t_fees",), "SELECT * EXCLUDE (_reason) FROM t_fees WHERE _reason IS NULL")

# --- gold ---------------------------------------------------------------------------------

_SEGMENT = """CASE cod_segmento WHEN 'BASICO' THEN 'Básico (< 2 SMLV)'
            WHEN 'ESTANDAR' THEN 'Estándar (2-5 SMLV)' WHEN 'PREMIUM' THEN 'Premium (5-15 SMLV)'
            WHEN 'ELITE' THEN 'Elite (> 15 SMLV)' END"""


def _bucket(days: str, names: tuple[str, ...]) -> str:
    first, second, third, fourth, fifth = names
    return (f"CASE WHEN {days} > 90 THEN {fifth} WHEN {days} > 60 THEN {fourth} "
            f"WHEN {days} > 30 THEN {third} WHEN {days} > 0 THEN {second} ELSE {first} END")


def _buckets(days: str) -> str:
    return _bucket(days, ("'AL_DIA'", "'RANGO_1'", "'RANGO_2'", "'RANGO_3'", "'DETERIORADO'"))


def _grades(days: str) -> str:
    return _bucket(days, ("'A'", "'B'", "'C'", "'D'", "'E'"))


def _provision(balance: str, days: str) -> str:
    share = _bucket(days, ("0.01", "0.03", "0.20", "0.50", "1.00"))
    return (f"CAST(round(CAST({balance} AS DECIMAL(18,2)) * CAST({share} AS DECIMAL(3,2)), 2) "
            "AS DOUBLE)")


_part("dim_customers", ("s_customers",), f"""
    SELECT id_cli, nomb_cli || ' ' || apell_cli AS nombre_completo, nomb_cli AS nombre_hash,
        apell_cli AS apellido_hash, num_doc AS num_doc_hash, tip_doc, fec_nac,
        CAST(floor((DATE '2024-12-31' - fec_nac) / 365.25) AS INTEGER) AS edad, fec_alta,
        cod_segmento, {_SEGMENT} AS segmento_label, score_buro, ciudad_res, depto_res,
        estado_cli, CASE WHEN estado_cli = 'ACTIVO' THEN 1 ELSE 0 END AS ind_activo,
        canal_adquis
    FROM s_customers
""")

_part("dim_products", ("s_products",), """
    SELECT cod_prod, desc_prod, desc_prod AS desc_negocio, tip_prod, tip_prod AS familia, tasa_ea,
        round((pow(1 + tasa_ea / 100.0, CAST(1 AS DOUBLE) / 12) - 1) * 100, 4)
            AS tasa_mensual_pct,
        plazo_max_meses, cuota_min, comision_admin, estado_prod,
        CASE WHEN estado_prod = 'ACTIVO' THEN 1 ELSE 0 END AS ind_activo
    FROM s_products
""")

_part("dim_geography", ("s_branches",), """
    SELECT ciudad, depto,
        CAST(sum(CAST(latitud AS DECIMAL(18,8))) AS DOUBLE) / count(latitud) AS latitud_ref,
        CAST(sum(CAST(longitud AS DECIMAL(18,8))) AS DOUBLE) / count(longitud) AS longitud_ref,
        count(*) AS n_puntos, md5(ciudad || '_' || depto) AS id_geo
    FROM s_branches GROUP BY ciudad, depto
""")

_part("dim_channels", ("s_branches", "s_movements"), """
    SELECT cod_canal, tipo_canal, md5(cod_canal || '_' || tipo_canal) AS id_canal,
        CASE cod_canal WHEN 'APP_MOVIL' THEN 'Aplicación Móvil' WHEN 'PORTAL_WEB' THEN 'Portal Web'
            WHEN 'CORRESPONSAL' THEN 'Corresponsal Bancario' WHEN 'ATM' THEN 'Cajero Automático'
            WHEN 'BANCA_TELEFONICA' THEN 'Banca Telefónica' WHEN 'SUCURSAL' THEN 'Sucursal Física'
            ELSE cod_canal END AS desc_canal
    FROM (SELECT tip_punto AS cod_canal, 'FISICO' AS tipo_canal FROM s_branches
          UNION SELECT cod_canal, 'DIGITAL' FROM s_movements)
""")

_part("transactions", ("s_movements", "s_customers", "dim_products"), """
    SELECT id_mov, m.id_cli, m.cod_prod, num_cuenta, fec_mov, hra_mov,
        strftime(fec_mov, '%Y') AS anio_mov, strftime(fec_mov, '%m') AS mes_mov, vr_mov,
        round(vr_mov * (CAST(1 AS DOUBLE) / 4100), 4) AS vr_mov_usd, tip_mov, cod_canal,
        cod_ciudad, cod_estado_mov, id_dispositivo, cod_segmento,
        familia AS familia_producto, ind_sospechoso, ind_horario_habil
    FROM s_movements m JOIN s_customers c ON m.id_cli = c.id_cli
    LEFT JOIN dim_products p ON m.cod_prod = p.cod_prod
""")

_part("portfolio", ("s_loans", "s_customers", "dim_products"), f"""
    SELECT id_oblig, l.id_cli, l.cod_prod, vr_aprobado, vr_desembolsado, sdo_capital, vr_cuota,
        fec_desembolso, fec_venc, strftime(fec_desembolso, '%Y') AS anio_desembolso,
        strftime(fec_desembolso, '%m') AS mes_desembolso, dias_mora_act,
        {_buckets('dias_mora_act')} AS bucket_mora,
        {_bucket('dias_mora_act', ('0', '1', '2', '3', '4'))} AS bucket_mora_orden,
        num_cuotas_pend, {_grades('dias_mora_act')} AS clasificacion_regulatoria,
        {_provision('sdo_capital', 'dias_mora_act')} AS provision_estimada,
        CASE WHEN dias_mora_act > 0 THEN 1 ELSE 0 END AS ind_en_mora,
        cod_segmento, ciudad_res, depto_res, desc_prod, tip_prod
    FROM s_loans l LEFT JOIN s_customers c ON l.id_cli = c.id_cli
    LEFT JOIN dim_products p ON l.cod_prod = p.cod_prod
""")

_part("fees_12m", ("s_fees",), """
    SELECT id_cli, strftime(fec_cobro, '%Y-%m') AS periodo,
        sum(CAST(vr_comision AS DECIMAL(18,2))) AS total_comisiones
    FROM s_fees WHERE estado_cobro = 'COBRADO' AND fec_cobro BETWEEN DATE '2000-08-01' AND DATE '2001-08-01'
    GROUP BY ALL
""")
_part("interest_12m", ("s_loans", "dim_products"), """
    SELECT id_cli, strftime(fec_desembolso, '%Y-%m') AS periodo,
        sum(CAST(sdo_capital AS DECIMAL(18,2)) * CAST(tasa_mensual_pct AS DECIMAL(9,4))
            * CAST(0.01 AS DECIMAL(3,2))) AS ingreso_intereses_est
    FROM s_loans l LEFT JOIN dim_products p ON l.cod_prod = p.cod_prod
    WHERE fec_desembolso BETWEEN DATE '2000-08-01' AND DATE '2001-08-01' GROUP BY ALL
""")
_part("income", ("fees_12m", "interest_12m"), """
    SELECT coalesce(f.id_cli, i.id_cli) AS id_cli, coalesce(f.periodo, i.periodo) AS periodo,
        coalesce(total_comisiones, 0) AS total_comisiones,
        coalesce(ingreso_intereses_est, 0) AS ingreso_intereses_est,
        coalesce(total_comisiones, 0) + coalesce(ingreso_intereses_est, 0) AS ingreso_total_mes
    FROM fees_12m f FULL OUTER JOIN interest_12m i
      ON f.id_cli = i.id_cli AND f.periodo = i.periodo
""")
_part("value_12m", ("income", "s_movements", "s_customers"), """
    SELECT v.id_cli, cltv_12m, total_comisiones_12m, total_intereses_12m,
        coalesce(meses_activo, 0) AS meses_activo, cod_segmento, estado_cli,
        '2001-08' AS periodo_calculo
    FROM (SELECT id_cli, CAST(round(sum(ingreso_total_mes), 2) AS DOUBLE) AS cltv_12m,
              CAST(round(sum(total_comisiones), 2) AS DOUBLE) AS total_comisiones_12m,
              CAST(round(sum(ingreso_intereses_est), 2) AS DOUBLE) AS total_intereses_12m
          FROM income GROUP BY id_cli) v
    LEFT JOIN (SELECT id_cli, count(DISTINCT strftime(fec_mov, '%Y-%m')) AS meses_activo
               FROM s_movements WHERE fec_mov BETWEEN DATE '2000-08-01' AND DATE '2001-08-01' GROUP BY id_cli) m
      ON m.id_cli = v.id_cli
    LEFT JOIN s_customers c ON c.id_cli = v.id_cli
""")
_part("kpis", ("portfolio",), """
    SELECT *, CASE WHEN monto_total_cartera > 0
            THEN round(monto_en_mora / monto_total_cartera * 100, 4) ELSE 0.0 END AS tasa_mora_pct,
        '2001' AS anio_calculo, '08' AS mes_calculo
    FROM (SELECT DATE '2001-08-01' AS fecha_calculo, cod_prod, tip_prod, cod_segmento, depto_res,
        count(id_oblig) AS total_obligaciones_activas,
        CAST(sum(CAST(sdo_capital AS DECIMAL(18,2))) AS DOUBLE) AS monto_total_cartera,
        CAST(sum(CASE WHEN ind_en_mora = 1 THEN CAST(sdo_capital AS DECIMAL(18,2)) ELSE 0 END)
            AS DOUBLE) AS monto_en_mora,
        CAST(sum(CAST(provision_estimada AS DECIMAL(18,2))) AS DOUBLE) AS provision_total_estimada,
        count(DISTINCT CASE WHEN ind_en_mora = 1 THEN id_cli END) AS clientes_con_mora
    FROM portfolio GROUP BY ALL)
""")

_part("ingestion_log", (), """
    SELECT strftime(o_orderdate, '%Y%m') AS batch_id, o_orderpriority AS table_name,
        count(*) AS n_records,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'FAILED' ELSE 'SUCCESS' END AS status
    FROM orders GROUP BY ALL
""")
_part("totals", ("ingestion_log",), """
    SELECT batch_id, CAST(sum(n_records) AS BIGINT) AS total_records FROM ingestion_log
    WHERE status = 'SUCCESS' GROUP BY batch_id
""")
_part("last7", ("totals",), """
    SELECT * FROM totals WHERE batch_id < '200107' ORDER BY batch_id DESC LIMIT 7
""")
_part("anomaly", ("last7", "totals"), """
    SELECT '200107' AS batch_id, pct > 30 AS anomaly_detected, current,
        CASE WHEN runs >= 3 THEN round(mean, 0) ELSE 0.0 END AS avg_7d, round(pct, 2) AS pct_diff
    FROM (SELECT *, CASE WHEN runs >= 3 AND mean > 0 THEN abs(current - mean) / mean * 100
                    ELSE 0.0 END AS pct
          FROM (SELECT avg(total_records) AS mean, count(*) AS runs,
                    coalesce((SELECT total_records FROM totals WHERE batch_id = '200107'), 0)
                        AS current FROM last7))
""")

_part("layer_counts", ("raw_loans", "s_loans", "portfolio"), """
    SELECT strftime(CAST(fec_desembolso AS DATE), '%Y%m') AS batch_id, 'bronze' AS layer,
        'TB_OBLIGACIONES' AS table_name, count(*) AS records, 'SUCCESS' AS status
    FROM raw_loans GROUP BY ALL
    UNION ALL
    SELECT strftime(fec_desembolso, '%Y%m'), 'silver', 'TB_OBLIGACIONES', count(*), 'SUCCESS'
    FROM s_loans GROUP BY ALL
    UNION ALL
    SELECT strftime(fec_desembolso, '%Y%m'), 'gold', 'fact_cartera', count(*), 'SUCCESS'
    FROM portfolio GROUP BY ALL
""")


def _check(name: str, table: str, layer: str, bad: str, what: str, details: str,
           source: str) -> str:
    """A check row from a one-row source with the counts."""
    return f"""
    SELECT '{name}' AS check_name, '{table}' AS table_name, '{layer}' AS layer,
        {bad} = 0 AS passed,
        CASE WHEN {bad} = 0 THEN 'PASSED' ELSE CAST({bad} AS VARCHAR) || ' {what}' END AS message,
        CAST({details} AS VARCHAR) AS details
    FROM ({source})"""


def _bounds(name: str, table: str, layer: str, column: str, low: str, high: str,
            source: str) -> str:
    return _check(
        name, table, layer, "(missing + below + above)", f"rows with {column} out of bounds",
        "json_object('missing', missing, 'below', below, 'above', above)",
        f"SELECT count(*) FILTER ({column} IS NULL) AS missing, "
        f"count(*) FILTER ({column} < {low}) AS below, "
        f"count(*) FILTER ({column} > {high}) AS above FROM {source}")


def _unique(name: str, table: str, layer: str, keys: tuple[str, ...], source: str) -> str:
    columns = ", ".join(keys)
    return _check(
        name, table, layer, "duplicates", f"duplicates of {columns}",
        "json_object('total', total, 'distinct', d, 'duplicates', duplicates)",
        "SELECT total, d, total - d AS duplicates FROM (SELECT count(*) AS total, "
        f"count(DISTINCT ({columns})) AS d FROM {source})")


def _not_null(name: str, table: str, layer: str, key: str, source: str) -> str:
    return _check(name, table, layer, "null_count", f"rows without {key}",
                  "json_object('null_count', null_count)",
                  f"SELECT count(*) FILTER ({key} IS NULL) AS null_count FROM {source}")


def _in_set(name: str, table: str, layer: str, column: str, values: str, source: str) -> str:
    invalid = f"SELECT {column} AS v FROM {source} WHERE {column} IS NULL OR {column} NOT IN ({values})"
    return _check(
        name, table, layer, "invalid_count", f"rows with an invalid {column}",
        "json_object('invalid_count', invalid_count, 'sample', sample)",
        f"SELECT (SELECT count(*) FROM ({invalid})) AS invalid_count, coalesce((SELECT "
        f"list(v ORDER BY v) FROM (SELECT DISTINCT coalesce(v, 'NULL') AS v FROM ({invalid}) "
        "ORDER BY 1 LIMIT 5)), []) AS sample")


def _binary(name: str, table: str, layer: str, column: str, source: str) -> str:
    return _check(
        name, table, layer, "invalid", f"rows with {column} not 0 or 1",
        "json_object('invalid', invalid, 'ones', ones, 'pct_ones', pct_ones)",
        f"SELECT invalid, ones, round(ones / total * 100, 4) AS pct_ones FROM (SELECT "
        f"count(*) AS total, count(*) FILTER ({column} NOT IN (0, 1) OR {column} IS NULL) "
        f"AS invalid, count(*) FILTER ({column} = 1) AS ones FROM {source})")


def _row_counts(name: str, layer: str, tables: dict[str, str]) -> str:
    counts = ", ".join(f"(SELECT count(*) FROM {source}) AS {table}"
                       for table, source in sorted(tables.items()))
    too_small = " + ".join(f"CAST({table} < 1 AS INTEGER)" for table in tables)
    pairs = ", ".join(f"'{table}', {table}" for table in sorted(tables))
    return _check(name, "ALL_TABLES", layer, f"({too_small})", "tables with fewer than 1 rows",
                  f"json_object('counts', json_object({pairs}))", f"SELECT {counts}")


def _references(name: str, table: str, layer: str, on: str, fact: str, dim: str) -> str:
    return _check(
        name, table, layer, "orphan_records", f"rows whose {on} has no dimension row",
        "json_object('orphan_records', orphan_records)",
        f"SELECT count(*) AS orphan_records FROM {fact} f WHERE NOT EXISTS "
        f"(SELECT 1 FROM {dim} d WHERE d.{on} = f.{on})")


_GOLD = {
    "dim_clientes": "dim_customers", "dim_productos": "dim_products",
    "dim_geografia": "dim_geography", "dim_canal": "dim_channels",
    "fact_transacciones": "transactions", "fact_cartera": "portfolio",
    "fact_rentabilidad_cliente": "value_12m", "kpis_diarios_cartera": "kpis",
}
_BUCKET_SET = "'AL_DIA', 'RANGO_1', 'RANGO_2', 'RANGO_3', 'DETERIORADO'"

_SUITE = "\nUNION ALL\n".join((
    _not_null("expect_pk_not_null", "TB_CLIENTES_CORE", "Silver", "id_cli", "s_customers"),
    _unique("expect_no_duplicate_pk", "dim_clientes", "Gold", ("id_cli",), "dim_customers"),
    _in_set("expect_bucket_mora_valid_values", "fact_cartera", "Gold", "bucket_mora",
            _BUCKET_SET, "portfolio"),
    _bounds("expect_provision_non_negative_and_consistent", "fact_cartera", "Gold",
            "provision_estimada", "0", "sdo_capital * 1.001", "portfolio"),
    _binary("expect_ind_sospechoso_binary", "TB_MOV_FINANCIEROS", "Silver", "ind_sospechoso",
            "s_movements"),
    _row_counts("expect_minimum_row_count_gold", "Gold", _GOLD),
    _references("expect_fact_cartera_cli_referential_integrity", "fact_cartera", "Gold", "id_cli",
                "portfolio", "dim_customers"),
    _bounds("expect_tasa_mora_pct_in_range", "kpis_diarios_cartera", "Gold", "tasa_mora_pct", "0",
            "100", "kpis"),
))

_FLAGGED_ORDERS = """
    SELECT o_orderkey, o_custkey, day AS o_orderdate, o_totalprice,
        CASE WHEN cents > mean + 3 * sd THEN 1 ELSE 0 END AS ind_sospechoso
    FROM (SELECT *, avg(cents) OVER w AS mean, stddev_samp(cents) OVER w AS sd
          FROM (SELECT *, CAST(o_orderdate AS DATE) AS day, round(o_totalprice * 100) AS cents
                FROM orders)
          WINDOW w AS (PARTITION BY o_custkey ORDER BY day
              RANGE BETWEEN INTERVAL 365 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
"""
_DOC_COUNTS = {name: name for name in ("customer", "orders", "lineitem", "part", "supplier")}
_COUNT_CHECK = _row_counts("expect_minimum_row_count_gold", "Gold", _DOC_COUNTS)
_REFERENCE_CHECK = _references("expect_fact_cartera_cli_referential_integrity", "documents",
                               "Gold", "doc_id", "documents", "labels")

# --- after two deliveries -------------------------------------------------------------------

def _second_quality(table: str, key: str, tagged: str, raw: str, day: str, late: str, waits: str) -> str:
    """The delivered rows of the second batch, and the rows whose customer came with it."""
    return f"""
        SELECT '{table}' AS table_name, 'BATCH_2' AS batch_id, n_input, n_output,
            n_input - n_output AS n_rejected,
            CASE WHEN n_input > 0 THEN round(n_output / n_input * 100, 2) ELSE 0.0 END AS pct_conformes
        FROM (
            SELECT (SELECT count(*) FROM {raw} WHERE substr({day}, 1, 7) IN {late})
                    + count(*) FILTER (late_client AND NOT late) AS n_input,
                count(*) FILTER (_reason IS NULL AND (late OR late_client)) AS n_output
            FROM (SELECT t._reason, coalesce(strftime(t.{day}, '%Y-%m') IN {late}, false) AS late,
                    {waits} AND coalesce(c.depto_res = 'ASIA', false) AS late_client
                  FROM {tagged} t LEFT JOIN s_customers c ON c.id_cli = t.id_cli))"""


def _rejected(table: str, tagged: str, key: str) -> str:
    ref = ("CASE _reason WHEN 'ID_CLI_NO_EXISTE_EN_DIMENSION' THEN id_cli "
           "WHEN 'COD_PROD_NO_EXISTE_EN_DIMENSION' THEN cod_prod END")
    return f"""
        SELECT '{table}' AS source_table, _reason AS reason, count(*) AS entries,
            count(DISTINCT {key}) AS row_keys, count(DISTINCT {ref}) AS ref_keys
        FROM {tagged} WHERE _reason IS NOT NULL GROUP BY _reason"""


ORACLE: dict[str, str] = {
    "daily_kpis": _with(("kpis",), "SELECT * FROM kpis"),
    "overdue_buckets": _with(("lines",), f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, days AS dias_mora_act,
            {_buckets('days')} AS bucket_mora,
            {_bucket('days', ('0', '1', '2', '3', '4'))} AS bucket_mora_orden,
            {_grades('days')} AS clasificacion_regulatoria,
            CASE WHEN days > 0 THEN 1 ELSE 0 END AS ind_en_mora FROM lines"""),
    "provision": _with(("lines",), f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
            days AS dias_mora_act, {_provision('l_extendedprice', 'days')} AS provision_estimada
        FROM lines"""),
    "clamp_overdue": _with(("lines",), """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
            CASE WHEN days < 0 THEN 0 ELSE days END AS dias_mora_act FROM lines"""),
    "incremental_scan": """
        SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
        FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'""",
    "incremental_with_nulls": """
        SELECT o_orderkey, day FROM (
            SELECT o_orderkey, nullif(CAST(o_orderdate AS DATE), DATE '1998-03-05') AS day FROM orders)
        WHERE day IS NULL OR day >= DATE '2000-01-01'""",
    "next_watermark": """
        SELECT CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_watermark FROM orders
        WHERE CAST(o_orderdate AS DATE) <= DATE '2000-06-30'""",
    "latest_watermark": """
        SELECT table_name, batch_id, last_watermark, updated_at FROM (
            SELECT o_orderpriority AS table_name, o_orderstatus AS batch_id,
                CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_watermark,
                max(o_orderkey) AS updated_at
            FROM orders GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY updated_at DESC) = 1""",
    "audit_columns": """
        SELECT *, '2024-01-31 07:00:00' AS _ingestion_timestamp, 'core' AS _source_system,
            'BATCH_20240131_070000' AS _batch_id FROM customer""",
    "date_parts": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
            strftime(o_orderdate, '%Y') AS _year, strftime(o_orderdate, '%m') AS _month,
            strftime(o_orderdate, '%d') AS _day FROM orders""",
    "upsert_orders": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
            CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
            o_totalprice
        FROM orders WHERE o_orderstatus = 'F' OR o_orderdate < TIMESTAMP '2000-01-01'""",
    "dedup_by_key": """
        SELECT * EXCLUDE (l_shipdate), CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY CAST(lineitem.l_shipdate AS DATE) DESC, l_partkey, l_suppkey, l_quantity,
                l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
    "dedup_exact": """
        SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), event_type
            ORDER BY event_id) = 1""",
    "required_split": _with(("raw_customers",), """
        SELECT *, CASE WHEN id_cli IS NULL OR tip_doc IS NULL OR fec_alta IS NULL
            OR cod_segmento IS NULL OR depto_res IS NULL OR estado_cli IS NULL
            THEN 'CAMPO_OBLIGATORIO_NULO' END AS reason FROM raw_customers"""),
    "ref_valid": """
        SELECT doc_id, lang, n_chars FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "ref_orphans": """
        SELECT doc_id, lang, n_chars FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "birthdate_range": _with(("raw_customers",), """
        SELECT id_cli, CAST(fec_nac AS DATE) AS fec_nac FROM raw_customers
        WHERE fec_nac IS NULL
           OR CAST(fec_nac AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2030-12-31'"""),
    "out_of_range_dates": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
        WHERE CAST(o_orderdate AS DATE) NOT BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
    "conform_types": """
        SELECT o_orderkey, o_totalprice AS total,
            CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day,
            CASE WHEN o_orderstatus <> 'O' THEN CAST(o_custkey AS INTEGER) END AS customer
        FROM orders""",
    "normalise_codes": "SELECT c_custkey, upper(c_mktsegment) AS segment FROM customer",
    "fill_defaults": _with(("raw_customers",), """
        SELECT id_cli, coalesce(score_buro, 0) AS score_buro,
            coalesce(ciudad_res, 'DESCONOCIDO') AS ciudad_res,
            coalesce(canal_adquis, 'NO_INFORMADO') AS canal_adquis FROM raw_customers"""),
    "except_rows": """
        SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events
        EXCEPT
        SELECT user_id, CAST(ts AS DATE), event_type FROM events WHERE value > 50""",
    "reject_rows": _with(("s_customers",), """
        SELECT 'orders' AS source_table, 'ID_CLI_NO_EXISTE_EN_DIMENSION' AS reason,
            'BATCH_20240131_070000' AS batch_id, CAST(o_orderkey AS VARCHAR) AS row_key,
            true AS has_payload
        FROM orders WHERE CAST(o_custkey AS VARCHAR) NOT IN (SELECT id_cli FROM s_customers)"""),
    "null_profile": _with(("raw_customers",), """
        SELECT column_name, null_pct FROM (
            SELECT unnest(['cod_segmento', 'fec_nac', 'score_buro', 'ciudad_res', 'canal_adquis',
                           'id_cli', 'depto_res']) AS column_name,
                unnest([round((1 - count(cod_segmento) / count(*)) * 100, 2),
                    round((count(*) - count(fec_nac)) / count(*) * 100, 2),
                    round((count(*) - count(score_buro)) / count(*) * 100, 2),
                    round((count(*) - count(ciudad_res)) / count(*) * 100, 2),
                    round((count(*) - count(canal_adquis)) / count(*) * 100, 2),
                    round((count(*) - count(id_cli)) / count(*) * 100, 2),
                    round((count(*) - count(depto_res)) / count(*) * 100, 2)]) AS null_pct
            FROM raw_customers) WHERE null_pct > 0"""),
    "quality_report": _with(("t_customers",), """
        SELECT 'TB_CLIENTES_CORE' AS table_name, 'BATCH_20240131_070000' AS batch_id, n_input,
            n_output, n_input - n_output AS n_rejected,
            round(n_output / n_input * 100, 2) AS pct_conformes,
            CASE WHEN no_birth > 0 THEN '{"fec_nac":'
                || CAST(round(no_birth * 100 / n_output, 2) AS VARCHAR) || '}' ELSE '{}' END
                AS null_summary
        FROM (SELECT count(*) AS n_input, count(*) FILTER (_reason IS NULL) AS n_output,
                count(*) FILTER (_reason IS NULL AND fec_nac IS NULL) AS no_birth
              FROM t_customers)"""),
    "mask_pii": "SELECT c_custkey, sha256(c_name) AS c_name FROM customer",
    "rolling_30d": """
        SELECT event_id, user_id, day, value,
            CASE WHEN n > 0 THEN (total // n + (total % n) / n) / 100 END AS mean_30d,
            round(sd / 100, 5) AS sd_30d
        FROM (SELECT *, sum(cents) OVER w AS total, count(*) OVER w AS n,
                  stddev_samp(cents) OVER w AS sd
              FROM (SELECT *, CAST(ts AS DATE) AS day, CAST(round(value * 100) AS BIGINT) AS cents
                    FROM events)
              WINDOW w AS (PARTITION BY user_id ORDER BY day
                  RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))""",
    "suspicious_flag": _FLAGGED_ORDERS.strip(),
    "rolling_large": """
        SELECT o_orderkey, round(mean / 1e12, 4) AS mean, round(sd / 1e12, 4) AS sd,
            CASE WHEN amount > mean + 3 * sd THEN 1 ELSE 0 END AS ind_sospechoso
        FROM (SELECT o_orderkey, o_totalprice * 1e12 AS amount, avg(o_totalprice * 1e12) OVER w AS mean,
                  stddev_samp(o_totalprice * 1e12) OVER w AS sd
              FROM orders
              WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE)
                  RANGE BETWEEN INTERVAL 365 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))""",
    "facts_after_second_delivery": _with(("portfolio",), "SELECT * FROM portfolio"),
    "transactions_after_second_delivery": _with(("transactions",), "SELECT * FROM transactions"),
    "kpis_from_state": _with(("kpis",), "SELECT * FROM kpis"),
    "client_value_from_state": _with(("value_12m",), "SELECT * FROM value_12m"),
    "refreshed_flags": _with(("s_movements", "s_customers"), """
        SELECT id_mov, m.id_cli, fec_mov, vr_mov, ind_sospechoso, ind_horario_habil,
            tip_mov = 'PURCHASE' AND vr_mov > 100 AND c.depto_res <> 'ASIA'
                AND fec_mov NOT IN (DATE '2024-01-05', DATE '2024-01-28') AS superseded
        FROM s_movements m JOIN s_customers c ON c.id_cli = m.id_cli"""),
    "still_rejected": _with(("t_loans", "t_movements", "t_fees"), " UNION ALL ".join([
        _rejected("TB_OBLIGACIONES", "t_loans", "id_oblig"),
        _rejected("TB_MOV_FINANCIEROS", "t_movements", "id_mov"),
        _rejected("TB_COMISIONES_LOG", "t_fees", "id_comision")])),
    "second_batch_quality": _with(("t_loans", "raw_loans", "t_fees", "raw_fees", "s_customers"), " UNION ALL ".join([
        _second_quality("TB_OBLIGACIONES", "id_oblig", "t_loans", "raw_loans", "fec_desembolso",
                        "('1997-03', '2001-07')", "true"),
        _second_quality("TB_COMISIONES_LOG", "id_comision", "t_fees", "raw_fees", "fec_cobro",
                        "('1998-05', '2001-07')", "t.vr_comision IS NOT NULL")])),
    "business_hours": """
        SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%H:%M:%S') AS hour,
            CASE WHEN dayofweek(ts) BETWEEN 1 AND 5 AND hour(ts) BETWEEN 6 AND 19
                THEN 1 ELSE 0 END AS ind_horario_habil FROM events""",
    "silver_customers": _with(("t_customers",), "SELECT * FROM t_customers"),
    "silver_products": _with(("t_products",), "SELECT * FROM t_products"),
    "silver_branches": _with(("t_branches",), "SELECT * FROM t_branches"),
    "silver_loans": _with(("t_loans",), "SELECT * FROM t_loans"),
    "silver_movements": _with(("t_movements",), "SELECT * FROM t_movements"),
    "silver_fees": _with(("t_fees",), "SELECT * FROM t_fees"),
    "segment_label": _with(("raw_customers",), f"""
        SELECT id_cli, cod_segmento, {_SEGMENT} AS segmento_label
        FROM (SELECT id_cli, upper(trim(coalesce(cod_segmento, 'OTRO'))) AS cod_segmento
              FROM raw_customers)"""),
    "age_years": """
        SELECT o_orderkey, CAST(floor((DATE '2001-08-01' - CAST(o_orderdate AS DATE)) / 365.25)
            AS INTEGER) AS edad FROM orders""",
    "monthly_rate": """
        SELECT p_partkey, round((pow(1 + p_size / 100.0, CAST(1 AS DOUBLE) / 12) - 1) * 100, 4)
            AS tasa_mensual_pct FROM part""",
    "score_bands": """
        SELECT c_custkey, CASE WHEN c_acctbal >= 0 AND c_acctbal / 10 < 400 THEN 'BAJO'
            WHEN c_acctbal >= 0 AND c_acctbal / 10 < 600 THEN 'MEDIO'
            WHEN c_acctbal >= 0 AND c_acctbal / 10 < 800 THEN 'ALTO' ELSE 'MUY_ALTO' END
            AS rango_score_buro FROM customer""",
    "usd_amounts": """
        SELECT o_orderkey, round(o_totalprice * (CAST(1 AS DOUBLE) / 4100), 4) AS vr_usd
        FROM orders""",
    "dim_clientes": _with(("dim_customers",), "SELECT * FROM dim_customers"),
    "dim_products": _with(("dim_products",), "SELECT * FROM dim_products"),
    "dim_geography": _with(("dim_geography",), "SELECT * FROM dim_geography"),
    "dim_canal": _with(("dim_channels",), "SELECT * FROM dim_channels"),
    "attach_segment": _with(("s_customers",), """
        SELECT o_orderkey, id_cli, cod_segmento
        FROM orders JOIN s_customers ON id_cli = CAST(o_custkey AS VARCHAR)"""),
    "fact_transactions": _with(("transactions",), "SELECT * FROM transactions"),
    "fact_portfolio": _with(("portfolio",), "SELECT * FROM portfolio"),
    "commissions_12m": _with(("fees_12m",), """
        SELECT id_cli, periodo, CAST(total_comisiones AS DOUBLE) AS total_comisiones
        FROM fees_12m"""),
    "interest_income": _with(("interest_12m",), """
        SELECT id_cli, periodo, CAST(round(ingreso_intereses_est, 2) AS DOUBLE)
            AS ingreso_intereses_est FROM interest_12m"""),
    "monthly_income": _with(("income",), """
        SELECT id_cli, periodo, CAST(round(total_comisiones, 2) AS DOUBLE) AS total_comisiones,
            CAST(round(ingreso_intereses_est, 2) AS DOUBLE) AS ingreso_intereses_est,
            CAST(round(ingreso_total_mes, 2) AS DOUBLE) AS ingreso_total_mes FROM income"""),
    "active_months": _with(("s_movements",), """
        SELECT id_cli, count(DISTINCT strftime(fec_mov, '%Y-%m')) AS meses_activo
        FROM s_movements WHERE fec_mov >= DATE '2023-01-30' GROUP BY id_cli"""),
    "client_value": _with(("value_12m",), "SELECT * FROM value_12m"),
    "check_key_not_null": _with(("raw_customers",), _not_null(
        "expect_pk_not_null", "customer", "Silver", "cod_segmento", "raw_customers")),
    "check_duplicate_keys": _unique("expect_no_duplicate_pk", "lineitem", "Gold",
                                    ("l_orderkey", "l_linenumber"), "lineitem"),
    "check_bucket_values": _with(("raw_customers",), _in_set(
        "expect_bucket_mora_valid_values", "customer", "Gold", "cod_segmento",
        "'ELITE', 'Premium'", "raw_customers")),
    "invalid_sample": """
        SELECT DISTINCT event_type FROM events
        WHERE event_type NOT IN ('view', 'click') ORDER BY event_type LIMIT 5""",
    "check_provision": _with(("lines",), _bounds(
        "expect_provision_non_negative_and_consistent", "lineitem", "Gold", "provision_estimada",
        "0", "l_extendedprice * 1.001",
        f"(SELECT l_extendedprice, {_provision('l_extendedprice', 'days')} "
        "AS provision_estimada FROM lines)")),
    "check_flag_binary": _binary("expect_ind_sospechoso_binary", "orders", "Silver",
                                 "ind_sospechoso", f"({_FLAGGED_ORDERS})"),
    "check_row_counts": _COUNT_CHECK,
    "check_references": _REFERENCE_CHECK,
    "check_rate_range": _bounds("expect_tasa_mora_pct_in_range", "customer", "Gold", "rate", "0",
                                "100", "(SELECT c_acctbal / 80 AS rate FROM customer)"),
    "quality_suite": _with(("s_customers", "s_movements", *_GOLD.values()), _SUITE),
    "batch_totals": _with(("totals",), "SELECT * FROM totals"),
    "last_batches": _with(("last7",), "SELECT * FROM last7"),
    "volume_anomaly": _with(("anomaly",), "SELECT * FROM anomaly"),
    "layer_counts": _with(("layer_counts",), "SELECT * FROM layer_counts"),
    "run_summary": _with(("layer_counts", "anomaly"), f"""
        SELECT l.batch_id, total_bronze, total_silver, total_gold, failed_tables,
            coalesce(total_checks, 0) AS total_checks,
            coalesce(passed_checks, 0) AS passed_checks,
            coalesce(failed_checks, 0) AS failed_checks,
            coalesce(anomaly_detected, false) AS anomaly_detected,
            CASE WHEN failed_tables > 0 THEN 'PARTIAL_FAILURE'
                WHEN failed_checks > 0 THEN 'CHECKS_FAILED'
                WHEN anomaly_detected THEN 'VOLUME_ALERT' ELSE 'SUCCESS' END AS status
        FROM (SELECT batch_id,
                CAST(coalesce(sum(records) FILTER (layer = 'bronze'), 0) AS BIGINT) AS total_bronze,
                CAST(coalesce(sum(records) FILTER (layer = 'silver'), 0) AS BIGINT) AS total_silver,
                CAST(coalesce(sum(records) FILTER (layer = 'gold'), 0) AS BIGINT) AS total_gold,
                count(*) FILTER (status = 'FAILED') AS failed_tables
              FROM layer_counts GROUP BY batch_id) l
        LEFT JOIN (SELECT '200107' AS batch_id, count(*) AS total_checks,
                count(*) FILTER (passed) AS passed_checks,
                count(*) FILTER (NOT passed) AS failed_checks
              FROM ({_COUNT_CHECK} UNION ALL {_REFERENCE_CHECK})) c ON c.batch_id = l.batch_id
        LEFT JOIN anomaly a ON a.batch_id = l.batch_id"""),
    "masked_customers": _with(("dim_customers",), """
        SELECT id_cli, left(nombre_hash, 4) || '****' AS nombre_ofuscado,
            '***' || right(num_doc_hash, 4) AS doc_ofuscado, tip_doc, edad, fec_alta,
            cod_segmento, segmento_label,
            CASE WHEN score_buro < 400 THEN 'BAJO' WHEN score_buro < 600 THEN 'MEDIO'
                WHEN score_buro < 800 THEN 'ALTO' ELSE 'MUY_ALTO' END AS rango_score_buro,
            depto_res, estado_cli, ind_activo, canal_adquis
        FROM dim_customers"""),
}
