"""Shared SQL of the checks: the role views as common table expressions."""

from __future__ import annotations


def total(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,6))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"({total(x)} / COUNT({x}))"


def rnd(x: str, digits: int) -> str:
    """Half-up on the printed number, as Spark rounds; a plain ROUND works on the binary value."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,16)), {digits}) AS DOUBLE)"


def quantile(x: str, p: float, source: str) -> str:
    """Linear interpolation from the nearer neighbour, spelled out so that every digit is defined."""
    at = f"CAST({p} AS DOUBLE) * (n - 1)"
    return f"""(SELECT CASE WHEN w >= 0.5 THEN hi - (hi - lo) * (1 - w) ELSE lo + (hi - lo) * w END FROM (
  SELECT max(v) FILTER (WHERE r = floor({at})) AS lo, max(v) FILTER (WHERE r = ceil({at})) AS hi,
         any_value({at} - floor({at})) AS w
  FROM (SELECT {x} AS v, row_number() OVER (ORDER BY {x}) - 1 AS r, count(*) OVER () AS n FROM {source})))"""


def pct(part: str, whole: str, digits: int = 2) -> str:
    share = rnd(f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100", digits)
    return f"CASE WHEN {whole} > 0 THEN {share} ELSE 0.0 END"


PLACES = """places AS (
  SELECT c_custkey AS cliente, r_name AS DEPARTAMENTO, n_name AS DISTRITO,
         CAST(n_nationkey AS VARCHAR) AS UBIGEO, c_mktsegment AS CARTERA
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

INVOICES = """invoices AS (
  SELECT l_orderkey || '-' || l_linenumber AS NRO_DOC_FAC,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS PERIODO,
         l_quantity AS CONSUMO, l_extendedprice AS IMPORTE,
         CAST(o_orderdate AS DATE) AS FECHA_EMISION, CAST(l_shipdate AS DATE) AS FECHA_VENCIMIENTO,
         DEPARTAMENTO, DISTRITO, o_orderpriority AS TARIFA, CARTERA, cliente, l_linenumber AS linea
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN places ON o_custkey = cliente)"""

RAW = """raw AS (
  SELECT NRO_DOC_FAC, PERIODO,
         CASE WHEN linea IN (6, 7) THEN NULL WHEN linea = 5 THEN -CONSUMO ELSE CONSUMO END AS CONSUMO,
         CASE WHEN linea IN (6, 7) THEN NULL WHEN linea = 5 THEN -IMPORTE ELSE IMPORTE END AS IMPORTE,
         CASE WHEN linea = 4 THEN NULL ELSE FECHA_EMISION END AS FECHA_EMISION,
         CASE WHEN linea = 4 THEN NULL ELSE FECHA_VENCIMIENTO END AS FECHA_VENCIMIENTO,
         '  ' || lower(DEPARTAMENTO) || chr(9) || ' ' AS DEPARTAMENTO, '  ' || lower(DISTRITO) || chr(9) || ' ' AS DISTRITO,
         '  ' || lower(TARIFA) || chr(9) || ' ' AS TARIFA, '  ' || lower(CARTERA) || chr(9) || ' ' AS CARTERA
  FROM invoices)"""

CLEAN = """kept AS (
  SELECT NRO_DOC_FAC, PERIODO, CONSUMO, IMPORTE, FECHA_EMISION, FECHA_VENCIMIENTO,
         upper(trim(DEPARTAMENTO, ' ' || chr(9))) AS DEPARTAMENTO, upper(trim(DISTRITO, ' ' || chr(9))) AS DISTRITO,
         upper(trim(TARIFA, ' ' || chr(9))) AS TARIFA, upper(trim(CARTERA, ' ' || chr(9))) AS CARTERA
  FROM raw WHERE CONSUMO > 0 AND IMPORTE > 0),
spread AS (SELECT avg(CONSUMO) AS mc, stddev_samp(CONSUMO) AS sc, avg(IMPORTE) AS mi, stddev_samp(IMPORTE) AS si FROM kept),
clean AS (
  SELECT kept.*, coalesce(sc > 0 AND abs(CONSUMO - mc) / sc > 3, false)
              OR coalesce(si > 0 AND abs(IMPORTE - mi) / si > 3, false) AS outlier
  FROM kept, spread)"""

STAR = """star_fact AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT NRO_DOC_FAC, PERIODO, CONSUMO, IMPORTE, FECHA_EMISION, FECHA_VENCIMIENTO,
           row_number() OVER (PARTITION BY NRO_DOC_FAC, PERIODO ORDER BY CONSUMO NULLS FIRST, IMPORTE NULLS FIRST,
             FECHA_EMISION NULLS FIRST, FECHA_VENCIMIENTO NULLS FIRST) AS n
    FROM clean WHERE NRO_DOC_FAC IS NOT NULL) WHERE n = 1),
star_dim AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT NRO_DOC_FAC, DEPARTAMENTO, DISTRITO, TARIFA, CARTERA,
           row_number() OVER (PARTITION BY NRO_DOC_FAC ORDER BY DEPARTAMENTO NULLS FIRST, DISTRITO NULLS FIRST,
             TARIFA NULLS FIRST, CARTERA NULLS FIRST) AS n
    FROM clean WHERE NRO_DOC_FAC IS NOT NULL) WHERE n = 1)"""

READINGS = """readings AS (
  SELECT CAST(event_id AS VARCHAR) AS NRO_DOC_FAC, CAST(year(ts) * 100 + month(ts) AS INTEGER) AS PERIODO,
         value AS CONSUMO, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS IMPORTE,
         DEPARTAMENTO, DISTRITO, UBIGEO, event_type AS TARIFA, CARTERA, cliente, ts
  FROM events JOIN places ON user_id = cliente)"""

STATS = f"""stats AS (
  SELECT DISTRITO, TARIFA, CARTERA, {mean('CONSUMO')} AS consumo_promedio,
         coalesce(stddev_samp(CONSUMO), 0) AS consumo_std, {mean('IMPORTE')} AS importe_promedio,
         coalesce(stddev_samp(IMPORTE), 0) AS importe_std, min(CONSUMO) AS consumo_minimo,
         max(CONSUMO) AS consumo_maximo, count(*) AS total_registros
  FROM readings GROUP BY DISTRITO, TARIFA, CARTERA)"""

SCORED = f"""scored AS (
  SELECT NRO_DOC_FAC, PERIODO, CONSUMO AS consumo_actual, IMPORTE AS importe_actual, DISTRITO, TARIFA, CARTERA,
         consumo_promedio AS consumo_promedio_historico, importe_promedio AS importe_promedio_historico,
         consumo_std AS desviacion_consumo,
         CASE WHEN coalesce(consumo_std, 0) = 0 THEN 0.0 ELSE {rnd('(CONSUMO - consumo_promedio) / consumo_std', 4)} END
           AS zscore_consumo,
         CASE WHEN coalesce(consumo_promedio, 0) = 0 THEN 0.0
              ELSE {rnd('(CONSUMO - consumo_promedio) / consumo_promedio * 100', 2)} END AS porcentaje_variacion,
         ts AS kafka_timestamp, DEPARTAMENTO
  FROM readings LEFT JOIN stats USING (DISTRITO, TARIFA, CARTERA))"""

CLASSIFIED = """classified AS (
  SELECT *, CASE WHEN zscore_consumo > 3 THEN 'Consumo extremadamente alto'
                 WHEN zscore_consumo >= 2 THEN 'Consumo alto'
                 WHEN porcentaje_variacion > 100 THEN 'Incremento brusco'
                 WHEN zscore_consumo < -2 THEN 'Consumo sospechosamente bajo'
                 WHEN consumo_actual > 150 THEN 'Alerta consumo crítico > 150 kWh'
                 ELSE 'Variacion moderada' END AS tipo_anomalia,
            CASE WHEN consumo_actual > 150 THEN 'Crítico' WHEN zscore_consumo > 3 THEN 'Alto'
                 WHEN zscore_consumo >= 2 THEN 'Medio' ELSE 'Bajo' END AS nivel_riesgo
  FROM scored)"""

FACT = """fact AS (
  SELECT 'ANOM-' || md5(NRO_DOC_FAC || '|' || PERIODO) AS id_anomalia, NRO_DOC_FAC AS nro_doc_fac, PERIODO AS periodo,
         consumo_actual, importe_actual, DISTRITO AS distrito, TARIFA AS tarifa, CARTERA AS cartera,
         consumo_promedio_historico, importe_promedio_historico, desviacion_consumo, zscore_consumo,
         porcentaje_variacion, tipo_anomalia, nivel_riesgo,
         strftime(kafka_timestamp, '%Y-%m-%d %H:%M:%S') AS fecha_deteccion, true AS flag_anomalia
  FROM classified)"""

ALERTS = f"""hourly AS (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
         DEPARTAMENTO, DISTRITO, {total('CONSUMO')} AS s, count(*) AS total_eventos,
         {rnd(mean('CONSUMO'), 2)} AS consumo_promedio
  FROM readings GROUP BY ALL),
alerts AS (
  SELECT window_start, window_end, DEPARTAMENTO, DISTRITO, {rnd('s', 2)} AS consumo_total_hora, total_eventos,
         consumo_promedio, TIMESTAMP '2025-01-01' AS fecha_generacion, 'CRITICO' AS nivel,
         'Alerta: consumo de ' || DISTRITO || ' (' || DEPARTAMENTO || ') supera 100 kWh/hora: '
           || CAST({rnd('s', 2)} AS VARCHAR) || ' kWh' AS mensaje
  FROM hourly WHERE s > 100)"""

HEATMAP = f"""heat AS (
  SELECT distrito, count(*) AS total_registros, count(*) FILTER (WHERE abs(zscore_consumo) > 3) AS anomalias_reales
  FROM fact WHERE distrito IS NOT NULL GROUP BY distrito),
heatmap AS (
  SELECT distrito, total_registros, anomalias_reales,
         {rnd('CAST(anomalias_reales AS DOUBLE) / CAST(total_registros AS DOUBLE) * 100', 4)} AS tasa_anomalia_pct,
         CASE WHEN CAST(anomalias_reales AS DOUBLE) / CAST(total_registros AS DOUBLE) * 100 > 0.05 THEN 'Alto'
              WHEN CAST(anomalias_reales AS DOUBLE) / CAST(total_registros AS DOUBLE) * 100 > 0.02 THEN 'Medio'
              ELSE 'Bajo' END AS riesgo
  FROM heat)"""

MAP = """district_place AS (
  SELECT DISTRITO AS distrito, min_by(DEPARTAMENTO, DEPARTAMENTO || '|' || UBIGEO) AS departamento,
         min_by(UBIGEO, DEPARTAMENTO || '|' || UBIGEO) AS ubigeo FROM places GROUP BY DISTRITO),
centroid AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS code, n_nationkey * CAST(-0.5 AS DOUBLE) AS lat,
         n_regionkey * CAST(-1.5 AS DOUBLE) AS lon FROM nation),
mapped AS (
  SELECT distrito, coalesce(departamento, 'LA LIBERTAD') AS departamento, coalesce(ubigeo, '') AS ubigeo,
         coalesce(lat, 0.0) AS lat, coalesce(lon, 0.0) AS lon, total_registros, anomalias_reales, tasa_anomalia_pct, riesgo
  FROM heatmap LEFT JOIN district_place USING (distrito) LEFT JOIN centroid ON lpad(ubigeo, 6, '0') = code)"""

RFM = f"""rfm AS (
  SELECT cliente, CAST(coalesce(date_diff('day', max(FECHA_EMISION), (SELECT max(FECHA_EMISION) FROM invoices)), 0)
           AS INTEGER) AS recency,
         count(DISTINCT PERIODO) AS frequency, coalesce({total('IMPORTE')}, 0) AS monetary
  FROM invoices GROUP BY cliente),
terciles AS (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS columna, p AS probabilidad, CAST(v AS DOUBLE) AS valor
  FROM (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS r, count(*) OVER () AS n FROM rfm),
       (SELECT CAST(1 AS DOUBLE) / 3 AS p UNION ALL SELECT CAST(2 AS DOUBLE) / 3)
  WHERE r = greatest(ceil(p * n), 1)""" for c in ("recency", "frequency", "monetary")
) + """),
cuts AS (SELECT """ + ", ".join(
    f"max(valor) FILTER (WHERE columna = '{c}' AND probabilidad {op} 0.5) AS {c[0]}{i}"
    for c in ("recency", "frequency", "monetary") for i, op in ((1, "<"), (2, ">"))
) + """ FROM terciles),
scores AS (
  SELECT rfm.*, CAST(CASE WHEN recency <= r1 THEN 3 WHEN recency <= r2 THEN 2 ELSE 1 END AS INTEGER) AS r_score,
         CAST(CASE WHEN frequency <= f1 THEN 1 WHEN frequency <= f2 THEN 2 ELSE 3 END AS INTEGER) AS f_score,
         CAST(CASE WHEN monetary <= m1 THEN 1 WHEN monetary <= m2 THEN 2 ELSE 3 END AS INTEGER) AS m_score
  FROM rfm, cuts),
segments AS (
  SELECT *, r_score + f_score + m_score AS rfm_total,
         CASE WHEN r_score + f_score + m_score >= 8 THEN 'Champion' WHEN r_score + f_score + m_score >= 6 THEN 'Cliente activo'
              WHEN r_score + f_score + m_score >= 4 THEN 'En riesgo' ELSE 'Perdido' END AS segmento
  FROM scores)"""

KPIS = f"""kpi_spread AS (
  SELECT avg(CONSUMO) AS mc, stddev_samp(CONSUMO) AS sc, avg(IMPORTE) AS mi, stddev_samp(IMPORTE) AS si FROM invoices),
kpi_row AS (
  SELECT {total('IMPORTE')} AS importe, {total('CONSUMO')} AS consumo, count(DISTINCT NRO_DOC_FAC) AS facturas,
         {mean('IMPORTE')} AS ticket, {mean('CONSUMO')} AS medio, count(*) AS registros,
         count(*) FILTER (WHERE sc > 0 AND si > 0 AND (abs(CONSUMO - mc) / sc > 3 OR abs(IMPORTE - mi) / si > 3)) AS outliers
  FROM invoices, kpi_spread),
kpis AS (
  SELECT 'facturacion_total_soles' AS indicador, {rnd('importe', 2)} AS valor FROM kpi_row
  UNION ALL SELECT 'consumo_total_kwh', {rnd('consumo', 2)} FROM kpi_row
  UNION ALL SELECT 'total_facturas', CAST(facturas AS DOUBLE) FROM kpi_row
  UNION ALL SELECT 'ticket_promedio', {rnd('ticket', 2)} FROM kpi_row
  UNION ALL SELECT 'consumo_promedio_global', {rnd('medio', 2)} FROM kpi_row
  UNION ALL SELECT 'total_registros', CAST(registros AS DOUBLE) FROM kpi_row
  UNION ALL SELECT 'registros_outliers', CAST(outliers AS DOUBLE) FROM kpi_row
  UNION ALL SELECT 'tasa_outlier_pct', {pct('outliers', 'registros')} FROM kpi_row)"""

PARTS = {
    "places": (PLACES, []), "invoices": (INVOICES, ["places"]), "raw": (RAW, ["invoices"]),
    "clean": (CLEAN, ["raw"]), "star": (STAR, ["clean"]), "readings": (READINGS, ["places"]),
    "stats": (STATS, ["readings"]), "scored": (SCORED, ["stats"]), "classified": (CLASSIFIED, ["scored"]),
    "fact": (FACT, ["classified"]), "alerts": (ALERTS, ["readings"]), "heatmap": (HEATMAP, ["fact"]),
    "map": (MAP, ["heatmap"]), "rfm": (RFM, ["invoices"]), "kpis": (KPIS, ["invoices"]),
}


def using(*names: str, body: str) -> str:
    """``body`` with the named views and everything they need in front."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in PARTS[name][1]:
            need(other)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    return "WITH " + ",\n".join(PARTS[n][0] for n in order) + "\n" + body
