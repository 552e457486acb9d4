"""Summaries, dashboard tables and alerts."""

from pyspark.sql import functions as F

from gridlens import settle
from gridlens.operators import alerts, batch, serving
from gridlens.session import scratch_path
from gridlens.sinks import files
from registry import views
from registry.catalog import ORACLES, check
from registry.sql import mean, pct, rnd, total, using
from registry.scoring import std4


def fact_table(spark, folder):
    """The stored anomaly fact: tables that read it several times do not repeat the scoring."""
    return settle(views.anomaly_fact(spark, folder), "fact")


@check("anomaly_type_distribution", using("fact", body="SELECT tipo_anomalia, count(*) AS cantidad FROM fact GROUP BY 1"))
def _(spark, folder):
    return serving.anomaly_type_distribution(views.anomaly_fact(spark, folder))


@check("risk_distribution", using("fact", body="SELECT nivel_riesgo, count(*) AS cantidad FROM fact GROUP BY 1"))
def _(spark, folder):
    return serving.risk_distribution(views.anomaly_fact(spark, folder))


@check("region_hourly_accumulation", using("scored", body=f"""
SELECT DISTRITO, CAST(hour(kafka_timestamp) AS INTEGER) AS hour, {rnd(total('consumo_actual'), 2)} AS total_kwh,
       count(*) AS total_records, {rnd(mean('consumo_actual'), 2)} AS avg_consumption, count(*) AS anomaly_count
FROM scored GROUP BY 1, 2"""))
def _(spark, folder):
    return serving.region_hourly_accumulation(views.classified(spark, folder))


def summary_sql(by):
    return f"""summary_{by} AS (
  SELECT {by}, count(id_anomalia) AS total_anomalias, {rnd(mean('zscore_consumo'), 4)} AS promedio_zscore,
         max(zscore_consumo) AS max_zscore, {pct("count(*) FILTER (WHERE nivel_riesgo = 'Alto')", "count(*)")} AS riesgo_alto_pct,
         {pct("count(*) FILTER (WHERE nivel_riesgo = 'Bajo')", "count(*)")} AS riesgo_bajo_pct
  FROM fact WHERE {by} IS NOT NULL GROUP BY {by})"""


def with_summaries(body, *columns):
    return using("fact", body="@@").replace("\n@@", ",\n" + ",\n".join(summary_sql(c) for c in columns) + "\n" + body)


for _by in ("distrito", "tarifa", "cartera"):
    check(f"anomaly_summary_{_by}", with_summaries(f"SELECT * FROM summary_{_by}", _by))(
        lambda spark, folder, by=_by: serving.anomaly_summary(views.anomaly_fact(spark, folder), by)
    )


@check("anomaly_summary", with_summaries(" UNION ALL ".join(
    f"SELECT '{c}' AS resumen, {c} AS clave, * EXCLUDE ({c}) FROM summary_{c}" for c in ("distrito", "tarifa", "cartera")
), "distrito", "tarifa", "cartera"))
def _(spark, folder):
    fact = fact_table(spark, folder)
    summaries = [
        serving.anomaly_summary(fact, c).withColumnRenamed(c, "clave").withColumn("resumen", F.lit(c))
        for c in ("distrito", "tarifa", "cartera")
    ]
    return summaries[0].unionByName(summaries[1]).unionByName(summaries[2])


@check("top5_critical", with_summaries("""
SELECT distrito, total_anomalias, promedio_zscore FROM summary_distrito
ORDER BY total_anomalias DESC, distrito LIMIT 5""", "distrito"))
def _(spark, folder):
    return serving.top5_critical(serving.anomaly_summary(views.anomaly_fact(spark, folder), "distrito"))


GENERAL = [
    ("total_anomalias_detectadas", "CAST(count(*) AS DOUBLE)"),
    ("total_distritos_afectados", "CAST(count(DISTINCT distrito) AS DOUBLE)"),
    ("total_tarifas_afectadas", "CAST(count(DISTINCT tarifa) AS DOUBLE)"),
    ("total_carteras_afectadas", "CAST(count(DISTINCT cartera) AS DOUBLE)"),
    ("promedio_zscore_global", rnd(mean("zscore_consumo"), 4)),
    ("max_zscore_global", rnd("max(zscore_consumo)", 4)),
    ("pct_anomalias_nivel_alto", pct("count(*) FILTER (WHERE nivel_riesgo = 'Alto')", "count(*)")),
    ("pct_flag_true", pct("count(*) FILTER (WHERE flag_anomalia)", "count(*)")),
    ("nulos_zscore", "CAST(count(*) FILTER (WHERE zscore_consumo IS NULL) AS DOUBLE)"),
]
SUMMARY_VALUES = ["total_anomalias", "promedio_zscore", "max_zscore", "riesgo_alto_pct", "riesgo_bajo_pct"]


def _long(section, key, values, source):
    return [
        f"SELECT '{section}' AS seccion, {key} AS clave, '{v}' AS indicador, CAST({v} AS DOUBLE) AS valor FROM {source}"
        for v in values
    ]


@check("kpi_report", with_summaries(" UNION ALL ".join(
    [f"SELECT 'resumen_general' AS seccion, '' AS clave, '{n}' AS indicador, {e} AS valor FROM fact" for n, e in GENERAL]
    + _long("distribucion_tipo_anomalia", "tipo_anomalia", ["cantidad"],
            "(SELECT tipo_anomalia, count(*) AS cantidad FROM fact GROUP BY 1)")
    + _long("distribucion_nivel_riesgo", "nivel_riesgo", ["cantidad"],
            "(SELECT nivel_riesgo, count(*) AS cantidad FROM fact GROUP BY 1)")
    + _long("top_5_distritos_criticos", "distrito", SUMMARY_VALUES[:2],
            "(SELECT * FROM summary_distrito ORDER BY total_anomalias DESC, distrito LIMIT 5)")
    + _long("top_5_tarifas_criticas", "tarifa", SUMMARY_VALUES[:2],
            "(SELECT * FROM summary_tarifa ORDER BY total_anomalias DESC, tarifa LIMIT 5)")
    + _long("resumen_cartera", "cartera", SUMMARY_VALUES, "summary_cartera")), "distrito", "tarifa", "cartera"))
def _(spark, folder):
    return serving.kpi_report(fact_table(spark, folder))


@check("dashboard_kpis", using("fact", body=f"""
SELECT count(*) AS registros_procesados, count(*) FILTER (WHERE abs(zscore_consumo) > 3) AS anomalias_reales,
       {pct("count(*) FILTER (WHERE abs(zscore_consumo) > 3)", "count(*)", 4)} AS tasa_anomalia_pct,
       {total('consumo_actual')} AS consumo_total_kwh,
       count(*) FILTER (WHERE abs(zscore_consumo) > 3) AS alertas_criticas,
       {total('importe_actual')} AS facturacion_total_soles, CAST(NULL AS DOUBLE) AS loader_validez_pct
FROM fact"""))
def _(spark, folder):
    return serving.dashboard_kpis(views.anomaly_fact(spark, folder))


@check("district_heatmap", using("heatmap", body="SELECT * FROM heatmap"))
def _(spark, folder):
    return serving.district_heatmap(views.anomaly_fact(spark, folder))


def _mapped(spark, folder):
    return serving.district_heatmap_join(
        serving.district_heatmap(views.anomaly_fact(spark, folder)),
        serving.district_places(views.places(spark, folder)), views.centroids(spark, folder),
    )


@check("district_heatmap_join", using("map", body="SELECT * FROM mapped"))
def _(spark, folder):
    return _mapped(spark, folder)


@check("choropleth", using("map", body="""
SELECT lpad(ubigeo, 6, '0') AS ubigeo, tasa_anomalia_pct, anomalias_reales, total_registros, distrito, departamento
FROM mapped"""))
def _(spark, folder):
    return serving.choropleth(_mapped(spark, folder))


@check("risk_split", using("fact", body=f"""
SELECT CASE WHEN abs(zscore_consumo) > 3 THEN 'Anomalia real (z>3)' ELSE 'Consumo normal (z<3)' END AS nivel_riesgo,
       count(*) AS cantidad, {pct('count(*)', '(SELECT count(*) FROM fact)')} AS pct FROM fact GROUP BY 1"""))
def _(spark, folder):
    return serving.risk_split(views.anomaly_fact(spark, folder))


@check("top_districts_by_rate", using("heatmap", body="""
SELECT distrito, tasa_anomalia_pct FROM heatmap ORDER BY tasa_anomalia_pct DESC, distrito LIMIT 30"""))
def _(spark, folder):
    return serving.top_districts_by_rate(serving.district_heatmap(views.anomaly_fact(spark, folder)))


@check("top_districts_by_anomalies", using("fact", body="""
SELECT distrito, count(*) AS cantidad FROM fact GROUP BY 1 ORDER BY cantidad DESC, distrito LIMIT 10"""))
def _(spark, folder):
    return serving.top_districts_by_anomalies(views.anomaly_fact(spark, folder))


@check("top_districts_by_mean_z", using("fact", body=f"""
SELECT distrito, {mean('zscore_consumo')} AS zscore_promedio FROM fact GROUP BY 1
ORDER BY zscore_promedio DESC, distrito LIMIT 10"""))
def _(spark, folder):
    return serving.top_districts_by_mean_z(views.anomaly_fact(spark, folder))


@check("zscore_sample", using("fact", body="""
SELECT distrito, zscore_consumo FROM fact ORDER BY id_anomalia LIMIT 200"""))
def _(spark, folder):
    return serving.zscore_sample(views.anomaly_fact(spark, folder))


@check("anomaly_feed", using("fact", body="""
SELECT * REPLACE (round(desviacion_consumo, 4) AS desviacion_consumo) FROM fact WHERE abs(zscore_consumo) > 3
ORDER BY id_anomalia LIMIT 500"""))
def _(spark, folder):
    return std4(serving.anomaly_feed(views.anomaly_fact(spark, folder)))


@check("json_safe", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 OR l_tax = 0 THEN NULL ELSE l_extendedprice END AS importe
FROM lineitem""")
def _(spark, folder):
    lines = views.table(spark, folder, "lineitem")
    odd = (
        F.when(F.col("l_discount") == 0, F.lit(float("nan"))).when(F.col("l_tax") == 0, F.lit(float("-inf")))
        .otherwise(F.col("l_extendedprice"))
    )
    return serving.json_safe(lines.select("l_orderkey", "l_linenumber", odd.alias("importe")))


@check("monthly_mean_trend", using("fact", body=f"""
SELECT periodo, {mean('consumo_actual')} AS consumo_promedio, {mean('importe_actual')} AS importe_promedio
FROM fact GROUP BY 1"""))
def _(spark, folder):
    return serving.monthly_mean_trend(views.anomaly_fact(spark, folder))


@check("events_per_day", "SELECT CAST(o_orderdate AS DATE) AS fecha, count(*) AS eventos FROM orders GROUP BY 1")
def _(spark, folder):
    return serving.events_per_day(views.table(spark, folder, "orders"), "o_orderdate")


@check("latest_alerts", using("alerts", body="""
SELECT * FROM alerts ORDER BY window_start DESC, DEPARTAMENTO, DISTRITO LIMIT 200"""))
def _(spark, folder):
    return views.plain_times(alerts.latest_alerts(views.alerts(spark, folder)))


@check("filter_alerts", using("alerts", body="""
SELECT * FROM alerts WHERE upper(nivel) = 'CRITICO' AND contains(upper(DEPARTAMENTO), 'A')
  AND contains(upper(DISTRITO), 'NATION_1')"""))
def _(spark, folder):
    return views.plain_times(alerts.filter_alerts(views.alerts(spark, folder), "critico", "a", "nation_1"))


@check("alert_page", using("alerts", body="""
SELECT * FROM alerts ORDER BY window_start DESC, DEPARTAMENTO, DISTRITO LIMIT 100 OFFSET 50"""))
def _(spark, folder):
    return views.plain_times(alerts.alert_page(views.alerts(spark, folder), 50, 100))


@check("alert_stats", using("alerts", body=f"""
SELECT count(*) AS total, {rnd(total('consumo_total_hora'), 2)} AS consumo_total_hora,
       {rnd(total('consumo_total_hora') + ' / count(*)', 2)} AS consumo_promedio_hora FROM alerts"""))
def _(spark, folder):
    return alerts.alert_totals(views.alerts(spark, folder))


@check("alert_stats_by_level", using("alerts", body="SELECT nivel, count(*) AS total FROM alerts GROUP BY 1"))
def _(spark, folder):
    return alerts.alerts_by_level(views.alerts(spark, folder))


@check("alert_stats_by_department", using("alerts", body=f"""
SELECT DEPARTAMENTO, count(*) AS total_alertas, {rnd(total('consumo_total_hora'), 2)} AS consumo_total_hora,
       count(DISTINCT DISTRITO) AS distritos_afectados FROM alerts GROUP BY 1"""))
def _(spark, folder):
    return alerts.alerts_by_department(views.alerts(spark, folder))


@check("merge_alerts", using("alerts", body="""
SELECT * REPLACE (CASE WHEN consumo_total_hora > 120 THEN 'REVISADO' ELSE nivel END AS nivel) FROM alerts"""))
def _(spark, folder):
    stored = settle(views.alerts(spark, folder), "alerts")
    changed = stored.filter(F.col("consumo_total_hora") > 120).withColumn("nivel", F.lit("REVISADO"))
    return views.plain_times(alerts.merge_alerts(stored, changed, keep=None))


@check("write_report", ORACLES["kpi_report"])
def _(spark, folder):
    """The report written as JSON lines and read back."""
    report, path = serving.kpi_report(fact_table(spark, folder)), scratch_path(spark, "report")
    files.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@check("export_dashboard_tables", ORACLES["risk_split"])
def _(spark, folder):
    """All dashboard tables written, one of them read back."""
    trend = batch.trend_export(batch.monthly_trend(views.invoices(spark, folder)))
    dim = views.places(spark, folder)
    tables = serving.dashboard_tables(fact_table(spark, folder), dim, views.centroids(spark, folder), trend)
    path = scratch_path(spark, "dashboard")
    files.export_dashboard_tables(tables, path)
    return spark.read.schema(tables["corrected_risk"].schema).json(f"{path}/corrected_risk")
