"""Scoring of events against the statistics."""

from pyspark.sql import functions as F

from gridlens import vocabulary
from gridlens.functions.numeric import pct_variation, zscore
from gridlens.operators import alerts, scoring
from gridlens.plans.speed_layer import anomalies
from gridlens.sinks.messages import store_events
from gridlens.session import scratch_path
from gridlens.sources.streams import as_kafka_records
from gridlens.sources.tables import read_events_json
from registry import views
from registry.catalog import check
from registry.sql import rnd, using
from registry.views import CRITICAL, CUSTOMER, ROLES


def std4(df):
    """The deviation depends on summation order in its last digits."""
    return df.withColumns({c: F.round(c, 4) for c in ("desviacion_consumo", "consumo_std") if c in df.columns})


def _fact_sql(columns="*", tail=""):
    return using("fact", body=f"SELECT {columns} REPLACE (round(desviacion_consumo, 4) AS desviacion_consumo) FROM fact {tail}")


def _scored_sql(view, extra=""):
    return using(view, body=f"""
SELECT NRO_DOC_FAC, PERIODO, consumo_actual, importe_actual, DISTRITO, TARIFA, CARTERA, consumo_promedio_historico,
       importe_promedio_historico, round(desviacion_consumo, 4) AS desviacion_consumo, zscore_consumo,
       porcentaje_variacion{extra} FROM {view}""")


def _parsed(spark, folder):
    readings = views.readings(spark, folder)
    broken = F.when(F.col("TARIFA") == "error", F.lit("x")).otherwise(F.col("IMPORTE").cast("string"))
    records = as_kafka_records(
        readings.withColumn("IMPORTE", broken), "consumo", F.col(ROLES.event_time), offset=F.col("NRO_DOC_FAC")
    )
    return scoring.parse_event(records)


@check("parse_event", using("readings", body="""
SELECT NRO_DOC_FAC AS NRO_DOC_FAC_key, NRO_DOC_FAC, PERIODO, CONSUMO,
       CASE WHEN TARIFA = 'error' THEN NULL ELSE IMPORTE END AS IMPORTE, DEPARTAMENTO,
       CAST(NULL AS VARCHAR) AS PROVINCIA, DISTRITO, UBIGEO, TARIFA, CARTERA, ts AS kafka_timestamp,
       CAST(NRO_DOC_FAC AS BIGINT) AS "offset", CAST(0 AS INTEGER) AS "partition" FROM readings"""))
def _(spark, folder):
    return views.plain_times(_parsed(spark, folder).drop(*ROLES.dates, ROLES.unit))


@check("join_event_dim", using("places", body="""
SELECT CAST(event_id AS VARCHAR) AS NRO_DOC_FAC, user_id AS cliente, value AS CONSUMO, event_type AS TARIFA, DISTRITO,
       CARTERA FROM events LEFT JOIN places ON user_id = cliente"""))
def _(spark, folder):
    joined = scoring.join_event_dim(
        views.events(spark, folder), views.places(spark, folder), key=CUSTOMER,
        columns=[ROLES.district, ROLES.portfolio],
    )
    return joined.select(ROLES.document, CUSTOMER, ROLES.consumption, ROLES.tariff, ROLES.district, ROLES.portfolio)


@check("add_location", using("places", body="""
SELECT CAST(event_id AS VARCHAR) AS NRO_DOC_FAC, user_id AS cliente, ts AS kafka_timestamp, DEPARTAMENTO, DISTRITO
FROM events LEFT JOIN places ON user_id = cliente"""))
def _(spark, folder):
    unplaced = views.events(spark, folder).withColumns({"DEPARTAMENTO": F.lit("?"), "DISTRITO": F.lit("?")})
    located = scoring.add_location(unplaced, views.places(spark, folder), key=CUSTOMER)
    return views.plain_times(
        located.select(ROLES.document, CUSTOMER, ROLES.event_time, ROLES.department, ROLES.district)
    )


@check("join_event_stats", using("stats", body="""
SELECT NRO_DOC_FAC, DISTRITO, TARIFA, CARTERA, CONSUMO, consumo_promedio, importe_promedio,
       round(consumo_std, 4) AS consumo_std FROM readings LEFT JOIN stats USING (DISTRITO, TARIFA, CARTERA)"""))
def _(spark, folder):
    joined = scoring.join_event_stats(views.readings(spark, folder), views.statistics(spark, folder))
    return std4(joined.select(
        ROLES.document, *ROLES.group, ROLES.consumption, "consumo_promedio", "importe_promedio", "consumo_std"
    ))


@check("zscore", using("scored", body="SELECT NRO_DOC_FAC, consumo_actual, zscore_consumo FROM scored"))
def _(spark, folder):
    joined = scoring.join_event_stats(views.readings(spark, folder), views.statistics(spark, folder))
    return joined.select(
        ROLES.document, F.col(ROLES.consumption).alias("consumo_actual"),
        zscore(F.col(ROLES.consumption), F.col("consumo_promedio"), F.col("consumo_std")).alias("zscore_consumo"),
    )


@check("pct_variation", using("scored", body="SELECT NRO_DOC_FAC, consumo_actual, porcentaje_variacion FROM scored"))
def _(spark, folder):
    joined = scoring.join_event_stats(views.readings(spark, folder), views.statistics(spark, folder))
    return joined.select(
        ROLES.document, F.col(ROLES.consumption).alias("consumo_actual"),
        pct_variation(F.col(ROLES.consumption), F.col("consumo_promedio")).alias("porcentaje_variacion"),
    )


@check("enrich_events", _scored_sql("scored"))
def _(spark, folder):
    return std4(views.enriched(spark, folder).drop(ROLES.event_time))


@check("classify_anomaly_type", using("classified", body="SELECT NRO_DOC_FAC, zscore_consumo, tipo_anomalia FROM classified"))
def _(spark, folder):
    return scoring.classify_anomaly_type(views.enriched(spark, folder), CRITICAL).select(
        ROLES.document, "zscore_consumo", "tipo_anomalia"
    )


@check("classify_risk", using("classified", body="SELECT NRO_DOC_FAC, zscore_consumo, nivel_riesgo FROM classified"))
def _(spark, folder):
    return scoring.classify_risk(views.enriched(spark, folder), CRITICAL).select(
        ROLES.document, "zscore_consumo", "nivel_riesgo"
    )


@check("add_detection_columns", _scored_sql(
    "classified", ", kafka_timestamp AS fecha_deteccion, true AS flag_anomalia, tipo_anomalia, nivel_riesgo"))
def _(spark, folder):
    return std4(views.plain_times(views.classified(spark, folder).drop(ROLES.event_time)))


@check("add_anomaly_id", using("scored", body="""
SELECT NRO_DOC_FAC, PERIODO, 'ANOM-' || md5(NRO_DOC_FAC || '|' || PERIODO) AS id_anomalia FROM scored"""))
def _(spark, folder):
    rows = views.enriched(spark, folder).select(ROLES.document, ROLES.period)
    return scoring.add_anomaly_id(rows, [ROLES.document, ROLES.period])


@check("conform_anomaly_fact", _fact_sql())
def _(spark, folder):
    return std4(views.anomaly_fact(spark, folder))


@check("conform_unclassified_fact", using("fact", body="""
SELECT * REPLACE (round(desviacion_consumo, 4) AS desviacion_consumo, '2025-01-01 00:00:00' AS fecha_deteccion,
  replace(tipo_anomalia, 'crítico', 'critico') AS tipo_anomalia) FROM fact"""))
def _(spark, folder):
    # Without type and risk in the input, both are worked out while conforming.
    return std4(scoring.conform_anomaly_fact(
        views.enriched(spark, folder), ["nro_doc_fac", "periodo"], CRITICAL, F.lit("2025-01-01").cast("timestamp")
    ))


@check("batch_parity", _fact_sql("* EXCLUDE (fecha_deteccion)"))
def _(spark, folder):
    path = scratch_path(spark, "events")
    store_events(views.readings(spark, folder).drop(ROLES.event_time, CUSTOMER), path)
    stored = read_events_json(spark, path)
    rows = anomalies(stored, views.statistics(spark, folder), critical=CRITICAL)
    identified = scoring.add_anomaly_id(rows.drop("id_anomalia"), ["nro_doc_fac", "periodo"])
    return std4(identified.select(*[c for c in vocabulary.ANOMALY_FACT if c != "fecha_deteccion"]))


@check("clip_scores", using("scored", body="""
SELECT NRO_DOC_FAC, greatest(least(zscore_consumo, 5.0), -5.0) AS zscore_consumo,
       greatest(least(porcentaje_variacion, 500.0), -200.0) AS porcentaje_variacion FROM scored"""))
def _(spark, folder):
    return scoring.clip_scores(
        views.enriched(spark, folder).select(ROLES.document, "zscore_consumo", "porcentaje_variacion")
    )


@check("alert_message", using("readings", body="""
SELECT NRO_DOC_FAC, 'Alerta: consumo de ' || DISTRITO || ' (' || DEPARTAMENTO || ') supera 500 kWh/hora: '
  || CAST(round(CONSUMO, 2) AS VARCHAR) || ' kWh' AS mensaje FROM readings"""))
def _(spark, folder):
    return views.readings(spark, folder).select(
        ROLES.document,
        alerts.alert_message(F.col(ROLES.district), F.col(ROLES.department), F.col(ROLES.consumption)).alias("mensaje"),
    )


REQUESTS = f"""requests AS (
  SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_type = 'error' THEN lower(DISTRITO)
              WHEN event_type = 'click' THEN 'NOWHERE' ELSE DISTRITO END AS distrito,
         CASE WHEN event_type = 'view' THEN 'other' ELSE event_type END AS tarifa, CARTERA AS cartera,
         value AS consumo_actual FROM events JOIN places ON user_id = cliente),
by_group AS (
  SELECT upper(DISTRITO) AS d, upper(TARIFA) AS t, upper(CARTERA) AS c, consumo_promedio AS m, consumo_std AS s FROM stats),
by_district AS (
  SELECT upper(DISTRITO) AS d, min_by(consumo_promedio, TARIFA || '|' || CARTERA) AS m,
         min_by(consumo_std, TARIFA || '|' || CARTERA) AS s FROM stats GROUP BY 1),
overall AS (SELECT avg(consumo_promedio) AS m, avg(consumo_std) AS s FROM stats),
found AS (
  SELECT r.*, coalesce(g.m, b.m, o.m) AS m, CASE WHEN coalesce(g.s, b.s, o.s) = 0 THEN 1.0 ELSE coalesce(g.s, b.s, o.s) END AS s
  FROM requests r LEFT JOIN by_group g ON upper(r.distrito) = g.d AND upper(tarifa) = t AND upper(cartera) = c
  LEFT JOIN by_district b ON upper(r.distrito) = b.d, overall o),
answers AS (
  SELECT id, distrito, tarifa, cartera, consumo_actual, {rnd('(consumo_actual - m) / s', 4)} AS zscore,
         {rnd('(consumo_actual - m) / CASE WHEN m = 0 THEN 1.0 ELSE m END * 100', 2)} AS porcentaje_variacion,
         {rnd('m', 2)} AS consumo_promedio, {rnd('s', 2)} AS desviacion_estandar FROM found)"""


def _answers(spark, folder):
    kind = F.col(ROLES.tariff)
    requests = views.readings(spark, folder).select(
        F.col(ROLES.document).alias("id"),
        F.when(kind == "error", F.lower(ROLES.district)).when(kind == "click", F.lit("NOWHERE"))
        .otherwise(F.col(ROLES.district)).alias("distrito"),
        F.when(kind == "view", F.lit("other")).otherwise(kind).alias("tarifa"),
        F.col(ROLES.portfolio).alias("cartera"), F.col(ROLES.consumption).alias("consumo_actual"),
    )
    return scoring.score_with_fallback(requests, views.statistics(spark, folder))


def _answers_sql(body):
    return using("stats", body="@@").replace("\n@@", f",\n{REQUESTS}\n{body}")


@check("score_with_fallback", _answers_sql("SELECT * FROM answers"))
def _(spark, folder):
    return _answers(spark, folder)


@check("score_single_rules", _answers_sql("""
SELECT *, CASE WHEN consumo_actual > 150 THEN 'Crítico' WHEN zscore > 3 THEN 'Alto' WHEN zscore >= 2 THEN 'Medio'
               WHEN zscore < -2 THEN 'Bajo' WHEN porcentaje_variacion > 100 THEN 'Medio' ELSE 'Bajo' END AS nivel_riesgo,
          CASE WHEN zscore > 3 THEN 'Consumo extremadamente alto' WHEN zscore >= 2 THEN 'Consumo alto'
               WHEN zscore < -2 THEN 'Consumo sospechosamente bajo' WHEN porcentaje_variacion > 100 THEN 'Incremento brusco'
               WHEN consumo_actual > 150 THEN 'Alerta consumo critico > 150 kWh' ELSE 'Consumo normal' END AS tipo_anomalia
FROM answers"""))
def _(spark, folder):
    return scoring.score_single_rules(_answers(spark, folder), CRITICAL)


@check("assign_dimensions", using("stats", body="@@").replace("\n@@", f""",
slots AS (SELECT *, row_number() OVER (ORDER BY DISTRITO, TARIFA, CARTERA) - 1 AS slot FROM stats),
drawn AS (
  SELECT CAST(event_id AS VARCHAR) AS nro_doc_fac, value AS consumo_actual, DISTRITO AS distrito, TARIFA AS tarifa,
         CARTERA AS cartera, consumo_promedio, importe_promedio, consumo_std,
         coalesce(nullif(consumo_std, 0), 1) AS s, consumo_promedio AS m
  FROM events JOIN slots
    ON slot = CAST(concat('0x', substr(md5(event_id || ':42'), 1, 8)) AS BIGINT) % (SELECT count(*) FROM stats))
SELECT nro_doc_fac, consumo_actual, distrito, tarifa, cartera, consumo_promedio AS consumo_promedio_historico,
       importe_promedio AS importe_promedio_historico, round(consumo_std, 4) AS desviacion_consumo,
       greatest(least({rnd('(consumo_actual - m) / s', 4)}, 5.0), -5.0) AS zscore_consumo,
       greatest(least({rnd('(consumo_actual - m) / coalesce(nullif(m, 0), 1) * 100', 2)}, 500.0), -200.0)
         AS porcentaje_variacion
FROM drawn"""))
def _(spark, folder):
    bare = views.events(spark, folder).select(
        F.col(ROLES.document).alias("nro_doc_fac"), F.col(ROLES.consumption).alias("consumo_actual")
    )
    return std4(scoring.assign_dimensions(bare, views.statistics(spark, folder), "nro_doc_fac"))
