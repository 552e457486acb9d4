"""The streaming operators, run over the stored events until everything available is processed."""

from pyspark.sql import functions as F

from gridlens.functions.numeric import exact_sum
from gridlens.operators import scoring
from gridlens.operators.alerts import hourly_alerts
from gridlens.plans.speed_layer import anomalies, start_live
from gridlens.session import scratch_path
from gridlens.sources.streams import as_kafka_records, replay_source
from gridlens.streaming import queries, versions
from gridlens.streaming.progress import ProgressLog, check_latencies, latency_report, read_progress
from registry import views
from registry.catalog import check
from registry.scoring import std4
from registry.sql import using
from registry.views import CRITICAL, CUSTOMER, HOURLY, ROLES


def _stream(spark, folder):
    schema = views.table(spark, folder, "events").schema
    return replay_source(spark, folder, schema, glob="events.parquet")


def _located_events(spark, folder):
    """The event stream joined to the stored locations."""
    events = views.as_events(_stream(spark, folder))
    places = views.places(spark, folder)
    return events.join(places, CUSTOMER, "left")


def _alerts(spark, folder):
    return hourly_alerts(
        _located_events(spark, folder), limit=HOURLY, generated_at=F.lit("2025-01-01").cast("timestamp")
    )


@check("hourly_alerts", using("alerts", body="SELECT * FROM alerts"))
def _(spark, folder):
    return views.plain_times(views.alerts(spark, folder))


@check("hourly_alerts_append", using("alerts", body="""
SELECT * FROM alerts WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""))
def _(spark, folder):
    out, state = scratch_path(spark, "alerts"), scratch_path(spark, "alerts-checkpoint")
    queries.drain(queries.stream_to_parquet(_alerts(spark, folder), out, state, queries.DRAIN))
    return views.plain_times(spark.read.parquet(out))


@check("hourly_alerts_update", using("alerts", body="SELECT * FROM alerts"))
def _(spark, folder):
    out, state = scratch_path(spark, "updates"), scratch_path(spark, "updates-checkpoint")
    queries.drain(queries.log_alert_updates(_alerts(spark, folder), out, state, queries.DRAIN))
    return views.plain_times(queries.current_alerts(spark, out))


def _in_files(spark, folder, files=4):
    """The events as files of consecutive times, each written after the one before, so that a stream takes them in turn."""
    events = views.table(spark, folder, "events")
    path = scratch_path(spark, "event-files")
    cuts = events.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [k / files for k in range(1, files)])).first()[0]
    place = sum((F.unix_micros(F.col("ts").cast("timestamp")) > c).cast("int") for c in cuts)
    for k in range(files):
        events.filter(place == k).coalesce(1).write.mode("append").parquet(path)
    return path, events.schema


@check("upsert_alerts", using("alerts", body="SELECT * FROM alerts"))
def _(spark, folder):
    """Four micro-batches, so that state and stored hours cross them."""
    path, schema = _in_files(spark, folder)
    stream = views.as_events(replay_source(spark, path, schema, files_per_trigger=1))
    alerts = hourly_alerts(stream.join(views.places(spark, folder), CUSTOMER, "left"), limit=HOURLY,
                           generated_at=F.lit("2025-01-01").cast("timestamp"))
    out, state = scratch_path(spark, "newest"), scratch_path(spark, "newest-checkpoint")
    queries.drain(queries.upsert_alerts(alerts, out, state, trigger=queries.DRAIN))
    return views.plain_times(queries.stored_alerts(spark, out))


@check("batch_progress", """
SELECT 'avisos' AS nombre, CAST(4 AS BIGINT) AS lotes, count(*) AS filas, true AS medido FROM events""")
def _(spark, folder):
    """Each of four micro-batches is a row of the progress table; the seconds are Spark's own."""
    path, schema = _in_files(spark, folder)
    alerts = hourly_alerts(views.as_events(replay_source(spark, path, schema, files_per_trigger=1)).join(
        views.places(spark, folder), CUSTOMER, "left"), limit=HOURLY)
    table, out, state = (scratch_path(spark, f"progress-{x}") for x in ("table", "alerts", "checkpoint"))
    with ProgressLog(spark, table) as log:
        queries.drain(log.expect(
            alerts.writeStream.queryName("avisos").format("parquet").option("path", out).option("checkpointLocation", state)
            .trigger(**queries.DRAIN).start()))
    report = check_latencies(latency_report(read_progress(spark, table)))
    measured = (F.col("p50_segundos") > 0) & (F.col("p95_segundos") <= F.col("max_segundos")) & F.col("oe3_latencia_cumplido").isNotNull()
    return report.select("nombre", "lotes", "filas", measured.alias("medido"))


@check("versioned_statistics", using("scored", body="""
SELECT NRO_DOC_FAC, zscore_consumo, CAST(2 AS BIGINT) AS version FROM scored"""))
def _(spark, folder):
    """The stream is scored with the statistics published last, not with the empty ones before."""
    stats = views.statistics(spark, folder)
    published = scratch_path(spark, "published")
    versions.publish(stats.limit(0), published)
    versions.publish(stats, published)
    events = scoring.parse_event(_messages(spark, folder))
    out, state = scratch_path(spark, "versioned"), scratch_path(spark, "versioned-checkpoint")
    queries.drain(versions.with_versions(
        events, published, lambda batch, now: scoring.enrich_events(batch, now).select(ROLES.document, "zscore_consumo"), out, state, queries.DRAIN))
    return spark.read.option("basePath", out).parquet(out).drop("batch_id")


FACT = using("fact", body="""
SELECT * EXCLUDE (fecha_deteccion) REPLACE (round(desviacion_consumo, 4) AS desviacion_consumo,
  'ANOM-' || md5(nro_doc_fac || '|' || periodo || '|' || CAST(consumo_actual AS VARCHAR)) AS id_anomalia) FROM fact""")


def _messages(spark, folder):
    """Kafka-shaped records of the event stream, the location included as the producer would send it."""
    located = _located_events(spark, folder)
    return as_kafka_records(located, "consumo", F.col(ROLES.event_time))


@check("stream_enrich_classify", FACT)
def _(spark, folder):
    events = scoring.parse_event(_messages(spark, folder))
    scored = anomalies(events, views.statistics(spark, folder), critical=CRITICAL)
    out, state = scratch_path(spark, "anomalies"), scratch_path(spark, "anomalies-checkpoint")
    queries.drain(queries.stream_to_parquet(scored, out, state, queries.DRAIN))
    return std4(spark.read.parquet(out).drop("fecha_deteccion"))


@check("foreach_batch_classify", using("classified", body="""
SELECT NRO_DOC_FAC, zscore_consumo, porcentaje_variacion, tipo_anomalia, nivel_riesgo, true AS flag_anomalia
FROM classified"""))
def _(spark, folder):
    events = scoring.parse_event(_messages(spark, folder))
    enriched = scoring.enrich_events(events, views.statistics(spark, folder))
    out, state = scratch_path(spark, "classified"), scratch_path(spark, "classified-checkpoint")
    queries.drain(queries.classify_batches(
        enriched, lambda batch: scoring.classify(batch, CRITICAL), out, state, queries.DRAIN
    ))
    return spark.read.option("basePath", out).parquet(out).select(
        ROLES.document, "zscore_consumo", "porcentaje_variacion", "tipo_anomalia", "nivel_riesgo", "flag_anomalia"
    )


@check("live_queries", using("fact", "alerts", body="""
SELECT 'anomalias' AS consulta, count(*) AS filas, round(sum(CAST(consumo_actual AS DECIMAL(18,6))), 2)::DOUBLE AS consumo FROM fact
UNION ALL SELECT 'alertas', count(*), round(sum(CAST(consumo_total_hora AS DECIMAL(18,6))), 2)::DOUBLE FROM alerts"""))
def _(spark, folder):
    """Both queries of the live flow over one stream of records, until all is processed; what each has stored."""
    out, state = scratch_path(spark, "live"), scratch_path(spark, "live-checkpoints")
    for query in start_live(_messages(spark, folder), views.statistics(spark, folder), None, out, state, critical=CRITICAL,
                            hourly_limit=HOURLY, trigger=queries.DRAIN):
        queries.drain(query)
    found = spark.read.parquet(f"{out}/anomalies").select(F.lit("anomalias").alias("consulta"), F.col("consumo_actual").alias("kwh"))
    alerts = queries.stored_alerts(spark, f"{out}/alerts").select(F.lit("alertas"), "consumo_total_hora")
    return found.union(alerts).groupBy("consulta").agg(
        F.count("*").alias("filas"), F.round(exact_sum("kwh"), 2).alias("consumo"))
