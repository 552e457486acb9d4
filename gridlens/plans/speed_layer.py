"""Events to classified anomalies and hourly alerts, live or from a stored event set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gridlens import vocabulary as v
from gridlens.operators import scoring
from gridlens.operators.alerts import hourly_alerts
from gridlens.roles import DEFAULT, Roles
from gridlens.operators.serving import region_hourly_accumulation
from gridlens.sinks.files import write_report
from gridlens.streaming import queries, versions
from gridlens.streaming.progress import check_latencies, latency_report, read_progress


def anomalies(events: DataFrame, stats: DataFrame, dim: DataFrame | None = None, roles: Roles = DEFAULT,
              key: str | None = None, dim_columns: Sequence[str] | None = None, critical: float = v.CRITICAL_KWH,
              detected_at: Column | None = None) -> DataFrame:
    """The seventeen anomaly columns. Stateless, so a stream and a stored event set give the same rows."""
    enriched = scoring.enrich_events(events, stats, dim, roles, key, dim_columns)
    classified = scoring.classify(enriched, critical, detected_at)
    return scoring.conform_anomaly_fact(classified, critical=critical)


def start_live(records: DataFrame, stats: DataFrame, dim: DataFrame | None, out: str, checkpoints: str,
               roles: Roles = DEFAULT, critical: float = v.CRITICAL_KWH, hourly_limit: float = v.HOURLY_KWH,
               alert_servers: str | None = None, alert_topic: str | None = None,
               trigger: dict | None = None, keep: int | None = None) -> list[StreamingQuery]:
    """Anomalies to Parquet, alerts to a table (all of them unless ``keep`` says how many) and, when a broker is
    given, to a topic.

    Events carry their location. Give ``dim`` only where it has to come from a table instead: both streams then join it
    in every micro-batch (see ``write_bucketed``).
    """
    events = scoring.parse_event(records, roles)
    scored = anomalies(events, stats, dim, roles, critical=critical)
    alerts = hourly_alerts(events if dim is None else scoring.add_location(events, dim, roles), roles, hourly_limit)
    started = [
        queries.stream_to_parquet(scored, f"{out}/anomalies", f"{checkpoints}/anomalies", trigger),
        queries.upsert_alerts(alerts, f"{out}/alerts", f"{checkpoints}/alerts", keep, trigger),
    ]
    if alert_servers and alert_topic:
        started.append(queries.stream_alerts_to_kafka(
            alerts, alert_servers, alert_topic, f"{checkpoints}/alert-topic", trigger
        ))
    return started


def start_versioned(records: DataFrame, statistics: str, out: str, checkpoint: str, roles: Roles = DEFAULT,
                    critical: float = v.CRITICAL_KWH, trigger: dict | None = None) -> StreamingQuery:
    """Anomalies scored with the newest published statistics (``versions.publish``) of each micro-batch."""
    events = scoring.parse_event(records, roles)
    return versions.with_versions(
        events, statistics, lambda batch, stats: anomalies(batch, stats, roles=roles, critical=critical), out, checkpoint, trigger)


def report_speed_layer(spark: SparkSession, progress: str, found: DataFrame, out: str,
                       district: str = "distrito") -> dict[str, DataFrame]:
    """Store the latency of every query with its gate, and the consumption of each district by hour of the day."""
    tables = {
        "reporte_latencia": check_latencies(latency_report(read_progress(spark, progress))),
        "acumulado_horario": region_hourly_accumulation(found, district=district),
    }
    for name, table in tables.items():
        write_report(table, f"{out}/{name}")
    return {name: spark.read.schema(table.schema).json(f"{out}/{name}") for name, table in tables.items()}
