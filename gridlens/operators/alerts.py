"""Hourly consumption alerts. The window aggregate runs on a stream (with its watermark) and on stored events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridlens import vocabulary as v
from gridlens.functions.numeric import exact_avg, exact_sum
from gridlens.roles import DEFAULT, Roles

ALERT_KEY = ["window_start", "DEPARTAMENTO", "DISTRITO"]


def alert_message(district: Column, department: Column, total: Column, limit: float = v.HOURLY_KWH) -> Column:
    """Text of an alert; an unknown place is left empty instead of voiding the whole text."""
    return F.concat(
        F.lit("Alerta: consumo de "), F.coalesce(district, F.lit("")),
        F.lit(" ("), F.coalesce(department, F.lit("")),
        F.lit(f") supera {limit:g} kWh/hora: "), F.round(total, 2).cast("string"), F.lit(" kWh"),
    )


def hourly_alerts(events: DataFrame, roles: Roles = DEFAULT, limit: float = v.HOURLY_KWH, hours: str = "1 hour",
                  watermark: str = "1 hour", generated_at: Column | None = None) -> DataFrame:
    """Hours in which a district used more than ``limit`` kWh, over tumbling event-time windows."""
    hourly = (
        events.withWatermark(roles.event_time, watermark)
        .groupBy(F.window(roles.event_time, hours).alias("_w"), roles.department, roles.district)
        .agg(
            exact_sum(roles.consumption).alias("_total"),
            F.count("*").alias("total_eventos"),
            F.round(exact_avg(roles.consumption), 2).alias("consumo_promedio"),
        )
    )
    moment = F.current_timestamp() if generated_at is None else generated_at
    return hourly.filter(F.col("_total") > limit).select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
        F.col(roles.department).alias("DEPARTAMENTO"), F.col(roles.district).alias("DISTRITO"),
        F.round("_total", 2).alias("consumo_total_hora"), "total_eventos", "consumo_promedio",
        moment.alias("fecha_generacion"), F.lit(v.ALERT_LEVEL).alias("nivel"),
        alert_message(F.col(roles.district), F.col(roles.department), F.col("_total"), limit).alias("mensaje"),
    )


def latest_per_key(updates: DataFrame, version: str) -> DataFrame:
    """The newest version of each alert. Aggregated, so repeated updates collapse before the shuffle."""
    rest = [c for c in updates.columns if c not in (*ALERT_KEY, version)]
    newest = updates.groupBy(*ALERT_KEY).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_row"))
    return newest.select(*ALERT_KEY, *[F.col("_row")[c].alias(c) for c in rest])


def merge_alerts(stored: DataFrame, batch: DataFrame, keep: int | None = None) -> DataFrame:
    """Stored alerts overwritten by a batch. All of them stay; ``keep`` is for a reader that wants the newest only."""
    both = stored.withColumn("_version", F.lit(0)).unionByName(batch.withColumn("_version", F.lit(1)))
    merged = latest_per_key(both, "_version").select(*batch.columns)
    return merged if keep is None else latest_alerts(merged, keep)


def latest_alerts(alerts: DataFrame, limit: int = 200) -> DataFrame:
    return alerts.orderBy(F.desc("window_start"), "DEPARTAMENTO", "DISTRITO").limit(limit)


def filter_alerts(alerts: DataFrame, level: str | None = None, department: str | None = None,
                  district: str | None = None) -> DataFrame:
    """Level equals, department and district contain; letter case does not matter."""
    if level:
        alerts = alerts.filter(F.upper("nivel") == level.upper())
    for column, text in (("DEPARTAMENTO", department), ("DISTRITO", district)):
        if text:
            alerts = alerts.filter(F.upper(F.col(column)).contains(text.upper()))
    return alerts


def alert_page(alerts: DataFrame, skip: int = 0, limit: int = 100) -> DataFrame:
    """One page, newest windows first."""
    return alerts.orderBy(F.desc("window_start"), "DEPARTAMENTO", "DISTRITO").offset(skip).limit(limit)


def alert_totals(alerts: DataFrame) -> DataFrame:
    total = exact_sum("consumo_total_hora")
    return alerts.agg(
        F.count("*").alias("total"),
        F.coalesce(F.round(total, 2), F.lit(0.0)).alias("consumo_total_hora"),
        F.when(F.count("*") > 0, F.round(total / F.count("*"), 2)).otherwise(F.lit(0.0)).alias("consumo_promedio_hora"),
    )


def alerts_by_level(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(F.coalesce("nivel", F.lit(v.UNKNOWN)).alias("nivel")).agg(F.count("*").alias("total"))


def alerts_by_department(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(F.coalesce("DEPARTAMENTO", F.lit(v.UNKNOWN)).alias("DEPARTAMENTO")).agg(
        F.count("*").alias("total_alertas"),
        F.round(exact_sum("consumo_total_hora"), 2).alias("consumo_total_hora"),
        F.countDistinct(F.coalesce("DISTRITO", F.lit(""))).alias("distritos_afectados"),
    )
