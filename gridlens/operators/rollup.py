"""One aggregate of the anomaly fact, from which the report, the summaries and the dashboard tables are projected.

The fact is read once. A row stands for one district, rate, portfolio, type and risk, and all its columns add up, so whatever
groups of these are asked for are sums over this small table and not over the fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridlens import vocabulary as v
from gridlens.functions.numeric import exact_sum_of, exact_sum_parts, share_pct
from gridlens.functions.rules import heatmap_risk

KEYS = ("distrito", "tarifa", "cartera", "tipo_anomalia", "nivel_riesgo")
MEASURES = ("zscore_consumo", "consumo_actual", "importe_actual")
COUNTS = ("filas", "con_id", "con_zscore", "sin_zscore", "con_bandera", "extremas", "normales")
GENERAL = "resumen_general"


def rollup(fact: DataFrame) -> DataFrame:
    z = F.col("zscore_consumo")
    return fact.groupBy(*KEYS).agg(
        F.count("*").alias("filas"), F.count("id_anomalia").alias("con_id"), F.count(z).alias("con_zscore"),
        F.count_if(z.isNull()).alias("sin_zscore"), F.count_if("flag_anomalia").alias("con_bandera"),
        F.count_if(F.abs(z) > v.Z_EXTREME).alias("extremas"), F.count_if(F.abs(z) <= v.Z_EXTREME).alias("normales"),
        F.max(z).alias("max_zscore"), *[part for m in MEASURES for part in exact_sum_parts(m)],
    )


def merged(base: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts, sums and the highest score of each group of ``by``; rows whose keys are null are left out."""
    for key in by:
        base = base.filter(F.col(key).isNotNull())
    high, low = (F.sum(F.when(F.col("nivel_riesgo") == r, F.col("filas"))) for r in (v.RISK_HIGH, v.RISK_LOW))
    return base.groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS], F.max("max_zscore").alias("max_zscore"),
        F.coalesce(high, F.lit(0)).alias("altas"), F.coalesce(low, F.lit(0)).alias("bajas"),
        *[exact_sum_of(m).alias(m) for m in MEASURES],
    )


def _mean_z() -> Column:
    return F.when(F.col("con_zscore") > 0, F.col("zscore_consumo") / F.col("con_zscore"))


def distribution(base: DataFrame, column: str) -> DataFrame:
    counted = merged(base, [column]).select(column, F.col("filas").alias("cantidad"))
    return counted.orderBy(F.desc("cantidad"), column)


def summary(base: DataFrame, by: str) -> DataFrame:
    total = F.col("con_id")
    return merged(base, [by]).select(
        by, total.alias("total_anomalias"), F.round(_mean_z(), 4).alias("promedio_zscore"), "max_zscore",
        share_pct(F.col("altas"), total).alias("riesgo_alto_pct"), share_pct(F.col("bajas"), total).alias("riesgo_bajo_pct"),
    ).orderBy(F.desc("total_anomalias"), by)


def general(base: DataFrame) -> DataFrame:
    """Figures of the whole fact, and how many districts, rates and portfolios it touches."""
    return merged(base).select(
        F.col("filas").cast("double").alias("total_anomalias_detectadas"),
        F.round(_mean_z(), 4).alias("promedio_zscore_global"), F.round("max_zscore", 4).alias("max_zscore_global"),
        share_pct(F.col("altas"), F.col("filas")).alias("pct_anomalias_nivel_alto"),
        share_pct(F.col("con_bandera"), F.col("filas")).alias("pct_flag_true"),
        F.col("sin_zscore").cast("double").alias("nulos_zscore"),
    )


def affected(base: DataFrame) -> DataFrame:
    counts = {"distrito": "total_distritos_afectados", "tarifa": "total_tarifas_afectadas", "cartera": "total_carteras_afectadas"}
    return base.select(*counts).distinct().agg(
        *[F.countDistinct(c).cast("double").alias(name) for c, name in counts.items()])


def dashboard_kpis(base: DataFrame, validity_pct: Column | None = None) -> DataFrame:
    return merged(base).select(
        F.col("filas").alias("registros_procesados"), F.col("extremas").alias("anomalias_reales"),
        share_pct(F.col("extremas"), F.col("filas"), 4).alias("tasa_anomalia_pct"),
        F.coalesce("consumo_actual", F.lit(0.0)).alias("consumo_total_kwh"), F.col("extremas").alias("alertas_criticas"),
        F.coalesce("importe_actual", F.lit(0.0)).alias("facturacion_total_soles"),
    ).withColumn("loader_validez_pct", F.lit(None).cast("double") if validity_pct is None else validity_pct)


def district_heatmap(base: DataFrame) -> DataFrame:
    rate = share_pct(F.col("extremas"), F.col("filas"), None)
    return merged(base, ["distrito"]).select(
        "distrito", F.col("filas").alias("total_registros"), F.col("extremas").alias("anomalias_reales"),
        F.round(rate, 4).alias("tasa_anomalia_pct"), heatmap_risk(rate).alias("riesgo"))
