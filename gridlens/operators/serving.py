"""Summaries, KPIs and dashboard tables over the anomaly fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridlens import vocabulary as v
from gridlens.functions.numeric import exact_avg, exact_sum, finite_or_null, share_pct
from gridlens.functions.rules import heatmap_risk
from gridlens.functions.text import pad_geo_code
from gridlens.operators import rollup
from gridlens.roles import DEFAULT, Roles
from gridlens.session import settle


def _extreme() -> Column:
    return F.abs("zscore_consumo") > v.Z_EXTREME


def distribution(fact: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; null values are left out."""
    return (
        fact.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("cantidad"))
        .orderBy(F.desc("cantidad"), column)
    )


def anomaly_type_distribution(fact: DataFrame) -> DataFrame:
    return distribution(fact, "tipo_anomalia")


def risk_distribution(fact: DataFrame) -> DataFrame:
    return distribution(fact, "nivel_riesgo")


def region_hourly_accumulation(fact: DataFrame, moment: str = "fecha_deteccion", district: str = "DISTRITO") -> DataFrame:
    """kWh, rows and flagged rows per district and hour of the day."""
    return (
        fact.groupBy(district, F.hour(moment).alias("hour"))
        .agg(
            F.round(exact_sum("consumo_actual"), 2).alias("total_kwh"),
            F.count("*").alias("total_records"),
            F.round(exact_avg("consumo_actual"), 2).alias("avg_consumption"),
            F.count_if("flag_anomalia").alias("anomaly_count"),
        )
        .orderBy(district, "hour")
    )


def anomaly_summary(fact: DataFrame, by: str) -> DataFrame:
    """Count, mean and maximum z-score and risk shares per group; critical rows count in neither share."""
    total = F.count("id_anomalia")
    return (
        fact.filter(F.col(by).isNotNull()).groupBy(by)
        .agg(
            total.alias("total_anomalias"),
            F.round(exact_avg("zscore_consumo"), 4).alias("promedio_zscore"),
            F.max("zscore_consumo").alias("max_zscore"),
            share_pct(F.count_if(F.col("nivel_riesgo") == v.RISK_HIGH), total).alias("riesgo_alto_pct"),
            share_pct(F.count_if(F.col("nivel_riesgo") == v.RISK_LOW), total).alias("riesgo_bajo_pct"),
        )
        .orderBy(F.desc("total_anomalias"), by)
    )


def top5_critical(summary: DataFrame, k: int = 5) -> DataFrame:
    by = summary.columns[0]
    return summary.orderBy(F.desc("total_anomalias"), by).limit(k).select(by, "total_anomalias", "promedio_zscore")


def kpi_report(fact: DataFrame, k: int = 5, base: DataFrame | None = None) -> DataFrame:
    """The whole report as rows (seccion, clave, indicador, valor), so no section has to fit in one row.

    The fact is read once, into ``rollup``; every section is projected from that (``base``, where it is there already).
    """
    base = settle(rollup.rollup(fact), "anomaly-rollup") if base is None else base
    sections = [
        part.unpivot([], part.columns, "indicador", "valor")
        .select(F.lit(rollup.GENERAL).alias("seccion"), F.lit("").alias("clave"), "indicador", "valor")
        for part in (rollup.general(base), rollup.affected(base))
    ]
    for section, column in (("distribucion_tipo_anomalia", "tipo_anomalia"), ("distribucion_nivel_riesgo", "nivel_riesgo")):
        sections.append(_as_section(rollup.distribution(base, column), section))
    for section, column in (("top_5_distritos_criticos", "distrito"), ("top_5_tarifas_criticas", "tarifa")):
        sections.append(_as_section(top5_critical(rollup.summary(base, column), k), section))
    sections.append(_as_section(rollup.summary(base, "cartera"), "resumen_cartera"))
    report, *others = sections
    for section in others:
        report = report.unionByName(section)
    return report


def _as_section(table: DataFrame, section: str) -> DataFrame:
    key, *values = table.columns
    doubles = table.select(key, *[F.col(c).cast("double").alias(c) for c in values])
    return doubles.unpivot([key], values, "indicador", "valor").select(
        F.lit(section).alias("seccion"), F.col(key).cast("string").alias("clave"), "indicador", "valor"
    )


def dashboard_kpis(fact: DataFrame, validity_pct: Column | None = None) -> DataFrame:
    """Headline figures; the loader's validity is passed in, never assumed."""
    anomalies = F.count_if(_extreme())
    return fact.agg(
        F.count("*").alias("registros_procesados"),
        anomalies.alias("anomalias_reales"),
        share_pct(anomalies, F.count("*"), 4).alias("tasa_anomalia_pct"),
        F.coalesce(exact_sum("consumo_actual"), F.lit(0.0)).alias("consumo_total_kwh"),
        anomalies.alias("alertas_criticas"),
        F.coalesce(exact_sum("importe_actual"), F.lit(0.0)).alias("facturacion_total_soles"),
    ).withColumn("loader_validez_pct", F.lit(None).cast("double") if validity_pct is None else validity_pct)


def district_heatmap(fact: DataFrame) -> DataFrame:
    """Rows, extreme rows, their share and the risk colour of each district."""
    rate = share_pct(F.col("anomalias_reales"), F.col("total_registros"), None)
    return (
        fact.filter(F.col("distrito").isNotNull()).groupBy("distrito")
        .agg(F.count("*").alias("total_registros"), F.count_if(_extreme()).alias("anomalias_reales"))
        .withColumns({"tasa_anomalia_pct": F.round(rate, 4), "riesgo": heatmap_risk(rate)})
    )


def district_places(dim: DataFrame, roles: Roles = DEFAULT, first_by: Sequence[str] | None = None) -> DataFrame:
    """Department and geographic code of each district: its first dimension row."""
    first_by = list(first_by or [roles.department, roles.geo_code])
    order = F.struct(*first_by)
    place = F.struct(F.col(roles.department).alias("departamento"), F.col(roles.geo_code).alias("ubigeo"))
    return (
        dim.filter(F.col(roles.district).isNotNull())
        # Hash distinct first: few places are left for min_by, which sorts its input.
        .select(*dict.fromkeys([roles.district, roles.department, roles.geo_code, *first_by])).distinct()
        .groupBy(F.col(roles.district).alias("distrito")).agg(F.min_by(place, order).alias("_p"))
        .select("distrito", "_p.departamento", F.col("_p.ubigeo").cast("string").alias("ubigeo"))
    )


def district_heatmap_join(heatmap: DataFrame, places: DataFrame, centroids: DataFrame,
                          default_department: str = v.DEFAULT_DEPARTMENT) -> DataFrame:
    """Put the heatmap on the map; unknown places get the default department, no code and (0, 0)."""
    located = heatmap.join(places, "distrito", "left").withColumns({
        "departamento": F.coalesce("departamento", F.lit(default_department)),
        "ubigeo": F.coalesce("ubigeo", F.lit("")),
    })
    points = centroids.select(F.col("IDDIST").alias("_code"), "lat", "lon")
    return located.join(points, pad_geo_code(F.col("ubigeo")) == F.col("_code"), "left").select(
        "distrito", "departamento", "ubigeo",
        F.coalesce("lat", F.lit(0.0)).alias("lat"), F.coalesce("lon", F.lit(0.0)).alias("lon"),
        "total_registros", "anomalias_reales", "tasa_anomalia_pct", "riesgo",
    )


def choropleth(heatmap: DataFrame) -> DataFrame:
    return heatmap.select(
        pad_geo_code(F.coalesce("ubigeo", F.lit(""))).alias("ubigeo"),
        "tasa_anomalia_pct", "anomalias_reales", "total_registros", "distrito", "departamento",
    )


# Row labels of the risk split.
NORMAL_ROWS = "Consumo normal (z<3)"
EXTREME_ROWS = "Anomalia real (z>3)"


def risk_split(fact: DataFrame) -> DataFrame:
    """Two rows: normal and extreme, with their shares."""
    return _split(fact.agg(
        F.count_if(F.abs("zscore_consumo") <= v.Z_EXTREME).alias(NORMAL_ROWS),
        F.count_if(_extreme()).alias(EXTREME_ROWS),
    ))


def _split(counts: DataFrame) -> DataFrame:
    counts = counts.withColumn("_all", F.col(f"`{NORMAL_ROWS}`") + F.col(f"`{EXTREME_ROWS}`"))
    return counts.unpivot(["_all"], [F.col(f"`{NORMAL_ROWS}`"), F.col(f"`{EXTREME_ROWS}`")],
                          "nivel_riesgo", "cantidad").select(
        "nivel_riesgo", "cantidad", share_pct(F.col("cantidad"), F.col("_all")).alias("pct")
    )


def top_districts_by_rate(heatmap: DataFrame, k: int = 30) -> DataFrame:
    return heatmap.orderBy(F.desc("tasa_anomalia_pct"), "distrito").limit(k).select("distrito", "tasa_anomalia_pct")


def top_districts_by_anomalies(fact: DataFrame, k: int = 10) -> DataFrame:
    return distribution(fact, "distrito").limit(k)


def top_districts_by_mean_z(fact: DataFrame, k: int = 10) -> DataFrame:
    return (
        fact.filter(F.col("distrito").isNotNull()).groupBy("distrito")
        .agg(exact_avg("zscore_consumo").alias("zscore_promedio"))
        .orderBy(F.desc("zscore_promedio"), "distrito").limit(k)
    )


def _total_order(df: DataFrame, order_by: str) -> list[str]:
    """Repeated events share an id; the other columns then decide which row comes first."""
    return [order_by, *[c for c in df.columns if c != order_by]]


def zscore_sample(fact: DataFrame, k: int = 200, order_by: str = "id_anomalia") -> DataFrame:
    return fact.orderBy(*_total_order(fact, order_by)).limit(k).select("distrito", "zscore_consumo")


def json_safe(df: DataFrame) -> DataFrame:
    """NaN and infinities in any floating column become null."""
    floating = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: finite_or_null(F.col(c)) for c in floating})


def anomaly_feed(fact: DataFrame, k: int = 500, order_by: str = "id_anomalia") -> DataFrame:
    """The first extreme rows, ready for JSON."""
    return json_safe(fact.filter(_extreme()).orderBy(*_total_order(fact, order_by)).limit(k))


def monthly_mean_trend(fact: DataFrame, period: str = "periodo", consumption: str = "consumo_actual",
                       amount: str = "importe_actual") -> DataFrame:
    return (
        fact.groupBy(F.col(period).alias("periodo"))
        .agg(exact_avg(consumption).alias("consumo_promedio"), exact_avg(amount).alias("importe_promedio"))
        .orderBy("periodo")
    )


def events_per_day(events: DataFrame, issued: str = DEFAULT.issued) -> DataFrame:
    day = F.to_date(F.col(issued))
    return events.filter(day.isNotNull()).groupBy(day.alias("fecha")).agg(F.count("*").alias("eventos")).orderBy("fecha")


def dashboard_tables(fact: DataFrame, dim: DataFrame, centroids: DataFrame, trend: DataFrame,
                     validity_pct: Column | None = None, roles: Roles = DEFAULT,
                     base: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables a front end reads, by file name; all but the samples of rows are projected from the rollup."""
    base = settle(rollup.rollup(fact), "anomaly-rollup") if base is None else base
    heatmap = district_heatmap_join(rollup.district_heatmap(base), district_places(dim, roles), centroids)
    loader = rollup.merged(base).select(F.col("filas").alias("total_filas")).withColumn(
        "validez_pct", F.lit(None).cast("double") if validity_pct is None else validity_pct
    )
    by_group = [
        rollup.summary(base, c).withColumnRenamed(c, "clave").withColumn("resumen", F.lit(name))
        for c, name in (("tarifa", "by_tariff"), ("cartera", "by_cartera"))
    ]
    return {
        "kpis": rollup.dashboard_kpis(base, validity_pct),
        "district_heatmap": heatmap,
        "corrected_risk": _split(rollup.merged(base).select(
            F.col("normales").alias(NORMAL_ROWS), F.col("extremas").alias(EXTREME_ROWS))),
        "batch_trend": trend,
        "chart_districts_rate": top_districts_by_rate(heatmap),
        "chart_zscore": zscore_sample(fact),
        "loader_stats": loader,
        "simulated_stream": anomaly_feed(fact),
        "summaries": by_group[0].unionByName(by_group[1]),
        "choropleth_data": choropleth(heatmap),
    }
