import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gridlens import vocabulary as v
from gridlens.operators import alerts, quality, serving

FACT = "id_anomalia string, distrito string, tarifa string, cartera string, consumo_actual double, importe_actual double, zscore_consumo double, tipo_anomalia string, nivel_riesgo string, flag_anomalia boolean, periodo int"


@pytest.fixture
def fact(spark):
    return spark.createDataFrame([
        ("1", "X", "T1", "C", 10.0, 1.0, 3.5, v.EXTREME, v.RISK_HIGH, True, 202401),
        ("2", "X", "T1", "C", 20.0, 2.0, 0.5, v.MODERATE, v.RISK_LOW, True, 202401),
        ("3", "X", "T2", "M", 600.0, 3.0, -4.0, v.SUSPICIOUSLY_LOW, v.RISK_CRITICAL, True, 202402),
        ("4", "Y", "T1", "C", 40.0, 4.0, 1.0, v.MODERATE, v.RISK_LOW, True, 202402),
        ("5", None, "T1", None, 50.0, math.inf, 0.0, v.MODERATE, v.RISK_MEDIUM, True, 202402),
    ], FACT)


def test_summary_leaves_out_null_groups_and_critical_rows(fact):
    assert rows(serving.anomaly_summary(fact, "distrito")) == [
        ("X", 3, 0.0, 3.5, 33.33, 33.33), ("Y", 1, 1.0, 1.0, 0.0, 100.0),
    ]
    assert rows(serving.top5_critical(serving.anomaly_summary(fact, "tarifa"), 1)) == [("T1", 4, 1.25)]


def test_distributions(fact):
    assert rows(serving.anomaly_type_distribution(fact))[0] == (v.MODERATE, 3)
    assert rows(serving.risk_distribution(fact))[0] == (v.RISK_LOW, 2)
    assert rows(serving.top_districts_by_anomalies(fact)) == [("X", 3), ("Y", 1)]
    assert rows(serving.top_districts_by_mean_z(fact)) == [("Y", 1.0), ("X", 0.0)]


def test_headline_figures(fact):
    row = serving.dashboard_kpis(fact.filter("id_anomalia <> '5'"), F.lit(88.5)).first().asDict()
    assert row == {
        "registros_procesados": 4, "anomalias_reales": 2, "tasa_anomalia_pct": 50.0, "consumo_total_kwh": 670.0,
        "alertas_criticas": 2, "facturacion_total_soles": 10.0, "loader_validez_pct": 88.5,
    }
    assert rows(serving.risk_split(fact)) == [("Consumo normal (z<3)", 3, 60.0), ("Anomalia real (z>3)", 2, 40.0)]
    assert rows(serving.risk_split(fact.limit(0))) == [("Consumo normal (z<3)", 0, 0.0), ("Anomalia real (z>3)", 0, 0.0)]


def test_map(spark, fact):
    dim = spark.createDataFrame([("X", "B", "130101"), ("X", "A", "101"), (None, "Z", "9")], "DISTRITO string, DEPARTAMENTO string, UBIGEO string")
    centroids = spark.createDataFrame([("000101", -8.0, -79.0)], "IDDIST string, lat double, lon double")
    heat = serving.district_heatmap_join(serving.district_heatmap(fact), serving.district_places(dim), centroids)
    assert sorted(rows(heat)) == [
        ("X", "A", "101", -8.0, -79.0, 3, 2, 66.6667, v.RISK_HIGH),
        ("Y", "LA LIBERTAD", "", 0.0, 0.0, 1, 0, 0.0, v.RISK_LOW),
    ]
    assert sorted(rows(serving.choropleth(heat), "ubigeo", "distrito")) == [("", "Y"), ("000101", "X")]
    assert rows(serving.top_districts_by_rate(heat, 1)) == [("X", 66.6667)]


def test_feed_is_json_safe(fact):
    feed = serving.anomaly_feed(fact.withColumn("zscore_consumo", F.lit(9.0)))
    assert [r.importe_actual for r in feed.collect()] == [1.0, 2.0, 3.0, 4.0, None]
    assert rows(serving.zscore_sample(fact, 2)) == [("X", 3.5), ("X", 0.5)]


def test_report(fact):
    report = {(r.seccion, r.clave, r.indicador): r.valor for r in serving.kpi_report(fact).collect()}
    assert report["resumen_general", "", "total_anomalias_detectadas"] == 5.0
    assert report["resumen_general", "", "total_distritos_afectados"] == 2.0
    assert report["resumen_general", "", "pct_anomalias_nivel_alto"] == 20.0
    assert report["distribucion_nivel_riesgo", v.RISK_CRITICAL, "cantidad"] == 1.0
    assert report["top_5_distritos_criticos", "X", "total_anomalias"] == 3.0
    assert report["resumen_cartera", "C", "riesgo_alto_pct"] == 33.33


def test_trends(spark, fact):
    assert rows(serving.monthly_mean_trend(fact.filter("id_anomalia <> '5'"))) == [(202401, 15.0, 1.5), (202402, 320.0, 3.5)]
    events = spark.createDataFrame([("2024-01-01",), ("2024-01-01",), (None,)], "d string").selectExpr("CAST(d AS date) AS FECHA_EMISION")
    assert [r.eventos for r in serving.events_per_day(events).collect()] == [2]
    hours = fact.withColumn("fecha_deteccion", F.lit("2024-01-01 05:30:00").cast("timestamp"))
    accumulated = serving.region_hourly_accumulation(hours.filter("distrito = 'X'"), district="distrito")
    assert rows(accumulated) == [("X", 5, 630.0, 3, 210.0, 3)]


def test_outputs_gate(fact):
    assert quality.check_outputs({"fact": fact, "other": fact}).first()["oe5_cumplido"]
    row = quality.check_outputs({"fact": fact, "other": fact.limit(0)}).first()
    assert (row["fact"], row["other"], row["oe5_cumplido"]) == (True, False, False)


ALERTS = "window_start timestamp, window_end timestamp, DEPARTAMENTO string, DISTRITO string, consumo_total_hora double, nivel string"


@pytest.fixture
def stored(spark):
    return spark.createDataFrame([
        ("2024-01-01 10", "2024-01-01 11", "La Libertad", "Trujillo", 600.0, "CRITICO"),
        ("2024-01-01 11", "2024-01-01 12", "La Libertad", "Moche", 700.5, "CRITICO"),
        ("2024-01-01 12", "2024-01-01 13", "Ancash", "Chimbote", 800.0, None),
    ], ALERTS.replace("timestamp", "string")).withColumns(
        {c: F.to_timestamp(c, "yyyy-MM-dd HH") for c in ("window_start", "window_end")})


def test_alert_queries(stored):
    def names(df):
        return [r.DISTRITO for r in df.collect()]

    assert names(alerts.filter_alerts(stored, "critico", "LIBERTAD")) == ["Trujillo", "Moche"]
    assert names(alerts.filter_alerts(stored, district="mO")) == ["Moche"]
    assert names(alerts.latest_alerts(stored, 2)) == ["Chimbote", "Moche"]
    assert names(alerts.alert_page(stored, 1, 1)) == ["Moche"]


def test_alert_statistics(stored):
    assert rows(alerts.alert_totals(stored)) == [(3, 2100.5, 700.17)]
    assert rows(alerts.alert_totals(stored.limit(0))) == [(0, 0.0, 0.0)]
    assert dict(rows(alerts.alerts_by_level(stored))) == {"CRITICO": 2, "DESCONOCIDO": 1}
    assert sorted(rows(alerts.alerts_by_department(stored))) == [("Ancash", 1, 800.0, 1), ("La Libertad", 2, 1300.5, 2)]


def test_merge_keeps_the_last_write_and_the_newest(stored):
    batch = stored.filter("DISTRITO = 'Moche'").withColumn("consumo_total_hora", F.lit(999.0))
    merged = alerts.merge_alerts(stored, batch, keep=2)
    assert rows(merged, "DISTRITO", "consumo_total_hora") == [("Chimbote", 800.0), ("Moche", 999.0)]
    # The department belongs to the key: districts of the same name do not overwrite each other.
    elsewhere = batch.withColumn("DEPARTAMENTO", F.lit("Piura"))
    assert alerts.merge_alerts(stored, elsewhere, keep=None).count() == 4


def test_message_survives_unknown_places(spark):
    df = spark.createDataFrame([("X", None, 512.345)], "d string, p string, t double")
    text = df.select(alerts.alert_message(F.col("d"), F.col("p"), F.col("t"))).first()[0]
    assert text == "Alerta: consumo de X () supera 500 kWh/hora: 512.35 kWh"
