import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gridlens import settle, vocabulary as v
from gridlens.operators import quality, scoring

STATS = (
    "DISTRITO string, TARIFA string, CARTERA string, consumo_promedio double, consumo_std double, "
    "importe_promedio double, importe_std double, consumo_minimo double, consumo_maximo double, total_registros bigint"
)

def now():
    return F.lit("2024-01-01 10:00:00").cast("timestamp")



@pytest.fixture
def stats(spark):
    return spark.createDataFrame([
        ("X", "T1", "C", 100.0, 10.0, 50.0, 5.0, 80.0, 130.0, 9),
        ("X", "T2", "C", 10.0, 0.0, 5.0, 0.0, 10.0, 10.0, 1),
        ("Y", "T1", "C", 0.0, 4.0, 5.0, 0.0, 0.0, 10.0, 3),
    ], STATS)


@pytest.fixture
def events(spark):
    return spark.createDataFrame([
        ("e1", 202401, 131.0, 1.0, "X", "T1", "C"), ("e2", 202401, 79.0, 1.0, "X", "T1", "C"),
        ("e3", 202401, 30.0, 1.0, "X", "T2", "C"), ("e4", 202401, 8.0, 1.0, "Y", "T1", "C"),
        ("e5", 202401, 600.0, 1.0, "Q", "T1", "C"), ("e6", 202401, None, 1.0, "X", "T1", "C"),
    ], "NRO_DOC_FAC string, PERIODO int, CONSUMO double, IMPORTE double, DISTRITO string, TARIFA string, CARTERA string")


def test_enrich_and_classify(events, stats):
    enriched = scoring.enrich_events(events, stats)
    assert len(enriched.columns) == 12
    out = scoring.classify(enriched, detected_at=now())
    got = {r[0]: r[1:] for r in rows(
        out, "NRO_DOC_FAC", "zscore_consumo", "porcentaje_variacion", "tipo_anomalia", "nivel_riesgo")}
    assert got == {
        "e1": (3.1, 31.0, v.EXTREME, v.RISK_HIGH),
        "e2": (-2.1, -21.0, v.SUSPICIOUSLY_LOW, v.RISK_LOW),
        "e3": (0.0, 200.0, v.SUDDEN, v.RISK_LOW),       # no deviation known
        "e4": (2.0, 0.0, v.HIGH, v.RISK_MEDIUM),         # mean 0
        "e5": (0.0, 0.0, "Alerta consumo crítico > 500 kWh", v.RISK_CRITICAL),  # no group
        "e6": (None, None, v.MODERATE, v.RISK_LOW),
    }
    assert out.filter("flag_anomalia").count() == 6


def test_dimension_replaces_event_columns(events, spark):
    dim = spark.createDataFrame([("e1", "D", "P", "Z")], "NRO_DOC_FAC string, DEPARTAMENTO string, PROVINCIA string, DISTRITO string")
    located = scoring.add_location(events, dim)
    assert located.count() == 6
    assert {r[0]: r[1:] for r in rows(located, "NRO_DOC_FAC", "DEPARTAMENTO", "DISTRITO")}["e1"] == ("D", "Z")
    assert {r[0]: r[1] for r in rows(located, "NRO_DOC_FAC", "DISTRITO")}["e2"] is None


def test_written_statistics_are_broadcast_by_size(events, stats, spark):
    scored = scoring.join_event_stats(events, settle(stats))
    assert "BroadcastHashJoin" in scored._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        beyond = scoring.join_event_stats(events, settle(stats))
        assert "SortMergeJoin" in beyond._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parse_event(spark):
    record = [
        ("7", '{"NRO_DOC_FAC":"7","PERIODO":"202401","CONSUMO":"1.5","IMPORTE":"x","FECHA_EMISION":"2024-01-02","extra":1}'),
        ("8", "not json"), (None, '{"CONSUMO":"2"}'),
    ]
    raw = spark.createDataFrame(record, "key string, value string").select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        now().alias("timestamp"), F.lit(5).cast("bigint").alias("offset"), F.lit(0).alias("partition"),
    )
    parsed = scoring.parse_event(raw)
    assert rows(parsed, "NRO_DOC_FAC_key", "NRO_DOC_FAC", "PERIODO", "CONSUMO", "IMPORTE", "offset") == [
        ("7", "7", 202401, 1.5, None, 5), ("8", None, None, None, None, 5), (None, None, None, 2.0, None, 5),
    ]
    assert parsed.first()["FECHA_EMISION"] == dt.datetime(2024, 1, 2)
    assert len(parsed.columns) == 19


def test_conform_fills_what_is_missing(spark):
    df = spark.createDataFrame([("1", "9.5", None), ("2", "700", "2.5")], "NRO_DOC_FAC string, CONSUMO string, zscore_consumo string")
    fact = scoring.conform_anomaly_fact(df, detected_at=now())
    assert fact.columns == v.ANOMALY_FACT
    assert rows(fact, "nro_doc_fac", "consumo_actual", "zscore_consumo", "tipo_anomalia", "nivel_riesgo",
                "fecha_deteccion", "flag_anomalia", "desviacion_consumo", "distrito") == [
        ("1", 9.5, 0.0, v.MODERATE, v.RISK_LOW, "2024-01-01 10:00:00", True, 0.0, None),
        ("2", 700.0, 2.5, v.HIGH, v.RISK_CRITICAL, "2024-01-01 10:00:00", True, 0.0, None),
    ]
    check = quality.check_anomaly_fact(fact).first()
    assert (check.num_columnas, check.nulos_zscore, check.pct_flag_true, check.oe4_cumplido) == (17, 0, 100.0, True)
    assert not quality.check_anomaly_fact(fact.limit(0)).first().oe4_cumplido
    assert not quality.check_anomaly_fact(fact.drop("distrito")).first().oe4_cumplido


def test_ids_are_stable_or_random(spark):
    df = spark.createDataFrame([("1",), (None,)], "k string")
    assert rows(scoring.add_anomaly_id(df, ["k"])) == rows(scoring.add_anomaly_id(df, ["k"]))
    assert scoring.add_anomaly_id(df, ["k"], random=True).first()[1].count("-") == 4


def test_fallback_chain(spark, stats):
    requests = spark.createDataFrame([
        ("x", "t1", "c", 131.0),      # exact in another letter case
        ("X", "T2", "C", 30.0),       # exact, deviation 0 counts as 1
        ("X", "other", "C", 131.0),   # first group of the district
        ("y", "T1", "C", 8.0),        # mean 0 counts as 1 in the variation
        ("nowhere", "T1", "C", 80.0), # overall mean
    ], "distrito string, tarifa string, cartera string, consumo_actual double")
    got = {r[0] + r[1]: r[2:] for r in rows(
        scoring.score_with_fallback(requests, stats), "distrito", "tarifa", "zscore", "porcentaje_variacion",
        "consumo_promedio", "desviacion_estandar")}
    overall, spread = 110 / 3, 14 / 3
    assert got == {
        "xt1": (3.1, 31.0, 100.0, 10.0), "XT2": (20.0, 200.0, 10.0, 1.0), "Xother": (3.1, 31.0, 100.0, 10.0),
        "yT1": (2.0, 800.0, 0.0, 4.0),
        "nowhereT1": (round((80 - overall) / spread, 4), round((80 - overall) / overall * 100, 2), 36.67, 4.67),
    }


def test_drawn_dimensions_are_uniform_and_clipped(spark, stats):
    events = spark.range(3000).selectExpr("CAST(id AS string) AS NRO_DOC_FAC", "1000D AS CONSUMO_ACTUAL", "'old' AS distrito")
    drawn = settle(scoring.assign_dimensions(events, settle(stats), "nro_doc_fac"))
    assert drawn.count() == 3000
    unkeyed = events.limit(2).withColumn("NRO_DOC_FAC", F.lit(None).cast("string"))
    assert scoring.assign_dimensions(unkeyed, settle(stats), "nro_doc_fac").filter("tarifa IS NOT NULL").count() == 2
    assert scoring.assign_dimensions(events, settle(stats.limit(0)), "nro_doc_fac").count() == 3000
    share = dict(rows(drawn.groupBy(F.concat("distrito", "tarifa")).count()))
    assert set(share) == {"XT1", "XT2", "YT1"} and all(900 < n < 1100 for n in share.values())
    assert drawn.agg(F.max("zscore_consumo"), F.max("porcentaje_variacion")).first() == (5.0, 500.0)
    again = scoring.assign_dimensions(events, settle(stats), "nro_doc_fac")
    assert sorted(rows(again)) == sorted(rows(drawn))
