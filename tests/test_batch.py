import datetime as dt

from conftest import rows
from gridlens import settle
from gridlens.operators import batch, quality
from gridlens.plans.batch_layer import batch_tables

D = dt.date
COLUMNS = (
    "NRO_DOC_FAC string, cliente string, PERIODO int, CONSUMO double, IMPORTE double, FECHA_EMISION date, "
    "DEPARTAMENTO string, DISTRITO string, TARIFA string, CARTERA string"
)


def joined(spark):
    return spark.createDataFrame([
        ("1", "a", 202301, 10.0, 100.0, D(2023, 1, 1), "N", "X", "T1", "C"),
        ("2", "a", 202302, 20.0, 50.0, D(2023, 2, 1), "N", "X", "T1", "C"),
        ("3", "b", 202302, 5.0, 10.0, D(2023, 2, 2), "N", "Y", "T1", "C"),
        ("4", "c", 202301, 7.0, 10.0, None, "S", "Z", "T2", "M"),
        ("5", "c", 202301, 7.0, None, None, "S", "Z", "T2", "M"),
    ], COLUMNS)


def test_statistics_of_single_and_equal_groups(spark):
    stats = batch.historical_statistics(joined(spark))
    assert rows(stats) == [
        ("X", "T1", "C", 15.0, 7.0710678118654755, 75.0, 35.35533905932738, 10.0, 20.0, 2),
        ("Y", "T1", "C", 5.0, 0.0, 10.0, 0.0, 5.0, 5.0, 1),
        ("Z", "T2", "M", 7.0, 0.0, 10.0, 0.0, 7.0, 7.0, 2),
    ]
    check = quality.check_statistics(stats).first()
    assert (check.columnas, check.columnas_esperadas, check.grupos_en_cero, check.oe2_cumplido) == (10, True, 1, False)
    assert quality.check_statistics(stats.filter("DISTRITO <> 'Z'")).first().oe2_cumplido
    assert not quality.check_statistics(stats.drop("consumo_minimo")).first().oe2_cumplido


def test_kpis(spark):
    kpis = dict(rows(batch.global_kpis(joined(spark))))
    assert kpis == {
        "facturacion_total_soles": 170.0, "consumo_total_kwh": 49.0, "total_facturas": 5.0, "ticket_promedio": 42.5,
        "consumo_promedio_global": 9.8, "total_registros": 5.0, "registros_outliers": 0.0, "tasa_outlier_pct": 0.0,
    }
    approximate = dict(rows(batch.global_kpis(joined(spark), approximate_documents=0.05)))
    assert approximate["total_facturas"] == 5.0


def test_kpis_count_outliers_of_either_measure(spark):
    usual = [(str(i), 10.0 + i % 2, 5.0 + i % 3) for i in range(60)]
    df = spark.createDataFrame([*usual, ("x", 900.0, 5.0), ("y", 10.0, 900.0)], "NRO_DOC_FAC string, CONSUMO double, IMPORTE double")
    kpis = dict(rows(batch.global_kpis(df)))
    assert (kpis["registros_outliers"], kpis["tasa_outlier_pct"]) == (2.0, 3.23)
    # Without any spread in one measure nothing counts as an outlier.
    flat = dict(rows(batch.global_kpis(df.selectExpr("NRO_DOC_FAC", "CONSUMO", "1D AS IMPORTE"))))
    assert flat["registros_outliers"] == 0.0


def test_kpis_of_nothing_are_zero(spark):
    assert {x for _, x in rows(batch.global_kpis(joined(spark).limit(0)))} == {0.0}


def test_rankings(spark):
    assert rows(batch.department_ranking(joined(spark))) == [("N", 160.0, 35.0, 3), ("S", 10.0, 14.0, 2)]
    assert rows(batch.monthly_trend(joined(spark))) == [(202301, 110.0, 24.0, 3), (202302, 60.0, 25.0, 2)]
    assert rows(batch.rate_portfolio_analysis(joined(spark))) == [("T1", "C", 160.0, 35 / 3, 3), ("T2", "M", 10.0, 7.0, 2)]
    assert rows(batch.top_customers(joined(spark), "cliente", 2)) == [("a", 30.0), ("c", 14.0)]


def test_rfm(spark):
    rfm = batch.rfm_base(joined(spark), "cliente")
    assert sorted(rows(rfm)) == [("a", 1, 2, 150.0), ("b", 0, 1, 10.0), ("c", 0, 1, 10.0)]
    terciles = batch.rfm_terciles(rfm)
    assert {(c, round(p, 2)): x for c, p, x in rows(terciles)} == {
        ("recency", 0.33): 0.0, ("recency", 0.67): 0.0, ("frequency", 0.33): 1.0, ("frequency", 0.67): 1.0,
        ("monetary", 0.33): 10.0, ("monetary", 0.67): 10.0,
    }
    segments = batch.rfm_segments(rfm, terciles)
    assert rows(segments, "cliente", "r_score", "f_score", "m_score", "rfm_total", "segmento") == [
        ("a", 1, 3, 3, 7, "Cliente activo"), ("b", 3, 1, 1, 5, "En riesgo"), ("c", 3, 1, 1, 5, "En riesgo"),
    ]
    assert rows(batch.rfm_segment_counts(segments)) == [("En riesgo", 2, 66.7), ("Cliente activo", 1, 33.3)]
    sketched = batch.rfm_segments(rfm, batch.rfm_terciles(rfm, 0.01))
    assert rows(sketched, "segmento") == rows(segments, "segmento")


def test_join_drops_unmatched(spark):
    fact = spark.createDataFrame([("1", 1.0), ("9", 2.0)], "NRO_DOC_FAC string, CONSUMO double")
    dim = spark.createDataFrame([("1", "X"), ("2", "Y")], "NRO_DOC_FAC string, DISTRITO string")
    assert rows(batch.join_fact_dim(fact, dim)) == [("1", 1.0, "X")]


def test_batch_tables_reconcile(spark):
    tables = batch_tables(settle(joined(spark)), "cliente")
    assert set(tables) == {
        "tmp_estadisticas_historicas", "kpis_globales", "ranking_departamentos", "tendencia_mensual",
        "analisis_tarifa_cartera", "rfm_clientes",
    }
    check = quality.reconcile_totals(tables["kpis_globales"], {
        n: tables[n] for n in ("ranking_departamentos", "tendencia_mensual", "analisis_tarifa_cartera")
    })
    assert [r.cuadra for r in check.collect()] == [True] * 3
    broken = {"x": tables["tendencia_mensual"].limit(1)}
    assert not quality.reconcile_totals(tables["kpis_globales"], broken).first().cuadra


def test_partial_aggregation_precedes_every_exchange(spark):
    plan = batch.historical_statistics(joined(spark).repartition(3))
    text = plan._jdf.queryExecution().executedPlan().toString()
    final, exchange, partial = (text.index(s) for s in ("HashAggregate(keys", "hashpartitioning(DISTRITO", "partial_sum"))
    assert final < exchange < partial


def test_hierarchy(spark):
    df = spark.createDataFrame([("p", "d1"), ("p", "d2"), ("q", "d1")], "c string, d string")
    assert sorted(rows(quality.hierarchy_consistency(df, "c", "d"))) == [("p", 2, False), ("q", 1, True)]
