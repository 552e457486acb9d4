"""Everything projected from the rollup against the same taken from the fact itself."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gridlens import settle
from gridlens.operators import rollup, serving

SCHEMA = ("id_anomalia string, distrito string, tarifa string, cartera string, tipo_anomalia string, nivel_riesgo string, "
          "zscore_consumo double, consumo_actual double, importe_actual double, flag_anomalia boolean")


@pytest.fixture(scope="module")
def fact(spark):
    draw = random.Random(4)
    some = lambda *values: draw.choice([None, *values])
    made = [(some(f"a{k}"), some("X", "Y", "Z"), some("T1", "T2"), some("C"), some("alto", "bajo"), some("Alto", "Bajo", "Crítico"),
             some(draw.gauss(0, 3), 3.0, 3.0000001, 1e12), some(draw.uniform(0, 9)), draw.uniform(0, 1e6), draw.random() < 0.9) for k in range(800)]
    return settle(spark.createDataFrame(made, SCHEMA).repartition(5), "fact")


@pytest.fixture(scope="module")
def base(fact):
    return settle(rollup.rollup(fact), "rollup")


def same(a, b):
    assert a.columns == b.columns
    got, want = (sorted(map(repr, rows(x))) for x in (a, b))
    assert got == want


def test_summaries_and_distributions(fact, base):
    for key in ("distrito", "tarifa", "cartera"):
        same(rollup.summary(base, key), serving.anomaly_summary(fact, key))
    for key in ("tipo_anomalia", "nivel_riesgo"):
        same(rollup.distribution(base, key), serving.distribution(fact, key))


def test_dashboard(fact, base):
    same(rollup.dashboard_kpis(base), serving.dashboard_kpis(fact))
    same(rollup.district_heatmap(base), serving.district_heatmap(fact))
    tables = serving.dashboard_tables(
        fact, fact.sparkSession.createDataFrame([], "DEPARTAMENTO string, DISTRITO string, UBIGEO string"),
        fact.sparkSession.createDataFrame([], "IDDIST string, lat double, lon double"), fact.select(F.lit(1).alias("periodo")), base=base)
    same(tables["corrected_risk"], serving.risk_split(fact))
    assert tables["loader_stats"].first().total_filas == 800


def test_an_empty_fact(fact):
    empty = fact.limit(0)
    same(rollup.dashboard_kpis(rollup.rollup(empty)), serving.dashboard_kpis(empty))
    assert rollup.summary(rollup.rollup(empty), "distrito").count() == 0


def test_the_report_reads_the_rollup_only(fact, base):
    plan = serving.kpi_report(fact.withColumn("zscore_consumo", F.raise_error(F.lit("the fact was read")).cast("double")), base=base)
    assert plan.count() > 20
