"""Infinite, undefined and huge measures."""

import math

from conftest import rows
from pyspark.sql import functions as F

from gridlens.functions.numeric import exact_avg, exact_sum
from gridlens.functions.text import strip
from gridlens.operators import batch, cleaning, scoring


def test_non_finite_measures_are_dropped(spark):
    df = spark.createDataFrame(
        [(f"d{i}", "202301", str(10 + i % 3), "5") for i in range(30)]
        + [("x", "202301", "Infinity", "5"), ("y", "202301", "NaN", "5"), ("z", "202301", "1", "-Infinity"), ("w", "202301", "1e19", "5")],
        "NRO_DOC_FAC string, PERIODO string, CONSUMO string, IMPORTE string")
    cleaned = cleaning.clean(df)
    assert sorted(r[0] for r in rows(cleaned.filter("outlier"), "NRO_DOC_FAC")) == ["W"]
    assert cleaned.count() == 31
    assert rows(cleaning.clean_counts(df), "nulos_eliminados", "filas_finales") == [(3, 31)]


def test_no_row_is_far_from_an_undefined_spread(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (float("inf"), 1.0)], "CONSUMO double, IMPORTE double")
    assert not any(r.outlier for r in cleaning.mark_outliers(df).collect())


def test_sums_are_total(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum("v"), exact_avg("v")).first()[0]

    assert total(0.1, 0.2, None) == 0.3 and total(1e19, 1.0) == 1e19 and total(1e-6, 2e-6) == 3e-6
    assert total(float("inf"), 1.0) == math.inf and math.isnan(total(float("nan"), 1.0))
    assert total(None) is None and total(1e19, -1e19, 2.5) == 2.5
    small = spark.createDataFrame([(1e-7,)] * 10, "v double")
    assert small.agg(exact_sum("v", 9)).first()[0] == 1e-6


def test_kpis_of_huge_values(spark):
    df = spark.createDataFrame([("a", 1e19, 1.0), ("a", 2.0, 3.0), ("b", 4.0, None)], "NRO_DOC_FAC string, CONSUMO double, IMPORTE double")
    found = dict(rows(batch.global_kpis(df)))
    assert found["total_facturas"] == 2 and found["consumo_total_kwh"] == 1e19 and found["facturacion_total_soles"] == 4.0


def test_events_take_finite_measures_only(spark):
    df = spark.createDataFrame([("1", "Infinity"), ("2", "3.5"), ("3", "NaN")], "NRO_DOC_FAC string, CONSUMO string")
    assert [r[0] for r in rows(scoring.typed_events(df), "CONSUMO")] == [None, 3.5, None]


def test_conforming_takes_either_name(spark):
    df = spark.createDataFrame([("1", 5.0, None), ("2", 6.0, 7.0)], "nro_doc_fac string, consumo double, consumo_actual double")
    assert sorted(rows(scoring.conform_anomaly_fact(df), "nro_doc_fac", "consumo_actual")) == [("1", 5.0), ("2", 7.0)]


def test_strip_takes_every_blank(spark):
    texts = ["abc", " a b ", "\u3000x\u2003", "", "\t", "ñ ", "é", "!~", "\x1cA", "a\u00a0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strip(F.col("t"))).collect()] == [t.strip() for t in texts]
