import math

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from gridlens import vocabulary as v
from gridlens.functions import rules
from gridlens.functions.numeric import clip, exact_avg, exact_sum, finite_or_null, pct_variation, zscore
from gridlens.functions.text import clean_header, is_blank, pad_geo_code, pad_left, strip_upper


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, -3.25, 1e9 + 0.01, None, -0.000001]
    for ordered in (values, values[::-1]):
        df = spark.createDataFrame([(x,) for x in ordered], "x double")
        assert rows(df.agg(exact_sum("x"), exact_avg("x")))[0] == (999999997.359999, 999999997.359999 / 6)


def test_sum_and_mean_of_nothing_are_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert rows(df.agg(exact_sum("x"), exact_avg("x"))) == [(None, None)]


def test_scores_guard_missing_and_zero_history(spark):
    df = spark.createDataFrame(
        [(10.0, 4.0, 2.0), (10.0, 4.0, 0.0), (10.0, None, None), (10.0, 0.0, 3.0), (1.0, 3.0, 3.0)],
        "x double, m double, s double",
    )
    out = df.select(zscore(F.col("x"), F.col("m"), F.col("s")), pct_variation(F.col("x"), F.col("m")))
    assert rows(out) == [(3.0, 150.0), (0.0, 150.0), (0.0, 0.0), (3.3333, 0.0), (-0.6667, -66.67)]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(9.0,), (-9.0,), (1.0,), (None,)], "x double")
    assert rows(df.select(clip(F.col("x"), -5.0, 5.0))) == [(5.0,), (-5.0,), (1.0,), (None,)]


def test_unspeakable_numbers_become_null(spark):
    df = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,), (2.0,), (None,)], "x double")
    assert rows(df.select(finite_or_null(F.col("x")))) == [(None,), (None,), (None,), (2.0,), (None,)]


def test_text(spark):
    df = spark.createDataFrame([("  trujillo\t",), ("",), (None,), (" común\n",), (" \t",)], "x string")
    assert rows(df.select(strip_upper(F.col("x")), is_blank(F.col("x")))) == [
        ("TRUJILLO", False), ("", True), (None, True), ("COMÚN", False), ("", True),
    ]


def test_padding_never_truncates(spark):
    df = spark.createDataFrame([("101",), ("130101",), ("1301011",), (None,), ("",)], "x string")
    assert rows(df.select(pad_geo_code(F.col("x")), pad_left(F.col("x"), 2))) == [
        ("000101", "101"), ("130101", "130101"), ("1301011", "1301011"), (None, None), ("", "00"),
    ]


def test_headers():
    assert clean_header("ï»¿ NRO ") == "NRO"
    assert clean_header("\ufeffNRO") == "NRO"


BOUNDARIES = [
    # z, pct, consumption -> type, risk, ad-hoc type, ad-hoc risk
    (3.0, 0.0, 500.0, v.HIGH, v.RISK_MEDIUM, v.HIGH, v.RISK_MEDIUM),
    (3.0001, 0.0, 500.0, v.EXTREME, v.RISK_HIGH, v.EXTREME, v.RISK_HIGH),
    (2.0, 200.0, 1.0, v.HIGH, v.RISK_MEDIUM, v.HIGH, v.RISK_MEDIUM),
    (1.9999, 100.0, 1.0, v.MODERATE, v.RISK_LOW, v.NORMAL, v.RISK_LOW),
    (1.9999, 100.01, 1.0, v.SUDDEN, v.RISK_LOW, v.SUDDEN, v.RISK_MEDIUM),
    (-2.0, 0.0, 1.0, v.MODERATE, v.RISK_LOW, v.NORMAL, v.RISK_LOW),
    (-2.0001, 0.0, 1.0, v.SUSPICIOUSLY_LOW, v.RISK_LOW, v.SUSPICIOUSLY_LOW, v.RISK_LOW),
    (-2.0001, 150.0, 1.0, v.SUDDEN, v.RISK_LOW, v.SUSPICIOUSLY_LOW, v.RISK_LOW),
    (0.0, 0.0, 500.01, "Alerta consumo crítico > 500 kWh", v.RISK_CRITICAL,
     "Alerta consumo critico > 500 kWh", v.RISK_CRITICAL),
    (4.0, 0.0, 501.0, v.EXTREME, v.RISK_CRITICAL, v.EXTREME, v.RISK_CRITICAL),
    (None, None, 1.0, v.MODERATE, v.RISK_LOW, v.NORMAL, v.RISK_LOW),
]


def _ruled(df):
    z, pct, x = F.col("z"), F.col("p"), F.col("x")
    return df.select(rules.anomaly_type(z, pct, x), rules.risk_level(z, x),
                     rules.adhoc_type(z, pct, x), rules.adhoc_risk(z, pct, x))


def test_rule_boundaries(spark):
    df = spark.createDataFrame([b[:3] for b in BOUNDARIES], "z double, p double, x double")
    assert rows(_ruled(df)) == [b[3:] for b in BOUNDARIES]


NUMBERS = st.floats(-1000, 1000, allow_nan=False)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(NUMBERS, NUMBERS, NUMBERS), min_size=20, max_size=40))
def test_every_row_has_one_type_and_critical_rows_are_critical(spark, data):
    df = spark.createDataFrame(data, "z double, p double, x double")
    for (z, pct, x), (kind, risk, _, _) in zip(data, rows(_ruled(df)), strict=True):
        assert kind and risk
        assert (risk == v.RISK_CRITICAL) == (x > 500)
        assert (kind == v.EXTREME) == (z > 3)


def test_segments_and_heatmap(spark):
    df = spark.createDataFrame([(3,), (4,), (6,), (8,), (9,)], "t int")
    assert rows(df.select(rules.rfm_segment(F.col("t")))) == [
        (v.LOST,), (v.AT_RISK,), (v.ACTIVE,), (v.CHAMPION,), (v.CHAMPION,)
    ]
    rates = spark.createDataFrame([(0.02,), (0.021,), (0.05,), (0.051,)], "r double")
    assert rows(rates.select(rules.heatmap_risk(F.col("r")))) == [
        (v.RISK_LOW,), (v.RISK_MEDIUM,), (v.RISK_MEDIUM,), (v.RISK_HIGH,)
    ]
