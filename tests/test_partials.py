"""Merged states against one run over everything; sketches against exact ranks."""

import os
import random
from decimal import Decimal
from statistics import stdev

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gridlens import Roles
from gridlens.operators import batch, partials, profiling, sketches

ROLES = Roles()
SCHEMA = ("NRO_DOC_FAC string, PERIODO int, CONSUMO double, IMPORTE double, DEPARTAMENTO string, DISTRITO string, "
          "TARIFA string, CARTERA string")


def invoices(n=600, seed=1):
    draw = random.Random(seed)
    return [(f"d{draw.randrange(n)}", 202301 + k % 5, round(draw.gauss(1e6, 3), 6), round(draw.uniform(-5, 5), 3),
             "AB"[k % 2], "XYZ"[k % 3], "T", None if k % 7 == 0 else "C") for k in range(n)]


@pytest.fixture
def stored(spark, tmp_path):
    table = spark.createDataFrame(invoices(), SCHEMA)
    folder = str(tmp_path / "states")
    partials.store(table.filter("PERIODO < 202303"), folder)
    partials.store(table.filter("PERIODO >= 202303").limit(7), folder)  # a run that saw part of the later months
    partials.store(table.filter("PERIODO >= 202303"), folder)
    return table, folder


def sorted_rows(df):
    return sorted(map(repr, rows(df)))


def test_merged_states_equal_one_run_to_the_last_digit(spark, stored, tmp_path):
    table, folder = stored
    parts = partials.read(spark, folder, partials.GROUPS)
    whole = partials.group_states(table.repartition(7))
    assert sorted_rows(partials.statistics(parts)) == sorted_rows(partials.statistics(whole))
    assert sorted_rows(partials.totals_by(parts, [ROLES.period])) == sorted_rows(batch.totals_by(table, [ROLES.period]))
    assert sorted_rows(partials.totals_by(parts, [ROLES.department])) == sorted_rows(batch.totals_by(table, [ROLES.department]))
    assert sorted_rows(partials.rates(parts)) == sorted_rows(batch.rate_portfolio_analysis(table))
    got = {r[0]: r[1] for r in rows(partials.kpis(parts, partials.exact_documents(spark, folder), table))}
    assert got == {r[0]: r[1] for r in rows(batch.global_kpis(table))}
    short = partials.kpis(parts, partials.sketched_documents(spark, folder))
    assert short.count() == 6
    documents = got["total_facturas"]
    assert abs({r[0]: r[1] for r in rows(short)}["total_facturas"] - documents) <= 0.03 * documents


def test_deviation_is_exact(spark):
    """Values whose spread is a millionth of their size: nothing cancels."""
    values = [4_000_000_000.0 + k * 0.001 for k in range(2001)]
    table = spark.createDataFrame([("d", 1, v, -v, "A", "X", "T", "C") for v in values], SCHEMA)
    found = partials.merge_states(partials.group_states(table.repartition(5)), []).select(partials.deviation("CONSUMO"), partials.deviation("IMPORTE"))
    want = float(stdev([Decimal(repr(v)) for v in values]))
    assert all(abs(x - want) <= 1e-12 * want for x in found.first())


def test_values_outside_the_exact_range(spark):
    cases = [1.0, None, 1e12, float("nan"), float("inf"), -2.5]
    for keep in (cases[:3] + cases[5:], cases, [None, None], [3.25], []):
        table = spark.createDataFrame([("d", 1, v, 1.0, "A", "X", "T", "C") for v in keep], SCHEMA)
        got = rows(partials.statistics(partials.group_states(table)), "consumo_promedio", "consumo_std", "total_registros")
        want = rows(batch.historical_statistics(table), "consumo_promedio", "consumo_std", "total_registros")
        assert len(got) == len(want)
        for a, b in zip(got, want):
            assert a[2] == b[2] and all(repr(x) == repr(y) or abs(x - y) <= 1e-9 * abs(y) for x, y in zip(a[:2], b[:2])), (a, b)


def test_a_new_period_leaves_the_old_files(spark, stored):
    table, folder = stored
    before = {os.path.join(at, n) for at, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}
    partials.store(table.withColumn("PERIODO", F.lit(202399)), folder)
    after = {os.path.join(at, n) for at, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}
    assert before < after and all("PERIODO=202399" in f for f in after - before)


@pytest.mark.parametrize("shape", ["normal", "few values", "sorted"])
def test_sketched_ranks(spark, shape):
    n = 60_000
    value = {"normal": F.randn(3), "few values": (F.rand(3) * 7).cast("int"), "sorted": F.col("id")}[shape].cast("double")
    table = spark.range(n).select(value.alias("v"), (F.col("id") % 6).alias("part"), F.lit(None).cast("double").alias("none"))
    table = table.withColumn("v", F.when(F.col("part") == 5, F.lit(float("nan"))).otherwise(F.col("v")))
    size = sketches.size_for(0.005)
    by_part = sketches.quantile_sketches(table, ["v", "none"], ["part"], size)
    merged = sketches.merge_sketches(by_part, ["v", "none"], size=size)
    chances = [0.01, 0.25, 0.5, 0.75, 0.99]
    known = sorted(v for v, in rows(table.filter("not isnan(v)"), "v"))
    for column, chance, found in rows(sketches.sketch_quantiles(merged, ["v", "none"], chances)):
        if column == "none":
            assert found is None
            continue
        below = sum(v < found for v in known) / len(known)
        upto = sum(v <= found for v in known) / len(known)
        assert below - 0.005 <= chance <= upto + 0.005, (shape, chance, found)


def test_profiles_from_sketches(spark):
    table = spark.range(1, 20_001).select(F.col("id").cast("double").alias("v"))
    exact, near = (profiling.describe_numeric(table, ["v"], relative_error=e).first() for e in (None, 0.005))
    assert all(abs(exact[c] - near[c]) <= 0.006 * 20_000 for c in ("p1", "p25", "p50", "p75", "p99"))
    assert (exact.media, exact.std, exact.outliers) == (near.media, near.std, near.outliers)
    box = profiling.box_stats(table, ["v"], relative_error=0.005).first()
    assert abs(box.mediana - 10_000) <= 120
    bins = profiling.histogram_capped(table, "v", bins=10, relative_error=0.005).collect()
    assert sum(b.cantidad for b in bins) == 20_000


def test_sizes():
    assert sketches.rank_error(sketches.size_for(0.01)) <= 0.01 < sketches.rank_error(sketches.size_for(0.01) - 1)
    with pytest.raises(ValueError):
        sketches.size_for(1e-6)
