import numpy as np
import pytest

from conftest import rows
from gridlens.operators import profiling


@pytest.fixture
def numbers(spark):
    values = [float(i % 17 + 1) for i in range(200)] + [400.0]
    return spark.createDataFrame([(x, x * 2) for x in values], "CONSUMO double, IMPORTE double"), np.array(values)


def test_description_equals_numpy(numbers):
    df, x = numbers
    row = profiling.describe_numeric(df, ["CONSUMO", "IMPORTE"]).first().asDict()
    assert row["columna"] == "CONSUMO" and row["outliers"] == 1 and row["outliers_pct"] == 0.5
    assert row["media"] == pytest.approx(x.mean()) and row["std"] == pytest.approx(x.std(ddof=1))
    assert (row["minimo"], row["maximo"]) == (1.0, 400.0)
    for p, name in profiling.PERCENTILES.items():
        assert row[name] == np.quantile(x, p)


def test_histogram_equals_numpy(numbers):
    df, x = numbers
    cap = np.quantile(x, 0.99)
    counts, edges = np.histogram(np.minimum(x, cap), bins=80)
    out = rows(profiling.histogram_capped(df, "CONSUMO"))
    assert [r[3] for r in out] == list(counts)
    assert [r[1] for r in out] == pytest.approx(list(edges[:-1])) and out[-1][2] == pytest.approx(edges[-1])


def test_histogram_of_one_value(spark):
    out = rows(profiling.histogram_capped(spark.createDataFrame([(5.0,), (5.0,)], "x double"), "x", 4))
    assert [r[3] for r in out] == [0, 0, 2, 0] and (out[0][1], out[-1][2]) == (4.5, 5.5)


def test_box(spark):
    df = spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4, 100)], "x double")
    assert rows(profiling.box_stats(df, ["x"])) == [("x", 2.0, 3.0, 4.0, -1.0, 7.0, 1.0, 4.0, 1)]


def test_text_profile(spark):
    data = [("a",)] * 12 + [("a ",)] * 3 + [(None,)] * 2 + [("  ",), ("",)]
    df = spark.createDataFrame(data, "t string").selectExpr("t", "CAST(1 AS string) AS u")
    got = {r[0]: r[1:] for r in rows(profiling.profile_categorical(df, ["t", "u"]))}
    assert got == {"t": (2, 4, 4, 3, True), "u": (0, 0, 1, 0, False)}
    top = rows(profiling.top_k_categories(df, ["t"], 2), "valor", "cantidad", "puesto", "pct")
    assert sorted(top, key=lambda r: r[2]) == [("a", 12, 1, 63.16), ("a ", 3, 2, 15.79)]


def test_crosstab(spark):
    data = [("t1", "c")] * 3 + [("t1", "m"), ("t2", "c"), (None, "c"), ("t2", None)]
    df = spark.createDataFrame(data, "T string, P string")
    assert sorted(rows(profiling.crosstab_margins(df, "T", "P"))) == [
        ("All", "All", 5), ("All", "c", 4), ("All", "m", 1), ("t1", "All", 4), ("t1", "c", 3), ("t1", "m", 1),
        ("t2", "All", 1), ("t2", "c", 1),
    ]
    assert rows(profiling.crosstab_wide(df, "T", "P")) == [("t1", 3, 1, 4), ("t2", 1, 0, 1), ("All", 4, 1, 5)]
    # Values that are not asked for are counted too.
    assert rows(profiling.crosstab_wide(df, "T", "P", ["c"])) == [("t1", 3, 1, 4), ("t2", 1, 0, 1), ("All", 4, 1, 5)]
    # A value named like the margin keeps its row.
    named = spark.createDataFrame([("All", "c"), ("t1", "c"), ("t1", "c")], "T string, P string")
    assert rows(profiling.crosstab_wide(named, "T", "P")) == [("All", 1, 1), ("t1", 2, 2), ("All", 3, 3)]


def test_usable_rows(spark):
    df = spark.createDataFrame([("1", "2"), ("x", "2"), ("0", "2"), ("3", None)], "CONSUMO string, IMPORTE string")
    assert rows(profiling.usable_measures(df)) == [(1.0, 2.0)]
