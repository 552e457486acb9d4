import datetime as dt

from conftest import rows
from gridlens import Roles
from gridlens.operators import cleaning, quality

RAW = "NRO_DOC_FAC string, PERIODO string, CONSUMO string, IMPORTE string, FECHA_EMISION string, DISTRITO string"


def raw(spark):
    return spark.createDataFrame([
        ("1", "202301", "12.5", "30", "20230115", " trujillo\t"),
        ("1", "202301", "13.5", "31", "20230115", "TRUJILLO"),
        ("2", "202302.0", "abc", "5", "20231345", "moche"),
        ("3", "x", "-3", "5", "", "moche"),
        ("4", None, "0", "5", None, None),
        ("5", "202301.5", None, "5", "20230116", "moche"),
        (None, "202301", "7", "8", "20230117", "común"),
        ("6", "202301", "NaN", "8", "20230117", ""),
    ], RAW)


def test_bad_values_become_null(spark):
    typed = cleaning.coerce_types(raw(spark))
    assert rows(typed, "PERIODO", "CONSUMO", "FECHA_EMISION") == [
        (202301, 12.5, dt.date(2023, 1, 15)), (202301, 13.5, dt.date(2023, 1, 15)), (202302, None, None),
        (None, -3.0, None), (None, 0.0, None), (None, None, dt.date(2023, 1, 16)),
        (202301, 7.0, dt.date(2023, 1, 17)), (202301, None, dt.date(2023, 1, 17)),
    ]
    assert dict(typed.dtypes)["PERIODO"] == "int"


def test_integer_dates_are_accepted(spark):
    df = spark.createDataFrame([(20230115,), (None,)], "FECHA_EMISION int")
    assert rows(cleaning.coerce_types(df)) == [(dt.date(2023, 1, 15),), (None,)]


def test_clean_and_its_counts(spark):
    cleaned = cleaning.clean(raw(spark))
    assert rows(cleaned, "NRO_DOC_FAC", "CONSUMO", "DISTRITO", "outlier") == [
        ("1", 12.5, "TRUJILLO", False), ("1", 13.5, "TRUJILLO", False), (None, 7.0, "COMÚN", False),
    ]
    counts = cleaning.clean_counts(raw(spark)).first().asDict()
    assert counts == {
        "filas_iniciales": 8, "nulos_eliminados": 3, "no_positivos_eliminados": 2, "filas_finales": 3,
        "outliers": 0, "tasa_validez_pct": 37.5,
    }


def test_counts_of_nothing(spark):
    assert cleaning.clean_counts(raw(spark).limit(0)).first()["tasa_validez_pct"] == 0.0


def test_outliers(spark):
    values = [(10.0 + i % 3, 5.0) for i in range(50)] + [(500.0, 5.0)]
    marked = cleaning.mark_outliers(spark.createDataFrame(values, "CONSUMO double, IMPORTE double"))
    assert [r.CONSUMO for r in marked.filter("outlier").collect()] == [500.0]
    # IMPORTE never varies, so it marks nothing; a single row has no deviation at all.
    assert cleaning.mark_outliers(marked.drop("outlier").limit(1)).filter("outlier").count() == 0


def test_star_keeps_the_first_row_of_a_key(spark):
    fact, dim = cleaning.split_star(cleaning.clean(raw(spark)))
    assert rows(fact, "NRO_DOC_FAC", "PERIODO", "CONSUMO") == [("1", 202301, 12.5)]
    assert rows(dim) == [("1", "TRUJILLO")]


def test_headers_and_union(spark):
    df = spark.createDataFrame([(1, 2)], "`\ufeffA ` int, b int")
    assert cleaning.normalise_headers(df).columns == ["A", "b"]
    stacked = cleaning.union_sources(
        spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("y", True)], "b string, c boolean")
    )
    assert rows(stacked) == [(1, "x", None), (None, "y", True)]


def test_text_columns_are_found(spark):
    df = spark.createDataFrame([(" a ", 1, None)], "t string, n int, u string")
    assert rows(cleaning.standardise_text(df)) == [("A", 1, None)]
    assert rows(cleaning.standardise_text(df, ["u"])) == [(" a ", 1, None)]


def test_hot_key_is_reduced_before_the_exchange(spark):
    plan = cleaning.keep_first(spark.range(10).selectExpr("id % 2 AS k", "id"), ["k"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.rindex("Partial")


FACT = "NRO_DOC_FAC string, CONSUMO double, IMPORTE double"


def test_validity(spark):
    fact = spark.createDataFrame([("1", 1.0, 2.0), ("1", None, 0.0), ("9", -1.0, None)], FACT)
    dim = spark.createDataFrame([("1", "X"), ("2", "Y")], "NRO_DOC_FAC string, DISTRITO string")
    rate = quality.validity_rate(fact, dim, 4)
    assert rate.first().asDict() == {
        "total_filas_originales": 4, "total_fact_consumo": 3, "total_dim_cliente": 2, "nulos_consumo": 1,
        "nulos_importe": 1, "consumo_cero_o_negativo": 1, "importe_cero_o_negativo": 1, "fact_sin_dim_asociada": 1,
        "tasa_validez_pct": 75.0,
    }
    assert quality.check_validity(rate).first()["oe1_cumplido"] is False
    assert quality.check_validity(rate, 75).first()["oe1_cumplido"] is True
    assert rows(quality.fact_without_dim(fact, dim, "NRO_DOC_FAC")) == [("9", 1)]
    assert quality.fact_with_dim(fact, dim, "NRO_DOC_FAC").count() == 2


def test_renamed_roles(spark):
    roles = Roles(consumption="kwh", amount="eur")
    df = spark.createDataFrame([("1", "2"), ("0", "2"), (None, "1")], "kwh string, eur string")
    assert rows(cleaning.clean(df, roles), "kwh", "eur") == [(1.0, 2.0)]


def test_latency_gate():
    assert quality.check_latency(4.9994) == {
        "latencia_segundos": 4.999, "oe3_latencia_cumplido": True, "precision_pct": 0,
        "oe3_precision_cumplido": False, "oe3_cumplido": True,
    }
    assert quality.check_latency(5.0)["oe3_cumplido"] is False
    assert quality.check_latency(1.0, 89.9)["oe3_cumplido"] is False
    assert quality.check_latency(1.0, 90.0)["oe3_cumplido"] is True


def test_check_validity_takes_the_whole_dimension(spark, folder):
    import __spark_entry__ as entry

    row = entry.queries()["check_validity"](spark, folder).first()
    # Each document is one row of the fact and one of the dimension; validity_rate drops some of the latter.
    assert row["total_dim_cliente"] == row["total_fact_consumo"] > 0 and row["fact_sin_dim_asociada"] == 0
