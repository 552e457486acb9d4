"""Cleaning, star schema, event ordering, quality."""

from pyspark.sql import functions as F

from gridlens import settle
from gridlens.functions.text import pad_geo_code
from gridlens.operators import batch, cleaning, events, ordering, quality
from registry import views
from registry.catalog import check
from registry.sql import pct, rnd, using
from registry.views import ROLES

PARTS = "NRO_DOC_FAC, PERIODO, CONSUMO, IMPORTE, FECHA_EMISION, FECHA_VENCIMIENTO"
DIMS = "DEPARTAMENTO, DISTRITO, TARIFA, CARTERA"


@check("coerce_types", using("raw", body=f"SELECT {PARTS} FROM raw"))
def _(spark, folder):
    return cleaning.coerce_types(views.raw_invoices(spark, folder)).select(*[c.strip() for c in PARTS.split(",")])


@check("drop_null_measures", using(
    "raw", body=f"SELECT {PARTS} FROM raw WHERE CONSUMO IS NOT NULL AND IMPORTE IS NOT NULL"))
def _(spark, folder):
    typed = cleaning.coerce_types(views.raw_invoices(spark, folder)).select(*[c.strip() for c in PARTS.split(",")])
    return cleaning.drop_null_measures(typed)


@check("keep_positive", using("raw", body=f"SELECT {PARTS} FROM raw WHERE CONSUMO > 0 AND IMPORTE > 0"))
def _(spark, folder):
    typed = cleaning.coerce_types(views.raw_invoices(spark, folder)).select(*[c.strip() for c in PARTS.split(",")])
    return cleaning.keep_positive(typed)


@check("standardise_text", using("raw", body="SELECT NRO_DOC_FAC, " + ", ".join(
    f"upper(trim({c.strip()}, ' ' || chr(9))) AS {c}" for c in DIMS.split(", ")) + " FROM raw"))
def _(spark, folder):
    return cleaning.standardise_text(
        views.raw_invoices(spark, folder).select("NRO_DOC_FAC", *DIMS.split(", "))
    )


@check("mark_outliers", using("readings", body="""
SELECT NRO_DOC_FAC, CONSUMO, IMPORTE,
       abs(CONSUMO - mc) / sc > 3 OR abs(IMPORTE - mi) / si > 3 AS outlier
FROM readings, (SELECT avg(CONSUMO) AS mc, stddev_samp(CONSUMO) AS sc, avg(IMPORTE) AS mi, stddev_samp(IMPORTE) AS si
                FROM readings)"""))
def _(spark, folder):
    rows = views.readings(spark, folder).select("NRO_DOC_FAC", "CONSUMO", "IMPORTE")
    return cleaning.mark_outliers(rows)


@check("clean", using("clean", body="SELECT * FROM clean"))
def _(spark, folder):
    return cleaning.clean(views.raw_invoices(spark, folder))


@check("clean_counts", using("clean", body=f"""
SELECT n AS filas_iniciales, nulls AS nulos_eliminados, n - nulls - kept_rows AS no_positivos_eliminados,
       kept_rows AS filas_finales, outliers, {pct('kept_rows', 'n')} AS tasa_validez_pct
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE CONSUMO IS NULL OR IMPORTE IS NULL) AS nulls FROM raw),
     (SELECT count(*) AS kept_rows, count(*) FILTER (WHERE outlier) AS outliers FROM clean)"""))
def _(spark, folder):
    return cleaning.clean_counts(views.raw_invoices(spark, folder))


@check("split_star", using("star", body="SELECT * FROM star_fact"))
def _(spark, folder):
    return cleaning.split_star(cleaning.clean(views.raw_invoices(spark, folder)))[0]


@check("split_star_dim", using("star", body="SELECT * FROM star_dim"))
def _(spark, folder):
    return cleaning.split_star(cleaning.clean(views.raw_invoices(spark, folder)))[1]


@check("union_sources", """
SELECT o_orderkey AS documento, o_totalprice AS importe, CAST(NULL AS VARCHAR) AS marca FROM orders
UNION ALL SELECT l_orderkey, l_extendedprice, l_returnflag FROM lineitem""")
def _(spark, folder):
    orders = views.table(spark, folder, "orders")
    lines = views.table(spark, folder, "lineitem")
    return cleaning.union_sources(
        orders.select(F.col("o_orderkey").alias("documento"), F.col("o_totalprice").alias("importe")),
        lines.select(F.col("l_returnflag").alias("marca"), F.col("l_extendedprice").alias("importe"),
                     F.col("l_orderkey").alias("documento")),
    )


LINE_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, "
    "l_shipdate"
)


@check("cap_rows_per_source", f"""
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {LINE_ORDER}) AS n FROM lineitem) WHERE n <= 5000""")
def _(spark, folder):
    return events.cap_rows_per_source(
        views.table(spark, folder, "lineitem"), "l_returnflag", LINE_ORDER.split(", "), per_source=5000
    )


@check("cap_rows_total", f"""
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {LINE_ORDER}) AS n FROM lineitem)
WHERE n <= greatest(12001 // (SELECT count(DISTINCT l_returnflag) FROM lineitem), 1)""")
def _(spark, folder):
    return events.cap_rows_per_source(
        views.table(spark, folder, "lineitem"), "l_returnflag", LINE_ORDER.split(", "), total=12001
    )


def _order_events(spark, folder):
    return views.table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias(ROLES.document), F.col("o_totalprice").alias(ROLES.amount),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias(ROLES.issued),
    )


ORDER_EVENTS = """order_events AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS NRO_DOC_FAC, o_totalprice AS IMPORTE,
         strftime(o_orderdate, '%Y-%m-%d') AS FECHA_EMISION FROM orders),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY FECHA_EMISION, lpad(NRO_DOC_FAC, 20, '0')) AS n FROM order_events)"""


@check("ordered_events", f"WITH {ORDER_EVENTS} SELECT NRO_DOC_FAC, IMPORTE, FECHA_EMISION FROM numbered")
def _(spark, folder):
    return events.ordered_events(_order_events(spark, folder))


@check("ordered_events_first", f"""
WITH {ORDER_EVENTS} SELECT NRO_DOC_FAC, IMPORTE, FECHA_EMISION FROM numbered WHERE n <= 1000""")
def _(spark, folder):
    return events.ordered_events(_order_events(spark, folder), max_events=1000)


@check("event_envelope", f"""
WITH {ORDER_EVENTS}
SELECT 'SIM-20250101_000000-' || lpad(CAST(n AS VARCHAR), 8, '0') AS _id_evento,
       TIMESTAMP '2025-01-01' AS _timestamp_simulacion, NRO_DOC_FAC, IMPORTE, FECHA_EMISION FROM numbered""")
def _(spark, folder):
    moment = F.lit("2025-01-01").cast("timestamp_ntz")
    wrapped = events.event_envelope(_order_events(spark, folder), "20250101_000000", moment)
    return wrapped.select("_id_evento", "_timestamp_simulacion", "datos.*")


@check("random_sample", """
SELECT event_id, value FROM events ORDER BY md5(event_id || ':42'), event_id, value LIMIT 500""")
def _(spark, folder):
    return ordering.random_rows(views.table(spark, folder, "events").select("event_id", "value"), "event_id", 500)


@check("pad_geo_code", """
SELECT c_custkey AS id, CASE WHEN length(CAST(c_custkey * 977 AS VARCHAR)) < 6
       THEN lpad(CAST(c_custkey * 977 AS VARCHAR), 6, '0') ELSE CAST(c_custkey * 977 AS VARCHAR) END AS ubigeo
FROM customer""")
def _(spark, folder):
    return views.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), pad_geo_code(F.col("c_custkey") * 977).alias("ubigeo")
    )


@check("fact_without_dim", """
SELECT o_orderkey AS l_orderkey, count(*) AS filas FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY o_orderkey""")
def _(spark, folder):
    orders = views.table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return quality.fact_without_dim(orders, views.table(spark, folder, "lineitem"), "l_orderkey")


@check("fact_with_dim", """
SELECT o_orderkey AS l_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def _(spark, folder):
    orders = views.table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    return quality.fact_with_dim(orders, views.table(spark, folder, "lineitem"), "l_orderkey")


def _validity(spark, folder, known=None):
    """``known``: the documents of the dimension, where it lacks some, as one that was stored before the fact does."""
    raw = settle(views.raw_invoices(spark, folder), "raw")
    fact, dim = cleaning.split_star(cleaning.clean(raw))
    fact, dim = settle(fact, "fact"), settle(dim if known is None else dim.filter(known), "dim")
    return quality.validity_rate(fact, dim, raw.agg(F.count("*")).scalar())


RATE = f"""rate AS (
  SELECT (SELECT count(*) FROM raw) AS total_filas_originales, count(*) AS total_fact_consumo,
         (SELECT count(*) FROM star_dim) AS total_dim_cliente,
         count(*) FILTER (WHERE CONSUMO IS NULL) AS nulos_consumo,
         count(*) FILTER (WHERE IMPORTE IS NULL) AS nulos_importe,
         count(*) FILTER (WHERE CONSUMO <= 0) AS consumo_cero_o_negativo,
         count(*) FILTER (WHERE IMPORTE <= 0) AS importe_cero_o_negativo,
         count(*) FILTER (WHERE NRO_DOC_FAC NOT IN (SELECT NRO_DOC_FAC FROM star_dim)) AS fact_sin_dim_asociada,
         {rnd('CAST(count(*) AS DOUBLE) / greatest((SELECT count(*) FROM raw), 1) * 100', 2)} AS tasa_validez_pct
  FROM star_fact)"""
VALIDITY = "late_dim AS (SELECT * FROM star_dim WHERE NRO_DOC_FAC NOT LIKE '%7-1'),\n" + RATE.replace("star_dim", "late_dim")


@check("validity_rate", using("star", body="SELECT * FROM rate").replace("\nSELECT * FROM rate", f",\n{VALIDITY}\nSELECT * FROM rate"))
def _(spark, folder):
    return _validity(spark, folder, ~F.col(ROLES.document).endswith("7-1"))


@check("check_validity", using("star", body="SELECT * FROM rate").replace(
    "\nSELECT * FROM rate", f",\n{RATE}\nSELECT *, tasa_validez_pct >= 85 AS oe1_cumplido FROM rate"))
def _(spark, folder):
    return quality.check_validity(_validity(spark, folder))


@check("hierarchy_consistency", using("places", body="""
SELECT DISTRITO, count(DISTINCT DEPARTAMENTO) AS padres, count(DISTINCT DEPARTAMENTO) = 1 AS consistente
FROM places GROUP BY DISTRITO"""))
def _(spark, folder):
    return quality.hierarchy_consistency(views.places(spark, folder), ROLES.district, ROLES.department)


@check("check_statistics", using("stats", body="""
SELECT CAST(10 AS INTEGER) AS columnas, true AS columnas_esperadas,
       count(*) FILTER (WHERE total_registros > 1 AND (consumo_promedio = 0 OR consumo_std = 0)) AS grupos_en_cero,
       count(*) FILTER (WHERE total_registros > 1 AND (consumo_promedio = 0 OR consumo_std = 0)) = 0 AS oe2_cumplido
FROM stats"""))
def _(spark, folder):
    return quality.check_statistics(batch.historical_statistics(views.readings(spark, folder)))


@check("check_anomaly_fact", using("fact", body="""
SELECT CAST(17 AS INTEGER) AS num_columnas, count(*) FILTER (WHERE zscore_consumo IS NULL) AS nulos_zscore,
       count(*) AS total_filas, round(count(*) FILTER (WHERE flag_anomalia) / count(*) * 100.0, 2) AS pct_flag_true,
       count(*) FILTER (WHERE zscore_consumo IS NULL) = 0 AND count(*) FILTER (WHERE flag_anomalia) = count(*)
         AND count(*) > 0 AS oe4_cumplido
FROM fact"""))
def _(spark, folder):
    return quality.check_anomaly_fact(views.anomaly_fact(spark, folder))


@check("check_outputs", using("fact", body="""
SELECT (SELECT count(*) FROM fact) > 0 AS fact, (SELECT count(distrito) FROM fact) > 0 AS distrito,
       (SELECT count(tarifa) FROM fact) > 0 AS tarifa, (SELECT count(cartera) FROM fact) > 0 AS cartera,
       (SELECT count(*) FROM fact) > 0 AND (SELECT count(distrito) FROM fact) > 0
         AND (SELECT count(tarifa) FROM fact) > 0 AND (SELECT count(cartera) FROM fact) > 0 AS oe5_cumplido"""))
def _(spark, folder):
    from gridlens.operators.serving import anomaly_summary

    fact = settle(views.anomaly_fact(spark, folder), "fact")
    return quality.check_outputs({"fact": fact, **{c: anomaly_summary(fact, c) for c in ("distrito", "tarifa", "cartera")}})
