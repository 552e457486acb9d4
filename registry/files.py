"""Sources and sinks: the tables written as files and read back."""

from pyspark.sql import functions as F

from gridlens.operators import batch, cleaning
from gridlens.operators.events import as_messages
from gridlens.session import scratch_path
from gridlens.sinks import files
from gridlens.sources import csv_folder, geojson, tables
from registry import views
from registry.batch import STATISTICS, rounded
from registry.catalog import check
from registry.sql import using
from registry.views import ROLES


def _monthly_folder(spark, folder, separators=(";", ",")):
    """Invoices as raw CSV, the early periods and the late ones with another separator and column order."""
    path = scratch_path(spark, "raw")
    raw = views.invoices(spark, folder).select(
        ROLES.document, F.col(ROLES.period).cast("string").alias(ROLES.period), ROLES.consumption, ROLES.amount,
        ROLES.district,
    )
    early = F.col(ROLES.period) < "199601"
    for name, rows, separator in zip(
        "ab", (raw.filter(early), raw.filter(~early).select(*reversed(raw.columns))), separators, strict=True
    ):
        rows.write.option("header", True).option("sep", separator).csv(f"{path}/{name}")
    return [f"{path}/a", f"{path}/b"]


@check("read_csv_folder", using("invoices", body="""
SELECT NRO_DOC_FAC, CAST(PERIODO AS VARCHAR) AS PERIODO, CAST(CONSUMO AS VARCHAR) AS CONSUMO,
       CAST(IMPORTE AS VARCHAR) AS IMPORTE, DISTRITO FROM invoices"""))
def _(spark, folder):
    return csv_folder.read_csv_folder(spark, _monthly_folder(spark, folder))


@check("read_csv_folder_known_layout", using("invoices", body="""
SELECT NRO_DOC_FAC, CAST(PERIODO AS VARCHAR) AS PERIODO, CAST(CONSUMO AS VARCHAR) AS CONSUMO,
       CAST(IMPORTE AS VARCHAR) AS IMPORTE, DISTRITO FROM invoices"""))
def _(spark, folder):
    columns = [ROLES.document, ROLES.period, ROLES.consumption, ROLES.amount, ROLES.district]
    return csv_folder.read_csv_folder(spark, _monthly_folder(spark, folder, (";", ";")), separator=";", columns=columns)


@check("detect_separator", using("invoices", body="""
SELECT DISTINCT 'mes=' || PERIODO AS folder, CASE WHEN PERIODO < 199601 THEN ';' ELSE ',' END AS separator FROM invoices"""))
def _(spark, folder):
    """A file for each month, in a folder of its own whose name SQL knows (Spark names the files)."""
    path = scratch_path(spark, "months")
    raw = views.invoices(spark, folder).withColumn("mes", F.col(ROLES.period))
    for rows, separator in ((raw.filter("mes < 199601"), ";"), (raw.filter("mes >= 199601"), ",")):
        rows.repartition("mes").write.mode("append").option("header", True).option("sep", separator).partitionBy("mes").csv(path)
    found = csv_folder.detect_separator(spark, path)
    return found.select(F.element_at(F.split("file", "/"), -2).alias("folder"), "separator")


@check("read_fact", using("invoices", body="""
SELECT NRO_DOC_FAC, PERIODO, CONSUMO, IMPORTE, FECHA_EMISION, FECHA_VENCIMIENTO FROM invoices"""))
def _(spark, folder):
    path = scratch_path(spark, "fact") + ".csv"
    files.write_large_csv(views.invoices(spark, folder), path, 10_000)
    return tables.read_fact(spark, path)


@check("read_dim", using("places", body="""
SELECT CAST(cliente AS VARCHAR) AS NRO_DOC_FAC, DEPARTAMENTO, DISTRITO, lpad(UBIGEO, 6, '0') AS UBIGEO, CARTERA
FROM places"""))
def _(spark, folder):
    path = scratch_path(spark, "dim") + ".csv"
    files.write_csv(views.places(spark, folder).withColumnRenamed("cliente", ROLES.document), path)
    return tables.read_dim(spark, path)


@check("read_statistics", using("invoices", body=STATISTICS))
def _(spark, folder):
    path = scratch_path(spark, "statistics")
    files.write_csv(batch.historical_statistics(views.invoices(spark, folder)), f"{path}.csv")
    return rounded(tables.read_statistics(spark, path))


@check("publish_events", """
SELECT CAST(o_orderkey AS VARCHAR) AS "key", CAST(o_orderkey AS VARCHAR) AS NRO_DOC_FAC, o_totalprice AS IMPORTE,
       o_orderpriority AS TARIFA FROM orders""")
def _(spark, folder):
    rows = views.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias(ROLES.document), F.col("o_totalprice").alias(ROLES.amount),
        F.col("o_orderpriority").alias(ROLES.tariff),
    )
    body = F.from_json("value", f"{ROLES.document} string, {ROLES.amount} double, {ROLES.tariff} string")
    return as_messages(rows).select("key", body.alias("_b")).select("key", "_b.*")


@check("write_parquet", using("invoices", body="SELECT NRO_DOC_FAC, PERIODO, CONSUMO, IMPORTE, DISTRITO FROM invoices"))
def _(spark, folder):
    """Invoices in a folder for each month, read back."""
    path = scratch_path(spark, "by-month")
    rows = views.invoices(spark, folder).select(ROLES.document, ROLES.period, *ROLES.measures, ROLES.district)
    files.write_parquet(rows, path, [ROLES.period])
    return spark.read.parquet(path).select(*rows.columns)


@check("normalise_headers", """
SELECT o_orderkey AS NRO_DOC_FAC, o_totalprice AS IMPORTE, o_orderpriority AS "TARIFA X" FROM orders""")
def _(spark, folder):
    """Headers as raw files have them: a byte-order mark, blanks around, a blank inside."""
    orders = views.table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return cleaning.normalise_headers(orders.toDF("﻿NRO_DOC_FAC", " IMPORTE\t", "TARIFA X "))


def _nations_geojson(spark, folder):
    """A collection with a triangle for each nation, every third one as the first part of a multipolygon."""
    k = F.col("n_nationkey").cast("double")
    ring = F.array(F.array(k, -k), F.array(k + 2, -k), F.array(k + 2, -k - 1))
    hole = F.array(F.array(k, k), F.array(k, k), F.array(k, k))
    multi = F.col("n_nationkey") % 3 == 0
    polygon, parts = F.to_json(F.array(ring, hole)), F.to_json(F.array(F.array(ring, hole)))
    head = F.to_json(F.struct(F.lpad(F.col("n_nationkey").cast("string"), 6, "0").alias("IDDIST"), F.concat(F.lit("} "), "n_name").alias("nombre")))
    feature = F.concat(
        F.lit('{"type":"Feature","properties":'), head, F.lit(',"geometry":{"type":"'),
        F.when(multi, "MultiPolygon").otherwise("Polygon"), F.lit('","coordinates":'), F.when(multi, parts).otherwise(polygon), F.lit("}}"))
    one = views.table(spark, folder, "nation").agg(F.array_join(F.array_sort(F.collect_list(feature)), ",\n").alias("f"))
    path = scratch_path(spark, "geojson")
    one.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}"))).write.text(path)
    return path


CENTRES = """
SELECT lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS IDDIST, CAST(-3 * n_nationkey - 1 AS DOUBLE) / 3 AS lat,
       CAST(3 * n_nationkey + 4 AS DOUBLE) / 3 AS lon FROM nation"""


@check("district_centroids", CENTRES)
def _(spark, folder):
    return geojson.district_centroids(geojson.read_geojson_features(spark, _nations_geojson(spark, folder)))


@check("large_geojson_centroids", CENTRES)
def _(spark, folder):
    """The same file cut at its braces and read by blocks."""
    return geojson.district_centroids(geojson.read_large_geojson(spark, _nations_geojson(spark, folder)))
