"""Profiles of numeric and text columns."""

from pyspark.sql import functions as F

from gridlens.operators import profiling
from registry import views
from registry.catalog import check
from registry.sql import mean, pct, quantile, using
from registry.views import ROLES

MEASURES = ["CONSUMO", "IMPORTE"]
USABLE = "(SELECT * FROM readings WHERE CONSUMO > 0 AND IMPORTE > 0)"


def _usable(spark, folder):
    return profiling.usable_measures(views.readings(spark, folder)).select(*MEASURES)


def _describe(c):
    quantiles = ", ".join(
        f"{quantile(c, p, USABLE)} AS {n}" for p, n in profiling.PERCENTILES.items()
    )
    far = f"count(*) FILTER (WHERE abs({c} - m) / s > 3)"
    return f"""SELECT '{c}' AS columna, {mean(c)} AS media, round(stddev_samp({c}), 4) AS std, min({c}) AS minimo,
  max({c}) AS maximo, {quantiles}, {far} AS outliers, {pct(far, 'count(*)')} AS outliers_pct
FROM {USABLE}, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {USABLE})"""


@check("describe_numeric", using("readings", body=" UNION ALL ".join(_describe(c) for c in MEASURES)))
def _(spark, folder):
    described = profiling.describe_numeric(_usable(spark, folder), MEASURES)
    return described.withColumn("std", F.round("std", 4))


TEXT = """text_values AS (
  SELECT 'estado' AS columna, CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN ' ' ELSE o_orderstatus END AS valor FROM orders
  UNION ALL SELECT 'cliente', CAST(o_custkey AS VARCHAR) FROM orders
  UNION ALL SELECT 'prioridad', CASE WHEN o_totalprice > 200000 THEN o_orderpriority || ' ' ELSE o_orderpriority END FROM orders),
counted AS (SELECT columna, valor, count(*) AS n FROM text_values GROUP BY ALL)"""


def _text(spark, folder):
    orders = views.table(spark, folder, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return orders.select(
        F.when(status == "F", None).when(status == "O", F.lit(" ")).otherwise(status).alias("estado"),
        F.col("o_custkey").cast("string").alias("cliente"),
        F.when(F.col("o_totalprice") > 200000, F.concat(priority, F.lit(" "))).otherwise(priority).alias("prioridad"),
    )


@check("profile_categorical", f"""WITH {TEXT}
SELECT columna, CAST(coalesce(sum(n) FILTER (WHERE valor IS NULL), 0) AS BIGINT) AS nulos,
       CAST(coalesce(sum(n) FILTER (WHERE trim(coalesce(valor, '')) = ''), 0) AS BIGINT) AS blancos,
       count(valor) AS unicos, count(*) FILTER (WHERE valor IS NOT NULL AND n < 10) AS raras,
       count(DISTINCT trim(valor)) < count(valor) AS variantes_espacios FROM counted GROUP BY columna""")
def _(spark, folder):
    return profiling.profile_categorical(_text(spark, folder), ["estado", "cliente", "prioridad"])


@check("top_k_categories", f"""WITH {TEXT},
ranked AS (
  SELECT columna, valor, n AS cantidad, CAST(row_number() OVER (PARTITION BY columna ORDER BY n DESC, valor) AS INTEGER) AS puesto
  FROM counted WHERE valor IS NOT NULL)
SELECT *, {pct('cantidad', '(SELECT count(*) FROM orders)')} AS pct FROM ranked WHERE puesto <= 10""")
def _(spark, folder):
    return profiling.top_k_categories(_text(spark, folder), ["estado", "cliente", "prioridad"])


@check("rare_categories", f"""WITH {TEXT}
SELECT columna, valor, n AS cantidad FROM counted WHERE valor IS NOT NULL AND n < 10""")
def _(spark, folder):
    return profiling.rare_categories(_text(spark, folder), ["estado", "cliente", "prioridad"])


@check("crosstab_margins", using("invoices", body="""
SELECT CASE WHEN grouping(TARIFA) = 1 THEN 'All' ELSE TARIFA END AS TARIFA,
       CASE WHEN grouping(CARTERA) = 1 THEN 'All' ELSE CARTERA END AS CARTERA, count(*) AS cantidad
FROM invoices GROUP BY CUBE (TARIFA, CARTERA)"""))
def _(spark, folder):
    return profiling.crosstab_margins(views.invoices(spark, folder), ROLES.tariff, ROLES.portfolio)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@check("crosstab_wide", using("invoices", body="SELECT coalesce(TARIFA, 'All') AS TARIFA, " + ", ".join(
    f'count(*) FILTER (WHERE CARTERA = \'{s}\') AS "{s}"' for s in SEGMENTS)
    + ', count(*) AS "All" FROM invoices GROUP BY ROLLUP (TARIFA)'))
def _(spark, folder):
    return profiling.crosstab_wide(views.invoices(spark, folder), ROLES.tariff, ROLES.portfolio)


@check("histogram_capped", using("readings", body="""@@""").replace("\n@@", f""",
b AS (SELECT min(CONSUMO) AS lo, {quantile('CONSUMO', 0.99, USABLE)} AS hi FROM {USABLE}),
counted AS (
  SELECT least(floor((least(CONSUMO, hi) - lo) / ((hi - lo) / 80)), 79) AS bin, count(*) AS n FROM {USABLE}, b GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / 80) AS desde,
       lo + (i + 1) * ((hi - lo) / 80) AS hasta, coalesce(n, 0) AS cantidad
FROM range(80) AS r(i) LEFT JOIN counted ON counted.bin = i, b"""))
def _(spark, folder):
    return profiling.histogram_capped(_usable(spark, folder), "CONSUMO")


def _box(c):
    low, high = "q1 - 1.5 * (q3 - q1)", "q3 + 1.5 * (q3 - q1)"
    return f"""SELECT '{c}' AS columna, any_value(q1) AS q1, any_value(q2) AS mediana,
  any_value(q3) AS q3, any_value({low}) AS limite_inferior,
  any_value({high}) AS limite_superior, min({c}) FILTER (WHERE {c} >= {low}) AS bigote_inferior,
  max({c}) FILTER (WHERE {c} <= {high}) AS bigote_superior, count(*) FILTER (WHERE {c} < {low} OR {c} > {high}) AS atipicos
FROM {USABLE}, (SELECT {quantile(c, 0.25, USABLE)} AS q1, {quantile(c, 0.5, USABLE)} AS q2, {quantile(c, 0.75, USABLE)} AS q3)"""


@check("box_stats", using("readings", body=" UNION ALL ".join(_box(c) for c in MEASURES)))
def _(spark, folder):
    return profiling.box_stats(_usable(spark, folder), MEASURES)
