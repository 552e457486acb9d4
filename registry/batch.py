"""Batch aggregates over the invoices."""

from pyspark.sql import functions as F

from gridlens import settle
from gridlens.session import scratch_path
from gridlens.functions.numeric import one_row
from gridlens.operators import batch, partials, quality, sketches
from gridlens.operators.cleaning import spread_of
from registry import views
from registry.catalog import check
from registry.sql import mean, pct, rnd, total, using
from registry.views import CUSTOMER, ROLES


@check("join_fact_dim", using("places", body="""
SELECT l_orderkey AS NRO_DOC_FAC, l_linenumber, l_quantity AS CONSUMO, l_extendedprice AS IMPORTE, DEPARTAMENTO,
       DISTRITO, o_orderpriority AS TARIFA, CARTERA
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN places ON o_custkey = cliente"""))
def _(spark, folder):
    fact = views.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias(ROLES.document), "l_linenumber",
        F.col("l_quantity").alias(ROLES.consumption), F.col("l_extendedprice").alias(ROLES.amount),
    )
    dim = views.order_dim(spark, folder).withColumnRenamed("l_orderkey", ROLES.document).drop(CUSTOMER, "o_orderdate")
    return batch.join_fact_dim(fact, dim)


STATISTICS = f"""
SELECT DISTRITO, TARIFA, CARTERA, {mean('CONSUMO')} AS consumo_promedio,
       round(coalesce(stddev_samp(CONSUMO), 0), 4) AS consumo_std, {mean('IMPORTE')} AS importe_promedio,
       round(coalesce(stddev_samp(IMPORTE), 0), 4) AS importe_std, min(CONSUMO) AS consumo_minimo,
       max(CONSUMO) AS consumo_maximo, count(*) AS total_registros
FROM invoices GROUP BY DISTRITO, TARIFA, CARTERA"""


def rounded(stats):
    return stats.withColumns({c: F.round(c, 4) for c in ("consumo_std", "importe_std")})


@check("historical_statistics", using("invoices", body=STATISTICS))
def _(spark, folder):
    return rounded(batch.historical_statistics(views.invoices(spark, folder)))


@check("global_kpis", using("kpis", body="SELECT indicador, valor FROM kpis"))
def _(spark, folder):
    return batch.global_kpis(views.invoices(spark, folder))


@check("global_stats_cross", using("readings", body="""
SELECT NRO_DOC_FAC, CONSUMO, round(mc, 6) AS media, round(sc, 4) AS desviacion
FROM readings, (SELECT avg(CONSUMO) AS mc, stddev_samp(CONSUMO) AS sc FROM readings)"""))
def _(spark, folder):
    rows = views.readings(spark, folder)
    spread = one_row(spread_of(rows, [ROLES.consumption]))
    return rows.select(
        ROLES.document, ROLES.consumption, F.round(spread["CONSUMO_mean"], 6).alias("media"),
        F.round(spread["CONSUMO_std"], 4).alias("desviacion"),
    )


TOTALS = f"{total('IMPORTE')} AS total_importe, {total('CONSUMO')} AS total_consumo, count(*) AS cantidad_registros"


@check("department_ranking", using("invoices", body=f"SELECT DEPARTAMENTO, {TOTALS} FROM invoices GROUP BY 1"))
def _(spark, folder):
    return batch.department_ranking(views.invoices(spark, folder))


@check("monthly_trend", using("invoices", body=f"SELECT PERIODO, {TOTALS} FROM invoices GROUP BY 1"))
def _(spark, folder):
    return batch.monthly_trend(views.invoices(spark, folder))


@check("trend_export", using("invoices", body=f"""
SELECT PERIODO AS periodo, {total('CONSUMO')} AS consumo, {total('IMPORTE')} AS importe FROM invoices GROUP BY 1"""))
def _(spark, folder):
    return batch.trend_export(batch.monthly_trend(views.invoices(spark, folder)))


@check("rate_portfolio_analysis", using("invoices", body=f"""
SELECT TARIFA, CARTERA, {total('IMPORTE')} AS total_importe, {mean('CONSUMO')} AS consumo_promedio,
       count(*) AS cantidad_registros FROM invoices GROUP BY 1, 2"""))
def _(spark, folder):
    return batch.rate_portfolio_analysis(views.invoices(spark, folder))


@check("fill_zero", using("invoices", body="""
SELECT NRO_DOC_FAC, round(coalesce(stddev_samp(CONSUMO), 0), 4) AS consumo_std, count(*) AS filas
FROM invoices GROUP BY 1"""))
def _(spark, folder):
    spread = views.invoices(spark, folder).groupBy(ROLES.document).agg(
        F.round(F.stddev(ROLES.consumption), 4).alias("consumo_std"), F.count("*").alias("filas")
    )
    return batch.fill_zero(spread)


@check("top_customers", using("invoices", body=f"""
SELECT cliente, {total('CONSUMO')} AS total_consumo FROM invoices GROUP BY 1
ORDER BY total_consumo DESC, cliente LIMIT 10"""))
def _(spark, folder):
    return batch.top_customers(views.invoices(spark, folder), CUSTOMER)


def _rfm(spark, folder):
    return batch.rfm_base(views.invoices(spark, folder), CUSTOMER)


@check("rfm_base", using("rfm", body="SELECT cliente, recency, frequency, monetary FROM rfm"))
def _(spark, folder):
    return batch.rfm_base(views.invoices(spark, folder), CUSTOMER)


@check("rfm_terciles", using("rfm", body="SELECT columna, round(probabilidad, 6) AS probabilidad, valor FROM terciles"))
def _(spark, folder):
    return batch.rfm_terciles(_rfm(spark, folder)).withColumn("probabilidad", F.round("probabilidad", 6))


@check("rfm_segments", using("rfm", body="SELECT * FROM segments"))
def _(spark, folder):
    rfm = _rfm(spark, folder)
    return batch.rfm_segments(rfm, batch.rfm_terciles(rfm))


@check("rfm_segment_counts", using("rfm", body=f"""
SELECT segmento, n AS clientes, {pct('n', 't', 1)} AS pct
FROM (SELECT segmento, count(*) AS n, sum(count(*)) OVER () AS t FROM segments GROUP BY segmento)"""))
def _(spark, folder):
    rfm = _rfm(spark, folder)
    return batch.rfm_segment_counts(batch.rfm_segments(rfm, batch.rfm_terciles(rfm)))


@check("reconcile_totals", using("kpis", body=f"""
SELECT tabla, {rnd(total('IMPORTE'), 2)} AS importe, CAST(count(*) AS DOUBLE) AS registros,
       {rnd(total('IMPORTE'), 2)} AS importe_global, CAST(count(*) AS DOUBLE) AS registros_global, true AS cuadra
FROM invoices, (SELECT unnest(['ranking', 'tendencia', 'tarifa_cartera']) AS tabla) GROUP BY tabla"""))
def _(spark, folder):
    joined = settle(views.invoices(spark, folder), "joined")
    return quality.reconcile_totals(batch.global_kpis(joined), {
        "ranking": batch.department_ranking(joined), "tendencia": batch.monthly_trend(joined),
        "tarifa_cartera": batch.rate_portfolio_analysis(joined),
    })


def _states(spark, folder):
    """States of all invoices, written in two runs, of which the second repeats the last months of the first."""
    invoices = settle(views.invoices(spark, folder), "invoices")
    path = scratch_path(spark, "states")
    partials.store(invoices.filter(F.col(ROLES.period) < 199607), path)
    partials.store(invoices.filter(F.col(ROLES.period) >= 199601), path)
    return invoices, path


@check("statistics_from_states", using("invoices", body=STATISTICS))
def _(spark, folder):
    _, path = _states(spark, folder)
    return rounded(partials.statistics(partials.read(spark, path, partials.GROUPS)))


@check("kpis_from_states", using("kpis", body="SELECT indicador, valor FROM kpis"))
def _(spark, folder):
    invoices, path = _states(spark, folder)
    states = partials.read(spark, path, partials.GROUPS)
    return partials.kpis(states, partials.exact_documents(spark, path), invoices.select(*ROLES.measures))


@check("trend_from_states", using("invoices", body=f"SELECT PERIODO, {TOTALS} FROM invoices GROUP BY 1"))
def _(spark, folder):
    _, path = _states(spark, folder)
    return partials.totals_by(partials.read(spark, path, partials.GROUPS), [ROLES.period])


CHANCES = (0.01, 0.25, 0.5, 0.75, 0.99)


@check("quantiles_from_states", using("invoices", body="""
SELECT columna, probabilidad, count(*) AS filas, true AS dentro
FROM invoices, (SELECT unnest(['CONSUMO', 'IMPORTE']) AS columna), (SELECT unnest([0.01, 0.25, 0.5, 0.75, 0.99]) AS probabilidad)
GROUP BY ALL""").replace("probabilidad, count", "CAST(probabilidad AS DOUBLE) AS probabilidad, count"))
def _(spark, folder):
    """Merged sketches, each value held against the ranks that all rows give it."""
    invoices, path = _states(spark, folder)
    found = partials.quantiles(spark, path, CHANCES).withColumnRenamed("valor", "cota")
    error = sketches.rank_error()
    values = invoices.unpivot([], list(ROLES.measures), "columna", "valor")
    # Ten rows meet every value: the quantiles that were asked for.
    ranks = values.join(F.broadcast(found), "columna").groupBy("columna", "probabilidad").agg(
        F.count("*").alias("filas"), F.count_if(F.col("valor") < F.col("cota")).alias("menores"),
        F.count_if(F.col("valor") <= F.col("cota")).alias("hasta"))
    inside = (F.col("menores") / F.col("filas") - error <= F.col("probabilidad")) & (
        F.col("probabilidad") <= F.col("hasta") / F.col("filas") + error)
    return ranks.select("columna", "probabilidad", "filas", inside.alias("dentro"))
