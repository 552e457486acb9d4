"""Batch tables over the joined invoices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridlens.functions.numeric import exact_avg, exact_sum, one_row, share_pct
from gridlens.functions.rules import first_match, rfm_segment
from gridlens.operators.cleaning import spread_of
from gridlens.operators.ordering import exact_quantiles, quantile_row, sketched_quantiles
from gridlens.roles import DEFAULT, Roles
from gridlens.session import settle

TERCILES = (1 / 3, 2 / 3)


def join_fact_dim(fact: DataFrame, dim: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """Invoices with their location. No repartition afterwards: the aggregates combine before they shuffle."""
    return fact.join(dim, roles.document, "inner")


def historical_statistics(joined: DataFrame, roles: Roles = DEFAULT, ordered: bool = True) -> DataFrame:
    """Mean, deviation and range per (district, tariff, portfolio); an undefined deviation is 0.

    The order is for readers; leave it out when the table is only joined.
    """
    consumption, amount = roles.measures
    stats = (
        joined.groupBy(*roles.group)
        .agg(
            exact_avg(consumption).alias("consumo_promedio"),
            F.stddev(consumption).alias("consumo_std"),
            exact_avg(amount).alias("importe_promedio"),
            F.stddev(amount).alias("importe_std"),
            F.min(consumption).alias("consumo_minimo"),
            F.max(consumption).alias("consumo_maximo"),
            F.count("*").alias("total_registros"),
        )
        .transform(fill_zero)
    )
    return stats.orderBy(*roles.group) if ordered else stats


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null numbers become 0."""
    return df.na.fill(0, list(columns) if columns else None)


def global_kpis(joined: DataFrame, roles: Roles = DEFAULT, approximate_documents: float | None = None) -> DataFrame:
    """Eight indicators as rows (indicador, valor). Three passes over three columns, which are written once."""
    consumption, amount = roles.measures
    joined = settle(joined.select(roles.document, *roles.measures), "kpi-columns")
    # Counted on its own: in one aggregate with the sums, every document would be shuffled with all of them.
    documents = joined.agg(
        F.approx_count_distinct(roles.document, approximate_documents)
        if approximate_documents else F.countDistinct(roles.document)
    ).scalar()
    spread = one_row(spread_of(joined, roles.measures))
    spreads = spread[f"{consumption}_std"], spread[f"{amount}_std"]
    far = [
        F.abs(F.col(c) - spread[f"{c}_mean"]) / F.nullif(spread[f"{c}_std"], F.lit(0.0)) > 3 for c in roles.measures
    ]
    totals = joined.agg(
        exact_sum(amount).alias("importe"),
        exact_sum(consumption).alias("consumo"),
        exact_avg(amount).alias("ticket"),
        exact_avg(consumption).alias("consumo_medio"),
        F.count("*").alias("registros"),
        F.count_if((spreads[0] > 0) & (spreads[1] > 0) & (far[0] | far[1])).alias("outliers"),
    )
    indicators = {
        "facturacion_total_soles": F.round("importe", 2),
        "consumo_total_kwh": F.round("consumo", 2),
        "total_facturas": documents,
        "ticket_promedio": F.round("ticket", 2),
        "consumo_promedio_global": F.round("consumo_medio", 2),
        "total_registros": F.col("registros"),
        "registros_outliers": F.col("outliers"),
        "tasa_outlier_pct": share_pct(F.col("outliers"), F.col("registros")),
    }
    wide = totals.select(*[
        F.coalesce(value.cast("double"), F.lit(0.0)).alias(name) for name, value in indicators.items()
    ])
    return wide.unpivot([], list(indicators), "indicador", "valor")


def totals_by(joined: DataFrame, keys: Sequence[str], roles: Roles = DEFAULT) -> DataFrame:
    return joined.groupBy(*keys).agg(
        exact_sum(roles.amount).alias("total_importe"),
        exact_sum(roles.consumption).alias("total_consumo"),
        F.count("*").alias("cantidad_registros"),
    )


def department_ranking(joined: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    return totals_by(joined, [roles.department], roles).orderBy(F.desc("total_importe"), roles.department)


def monthly_trend(joined: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    return totals_by(joined, [roles.period], roles).orderBy(roles.period)


def trend_export(trend: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    """The trend as the front end reads it."""
    return trend.select(
        F.col(roles.period).cast("int").alias("periodo"),
        F.col("total_consumo").cast("double").alias("consumo"),
        F.col("total_importe").cast("double").alias("importe"),
    )


def rate_portfolio_analysis(joined: DataFrame, roles: Roles = DEFAULT) -> DataFrame:
    keys = [roles.tariff, roles.portfolio]
    return (
        joined.groupBy(*keys)
        .agg(
            exact_sum(roles.amount).alias("total_importe"),
            exact_avg(roles.consumption).alias("consumo_promedio"),
            F.count("*").alias("cantidad_registros"),
        )
        .orderBy(F.desc("total_importe"), *keys)
    )


def top_customers(joined: DataFrame, customer: str, k: int = 10, roles: Roles = DEFAULT) -> DataFrame:
    return (
        joined.groupBy(customer).agg(exact_sum(roles.consumption).alias("total_consumo"))
        .orderBy(F.desc("total_consumo"), customer).limit(k)
    )


def rfm_base(joined: DataFrame, customer: str | None = None, roles: Roles = DEFAULT) -> DataFrame:
    """Days since the last purchase, distinct periods and total amount of each customer.

    The newest date is taken from the stored per-customer rows, so the invoices are read once.
    """
    customer = customer or roles.document
    per_customer = settle(joined.groupBy(customer).agg(
        F.max(F.to_date(F.col(roles.issued))).alias("_last"),
        F.countDistinct(roles.period).alias("frequency"),
        exact_sum(roles.amount).alias("monetary"),
    ), "customers")
    newest = F.coalesce(per_customer.agg(F.max("_last")).scalar(), F.current_date())
    return fill_zero(
        per_customer.select(customer, F.datediff(newest, F.col("_last")).alias("recency"), "frequency", "monetary"),
        ["recency", "frequency", "monetary"],
    )


def rfm_terciles(rfm: DataFrame, relative_error: float | None = None) -> DataFrame:
    """Lower and upper tercile of each measure as rows; exact unless an error is allowed."""
    columns = ["recency", "frequency", "monetary"]
    if relative_error:
        return sketched_quantiles(rfm, columns, TERCILES, relative_error)
    return exact_quantiles(rfm, columns, TERCILES, discrete=True)


def rfm_segments(rfm: DataFrame, terciles: DataFrame) -> DataFrame:
    """Scores 1 to 3 per measure (recent is good), their total and the segment."""
    columns = {"recency": "r", "frequency": "f", "monetary": "m"}
    names = {(c, p): f"{short}{i}" for c, short in columns.items() for i, p in enumerate(TERCILES, 1)}
    cuts = one_row(settle(quantile_row(terciles, names), "cuts"))

    def score(column: str, scores: tuple[int, int, int]) -> Column:
        low, high = (F.coalesce(cuts[f"{columns[column]}{i}"], F.lit(0.0)) for i in (1, 2))
        return first_match([(F.col(column) <= low, scores[0]), (F.col(column) <= high, scores[1])], scores[2])

    scored = rfm.withColumns({
        "r_score": score("recency", (3, 2, 1)),
        "f_score": score("frequency", (1, 2, 3)),
        "m_score": score("monetary", (1, 2, 3)),
    })
    scored = scored.withColumn("rfm_total", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    customer = rfm.columns[0]
    return scored.withColumn("segmento", rfm_segment(F.col("rfm_total"))).orderBy(F.desc("rfm_total"), customer)


def rfm_segment_counts(segments: DataFrame) -> DataFrame:
    """Customers and share of each segment."""
    counts = segments.groupBy("segmento").agg(F.count("*").alias("clientes"))
    everyone = counts.agg(F.sum("clientes")).scalar()
    return counts.withColumn("pct", share_pct(F.col("clientes"), everyone, 1)).orderBy(F.desc("clientes"), "segmento")
